"""Canonical ids on the source rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.hashing import canonical_hash, mask_of
from kindred.operators.prep import apply_exclusions
from kindred.operators.skew import HOT_FLOOR, salted_join
from kindred.plans.config import CanonicalId, Config, Table
from kindred.plans.extract import key_structs


def enrich(
    df: DataFrame,
    cfg: Config,
    canonical: CanonicalId,
    table: Table,
    lookup: DataFrame,
    by_merge_order: bool = False,
    floor: int = HOT_FLOOR,
    rows: int | None = None,
) -> DataFrame:
    """All rows and columns, plus the canonical id of the first valid key.

    A key the lookup does not know gets its own hash; a row without a valid key NULL.
    ``rows`` is the number of rows, where the caller knows it.
    """
    structs = key_structs(cfg, canonical, table, by_merge_order)
    if not structs:
        return df.withColumn(canonical.name, F.lit(None).cast("string"))
    rows = df.count() if rows is None else rows
    keyed = df.withColumn("_key", F.coalesce(*structs)).withColumns({"_id": F.col("_key.id"), "_ns": F.col("_key.ns")})
    known = lookup.select(F.col("id").alias("_id"), F.col("id_key_type").alias("_ns"), F.col("canonical_id").alias("_found"))
    joined = salted_join(keyed, known, ["_id", "_ns"], "left", floor=floor, total=rows)
    own = canonical_hash(F.col("_id"), mask_of(F.col("_ns"), len(canonical.merge_by_keys)))
    return joined.select(*df.columns, F.coalesce("_found", own).alias(canonical.name))


def enrich_excluding(
    df: DataFrame,
    canonical: CanonicalId,
    table: Table,
    lookup: DataFrame,
    exclusions: DataFrame,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Variant with an exclusion list: listed values become NULL first, key columns
    turn empty text into NULL, the first non-empty key decides, and an unknown key
    stays without an id."""
    rows = df.count()
    columns: Mapping[str, str] = {kc.column: kc.key for kc in table.key_columns}
    cleaned = apply_exclusions(df, exclusions, columns, floor=floor)
    texts = {c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns}
    cleaned = cleaned.select(*[texts[c].alias(c) if c in texts else F.col(c) for c in cleaned.columns])
    pairs = [
        F.when(F.col(kc.column).isNotNull(), F.struct(F.col(kc.column).alias("id"), F.lit(canonical.ns(kc.key)).cast("long").alias("ns")))
        for kc in table.key_columns
        if kc.key in canonical.merge_by_keys
    ]
    keyed = cleaned.withColumn("_key", F.coalesce(*pairs)).withColumns({"_id": F.col("_key.id"), "_ns": F.col("_key.ns")})
    known = lookup.select(F.col("id").alias("_id"), F.col("id_key_type").alias("_ns"), F.col("canonical_id").alias(canonical.name))
    joined = salted_join(keyed, known, ["_id", "_ns"], "left", floor=floor, total=rows)
    return joined.select(*df.columns, canonical.name)
