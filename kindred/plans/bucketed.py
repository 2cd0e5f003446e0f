"""Lookups in catalog tables bucketed by what they are joined by, so that they are never shuffled again.

A lookup is published twice: bucketed and sorted by key for enrichment, and by
canonical id for masters. Every later enrichment moves its own rows to the buckets;
the lookup, usually the larger side of an increment, stays where it is.

The number of buckets should be no less than ``spark.sql.shuffle.partitions``: of two
layouts Spark keeps the one with more parts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.hashing import canonical_hash, mask_of
from kindred.operators.skew import HOT_FLOOR, hot_keys, row_spread
from kindred.plans.config import CanonicalId, Config, Master, Table
from kindred.plans.extract import key_structs
from kindred.plans.master import master_table
from kindred.sources.tables import write_bucketed

BUCKETS = 512
#: Rows that match nothing are dealt to this many places.
SPREAD = 1 << 20


@dataclass(frozen=True)
class BucketedLookup:
    """Names of the two catalog tables of a lookup."""

    by_key: str
    by_id: str


def publish_lookup(lookup: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> BucketedLookup:
    """Write ``name``_by_key and ``name``_by_id with equal numbers of buckets; ``path`` is a folder for their files."""
    done = BucketedLookup(f"{name}_by_key", f"{name}_by_id")
    keyed = lookup.select("id", "id_key_type", "canonical_id")
    write_bucketed(keyed, done.by_key, ["id", "id_key_type"], buckets, path and f"{path}/by_key")
    write_bucketed(lookup.select("canonical_id").distinct(), done.by_id, ["canonical_id"], buckets, path and f"{path}/by_id")
    return done


def enrich_bucketed(
    df: DataFrame, cfg: Config, canonical: CanonicalId, table: Table, published: BucketedLookup, floor: int = HOT_FLOOR, rows: int | None = None
) -> DataFrame:
    """The rows of ``enrich`` with one shuffle, that of ``df`` to the lookup's buckets.

    Keys of more than ``floor`` rows find their id in a broadcast list, which has at most one entry per ``floor``
    rows, and are dealt over all buckets with the rows that have no key; so no bucket takes more of one key than that.
    """
    spark = df.sparkSession
    structs = key_structs(cfg, canonical, table)
    if not structs:
        return df.withColumn(canonical.name, F.lit(None).cast("string"))
    known = spark.table(published.by_key).select(F.col("id").alias("_id"), F.col("id_key_type").alias("_ns"), F.col("canonical_id").alias("_found"))
    keyed = df.withColumn("_key", F.coalesce(*structs)).withColumns({"_own_id": F.col("_key.id"), "_own_ns": F.col("_key.ns")}).drop("_key")
    hot = hot_keys(keyed, ["_own_id", "_own_ns"], df.count() if rows is None else rows, floor)
    if hot is None:
        keyed = keyed.withColumns({"_hot": F.lit(False), "_hot_found": F.lit(None).cast("string")})
    else:
        named = hot.select(F.col("_own_id").alias("_id"), F.col("_own_ns").alias("_ns"))
        ids = known.join(F.broadcast(named), ["_id", "_ns"]).select(F.col("_id").alias("_own_id"), F.col("_ns").alias("_own_ns"), F.col("_found").alias("_hot_found"))
        listed = hot.select("_own_id", "_own_ns", F.lit(True).alias("_hot")).join(F.broadcast(ids), ["_own_id", "_own_ns"], "left")
        keyed = keyed.join(F.broadcast(listed), ["_own_id", "_own_ns"], "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    # Numbers below zero belong to no key type, so these rows meet nothing and lie anywhere.
    nowhere = F.col("_hot") | F.col("_own_id").isNull()
    dealt = keyed.withColumns({
        "_id": F.coalesce("_own_id", F.lit("")),
        "_ns": F.when(nowhere, -1 - F.pmod(row_spread(df), F.lit(SPREAD))).otherwise(F.col("_own_ns")),
    })
    joined = dealt.join(known, ["_id", "_ns"], "left")
    own = canonical_hash(F.col("_own_id"), mask_of(F.col("_own_ns"), len(canonical.merge_by_keys)))
    return joined.select(*df.columns, F.coalesce("_hot_found", "_found", own).alias(canonical.name))


def master_bucketed(spark: SparkSession, master: Master, enriched: Mapping[str, DataFrame], published: BucketedLookup) -> DataFrame:
    """Masters of the ids of a published lookup. Values are combined before they move to the lookup's buckets."""
    return master_table(master, enriched, spark.table(published.by_id))
