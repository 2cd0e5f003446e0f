"""Master profiles: best values per canonical id."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.skew import salted_join
from kindred.plans.config import Attribute, Master, SourceColumn
from kindred.sources.scratch import Scratch


def best_value(value: str, order: str, newest: bool = True) -> Column:
    """Aggregate: the non-null value with the highest (or lowest) order.

    A missing order counts as oldest; equal orders are settled by the value.
    """
    pair = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    return (F.max(pair) if newest else F.min(pair))["v"]


def master_value(df: DataFrame, canonical: str, column: str, order_by: str, name: str, newest: bool = True) -> DataFrame:
    """One attribute from one enriched table."""
    return df.filter(F.col(canonical).isNotNull()).groupBy(canonical).agg(best_value(column, order_by, newest).alias(name))


def _source_rows(df: DataFrame, canonical: str, source: SourceColumn, place: int) -> DataFrame:
    return df.filter(F.col(canonical).isNotNull() & F.col(source.column).isNotNull()).select(
        canonical, F.lit(place).alias("_place"), F.col(source.order_by).alias("_order"), F.col(source.column).alias("_value")
    )


def master_array(enriched: Mapping[str, DataFrame], canonical: str, attribute: Attribute) -> DataFrame:
    """The newest n values of each source, sources in order, cut to n. Repeats stay.

    The row limit bounds every group before anything is collected.
    """
    n, sources = attribute.array_elements, attribute.ranked()
    rows = reduce(
        DataFrame.unionByName,
        [_source_rows(enriched[s.table], canonical, s, i) for i, s in enumerate(sources) if s.table in enriched],
    )
    newest_first = Window.partitionBy(canonical, "_place").orderBy(F.col("_order").desc_nulls_last(), F.col("_value").desc())
    top = rows.withColumn("_rn", F.row_number().over(newest_first)).filter(F.col("_rn") <= n)
    ordered = F.sort_array(F.collect_list(F.struct("_place", "_rn", "_value")))
    return top.groupBy(canonical).agg(F.slice(F.transform(ordered, lambda x: x["_value"]), 1, n).alias(attribute.name))


def _single_columns(attribute: Attribute) -> list[tuple[SourceColumn, str, str]]:
    return [(s, f"_{attribute.name}_{i}_v", f"_{attribute.name}_{i}_o") for i, s in enumerate(attribute.ranked())]


def master_table(master: Master, enriched: Mapping[str, DataFrame], lookup: DataFrame) -> DataFrame:
    """One row per canonical id that the lookup knows.

    All single values come from one aggregation over the padded union of the
    contributing tables.
    """
    canonical = master.canonical_id
    singles = [a for a in master.attributes if not a.array_elements]
    arrays = [a for a in master.attributes if a.array_elements]
    tables: list[str] = []
    for attribute in master.attributes:
        tables += [s.table for s in attribute.source_columns if s.table in enriched and s.table not in tables]

    parts = []
    for name in tables:
        columns = [F.col(canonical)]
        for attribute in singles:
            for source, value, order in _single_columns(attribute):
                if source.table == name:
                    columns += [F.col(source.column).alias(value), F.col(source.order_by).alias(order)]
        parts.append(enriched[name].filter(F.col(canonical).isNotNull()).select(*columns))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    chosen = []
    for attribute in singles:
        options = [
            best_value(value, order, newest=source.order == "last")
            for source, value, order in _single_columns(attribute)
            if source.table in enriched
        ]
        chosen.append((F.coalesce(*options) if options else F.lit(None).cast("string")).alias(attribute.name))
    profiles = rows.groupBy(canonical).agg(*chosen) if chosen else rows.select(canonical).distinct()
    for attribute in arrays:
        profiles = profiles.join(master_array(enriched, canonical, attribute), canonical, "left")
    profiles = profiles.select(
        canonical,
        *[
            F.coalesce(a.name, F.array().cast(profiles.schema[a.name].dataType)).alias(a.name) if a.array_elements else F.col(a.name)
            for a in master.attributes
        ],
    )
    known = lookup.select(F.col("canonical_id").alias(canonical)).distinct()
    return profiles.join(known, canonical, "left_semi")


def master_counts(
    enriched: DataFrame, canonical: str, id_column: str, ids_name: str, count_name: str, part_size: int = 100_000
) -> DataFrame:
    """Per profile: its distinct ids as a sorted text list, and the number of records.

    A profile with more than ``part_size`` ids is delivered in several rows, told
    apart by ``part``, each with a share of the ids; the record count is that of the
    whole profile. So no list grows with the data, and none is cut.
    """
    rows = enriched.filter(F.col(canonical).isNotNull())
    per_id = rows.groupBy(canonical, F.col(id_column).cast("string").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    # Read three times below, so it is written once.
    per_id = Scratch(enriched.sparkSession, "counts").save(per_id, "ids")
    sizes = per_id.groupBy(canonical).agg(F.count("_id").alias("_ids"), F.sum("_n").alias(count_name))
    sizes = sizes.withColumn("_ways", F.greatest(F.ceil(F.col("_ids") / part_size), F.lit(1)))
    # Only oversized profiles need to know their number of parts: few rows, by their size.
    large = sizes.filter(F.col("_ways") > 1).select(canonical, "_ways")
    split = salted_join(per_id, large, [canonical], "left")
    part = F.pmod(F.xxhash64("_id"), F.coalesce("_ways", F.lit(1))).cast("int")
    lists = split.groupBy(canonical, part.alias("part")).agg(F.sort_array(F.collect_list("_id")).alias(ids_name))
    return lists.join(sizes.select(canonical, count_name), canonical).select(canonical, "part", ids_name, count_name)
