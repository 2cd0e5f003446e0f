"""Merge statistics, coverage, quality and monitoring reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.clock import epoch_text

# Label and upper bound of each merge class, smallest first.
MERGE_CLASSES = [
    ("1 identity (no merge)", 1),
    ("2 identities merged", 2),
    ("3-5 identities merged", 5),
    ("6-10 identities merged", 10),
    ("10+ identities merged", None),
]


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL when there is nothing to compare with."""
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), digits)


def key_stats_report(stats: DataFrame) -> DataFrame:
    return stats.orderBy("from_table")


def identity_counts(lookup: DataFrame) -> DataFrame:
    """Identifiers per canonical id; the base of the reports below."""
    return lookup.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("identity_count"))


def canonical_counts(lookup: DataFrame) -> DataFrame:
    """Identifiers, profiles, merge ratio and reduction."""
    totals = identity_counts(lookup).agg(
        F.coalesce(F.sum("identity_count"), F.lit(0)).alias("total_canonical_ids"),
        F.count(F.lit(1)).alias("unique_canonical_ids"),
    )
    total, unique = F.col("total_canonical_ids"), F.col("unique_canonical_ids")
    return totals.select(
        total,
        unique,
        F.round(total / F.nullif(unique, F.lit(0)), 2).alias("merge_ratio"),
        pct(total - unique, total, 1).alias("fragmentation_reduction_pct"),
    )


def top_merged(lookup: DataFrame, n: int = 10) -> DataFrame:
    """The n largest profiles."""
    return identity_counts(lookup).orderBy(F.desc("identity_count"), "canonical_id").limit(n)


def merge_distribution(lookup: DataFrame) -> DataFrame:
    """Profiles and identifiers per merge class, with shares; one aggregation for all classes."""
    n, one = F.col("identity_count"), F.lit(1)
    lower, aggregates, classes = 0, [F.count(one).alias("_profiles"), F.sum(n).alias("_ids")], []
    for i, (label, upper) in enumerate(MERGE_CLASSES):
        inside = (n > lower) if upper is None else (n > lower) & (n <= upper)
        aggregates += [F.count_if(inside).alias(f"_p{i}"), F.sum(F.when(inside, n)).alias(f"_i{i}")]
        classes.append(
            F.struct(
                F.lit(label).alias("merge_category"),
                F.lit(i + 1).alias("class_order"),
                F.col(f"_p{i}").alias("canonical_id_count"),
                F.col(f"_i{i}").alias("total_identities"),
                pct(F.col(f"_p{i}"), F.col("_profiles")).alias("pct_of_profiles"),
                pct(F.col(f"_i{i}"), F.col("_ids")).alias("pct_of_identities"),
            )
        )
        lower = upper
    rows = identity_counts(lookup).agg(*aggregates).select(F.inline(F.array(*classes)))
    return rows.filter(F.col("canonical_id_count") > 0).orderBy("class_order")


def key_type_distribution(lookup: DataFrame, key_dim: DataFrame) -> DataFrame:
    """Per key type: identifiers and distinct profiles. ``key_dim`` has one row per merge key."""
    per_profile = lookup.groupBy("id_key_type", "canonical_id").agg(F.count(F.lit(1)).alias("n"))
    per_type = per_profile.groupBy("id_key_type").agg(
        F.sum("n").alias("identity_count"), F.count(F.lit(1)).alias("unique_canonical_ids")
    )
    names = key_dim.select(F.col("key_type").alias("id_key_type"), "key_name")
    return (
        per_type.join(F.broadcast(names), "id_key_type", "left")
        .select(
            "id_key_type",
            F.coalesce("key_name", F.col("id_key_type").cast("string")).alias("key_name"),
            "identity_count",
            "unique_canonical_ids",
        )
        .orderBy("id_key_type")
    )


def attribute_coverage(master: DataFrame, canonical: str) -> DataFrame:
    """Per attribute: filled profiles, share, and average length of array attributes."""
    structs = []
    aggregates = [F.count(F.lit(1)).alias("_total")]
    for f in master.schema.fields:
        if f.name == canonical:
            continue
        is_array = isinstance(f.dataType, T.ArrayType)
        filled = (F.size(f.name) > 0) if is_array else F.col(f.name).isNotNull()
        aggregates.append(F.count_if(filled).alias(f"n_{f.name}"))
        aggregates.append((F.avg(F.size(f.name)) if is_array else F.lit(None).cast("double")).alias(f"a_{f.name}"))
        structs.append(
            F.struct(
                F.lit(f.name).alias("attribute"),
                F.col("_total").alias("total_records"),
                F.col(f"n_{f.name}").alias("filled"),
                pct(F.col(f"n_{f.name}"), F.col("_total")).alias("coverage_pct"),
                F.round(f"a_{f.name}", 2).alias("avg_elements"),
            )
        )
    return master.agg(*aggregates).select(F.inline(F.array(*structs)))


def sample(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """n rows, the same on every run."""
    return df.orderBy(key).limit(n)


def config_rule_report(column_lookup: DataFrame, filter_lookup: DataFrame) -> DataFrame:
    """Which rule applies to which column. Both are configuration tables."""
    return column_lookup.join(filter_lookup, "key_name", "left").orderBy("table_name", "key_name", "column_name")


def master_reconcile(master: DataFrame, lookup: DataFrame) -> DataFrame:
    """Does the master table have one row per profile?"""
    rows = master.agg(F.count(F.lit(1)).alias("total_records"))
    ids = lookup.select("canonical_id").distinct().agg(F.count(F.lit(1)).alias("unique_canonical_ids"))
    both = rows.unionByName(ids, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in ("total_records", "unique_canonical_ids")])
    return both.withColumn("is_equal", F.col("total_records") == F.col("unique_canonical_ids"))


def dedup_rates(source_stats: DataFrame, result_stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How much fewer profiles there are than identifiers of each key, in percent."""
    source = source_stats.filter(F.col("from_table") == "*").select(*[F.col(f"distinct_{k}").alias(f"source_{k}") for k in keys])
    result = result_stats.filter(F.col("from_table") == "*").select(F.col("total_distinct").alias("final_canonical_ids"))
    # Each side is one row; the union of both is folded into one.
    both = source.unionByName(result, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    rates = [pct(F.col(f"source_{k}") - F.col("final_canonical_ids"), F.col(f"source_{k}"), 1).alias(f"{k}_dedup_pct") for k in keys]
    return both.select("*", *rates)


def badge(coverage: Column) -> Column:
    return F.when(coverage >= 95, "Excellent").when(coverage >= 85, "Good").otherwise("Needs Improvement")


def quality_score(coverage: DataFrame) -> DataFrame:
    """Mean coverage of all attributes and its badge."""
    return coverage.agg(F.round(F.avg("coverage_pct"), 2).alias("quality_score")).withColumn("badge", badge(F.col("quality_score")))


def convergence_report(spark: SparkSession, metrics: Sequence[Mapping]) -> DataFrame:
    """One row per step, at most as many as the step limit."""
    rows = [(m["iteration"], m["edge_count"], m["updated_count"]) for m in metrics]
    return spark.createDataFrame(rows, "iteration bigint, edge_count bigint, updated_count bigint").orderBy("iteration")


def id_coverage(tables: Mapping[str, DataFrame], id_column: str, threshold: float = 90.0) -> DataFrame:
    """Per table: rows, rows with an id, share, and whether the share is above the threshold."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total_records"), F.count(id_column).alias("with_canonical_id")).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    rows = rows.withColumn("coverage_pct", pct(F.col("with_canonical_id"), F.col("total_records")))
    return rows.withColumn("passed", F.coalesce(F.col("coverage_pct") > threshold, F.lit(False)))


def last_ingestion(ledger: DataFrame, source: str) -> DataFrame:
    latest = ledger.filter((F.col("source_name") == source) & (F.col("status") == "SUCCESS")).agg(F.max("time").alias("last_ingestion_timestamp"))
    return latest.withColumn("last_ingestion", epoch_text(F.col("last_ingestion_timestamp")))


def recent_failures(ledger: DataFrame, n: int = 10) -> DataFrame:
    failed = ledger.filter(F.col("status") == "ERROR").orderBy(F.desc("time"), "log_id").limit(n)
    return failed.select("source_name", "table_name", "error_message", "end_time", "time")


def freshness(tables: Mapping[str, DataFrame], col: str) -> DataFrame:
    """Per table: rows, first and latest record."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total_records"), F.min(col).alias("first_record"), F.max(col).alias("latest_record")
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def key_presence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"has_{c}") for c in columns])


def check_outputs(stats: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tables by phase against found ones: error when missing, warning when empty."""
    found = stats.select("table_name", "exists", "row_count")
    state = (
        F.when(~F.coalesce("exists", F.lit(False)), "error").when(F.col("row_count") == 0, "warning").otherwise("ok")
    )
    return expected.join(found, "table_name", "left").select("phase", "table_name", "row_count", state.alias("result"))


def merge_outliers(lookup: DataFrame, min_ids: int = 10) -> DataFrame:
    """Profiles with more identifiers than looks healthy."""
    return identity_counts(lookup).filter(F.col("identity_count") > min_ids)
