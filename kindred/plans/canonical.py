"""Canonical ids, the identifier lookup and the small reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.hashing import canonical_hash, mask_of
from kindred.operators.skew import HOT_FLOOR, salted_join
from kindred.plans.config import CanonicalId, Config
from kindred.plans.resolve import LEADER


def component_table(graph: DataFrame, canonical: CanonicalId) -> DataFrame:
    """One row per component: leader, canonical id, first and last time seen.

    The id is hashed once per component, not once per identifier.
    """
    mask = mask_of(F.col("leader_ns"), len(canonical.merge_by_keys))
    return (
        graph.groupBy(*LEADER)
        .agg(
            F.min("follower_first_seen_at").alias("canonical_id_first_seen_at"),
            F.max("follower_last_seen_at").alias("canonical_id_last_seen_at"),
        )
        .withColumn("canonical_id", canonical_hash(F.col("leader_id"), mask))
    )


def lookup_table(graph: DataFrame, canonical: CanonicalId, floor: int = HOT_FLOOR) -> DataFrame:
    """Identifier to canonical id."""
    return salted_join(graph, component_table(graph, canonical), LEADER, floor=floor).select(
        "canonical_id",
        F.col("follower_id").alias("id"),
        F.col("follower_ns").alias("id_key_type"),
        "canonical_id_first_seen_at",
        "canonical_id_last_seen_at",
        F.col("follower_first_seen_at").alias("id_first_seen_at"),
        F.col("follower_last_seen_at").alias("id_last_seen_at"),
        F.col("follower_source_table_ids").alias("id_source_table_ids"),
        F.col("follower_last_processed_at").alias("id_last_processed_at"),
    )


def assert_one_canonical_per_id(lookup: DataFrame) -> DataFrame:
    """Raise if an identifier has several canonical ids, which would multiply rows."""
    repeated = lookup.groupBy("id", "id_key_type").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    row = repeated.first()
    if row is not None:
        raise ValueError(f"identifier {row.id!r} of type {row.id_key_type} has {row.n} canonical ids")
    return lookup


def key_dim(spark: SparkSession, canonical: CanonicalId) -> DataFrame:
    rows = [(canonical.ns(k), k) for k in canonical.merge_by_keys]
    return spark.createDataFrame(rows, "key_type bigint, key_name string")


def table_dim(spark: SparkSession, cfg: Config) -> DataFrame:
    rows = [(i + 1, t.name) for i, t in enumerate(cfg.tables)]
    return spark.createDataFrame(rows, "table_id bigint, table_name string")


def unification_metadata(spark: SparkSession, cfg: Config) -> DataFrame:
    rows = [(c.name, "canonical_id") for c in cfg.canonical_ids]
    return spark.createDataFrame(rows, "canonical_id_name string, canonical_id_type string")


def filter_lookup(spark: SparkSession, cfg: Config) -> DataFrame:
    """Validation rule per key, with the usual defaults filled in."""
    rows = []
    for key in cfg.keys:
        texts = list(key.invalid_texts) or ["", "N/A", "null"]
        rows.append((key.name, texts, key.valid_regexp or (".*@.*" if key.name == "email" else None)))
    return spark.createDataFrame(rows, "key_name string, invalid_texts array<string>, valid_regexp string")


def column_lookup(spark: SparkSession, cfg: Config) -> DataFrame:
    rows = [(t.database, t.name, kc.column, kc.key) for t in cfg.tables for kc in t.key_columns]
    return spark.createDataFrame(rows, "database_name string, table_name string, column_name string, key_name string")
