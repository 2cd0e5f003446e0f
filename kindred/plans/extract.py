"""From source rows to links between identifiers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.keyrules import key_valid
from kindred.operators.skew import salted_join
from kindred.plans.config import CanonicalId, Config, Table

ID_TYPE = "struct<id:string,ns:bigint>"
# Table ids are packed 62 to a long while aggregating.
BITS = 62


def key_structs(cfg: Config, canonical: CanonicalId, table: Table, by_merge_order: bool = False) -> list[Column]:
    """One (id, ns) struct per merge key column, NULL where the value is not usable."""
    columns = [kc for kc in table.key_columns if kc.key in canonical.merge_by_keys]
    if by_merge_order:
        columns = sorted(columns, key=lambda kc: canonical.ns(kc.key))
    out = []
    for kc in columns:
        rule, col = cfg.key(kc.key), F.col(kc.column)
        pair = F.struct(col.cast("string").alias("id"), F.lit(canonical.ns(kc.key)).cast("long").alias("ns"))
        out.append(F.when(key_valid(col, rule.invalid_texts, rule.valid_regexp), pair))
    return out


def extract_ids(df: DataFrame, cfg: Config, canonical: CanonicalId, table: Table) -> DataFrame:
    """id_ns_array (valid keys in key-column order), time, source_table_id."""
    structs = key_structs(cfg, canonical, table)
    ids = F.filter(F.array(*structs), lambda x: x.isNotNull()) if structs else F.array().cast(f"array<{ID_TYPE}>")
    rows = df.select(
        ids.alias("id_ns_array"),
        F.col("time").cast("long").alias("time"),
        F.lit(cfg.table_id(table.name)).cast("long").alias("source_table_id"),
    )
    return rows if structs else rows.limit(0)


def extract_all(tables: Mapping[str, DataFrame], cfg: Config, canonical: CanonicalId) -> DataFrame:
    parts = [extract_ids(tables[t.name], cfg, canonical, t) for t in cfg.tables]
    return reduce(DataFrame.unionByName, parts)


def _table_words(table_count: int) -> list[Column]:
    """Bit sets of the table ids seen, as plain long aggregates."""
    words = []
    for word in range((table_count + BITS - 1) // BITS):
        offset = F.col("source_table_id") - F.lit(word * BITS + 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), offset.cast("int"))
        inside = (offset >= 0) & (offset < BITS)
        words.append(F.bit_or(F.when(inside, bit).otherwise(F.lit(0).cast("long"))).alias(f"_w{word}"))
    return words


def table_bits(table_count: int) -> list[Column]:
    """Per table: is it in the bit sets?"""
    places = [divmod(t, BITS) for t in range(table_count)]
    return [F.col(f"_w{word}").bitwiseAND(F.lit(1 << bit)) != 0 for word, bit in places]


def table_id_array(table_count: int) -> Column:
    """Ascending array of the table ids in the bit sets."""
    bits = [F.when(is_seen, F.lit(t + 1).cast("long")) for t, is_seen in enumerate(table_bits(table_count))]
    return F.filter(F.array(*bits), lambda x: x.isNotNull())


def pair_table(records: DataFrame, table_count: int) -> DataFrame:
    """One row per distinct (follower, leader): first and last time, tables seen.

    The leader of a record is its first valid key. Only flat values are
    aggregated, so equal links collapse before the shuffle.
    """
    # The outer form: Spark puts a test of the array below any other, which finds all keys of a row twice.
    links = records.select(
        F.explode_outer("id_ns_array").alias("f"), F.get("id_ns_array", F.lit(0)).alias("l"), "time", "source_table_id"
    ).filter(F.col("f").isNotNull())
    return links.groupBy(
        F.col("f.id").alias("follower_id"),
        F.col("f.ns").alias("follower_ns"),
        F.col("l.id").alias("leader_id"),
        F.col("l.ns").alias("leader_ns"),
    ).agg(F.min("time").alias("first_at"), F.max("time").alias("last_at"), *_table_words(table_count))


def _word_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_w")]


def follower_columns(pairs: DataFrame) -> list[Column]:
    """Aggregates over the links of a follower: its times and tables."""
    return [F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *[F.bit_or(w).alias(w) for w in _word_names(pairs)]]


def follower_table(pairs: DataFrame) -> DataFrame:
    """One row per follower with its times and tables over all its links."""
    return pairs.groupBy("follower_id", "follower_ns").agg(*follower_columns(pairs))


def edges(pairs: DataFrame, table_count: int, as_of: int) -> DataFrame:
    """The initial graph: each (follower, leader) with the follower's own times and tables."""
    links = pairs.select("follower_id", "follower_ns", "leader_id", "leader_ns")
    return salted_join(links, follower_table(pairs), ["follower_id", "follower_ns"]).select(
        "follower_id",
        "follower_ns",
        "leader_id",
        "leader_ns",
        F.col("first_at").alias("follower_first_seen_at"),
        F.col("last_at").alias("follower_last_seen_at"),
        table_id_array(table_count).alias("follower_source_table_ids"),
        F.lit(as_of).cast("long").alias("follower_last_processed_at"),
    )
