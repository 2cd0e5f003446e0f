"""Key statistics before and after unification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.plans.config import CanonicalId, Config
from kindred.plans.extract import table_bits

TOTAL = "*"


def _seen_in(cfg: Config) -> list[Column]:
    """Per group: was any member seen in table i?"""
    ids = F.col("follower_source_table_ids")
    return [F.bool_or(F.array_contains(ids, F.lit(i + 1).cast("long"))).alias(f"_t{i}") for i in range(len(cfg.tables))]


def _per_table(df: DataFrame, cfg: Config) -> DataFrame:
    """One row per table a group was seen in, and one for the total."""
    names = [F.when(F.col(f"_t{i}"), F.lit(t.name)) for i, t in enumerate(cfg.tables)]
    sources = F.filter(F.array(*names, F.lit(TOTAL)), lambda x: x.isNotNull())
    flags = [f"_t{i}" for i in range(len(cfg.tables))]
    return df.withColumn("from_table", F.explode(sources)).drop(*flags)


def source_key_stats(graph: DataFrame, cfg: Config, canonical: CanonicalId, as_of: int) -> DataFrame:
    """Per source table and in total: distinct leaders, distinct identifiers of each key."""
    leaders = graph.groupBy("leader_id", "leader_ns").agg(*_seen_in(cfg))
    followers = graph.groupBy("follower_id", "follower_ns").agg(*_seen_in(cfg))
    return _source_key_stats(leaders, followers, cfg, canonical, as_of)


def source_key_stats_of_ranks(leaders: DataFrame, followers: DataFrame, cfg: Config, canonical: CanonicalId, as_of: int) -> DataFrame:
    """The same from bit sets of the tables seen: one row or more per leader (``rank``), one per follower."""
    words = [c for c in leaders.columns if c.startswith("_w")]
    leaders = leaders.groupBy("rank").agg(*[F.bit_or(w).alias(w) for w in words])
    flags = [is_seen.alias(f"_t{i}") for i, is_seen in enumerate(table_bits(len(cfg.tables)))]
    return _source_key_stats(leaders.select(*flags), followers.select("follower_ns", *flags), cfg, canonical, as_of)


def _source_key_stats(leaders: DataFrame, followers: DataFrame, cfg: Config, canonical: CanonicalId, as_of: int) -> DataFrame:
    # Groups seen in the same tables are counted first; only these counts are repeated per table.
    flags, one = [f"_t{i}" for i in range(len(cfg.tables))], F.count(F.lit(1)).alias("n")
    leaders = _per_table(leaders.groupBy(*flags).agg(one), cfg)
    leaders = leaders.groupBy("from_table").agg(F.sum("n").alias("total_distinct"))
    followers = _per_table(followers.groupBy("follower_ns", *flags).agg(one), cfg)
    of_key = lambda k: F.sum(F.when(F.col("follower_ns") == canonical.ns(k), F.col("n")).otherwise(0))
    followers = followers.groupBy("from_table").agg(*[of_key(k).alias(f"distinct_{k}") for k in canonical.merge_by_keys])
    return leaders.join(followers, "from_table").withColumn("time", F.lit(as_of).cast("long"))


def result_key_stats(graph: DataFrame, cfg: Config, canonical: CanonicalId, as_of: int) -> DataFrame:
    """Per source table and in total: profiles, profiles with each key, and a text
    histogram ``identifiers:profiles,...`` per key."""
    keys = canonical.merge_by_keys
    counts = [F.count_if(F.col("follower_ns") == canonical.ns(k)).alias(f"n_{k}") for k in keys]
    profiles = graph.groupBy("leader_id", "leader_ns").agg(*_seen_in(cfg), *counts)
    # Profiles alike are counted first; only these counts are repeated per table and key.
    alike = [*[f"_t{i}" for i in range(len(cfg.tables))], *[f"n_{k}" for k in keys]]
    profiles = _per_table(profiles.groupBy(*alike).agg(F.count(F.lit(1)).alias("f")), cfg)
    totals = profiles.groupBy("from_table").agg(
        F.sum("f").alias("total_distinct"),
        *[F.sum(F.when(F.col(f"n_{k}") > 0, F.col("f")).otherwise(0)).alias(f"distinct_with_{k}") for k in keys],
    )
    # Frequencies are counted first; only one entry per distinct count is collected.
    long = profiles.select(
        "from_table", "f", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"n_{k}").alias("n")) for k in keys])).alias("e")
    ).select("from_table", "e.key", "e.n", "f")
    freq = long.filter(F.col("n") > 0).groupBy("from_table", "key", "n").agg(F.sum("f").alias("f"))

    def histogram(key: str) -> Column:
        entries = F.sort_array(F.collect_list(F.when(F.col("key") == key, F.struct("n", "f"))))
        texts = F.transform(entries, lambda e: F.concat_ws(":", e["n"].cast("string"), e["f"].cast("string")))
        return F.concat_ws(",", texts).alias(f"histogram_{key}")

    histograms = freq.groupBy("from_table").agg(*[histogram(k) for k in keys])
    return totals.join(histograms, "from_table", "left").withColumn("time", F.lit(as_of).cast("long"))
