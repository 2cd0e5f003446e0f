"""The whole unification: records to lookup, enriched tables, profiles and statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.hashing import canonical_hash, mask_of
from kindred.operators.skew import HOT_FLOOR, salted_join
from kindred.plans.canonical import lookup_table
from kindred.plans.config import CanonicalId, Config, KeyColumn, check_config
from kindred.plans.enrich import enrich
from kindred.plans.extract import BITS, edges, extract_all, pair_table
from kindred.plans.master import master_table
from kindred.plans.resolve import LEADER, MAX_STEPS, resolve
from kindred.plans.stats import result_key_stats, source_key_stats
from kindred.sources.scratch import Scratch

ANCHOR_NS = 0


@dataclass
class Unified:
    lookup: DataFrame
    graph: DataFrame
    enriched: dict[str, DataFrame]
    masters: dict[str, DataFrame]
    source_stats: DataFrame
    result_stats: DataFrame
    metrics: list[dict] = field(default_factory=list)


def unify(
    tables: Mapping[str, DataFrame],
    cfg: Config,
    as_of: int,
    canonical: CanonicalId | None = None,
    max_steps: int | None = None,
    floor: int = HOT_FLOOR,
) -> Unified:
    """Resolve one canonical id over all tables. The config is checked first.

    At most ``max_steps`` rounds, else the configured ``merge_iterations``; more would raise.
    """
    canonical = canonical or cfg.canonical_ids[0]
    max_steps = max_steps or canonical.merge_iterations or MAX_STEPS
    check_config(cfg, {name: df.schema for name, df in tables.items()})
    spark = next(iter(tables.values())).sparkSession
    scratch = Scratch(spark, "unify")
    count = len(cfg.tables)
    pairs = scratch.save(pair_table(extract_all(tables, cfg, canonical), count), "pairs")
    result = resolve(pairs, canonical, count, as_of, max_steps, floor, saved=True)
    lookup = scratch.save(lookup_table(result.graph, canonical, floor), "lookup")
    # Written once: every attribute of a master reads them.
    enriched = {t.name: scratch.save(enrich(tables[t.name], cfg, canonical, t, lookup, floor=floor), f"enriched_{t.name}") for t in cfg.tables}
    masters = {m.name: master_table(m, enriched, lookup) for m in cfg.master_tables if m.canonical_id == canonical.name}
    return Unified(
        lookup,
        result.graph,
        enriched,
        masters,
        source_key_stats(edges(pairs, count, as_of), cfg, canonical, as_of),
        result_key_stats(result.graph, cfg, canonical, as_of),
        result.metrics,
    )


def unify_levels(tables: Mapping[str, DataFrame], cfg: Config, as_of: int, floor: int = HOT_FLOOR) -> dict[str, Unified]:
    """Several canonical ids in order, such as person and household.

    Each later level may merge by an earlier id: name it as a key, and every table
    gets that id as a further key column.
    """
    results: dict[str, Unified] = {}
    current = dict(tables)
    for level in cfg.canonical_ids:
        earlier = [n for n in results if n in level.merge_by_keys]
        level_tables = tuple(
            replace(t, key_columns=t.key_columns + tuple(KeyColumn(n, n) for n in earlier)) for t in cfg.tables
        )
        one = replace(
            cfg,
            tables=level_tables,
            canonical_ids=(level,),
            master_tables=tuple(m for m in cfg.master_tables if m.canonical_id == level.name),
        )
        done = unify(current, one, as_of, level, floor=floor)
        scratch = Scratch(done.lookup.sparkSession, f"level-{level.name}")
        current = {name: scratch.save(df, name) for name, df in done.enriched.items()}
        results[level.name] = replace(done, enriched=dict(current))
    return results


@dataclass
class Delta:
    """What new records change: rows of the touched profiles, the ids they had before, and ids that merged."""

    lookup: DataFrame
    touched: DataFrame
    merged: DataFrame


def resolve_incremental(
    previous: DataFrame,
    records: DataFrame,
    canonical: CanonicalId,
    table_count: int,
    as_of: int,
    max_steps: int = MAX_STEPS,
    floor: int = HOT_FLOOR,
) -> tuple[DataFrame, DataFrame]:
    """New lookup and the canonical ids that were merged away.

    ``previous`` is the last lookup, ``records`` the newly extracted rows. Only
    profiles that a new record touches are resolved again; the others pass through.
    """
    members = lambda touched: salted_join(previous, touched, ["canonical_id"], "left_semi", floor=floor)
    delta = resolve_delta(previous, members, records, canonical, table_count, as_of, max_steps=max_steps, floor=floor)
    untouched = salted_join(previous, delta.touched, ["canonical_id"], "left_anti", floor=floor)
    return delta.lookup.unionByName(untouched.select(*delta.lookup.columns)), delta.merged


def resolve_delta(
    previous: DataFrame,
    members: Callable[[DataFrame], DataFrame],
    records: DataFrame,
    canonical: CanonicalId,
    table_count: int,
    as_of: int,
    bridges: DataFrame | None = None,
    max_steps: int = MAX_STEPS,
    floor: int = HOT_FLOOR,
) -> Delta:
    """Resolve new records together with the profiles they touch.

    ``members`` gives the rows of ``previous`` that have one of some canonical ids. ``bridges`` are identifiers
    that became one elsewhere: ``ns``, ``old`` and ``new``. Earlier canonical ids enter as the
    leaders of their identifiers and outrank all keys, the earliest first, so a component
    keeps its oldest id and only components without one get a new hash.
    """
    scratch = Scratch(previous.sparkSession, "incremental")
    fresh = pair_table(records, table_count)
    words = [c for c in fresh.columns if c.startswith("_w")]
    if bridges is not None:
        none = F.lit(None).cast("long")
        ends = F.explode(F.array("old", "new")).alias("follower_id")
        links = bridges.select(ends, F.col("ns").cast("long").alias("follower_ns"), F.col("new").alias("leader_id"), F.col("ns").cast("long").alias("leader_ns")).distinct()
        fresh = fresh.unionByName(links.select("*", none.alias("first_at"), none.alias("last_at"), *[F.lit(0).cast("long").alias(w) for w in words]))
    fresh = scratch.save(fresh, "fresh")
    # Leaders follow themselves, so the followers are all identifiers there are.
    arrived = fresh.select(F.col("follower_id").alias("id"), F.col("follower_ns").alias("id_key_type")).distinct()
    touched = previous.join(arrived, ["id", "id_key_type"], "left_semi").select("canonical_id").distinct()
    touched = scratch.save(touched, "touched")
    previous = scratch.save(members(touched), "previous")

    def seen_bits(word: str) -> Column:
        offset = BITS * int(word.removeprefix("_w"))
        mine = F.filter("id_source_table_ids", lambda t: (t > offset) & (t <= offset + BITS))
        one = F.lit(1).cast("long")
        return F.aggregate(
            mine,
            F.lit(0).cast("long"),
            lambda acc, t: acc.bitwiseOR(F.call_function("shiftleft", one, (t - offset - 1).cast("int"))),
        )

    anchors = previous.select(
        F.col("id").alias("follower_id"),
        F.col("id_key_type").alias("follower_ns"),
        F.col("canonical_id").alias("leader_id"),
        F.lit(ANCHOR_NS).cast("long").alias("leader_ns"),
        F.col("id_first_seen_at").alias("first_at"),
        F.col("id_last_seen_at").alias("last_at"),
        *[seen_bits(w).alias(w) for w in words],
    )
    seniority = previous.groupBy(F.col("canonical_id").alias("leader_id")).agg(
        F.min("canonical_id_first_seen_at").alias("seniority")
    ).withColumn("leader_ns", F.lit(ANCHOR_NS).cast("long"))
    pairs = scratch.save(fresh.unionByName(anchors.select(*fresh.columns)), "pairs")
    graph = resolve(pairs, canonical, table_count, as_of, max_steps, floor, seniority, saved=True).graph

    component = graph.groupBy(*LEADER).agg(
        F.min("follower_first_seen_at").alias("canonical_id_first_seen_at"),
        F.max("follower_last_seen_at").alias("canonical_id_last_seen_at"),
    )
    own = canonical_hash(F.col("leader_id"), mask_of(F.greatest("leader_ns", F.lit(1)), len(canonical.merge_by_keys)))
    component = component.withColumn(
        "canonical_id", F.when(F.col("leader_ns") == ANCHOR_NS, F.col("leader_id")).otherwise(own)
    )
    lookup = scratch.save(
        salted_join(graph, component, LEADER, floor=floor).select(
            "canonical_id",
            F.col("follower_id").alias("id"),
            F.col("follower_ns").alias("id_key_type"),
            "canonical_id_first_seen_at",
            "canonical_id_last_seen_at",
            F.col("follower_first_seen_at").alias("id_first_seen_at"),
            F.col("follower_last_seen_at").alias("id_last_seen_at"),
            F.col("follower_source_table_ids").alias("id_source_table_ids"),
            F.col("follower_last_processed_at").alias("id_last_processed_at"),
        ),
        "lookup",
    )
    before = previous.select("id", "id_key_type", F.col("canonical_id").alias("old_canonical_id"))
    merged = (
        before.join(lookup.select("id", "id_key_type", "canonical_id"), ["id", "id_key_type"])
        .filter(F.col("old_canonical_id") != F.col("canonical_id"))
        .select("old_canonical_id", "canonical_id")
        .distinct()
    )
    return Delta(lookup, touched, merged)
