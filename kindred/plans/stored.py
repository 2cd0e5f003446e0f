"""Unification over stored tables: every canonical id, in full or by what is new.

Lookups are kept by canonical id, enriched tables by all ids of a row, masters by
theirs, each in key buckets. An increment resolves its new records with the profiles
they touch, and rewrites only the buckets of ids that changed; to the others it adds
files. Ids that merged are published as a feed, and rows that carry one are
remapped. The stable-id rule: a profile keeps its earliest id; so the profiles after
some increments are those of one full run, under the id they had first.

An increment first computes its changes into tables of its own and then marks them as
ready, with the watermarks it read up to. Publishing them is repeatable, and the next
run of whatever name finishes one that died in between.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import state
from kindred.plans import canonical as K
from kindred.plans.config import CanonicalId, Config, KeyColumn, check_config
from kindred.plans.enrich import enrich
from kindred.plans.extract import extract_all, pair_table
from kindred.plans.ledger import Ledger, logged
from kindred.plans.master import master_table
from kindred.plans.resolve import MAX_STEPS, resolve
from kindred.plans.stats import result_key_stats, source_key_stats_of_ranks
from kindred.plans.unify import Unified, resolve_delta
from kindred.sources import tables
from kindred.sources.scratch import Scratch

PROJECT = "unification"
#: Rows of a key bucket, from which the number of buckets follows.
BUCKET_ROWS = 2_000_000


def levels_of(cfg: Config) -> list[CanonicalId]:
    """Canonical ids, each behind the ids it merges by; else in their order."""
    names = {c.name for c in cfg.canonical_ids}
    done: list[CanonicalId] = []
    rest = list(cfg.canonical_ids)
    while rest:
        known = {c.name for c in done}
        ready = next((c for c in rest if not (set(c.merge_by_keys) & names - known - {c.name})), None)
        if ready is None or ready.name in ready.merge_by_keys:
            raise ValueError(f"canonical ids merge by each other: {sorted(c.name for c in rest)}")
        done.append(ready)
        rest.remove(ready)
    return done


def level_config(cfg: Config, level: CanonicalId, earlier: list[CanonicalId]) -> Config:
    """The configuration of one id: earlier ids that it merges by are key columns of every table."""
    more = tuple(KeyColumn(c.name, c.name) for c in earlier if c.name in level.merge_by_keys)
    return replace(
        cfg,
        tables=tuple(replace(t, key_columns=t.key_columns + more) for t in cfg.tables),
        canonical_ids=(level,),
        master_tables=tuple(m for m in cfg.master_tables if m.canonical_id == level.name),
    )


def _buckets(rows: int, buckets: int | None) -> int:
    return buckets or max(tables.MIN_BUCKETS, -(-rows // BUCKET_ROWS))


def _parents(level: CanonicalId, earlier: list[CanonicalId]) -> list[CanonicalId]:
    return [c for c in earlier if c.name in level.merge_by_keys]


def _children(lookup: DataFrame, level: CanonicalId, parent: CanonicalId) -> DataFrame:
    """Which id of a level each id of an earlier level belongs to."""
    return lookup.filter(F.col("id_key_type") == level.ns(parent.name)).select(F.col("id").alias(parent.name), F.col("canonical_id").alias(level.name))


def _as_graph(lookup: DataFrame) -> DataFrame:
    """A lookup as a graph whose leaders are the canonical ids, for the statistics."""
    return lookup.select(
        F.col("id").alias("follower_id"), F.col("id_key_type").alias("follower_ns"), F.col("canonical_id").alias("leader_id"),
        F.lit(1).cast("long").alias("leader_ns"), F.col("id_source_table_ids").alias("follower_source_table_ids"),
    )


def run_unification(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    cfg: Config,
    root: str,
    as_of: int,
    full: bool = True,
    run_id: str = "full",
    buckets: int | None = None,
    ledger: Ledger | None = None,
) -> dict[str, Unified]:
    """Unify and store every canonical id of the configuration under ``root``; results by the name of the id.

    Stored are, per id, lookup, key and table names, statistics, the graph of the last full run and the feed of
    merged ids; for an id that merges by an earlier one, the table of which belongs to which; enriched tables with
    all ids, masters, and the configuration tables. ``full=False`` takes the rows after the watermark of each source.
    """
    with logged(ledger, run_id, PROJECT, spark) as done:
        inc_log = f"{root}/inc_log"
        tables.create_if_absent(spark, inc_log, state.INC_LOG_SCHEMA)
        _finish(spark, cfg, root)
        if not full and not tables.exists(spark, f"{root}/{cfg.canonical_ids[0].name}_lookup"):
            full = True
        if full:
            results = _full(spark, sources, cfg, root, as_of, run_id, buckets)
        else:
            if not tables.has_run(spark, inc_log, run_id):
                done.records = _prepare(spark, sources, cfg, root, as_of, run_id)
                _finish(spark, cfg, root)
            results = _stored(spark, cfg, root)
    return results


def _full(spark: SparkSession, sources: Mapping[str, DataFrame], cfg: Config, root: str, as_of: int, run_id: str, buckets: int | None) -> dict[str, Unified]:
    scratch, count = Scratch(spark, "unify"), len(cfg.tables)
    seen = {t.name: sources[t.name].agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("upto")).first() for t in cfg.tables}
    rows = {t.name: sources[t.name] if seen[t.name].upto is None else sources[t.name].filter(F.col("time").isNull() | (F.col("time") <= seen[t.name].upto)) for t in cfg.tables}
    results: dict[str, Unified] = {}
    earlier: list[CanonicalId] = []
    for level in levels_of(cfg):
        one = level_config(cfg, level, earlier)
        check_config(one, {name: df.schema for name, df in rows.items()})
        name = level.name
        pairs = scratch.save(pair_table(extract_all(rows, one, level), count), f"{name}-pairs")
        result = resolve(pairs, level, count, as_of, level.merge_iterations or MAX_STEPS, saved=True, written=False)
        tables.swap_commit(result.graph, f"{root}/{name}_graph")
        graph = tables.load(spark, f"{root}/{name}_graph")
        tables.replace_by_keys(K.lookup_table(graph, level), f"{root}/{name}_lookup", ["canonical_id"], _buckets(graph.count(), buckets), run_id)
        lookup = K.assert_one_canonical_per_id(tables.load(spark, f"{root}/{name}_lookup"))
        _store(spark, source_key_stats_of_ranks(result.seen, result.followers, one, level, as_of), f"{root}/{name}_source_key_stats")
        _store(spark, result_key_stats(graph, one, level, as_of), f"{root}/{name}_result_key_stats")
        _store(spark, K.key_dim(spark, level), f"{root}/{name}_keys")
        _store(spark, K.table_dim(spark, cfg), f"{root}/{name}_tables")
        _store(spark, spark.createDataFrame([], f"{MERGED}"), f"{root}/{name}_merged")
        for parent in _parents(level, earlier):
            tables.replace_by_keys(_children(lookup, level, parent), f"{root}/{parent.name}_to_{name}", [parent.name], _buckets(0, buckets), run_id)
        # Not written yet: the rows get all their ids and are stored once.
        rows = {t.name: enrich(rows[t.name], one, level, t, lookup, rows=seen[t.name].n) for t in one.tables}
        results[name] = Unified(lookup, graph, {}, {}, *_stats(spark, root, name), result.metrics)
        earlier.append(level)
    names = [c.name for c in earlier]
    for table, df in rows.items():
        tables.replace_by_keys(df, f"{root}/enriched_{table}", names, _buckets(seen[table].n, buckets), run_id)
    enriched = {t: tables.load(spark, f"{root}/enriched_{t}") for t in rows}
    for m in cfg.master_tables:
        made = master_table(m, enriched, results[m.canonical_id].lookup)
        tables.replace_by_keys(made, f"{root}/{m.name}", [m.canonical_id], _buckets(max(s.n for s in seen.values()), buckets), run_id)
    _store(spark, K.unification_metadata(spark, cfg), f"{root}/unification_metadata")
    _store(spark, K.filter_lookup(spark, cfg), f"{root}/filter_lookup")
    _store(spark, K.column_lookup(spark, cfg), f"{root}/column_lookup")
    marks = [(t, PROJECT, s.upto) for t, s in seen.items()]
    tables.append(spark.createDataFrame(marks, state.INC_LOG_SCHEMA), f"{root}/inc_log", f"{run_id}-{as_of}")
    scratch.close()
    stored = _stored(spark, cfg, root)
    return {n: replace(stored[n], metrics=results[n].metrics) for n in results}


MERGED = "old_canonical_id string, canonical_id string, time long"


def _store(spark: SparkSession, df: DataFrame, root: str) -> None:
    tables.swap_commit(df, root)


def _stats(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    return tables.load(spark, f"{root}/{name}_source_key_stats"), tables.load(spark, f"{root}/{name}_result_key_stats")


def _stored(spark: SparkSession, cfg: Config, root: str) -> dict[str, Unified]:
    load = lambda n: tables.load(spark, f"{root}/{n}")
    enriched = {t.name: load(f"enriched_{t.name}") for t in cfg.tables}
    return {
        c.name: Unified(load(f"{c.name}_lookup"), load(f"{c.name}_graph"), enriched, {m.name: load(m.name) for m in cfg.master_tables if m.canonical_id == c.name}, *_stats(spark, root, c.name))
        for c in cfg.canonical_ids
    }


def _work(spark: SparkSession, root: str, run_id: str, name: str) -> str:
    return f"{root}/_work/{run_id}/{name}"


def _prepare(spark: SparkSession, sources: Mapping[str, DataFrame], cfg: Config, root: str, as_of: int, run_id: str) -> int:
    """Everything an increment changes, as tables of its own; then the mark that they are ready. Returns the new rows."""
    log, count = tables.load(spark, f"{root}/inc_log"), len(cfg.tables)
    after = {t.name: state.read_watermark(log, t.name, PROJECT) for t in cfg.tables}
    upto = {t.name: state.max_time(sources[t.name]) for t in cfg.tables}
    scratch = Scratch(spark, "unify-delta")

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = _work(spark, root, run_id, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = {t.name: scratch.save(state.new_rows(sources[t.name], after[t.name], upto[t.name]), f"new-{t.name}") for t in cfg.tables}
    new = {name: df.count() for name, df in rows.items()}
    earlier: list[CanonicalId] = []
    merged: dict[str, DataFrame] = {}
    for level in levels_of(cfg):
        one, name = level_config(cfg, level, earlier), level.name
        parents = _parents(level, earlier)
        bridges = [
            merged[p.name].select(F.lit(level.ns(p.name)).alias("ns"), F.col("old_canonical_id").alias("old"), F.col("canonical_id").alias("new")) for p in parents
        ]
        lookup = f"{root}/{name}_lookup"
        delta = resolve_delta(
            tables.load(spark, lookup), lambda touched, at=lookup: tables.load_keys(spark, at, touched), extract_all(rows, one, level), level, count, as_of,
            reduce(DataFrame.unionByName, bridges) if bridges else None,
        )
        changed = keep(K.assert_one_canonical_per_id(delta.lookup), f"{name}-lookup")
        keep(delta.touched, f"{name}-touched")
        merged[name] = keep(delta.merged, f"{name}-merged")
        rows = {t.name: scratch.save(enrich(rows[t.name], one, level, t, changed, rows=new[t.name]), f"{name}-{t.name}") for t in one.tables}
        earlier.append(level)
    names = [c.name for c in earlier]
    for t in cfg.tables:
        at = f"{root}/enriched_{t.name}"
        # Rows with an id that is no more, found in the id columns alone.
        ids = tables.load(spark, at).select(*names)
        gone = [ids.join(merged[n].select(F.col("old_canonical_id").alias(n)).distinct(), n, "left_semi").select(*names) for n in names]
        gone = keep(reduce(DataFrame.unionByName, gone).distinct(), f"{t.name}-gone")
        old = tables.load_keys(spark, at, gone)
        columns = old.columns
        for n in names:
            renamed = merged[n].select(F.col("old_canonical_id").alias(n), F.col("canonical_id").alias("_now"))
            old = old.join(renamed, n, "left").withColumn(n, F.coalesce("_now", n)).drop("_now")
        keep(old.select(*columns).unionByName(rows[t.name], allowMissingColumns=True), f"{t.name}-added")
        ids_now = [rows[t.name].select(F.col(n).alias("id"), F.lit(n).alias("level")) for n in names]
        keep(reduce(DataFrame.unionByName, ids_now).filter("id IS NOT NULL").distinct(), f"{t.name}-ids")
    # The plan of the run: its publication makes the tables above count.
    marks = {run_id: [[t, PROJECT, v] for t, v in upto.items()]}
    tables.replace(spark.createDataFrame([(run_id, as_of)], "run_id string, as_of long"), f"{root}/run_plan", run_id, marks)
    scratch.close()
    return sum(new.values())


def _finish(spark: SparkSession, cfg: Config, root: str) -> None:
    """Publish a prepared increment; every step is skipped where it is done. Its watermarks come last."""
    inc_log, plan = f"{root}/inc_log", f"{root}/run_plan"
    for run_id, marks in tables.marks(spark, plan).items():
        if tables.has_run(spark, inc_log, run_id):
            continue
        as_of = tables.load(spark, plan).first()["as_of"]
        work = lambda name: spark.read.parquet(_work(spark, root, run_id, name))  # noqa: B023, E731
        scratch = Scratch(spark, "unify-publish")
        earlier: list[CanonicalId] = []
        for level in levels_of(cfg):
            name = level.name
            changed, touched, merged = work(f"{name}-lookup"), work(f"{name}-touched"), work(f"{name}-merged")
            tables.replace_keys(changed, touched, f"{root}/{name}_lookup", ["canonical_id"], run_id)
            tables.append(merged.withColumn("time", F.lit(as_of).cast("long")), f"{root}/{name}_merged", run_id)
            for parent in _parents(level, earlier):
                belongs = _children(changed, level, parent)
                tables.replace_keys(belongs, belongs, f"{root}/{parent.name}_to_{name}", [parent.name], run_id)
            earlier.append(level)
        names = [c.name for c in earlier]
        for t in cfg.tables:
            tables.replace_keys(work(f"{t.name}-added"), work(f"{t.name}-gone"), f"{root}/enriched_{t.name}", names, run_id)
        for m in cfg.master_tables:
            n = m.canonical_id
            now = [work(f"{t.name}-ids").filter(F.col("level") == n).select(F.col("id").alias(n)) for t in cfg.tables]
            now.append(work(f"{n}-merged").select(F.col("canonical_id").alias(n)))
            # Written once: every attribute of the master reads the rows of these ids.
            changed_ids = scratch.save(reduce(DataFrame.unionByName, now).distinct(), f"{m.name}-ids")
            of_them = {t.name: tables.load(spark, f"{root}/enriched_{t.name}").join(changed_ids, n, "left_semi") for t in cfg.tables}
            made = master_table(m, of_them, work(f"{n}-lookup"))
            gone = changed_ids.unionByName(work(f"{n}-merged").select(F.col("old_canonical_id").alias(n)))
            tables.replace_keys(made, gone, f"{root}/{m.name}", [n], run_id)
        for level in levels_of(cfg):
            lookup = tables.load(spark, f"{root}/{level.name}_lookup")
            _store(spark, result_key_stats(_as_graph(lookup), cfg, level, as_of), f"{root}/{level.name}_result_key_stats")
        tables.append(spark.createDataFrame([tuple(r) for r in marks], state.INC_LOG_SCHEMA), inc_log, run_id)
        scratch.close()


def expected_outputs(spark: SparkSession, cfg: Config) -> DataFrame:
    """Tables ``run_unification`` must leave behind: phase, table_name."""
    names: list[str] = []
    earlier: list[CanonicalId] = []
    for level in levels_of(cfg):
        names += [f"{level.name}_{part}" for part in ("lookup", "graph", "keys", "tables", "source_key_stats", "result_key_stats")]
        names += [f"{p.name}_to_{level.name}" for p in _parents(level, earlier)]
        earlier.append(level)
    names += [f"enriched_{t.name}" for t in cfg.tables] + [m.name for m in cfg.master_tables]
    names += ["unification_metadata", "filter_lookup", "column_lookup"]
    return spark.createDataFrame([("unification", n) for n in names], "phase string, table_name string")
