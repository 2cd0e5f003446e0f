"""Stage jobs over stored tables: union, staging, preparation, unification.

Data is committed together with the watermarks that have to follow it, all under
a run id. So a run that died half-way can be repeated, or followed by another one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import histunion as H
from kindred.operators import prep as P
from kindred.operators import staging as S
from kindred.operators import state
from kindred.plans.ledger import Ledger, logged
from kindred.plans.stored import expected_outputs, run_unification
from kindred.sources import tables

__all__ = ["PrepSource", "expected_outputs", "run_hist_union", "run_prep", "run_staging", "run_unification"]


def _inc_log(spark: SparkSession, root: str) -> DataFrame:
    tables.create_if_absent(spark, root, state.INC_LOG_SCHEMA)
    return tables.load(spark, root)


def _settle(spark: SparkSession, target: str, inc_log: str) -> None:
    """Write the watermarks of a run that died behind its data.

    They were fixed before its load and published with its data, so rows that came
    later stay for the next run, and a run under another id loads nothing twice.
    """
    _inc_log(spark, inc_log)
    for log_run, rows in tables.marks(spark, target).items():
        if not tables.has_run(spark, inc_log, log_run):
            tables.append(spark.createDataFrame([tuple(r) for r in rows], state.INC_LOG_SCHEMA), inc_log, log_run)


def run_hist_union(
    spark: SparkSession,
    inc: DataFrame | None,
    hist: DataFrame | None,
    name: str,
    target: str,
    inc_log: str,
    run_id: str,
    full: bool = False,
    mode: str | None = None,
    types: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    changes: str | None = None,
    ledger: Ledger | None = None,
    **align,
) -> None:
    """Bring the union up to date and move both watermarks.

    Modes: ``incremental`` appends what is new on either side, ``full`` rebuilds the target,
    ``snapshot`` takes ``inc`` as the whole latest state, without history: with ``keys`` the rows
    that are new, changed or vanished since the last snapshot are found by row hash
    and appended to the table ``changes``, whose ``time`` later stages can follow. ``types`` casts
    columns of both sides to one type first. A run id that has moved its watermarks is done
    and not repeated.
    """
    inc, hist = H.with_missing_side(spark, inc, hist)
    if types:
        inc, hist = (H.cast_align(side, {c: t for c, t in types.items() if c in side.columns}) for side in (inc, hist))
    mode = mode or ("full" if full else "incremental")
    if mode not in ("incremental", "full", "snapshot"):
        raise ValueError("mode must be incremental, full or snapshot")
    inc_name, hist_name, target_name = H.derive_name_texts(name)
    log_run = f"{run_id}-{inc_name}"
    _settle(spark, target, inc_log)
    if tables.has_run(spark, inc_log, log_run):
        return
    with logged(ledger, run_id, target_name, spark) as done:
        # Fixed before the load: rows that arrive meanwhile belong to the next run.
        sides = {inc_name: inc} if mode == "snapshot" else {inc_name: inc, hist_name: hist}
        upto = {n: state.max_time(side) for n, side in sides.items()}
        marks = {log_run: [[n, H.PROJECT, v] for n, v in upto.items()]}
        if mode == "incremental":
            log = _inc_log(spark, inc_log)
            seen = {n: state.read_watermark(log, n, H.PROJECT) for n in upto}
            new_inc = state.new_rows(inc, seen[inc_name], upto[inc_name])
            new_hist = state.new_rows(hist, seen[hist_name], upto[hist_name])
            tables.append(H.hist_union_full(new_inc, new_hist, **align), target, run_id, marks)
            done.records = tables.run_count(spark, target, run_id) if ledger else 0
        else:
            if mode == "snapshot" and keys and changes:
                before = tables.load(spark, target) if tables.exists(spark, target) else None
                tables.append(H.snapshot_changes(inc, before, keys), changes, run_id)
            whole = H.hist_union_snapshot(inc) if mode == "snapshot" else H.hist_union_full(inc, hist, **align)
            tables.swap_commit(whole, target, run_id=run_id, marks=marks)
            done.records = tables.load(spark, target).count() if ledger else 0
        _settle(spark, target, inc_log)


def run_staging(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    rules: S.Rules,
    target: str,
    inc_log: str,
    run_id: str,
    as_of: int,
    mode: str = "incremental",
    project: str = "staging",
    buckets: int | None = None,
    ledger: Ledger | None = None,
    registry: str | None = None,
) -> str:
    """Stage new rows and upsert them (append without a dedupe rule). Returns what was done.

    With ``registry``, a table beside the target, the JSON keys found so far are stored:
    only new rows are searched, and a key keeps its column and type in every run.
    A run id that has moved its watermark is done; its repeat returns ``skipped``.
    """
    log_run = f"{run_id}-{project}-{name}"
    _settle(spark, target, inc_log)
    if tables.has_run(spark, inc_log, log_run):
        return "skipped"
    upto = state.max_time(source)
    chosen = state.choose_mode(tables.exists(spark, target), mode)
    if chosen == "incremental":
        mark = state.read_watermark(_inc_log(spark, inc_log), name, project)
        rows = state.new_rows(source, mark, upto)
    else:
        rows = source if upto is None else source.filter(F.col("time") <= upto)
    pending = rows.count() if chosen == "incremental" or ledger else 1
    if chosen == "incremental" and pending == 0:
        return "skipped"
    with logged(ledger, run_id, name, spark) as done:
        done.records = pending
        if registry:
            rules = _with_registered_keys(spark, rows, rules, registry, log_run)
        staged = S.guard_types(S.stage(rows, rules, name, as_of))
        marks = {log_run: [[name, project, upto or 0]]}
        if chosen == "full":
            tables.swap_commit(staged, target, run_id=run_id, marks=marks)
        elif rules.keys:
            tables.upsert_table(staged, target, list(rules.keys), run_id, buckets, marks)
        else:
            tables.append(staged, target, run_id, marks)
        _settle(spark, target, inc_log)
    return chosen


def _with_registered_keys(spark: SparkSession, rows: DataFrame, rules: S.Rules, registry: str, run_id: str) -> S.Rules:
    """Rules with every key of the registry, after adding the ones that these rows bring. A repeated run adds none."""
    tables.create_if_absent(spark, registry, S.KEY_REGISTRY_SCHEMA)
    searched = S.searched_columns(rows, rules)
    if not tables.has_run(spark, registry, run_id):
        fresh = S.new_json_keys(rows, searched, tables.load(spark, registry))
        tables.append(spark.createDataFrame(fresh, S.KEY_REGISTRY_SCHEMA), registry, run_id)
    found = S.registered_paths(tables.load(spark, registry), searched)
    return replace(rules, json={**rules.json, **found}, find_json=False)


@dataclass
class PrepSource:
    name: str
    df: DataFrame
    columns: Mapping[str, str]


def run_prep(spark: SparkSession, sources: list[PrepSource], root: str, as_of: int) -> DataFrame:
    """Bring prep tables, unified input and exclusion list up to date; return the cleaned input."""
    input_root, excl_root = f"{root}/unif_input", f"{root}/exclusion_list"
    tables.create_if_absent(spark, excl_root, "key_value string, key_name string, tbls array<string>, note string")
    for src in sources:
        prep_root = f"{root}/prep_{src.name}"
        aliases = sorted(src.columns.values())
        if tables.exists(spark, prep_root):
            kept = P.prep_delete_vanished(tables.load(spark, prep_root), src.df, src.columns)
            prep = kept.unionByName(P.prep_new_rows(src.df, kept, src.columns, as_of))
        else:
            prep = P.prep_project(src.df, src.columns).withColumn("time", F.lit(as_of).cast("long"))
        tables.swap_commit(prep, prep_root)
        prep = tables.load(spark, prep_root)
        # The input is kept by source, so the rows of the others are neither read nor written.
        text = ", ".join(f"{a} string" for a in aliases)
        tables.create_if_absent(spark, input_root, f"{text}, time bigint, source string, ingest_time bigint")
        held = _with_columns(tables.load_part(spark, input_root, src.name), aliases)
        mine = P.input_cascade_delete(held, prep, aliases, src.name)
        tables.replace_part(P.input_append(prep, mine, aliases, src.name), input_root, src.name)
    unif = _with_columns(tables.load(spark, input_root), ["email", "phone"])
    excl = P.extend_exclusions(tables.load(spark, excl_root), P.find_masked(unif), "unif_input")
    tables.swap_commit(excl, excl_root)
    return P.require_contact(P.apply_exclusions(unif, tables.load(spark, excl_root)))


def _with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Add missing text columns, so that sources with different keys share one table."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})
