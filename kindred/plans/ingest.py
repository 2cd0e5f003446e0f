"""Loading a source into its table, restartable from the ledger.

History comes by months, several of them in one commit. Months with a SUCCESS row are
left out by an anti-join; the rows of a commit and its ledger rows share one run id.
The window of a rolling load starts where the table ends. What is to be logged is
published with the data, so a run that died between the two is completed
first: its rows are neither lost nor loaded twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators import state
from kindred.plans.ledger import MESSAGE, Ledger
from kindred.sources import tables
from kindred.sources.windows import add_time, choose_inc_fields, map_inc_fields, pull_full, resolve_window

#: Months in one commit.
MONTHS_AT_ONCE = 24
RUNNER = "ingestion_runner"


@dataclass(frozen=True)
class Job:
    """A table of a source. ``fields`` has the incremental column for ``hist`` and ``inc``, as ``choose_inc_fields`` reads it."""

    table: str
    fields: Mapping[str, Mapping[str, str]]
    default_start: str = "1970-01-01 00:00:00"
    style: str = "sql"


def _moment(df: DataFrame, name: str) -> Column:
    """The incremental column as a timestamp; one that is a timestamp is left alone, so that bounds reach the scan."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.TimestampType | T.TimestampNTZType) else F.col(name).try_cast("timestamp")


def _ledger_rows(spark: SparkSession, kind: str, ledger: Ledger, job: Job, windows: list[list]) -> DataFrame:
    """A ledger row per window: source, start, end, records."""
    counted = spark.createDataFrame([tuple(w) for w in windows], "source string, start string, end string, records bigint")
    return state.ledger_row(counted, kind, ledger.as_of, F.col("source"), ledger.workflow, job.table, F.col("start"), F.col("end"))


def _log_marks(spark: SparkSession, target: str, ledger: Ledger, job: Job) -> None:
    """SUCCESS rows of the last commit, if they are missing."""
    for run_id, windows in tables.marks(spark, target).items():
        if windows and not tables.has_run(spark, ledger.root, run_id):
            tables.append(_ledger_rows(spark, "success", ledger, job, windows), ledger.root, run_id)


def _load_months(spark: SparkSession, source: DataFrame, job: Job, target: str, ledger: Ledger, bounds: tuple[str, str], at_once: int) -> int:
    fields = choose_inc_fields(job.fields, "hist")
    if fields is None:
        raise ValueError(f"{job.table} has no incremental column for its history")
    ranges = state.month_ranges(spark.createDataFrame([bounds], "a string, b string"), "a", "b")
    todo = state.pending_batches(ledger.load(spark), ranges, ledger.source, ledger.workflow, job.table).orderBy("month_name").collect()
    rows, at = map_inc_fields(source, fields), fields.table_field
    total = 0
    for first in range(0, len(todo), at_once):
        months = todo[first : first + at_once]
        run_id = f"{ledger.source}-{job.table}-{months[0].month_name}-{months[-1].month_name}"
        started = [[f"{ledger.source}_{m.month_name}", m.start_time, m.end_time, 0] for m in months]
        tables.append(_ledger_rows(spark, "started", ledger, job, started), ledger.root, f"{run_id}-started")
        try:
            moment = _moment(rows, at)
            # Up to the next month's start, so that no fraction of a second falls between two months.
            until = F.add_months(F.to_date(F.lit(f"{months[-1].month_name}-01")), 1).cast("timestamp")
            part = rows.filter((moment >= F.to_timestamp(F.lit(f"{months[0].month_name}-01"))) & (moment < until))
            if len(months) < 1 + _span(months[0].month_name, months[-1].month_name):
                part = part.filter(F.date_format(moment, "yyyy-MM").isin([m.month_name for m in months]))
            loaded = add_time(part, ledger.as_of)
            counts = {r["m"]: r["n"] for r in part.groupBy(F.date_format(moment, "yyyy-MM").alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}
            windows = [[f"{ledger.source}_{m.month_name}", m.start_time, m.end_time, counts.get(m.month_name, 0)] for m in months]
            tables.append(loaded, target, run_id, {run_id: windows})
        except Exception as fault:
            ledger.log(spark, "error", run_id, job.table, source=f"{ledger.source}_{months[0].month_name}", error=str(fault)[:MESSAGE])
            raise
        _log_marks(spark, target, ledger, job)
        total += sum(counts.values())
    return total


def _span(first: str, last: str) -> int:
    (a, b), (c, d) = first.split("-"), last.split("-")
    return 12 * (int(c) - int(a)) + int(d) - int(b)


def _load_window(spark: SparkSession, source: DataFrame, job: Job, target: str, ledger: Ledger, run_id: str) -> int:
    fields = choose_inc_fields(job.fields, "inc")
    run = f"{ledger.source}-{job.table}-{run_id}"
    if tables.has_run(spark, target, run):
        return 0
    ledger.log(spark, "started", run, job.table)
    try:
        rows = map_inc_fields(source, fields)
        if fields is None:
            # Without an incremental column every run takes the place of the table.
            loaded = add_time(pull_full(rows), ledger.as_of)
            n = loaded.count()
            tables.swap_commit(loaded, target, run_id=run, marks={run: [[ledger.source, "", "", n]]})
        else:
            so_far = tables.load(spark, target) if tables.exists(spark, target) else spark.createDataFrame([], rows.schema)
            window = resolve_window(so_far, fields.table_field, job.default_start, job.style, ledger.as_of).first()
            moment = _moment(rows, fields.table_field)
            part = rows.filter((moment > F.lit(window.start_time).cast("timestamp")) & (moment <= F.timestamp_seconds(F.lit(ledger.as_of))))
            n = part.count()
            tables.append(add_time(part, ledger.as_of), target, run, {run: [[ledger.source, window.start_time, window.end_time, n]]})
    except Exception as fault:
        ledger.log(spark, "error", run, job.table, error=str(fault)[:MESSAGE])
        raise
    _log_marks(spark, target, ledger, job)
    return n


def run_ingest(
    spark: SparkSession,
    source: DataFrame,
    job: Job,
    target: str,
    ledger: Ledger,
    run_id: str,
    mode: str | None = None,
    bounds: tuple[str, str] | None = None,
    months_at_once: int = MONTHS_AT_ONCE,
) -> int:
    """Load the months of ``bounds`` that are missing (``hist``), or the window since the last load (``inc``, the default).

    Returns the rows loaded. A failure is logged and raised; what was committed
    before it stays, and a repeat goes on behind it.
    """
    chosen = state.run_mode(mode)
    ledger.load(spark)
    _log_marks(spark, target, ledger, job)
    try:
        if chosen == "hist":
            if bounds is None:
                raise ValueError("a history load needs its first and last moment")
            n = _load_months(spark, source, job, target, ledger, bounds, months_at_once)
        else:
            n = _load_window(spark, source, job, target, ledger, run_id)
    except Exception as fault:
        ledger.log(spark, "runner_error", f"{run_id}-{chosen}", job.table, source=RUNNER, error=str(fault)[:MESSAGE])
        raise
    ledger.log(spark, "runner_completed", f"{run_id}-{chosen}", job.table, n, source=RUNNER)
    return n
