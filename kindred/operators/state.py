"""Watermarks per table and project, and the ingestion ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.clock import epoch_text

INC_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("project_name", T.StringType()),
        T.StructField("inc_value", T.LongType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("workflow_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("job_url", T.StringType()),
        T.StructField("time", T.LongType()),
    ]
)


def watermark(inc_log: DataFrame, table: str, project: str) -> DataFrame:
    """One row with the highest committed value, 0 before the first run."""
    mine = (F.col("table_name") == table) & (F.col("project_name") == project)
    return inc_log.filter(mine).agg(F.coalesce(F.max("inc_value"), F.lit(0)).alias("inc_value"))


def read_watermark(inc_log: DataFrame, table: str, project: str) -> int:
    """The watermark as a number, so that filters on it reach the file scan."""
    return watermark(inc_log, table, project).first()["inc_value"]


def new_rows(df: DataFrame, wm: int, upto: int | None = None, col: str = "time") -> DataFrame:
    """Rows strictly after the watermark; ``upto`` bounds them to one snapshot."""
    rows = df.filter(F.col(col) > wm)
    return rows if upto is None else rows.filter(F.col(col) <= upto)


def max_time(df: DataFrame, col: str = "time") -> int | None:
    return df.agg(F.max(col)).first()[0]


def watermark_row(df: DataFrame, table: str, project: str, empty_as_zero: bool = False) -> DataFrame:
    """The row to append to the log: the highest time of the whole source table."""
    value = F.max("time").cast("long")
    if empty_as_zero:
        value = F.coalesce(value, F.lit(0).cast("long"))
    return df.agg(value.alias("inc_value")).select(
        F.lit(table).alias("table_name"), F.lit(project).alias("project_name"), "inc_value"
    )


def watermark_value_row(spark: SparkSession, table: str, project: str, value: int | None) -> DataFrame:
    """The same row from a value that was fixed before the data was loaded."""
    return spark.createDataFrame([(table, project, value)], INC_LOG_SCHEMA)


def pending_count(df: DataFrame, wm: int) -> DataFrame:
    """Watermark and number of rows after it; 0 means there is nothing to do."""
    return new_rows(df, wm).agg(F.count(F.lit(1)).alias("inc_records")).select(
        F.lit(wm).cast("long").alias("stg_time"), "inc_records"
    )


def choose_mode(target_exists: bool, mode: str = "incremental") -> str:
    """Full scan on the first run or on request, else incremental."""
    if mode not in ("incremental", "full"):
        raise ValueError("mode must be incremental or full")
    return "full" if mode == "full" or not target_exists else "incremental"


def run_mode(mode: str | None = None) -> str:
    """History by months, or the rolling window, which is the default."""
    if mode not in (None, "hist", "inc"):
        raise ValueError("mode must be hist or inc")
    return mode or "inc"


def month_ranges(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month between two timestamp columns: start_time, end_time, month_name."""
    first = F.date_trunc("month", F.col(start).cast("timestamp"))
    months = F.explode(F.sequence(first, F.col(end).cast("timestamp"), F.expr("interval 1 month")))
    text = "yyyy-MM-dd'T'HH:mm:ss"
    return bounds.select(months.alias("m")).select(
        F.concat(F.date_format("m", text), F.lit(".000000")).alias("start_time"),
        F.concat(F.date_format(F.last_day("m"), "yyyy-MM-dd"), F.lit("T23:59:59.000000")).alias("end_time"),
        F.date_format("m", "yyyy-MM").alias("month_name"),
    )


def pending_batches(ledger: DataFrame, ranges: DataFrame, source: str, workflow: str, table: str) -> DataFrame:
    """Months without a SUCCESS row for ``source_<month>``."""
    done = ledger.filter(
        (F.col("workflow_name") == workflow) & (F.col("table_name") == table) & (F.col("status") == "SUCCESS")
    ).select(F.col("source_name").alias("_batch"))
    keyed = ranges.withColumn("_batch", F.concat(F.lit(f"{source}_"), F.col("month_name")))
    return keyed.join(done, "_batch", "left_anti").drop("_batch")


def ledger_row(
    counted: DataFrame,
    kind: str,
    as_of: int,
    source: str | Column = "ingestion_runner",
    workflow: str = "ingestion_runner",
    table: str | None = None,
    start_time: str | Column | None = None,
    end_time: str | Column | None = None,
    error: str | None = None,
    job_id: str | None = None,
    job_url: str | None = None,
) -> DataFrame:
    """One ledger row for every row of ``counted``, which has ``records`` for the kinds that report them.

    Source and window may be columns of ``counted``.

    Kinds: started, success, success_no_window, error, runner_completed, runner_error.
    """
    now = F.concat(epoch_text(F.lit(as_of)), F.lit(" UTC"))
    text = lambda v: F.lit(v).cast("string")
    records: Column = F.col("records").cast("long")
    zero = F.lit(0).cast("long")
    runner_id = lambda prefix: F.concat(F.lit(prefix), F.lit(as_of).cast("string"))
    shapes = {
        "started": (F.concat(F.lit(source), F.lit(f"_{table}_"), now), "STARTED", now, text(None), zero),
        "success": (F.concat(F.lit(source), F.lit(f"_{table}_"), now), "SUCCESS", text(start_time), text(end_time), records),
        "success_no_window": (F.concat(F.lit(source), F.lit(f"_{table}_"), now), "SUCCESS", text(""), text(""), records),
        "error": (F.concat(F.lit(source), F.lit("_"), now), "ERROR", text(None), now, zero),
        "runner_completed": (runner_id("ingestion_runner_"), "COMPLETED", text(None), now, records),
        "runner_error": (runner_id("ingestion_runner_error_"), "ERROR", text(None), now, zero),
    }
    if kind not in shapes:
        raise ValueError(f"kind must be one of {sorted(shapes)}")
    log_id, status, start, end, count = shapes[kind]
    tabled = kind in ("started", "success", "success_no_window")
    job = kind in ("success", "success_no_window")
    return counted.select(
        log_id.alias("log_id"),
        F.lit(source).alias("source_name"),
        F.lit(workflow).alias("workflow_name"),
        text(table if tabled else None).alias("table_name"),
        F.lit(status).alias("status"),
        start.alias("start_time"),
        end.alias("end_time"),
        count.alias("records_processed"),
        text(error if kind.endswith("error") else None).alias("error_message"),
        text(job_id if job else None).alias("job_id"),
        text(job_url if job else None).alias("job_url"),
        F.lit(as_of).cast("long").alias("time"),
    )


def last_record_time(df: DataFrame, col: str, as_of: int, lookback_days: int = 30) -> DataFrame:
    """Latest text value of ``col`` among recently loaded rows."""
    recent = df.filter(F.col("time") >= as_of - 86400 * lookback_days)
    return recent.agg(F.coalesce(F.max(col), F.lit("1970-01-01 00:00:00")).alias("last_record_time"))
