"""What slice of a source to load next, and the columns every load adds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.clock import format_window_bound


def add_time(df: DataFrame, as_of: int) -> DataFrame:
    """Stamp the upload time."""
    return df.withColumn("time", F.lit(as_of).cast("long"))


def add_constant(df: DataFrame, name: str, data_type: str, value) -> DataFrame:
    """Tag every row with a fixed value."""
    return df.withColumn(name, F.lit(value).cast(data_type))


def pull_window(df: DataFrame, inc_col: str, start, end=None) -> DataFrame:
    """Rows after ``start`` and, if given, up to ``end``. Plain bounds reach the file scan."""
    rows = df.filter(F.col(inc_col) > F.lit(start))
    return rows if end is None else rows.filter(F.col(inc_col) <= F.lit(end))


def pull_full(df: DataFrame) -> DataFrame:
    """Everything, for sources without an incremental column."""
    return df


def resolve_window(
    target: DataFrame,
    inc_col: str | None,
    default_start: str,
    style: str,
    as_of: int,
    empty_start: bool = True,
) -> DataFrame:
    """One row: start_time (latest value loaded so far, or the default) and end_time.

    Without an incremental column the start is empty, or the default if
    ``empty_start`` is off.
    """
    end = format_window_bound(F.timestamp_seconds(F.lit(as_of)), style).alias("end_time")
    if not inc_col:
        start = F.lit("" if empty_start else default_start)
        return target.agg(F.count(F.lit(1)).alias("_n")).select(start.alias("start_time"), end)
    latest = target.agg(F.max(F.col(inc_col)).alias("_latest"))
    bound = F.col("_latest")
    if style != "sql":
        # These sources read whole seconds; the fraction is written as zeros.
        seconds = F.date_trunc("second", bound.try_cast("timestamp"))
        bound = format_window_bound(seconds, "millis_z" if style == "iso" else style)
    else:
        bound = bound.cast("string")
    return latest.select(F.coalesce(bound, F.lit(default_start)).alias("start_time"), end)


@dataclass(frozen=True)
class IncFields:
    """Names of the incremental column: in our table and at the source."""

    table_field: str
    source_field: str


def choose_inc_fields(config: Mapping[str, Mapping[str, str]], mode: str) -> IncFields | None:
    """Field names for a history (``hist``) or incremental (``inc``) load; None when
    the source has no incremental column."""
    entry = config.get(mode) or {}
    if not entry.get("table_field"):
        return None
    return IncFields(entry["table_field"], entry.get("source_field") or entry["table_field"])


def map_inc_fields(df: DataFrame, fields: IncFields | None) -> DataFrame:
    """Rename the source's column to the name our table uses."""
    if fields is None or fields.table_field == fields.source_field:
        return df
    return df.withColumnRenamed(fields.source_field, fields.table_field)
