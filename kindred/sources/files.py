"""Delimited files with declared columns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.clock import java_pattern

CORRUPT = "_corrupt"
LINE = "_line"
NONE = "\uffff"
NEWLINES = {"CRLF": "\r\n", "LF": "\n"}


def resolve_path(pattern: str, date: str | None = None) -> str:
    """Static, dated (``{date}``) or wildcard path."""
    if "{date}" in pattern:
        if date is None:
            raise ValueError("the path needs a date")
        return pattern.replace("{date}", date)
    return pattern


def _typed(col: Column, kind: str, fmt: str | None) -> Column:
    if kind == "string":
        return col
    if kind in ("long", "double", "boolean"):
        return F.trim(col).try_cast(kind)
    if kind in ("timestamp", "date"):
        ts = F.try_to_timestamp(col, F.lit(java_pattern(fmt))) if fmt else col.try_cast("timestamp")
        return ts if kind == "timestamp" else ts.cast("date")
    if kind == "json":
        # Kept as text; what does not parse becomes NULL.
        return F.when(F.try_parse_json(col).isNotNull(), col)
    raise ValueError(f"unknown column type {kind!r}")


def parse_typed(df: DataFrame, columns: Sequence[Mapping[str, str]]) -> DataFrame:
    """Text columns to declared types; a value that does not parse becomes NULL."""
    return df.select(*[_typed(F.col(c["name"]), c["type"], c.get("format")).alias(c["name"]) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[Mapping[str, str]],
    delimiter: str = ",",
    quote: str = '"',
    escape: str = '"',
    charset: str = "UTF-8",
    newline: str | None = None,
    skip_header_lines: int = 1,
    stop_on_invalid_record: bool = False,
    allow_extra_columns: bool = False,
    allow_optional_columns: bool = False,
    trim_if_not_quoted: bool = False,
    date: str | None = None,
    with_file: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan delimited files.

    A record with too many or too few fields is dropped, kept by the ``allow_``
    options, or stops the load with ``stop_on_invalid_record``; so is a line with an
    open quote. With ``multi_line`` a quoted field may hold line ends; such files are
    read whole, others are split.
    """
    names = [c["name"] for c in columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])
    options = {
        "sep": delimiter,
        "quote": quote,
        "escape": escape,
        "enforceSchema": True,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "ignoreLeadingWhiteSpace": trim_if_not_quoted,
        "ignoreTrailingWhiteSpace": trim_if_not_quoted,
        "emptyValue": "",
        "nullValue": "",
    }
    reader = {"header": skip_header_lines > 0, "encoding": charset}
    if newline:
        reader["lineSep"] = NEWLINES.get(newline, newline)
    path = resolve_path(path, date)
    if multi_line:
        # Left alone, the parser takes the first line end of a file, perhaps one inside quotes, for
        # that of all records. Every record ends with LF here, and a CR before it is taken off below.
        rows = spark.read.schema(schema).options(**{"lineSep": "\n"} | options | reader | {"multiLine": True}).csv(path)
        if not newline:
            rows = _without_cr(rows, names)
    else:
        # Whole lines, so that quotes can be counted; no line holds the noncharacter.
        rows = spark.read.schema(T.StructType([T.StructField(LINE, T.StringType())])).options(**reader | {"sep": NONE, "quote": ""}).csv(path)
    if skip_header_lines > 1:
        # The reader drops one line per file; the further header lines are the
        # first records of the file's first block.
        rows = _drop_leading(rows, skip_header_lines - 1)
    if not multi_line:
        ends = F.replace(F.col(LINE), F.lit(escape + quote), F.lit("")) if escape != quote else F.col(LINE)
        is_open = (F.length(ends) - F.length(F.replace(ends, F.lit(quote), F.lit("")))) % 2 == 1
        given = ["_file"] if "_file" in rows.columns else []
        parsed = F.from_csv(LINE, _ddl(schema), {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()})
        rows = rows.select(LINE, parsed.alias("_r"), is_open.alias("_open"), *given).select(
            *[F.col(f"_r.{n}") for n in names], F.when(F.col("_open"), F.col(LINE)).otherwise(F.col(f"_r.{CORRUPT}")).alias(CORRUPT), "_open", *given
        )
    else:
        rows = rows.withColumn("_open", F.lit(False))
    # Whether a record fits shows only when all its fields are read, so the test
    # names them all, also under a query that needs none.
    bad = F.col(CORRUPT).isNotNull() & (F.length(F.concat_ws("", *names)) >= 0)
    if allow_extra_columns or allow_optional_columns:
        fields = F.size(F.split(F.regexp_replace(F.col(CORRUPT), f"{quote}[^{quote}]*{quote}", ""), f"\\Q{delimiter}\\E"))
        extra, short = fields > len(names), fields < len(names)
        allowed = F.lit(False)
        if allow_extra_columns:
            allowed = allowed | extra
        if allow_optional_columns:
            allowed = allowed | short
        bad = bad & (~allowed | F.col("_open"))
    if stop_on_invalid_record:
        rows = rows.withColumn(CORRUPT, F.when(bad, F.raise_error(F.concat(F.lit("invalid record: "), F.col(CORRUPT)))))
        rows = rows.filter(F.col(CORRUPT).isNull())
    else:
        rows = rows.filter(~bad)
    # A filter that went through Python no longer knows the reader's file name.
    origin = F.col("_file") if "_file" in rows.columns else F.input_file_name()
    kept = rows.select(*names, *([origin.alias("source_file")] if with_file else []))
    typed = [_typed(F.col(c["name"]), c["type"], c.get("format")).alias(c["name"]) for c in columns]
    return kept.select(*typed, *(["source_file"] if with_file else []))


def _without_cr(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The last field of every record without the CR of a CRLF behind it; empty is NULL."""
    last = {}
    for i, n in enumerate(names):
        bare = F.nullif(F.regexp_replace(n, "\r$", ""), F.lit(""))
        behind = [F.col(b).isNull() for b in names[i + 1 :]]
        ends = F.lit(True)
        for b in behind:
            ends = ends & b
        last[n] = F.when(ends, bare).otherwise(F.col(n))
    return rows.withColumns(last)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _drop_leading(rows: DataFrame, lines: int) -> DataFrame:
    """Drop the first ``lines`` records of every file.

    Only the block at offset 0 of a file holds them. Built-in expressions cannot
    number records within a file without a shuffle, so each task counts while its
    records stream through as Arrow batches.
    """
    tagged = rows.select("*", F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_path").alias("_file"))

    def skip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            place = batch.groupby("_file", sort=False).cumcount() + batch["_file"].map(lambda f: seen.get(f, 0))
            for name, count in batch["_file"].value_counts().items():
                seen[name] = seen.get(name, 0) + int(count)
            yield batch[(batch["_start"] > 0) | (place >= lines)].drop(columns="_start")

    kept = tagged.mapInPandas(skip, T.StructType(rows.schema.fields + [T.StructField("_file", T.StringType())]))
    return kept
