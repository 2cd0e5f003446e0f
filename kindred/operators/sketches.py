"""Sketches of identifier columns: distinct values and overlaps without shuffling values.

A theta sketch of 2^``lg`` entries (16 bytes each at most) is kept per column and load,
beside the table it describes. Sketches merge, so a load only reads its own rows, and
pairs of columns are compared through their sketches alone. Up to 2^``lg`` distinct
values the figures are exact; above, ``error`` is three standard errors.

Only the pairs that are worth it get the exact pass, see ``exact_overlap``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.sources import tables

#: Binary logarithm of the entries of a sketch: a distinct count has a standard error of 0.8 %.
LG_ENTRIES = 14

SKETCHES = "table_name string, column_name string, identifier_type string, row_count long, null_count long, sketch binary"


class Pair(NamedTuple):
    """Two identifier columns of one kind."""

    identifier_type: str
    table_a: str
    column_a: str
    table_b: str
    column_b: str


def _value(name: str) -> Column:
    """A value as text behind a mark, since sketches take no notice of empty text."""
    return F.concat(F.lit("="), F.col(name).cast("string"))


def sketch_columns(df: DataFrame, table: str, columns: Mapping[str, str], lg: int = LG_ENTRIES) -> DataFrame:
    """One row per column of ``columns`` (name to kind of identifier), from one pass that shuffles sketches only.

    Values are compared as text. A column without values, or an empty table, has an empty sketch.
    """
    made = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(columns):
        made += [F.count(F.col(name)).alias(f"_n{i}"), F.theta_sketch_agg(_value(name), F.lit(lg)).alias(f"_s{i}")]
    rows = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(name).alias("column_name"), F.lit(kind).alias("identifier_type"),
            F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"), F.col(f"_s{i}").alias("sketch"),
        )
        for i, (name, kind) in enumerate(columns.items())
    ]
    return df.agg(*made).select(F.inline(F.array(*rows)))


def record_sketches(df: DataFrame, table: str, columns: Mapping[str, str], root: str, run_id: str, lg: int = LG_ENTRIES) -> None:
    """Add the sketches of a load's rows to the stored ones at ``root``; a load that is there already adds nothing."""
    tables.create_if_absent(df.sparkSession, root, SKETCHES)
    tables.append(sketch_columns(df, table, columns, lg), root, f"{table}:{run_id}")


def merge_sketches(stored: DataFrame, lg: int = LG_ENTRIES) -> DataFrame:
    """One row per column over all loads."""
    return stored.groupBy("table_name", "column_name", "identifier_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.theta_union_agg("sketch", F.lit(lg)).alias("sketch")
    )


def profile_estimate(merged: DataFrame) -> DataFrame:
    """Rows, NULLs and (estimated) distinct values of every column."""
    return merged.select(
        "table_name", "column_name", "identifier_type", F.theta_sketch_estimate("sketch").alias("unique_count"), "row_count", "null_count"
    )


def _coverages(rows: DataFrame) -> DataFrame:
    pct = lambda side: F.round(F.col("shared") * 100.0 / F.nullif(F.col(side), F.lit(0)), 2)
    return rows.withColumns({"coverage_a_pct": pct("values_a"), "coverage_b_pct": pct("values_b")})


def overlap_estimate(merged: DataFrame, lg: int = LG_ENTRIES) -> DataFrame:
    """Estimated shared values of all pairs of columns of the same kind, with ``error``.

    There are as many rows as the schemas have columns, so the join is of that size whatever the tables hold.
    """
    side = lambda s: merged.select(
        "identifier_type", F.struct("table_name", "column_name").alias(f"at_{s}"), F.col("table_name").alias(f"table_{s}"),
        F.col("column_name").alias(f"column_{s}"), F.col("sketch").alias(f"sketch_{s}"),
    )
    pairs = side("a").join(side("b"), "identifier_type").filter(F.col("at_a") < F.col("at_b"))
    estimate: dict[str, Column] = {
        "values_a": F.theta_sketch_estimate("sketch_a"),
        "values_b": F.theta_sketch_estimate("sketch_b"),
        "shared": F.theta_sketch_estimate(F.theta_intersection("sketch_a", "sketch_b")),
        "_either": F.theta_sketch_estimate(F.theta_union("sketch_a", "sketch_b", F.lit(lg))),
    }
    k = float(1 << lg)
    # Of k values drawn from the union a share is in both; none seen still leaves room for three in k.
    spread = F.ceil(3 * F.sqrt(F.greatest(F.col("shared"), F.col("_either") / k) * F.col("_either") / k))
    error = F.when(F.col("_either") > k, spread).otherwise(0).cast("long")
    return _coverages(pairs.withColumns(estimate)).select(*Pair._fields, "values_a", "values_b", "shared", error.alias("error"), "coverage_a_pct", "coverage_b_pct")


def worthwhile(estimates: DataFrame, min_pct: float) -> list[Pair]:
    """Pairs that may cover at least ``min_pct`` percent of either side, the error included; at most as many as the schemas have pairs."""
    most = (F.col("shared") + F.col("error")) * 100.0
    rows = estimates.filter((most >= min_pct * F.least("values_a", "values_b")) & (F.col("shared") + F.col("error") > 0))
    return [Pair(*r) for r in rows.select(*Pair._fields).orderBy(*Pair._fields).collect()]


def exact_overlap(sources: Mapping[str, DataFrame], pairs: Sequence[Pair]) -> DataFrame:
    """Exact shared values of the given pairs, in one pass over the columns they name and no others."""
    places: dict[tuple[str, str, str], int] = {}
    for p in pairs:
        for at in ((p.identifier_type, p.table_a, p.column_a), (p.identifier_type, p.table_b, p.column_b)):
            places.setdefault(at, len(places))
    if not places:
        raise ValueError("no pairs were asked for")
    read = [
        sources[table].select(F.lit(kind).alias("kind"), F.lit(i).alias("t"), F.col(column).cast("string").alias("v")).filter("v IS NOT NULL")
        for (kind, table, column), i in places.items()
    ]
    # A value carries one flag per column; flags of a hot value are combined before the shuffle.
    held = reduce(DataFrame.unionByName, read).groupBy("kind", "v").agg(*[F.bool_or(F.col("t") == i).alias(f"t{i}") for i in places.values()])
    both = lambda i, j: F.count_if(F.col(f"t{i}") & F.col(f"t{j}"))
    counted, rows = [], []
    for n, p in enumerate(pairs):
        i, j = places[p.identifier_type, p.table_a, p.column_a], places[p.identifier_type, p.table_b, p.column_b]
        counted += [both(i, i).alias(f"a{n}"), both(j, j).alias(f"b{n}"), both(i, j).alias(f"s{n}")]
        names = [F.lit(v).alias(k) for k, v in p._asdict().items()]
        rows.append(F.struct(*names, F.col(f"a{n}").alias("values_a"), F.col(f"b{n}").alias("values_b"), F.col(f"s{n}").alias("shared")))
    return _coverages(held.agg(*counted).select(F.inline(F.array(*rows))))
