"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that a task takes; a key with more is cut into pieces of this size.
# There are at most (rows / HOT_FLOOR) such keys: a hundred thousand in 10^11 rows.
HOT_FLOOR = 1_000_000
# Rows are first counted by this many hashes of their keys, or more where the table is larger.
PLACES = 1 << 16


def _any_null(on: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in on:
        test = test | F.col(name).isNull()
    return test


def crowded_places(df: DataFrame, on: Sequence[str], places: int, floor: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` with the place of their key, and the places of more than ``floor`` rows.

    NULL keys have a place of their own, NULL. A test of the keys, or of the place, would be pushed
    to the scan, where Spark computes the keys again for each of its terms.
    """
    keyed = df.select(*on, F.when(~_any_null(on), F.pmod(F.xxhash64(*on), F.lit(places))).alias("_place"))
    return keyed, keyed.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > floor).select("_place")


def hot_keys(df: DataFrame, on: Sequence[str], total: int, floor: int = HOT_FLOOR) -> DataFrame | None:
    """Keys of more than ``floor`` rows and the number of pieces of that size each needs; None if there are none.

    At most ``total / floor`` rows by construction. Where ``total`` is no more than
    ``floor`` there can be none, and nothing is counted. Else rows are counted by a hash of
    their key, which moves a few numbers only: no key has more rows than its hash. Keys
    themselves are counted where a hash has more than ``floor`` rows.
    """
    if total <= floor:
        return None
    spark, places = df.sparkSession, max(PLACES, 4 * -(-total // floor))
    keyed, crowded = crowded_places(df, on, places, floor)
    found = [row for row in crowded.collect() if row["_place"] is not None]
    if not found:
        return None
    crowded = spark.createDataFrame(found, crowded.schema)
    counts = keyed.join(F.broadcast(crowded), "_place", "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > floor).withColumn("_ways", F.ceil(F.col("_n") / floor).cast("int")).drop("_n")
    rows = hot.collect()
    return spark.createDataFrame(rows, hot.schema) if rows else None


def is_comparable(kind: T.DataType) -> bool:
    """Can values of the type be hashed and ordered? Maps and variants, also nested, cannot."""
    if isinstance(kind, T.StructType):
        return all(is_comparable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return is_comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_spread(df: DataFrame) -> Column:
    """A number that differs between rows and stays the same when a task is repeated."""
    names = [f"`{f.name}`" for f in df.schema.fields if is_comparable(f.dataType)]
    return F.xxhash64(*names, F.spark_partition_id())


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    floor: int = HOT_FLOOR,
    total: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Equi-join of a possibly skewed ``left`` with ``right``; ``how`` is inner, left,
    left_semi or left_anti.

    Hot keys of ``left`` are cut into pieces and the matching ``right`` rows are
    repeated once per piece. Rows with a NULL key match nothing and are spread.
    ``left`` should be cheap to count (a scan or a saved table), or the caller
    passes ``total``, its number of rows or an upper bound near it. ``largest`` is the
    number of rows of its most frequent key or an upper bound, where the caller knows it:
    up to ``floor``, keys are not counted.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} is not supported")
    on = list(on)
    keeps_unmatched = how in ("left", "left_anti")
    columns = left.columns + ([] if how.startswith("left_") else [c for c in right.columns if c not in on])
    if not keeps_unmatched:
        left = left.filter(~_any_null(on))
    total = left.count() if total is None else total
    hot = None if largest is not None and largest <= floor else hot_keys(left, on, total, floor)
    if hot is None and (not keeps_unmatched or total <= floor):
        return left.join(right, on, how).select(*columns)

    ways = F.lit(1)
    if hot is not None:
        left = left.join(F.broadcast(hot), on, "left")
        right = right.join(F.broadcast(hot), on, "left")
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1))).drop("_ways")
        ways = F.coalesce("_ways", F.lit(1))
    else:
        right = right.withColumn("_salt", F.lit(0))
    ways = F.when(_any_null(on), F.lit(-(-total // floor))).otherwise(ways)
    # Most rows have one way, and their columns are not hashed.
    left = left.withColumn("_salt", F.when(ways == 1, F.lit(0)).otherwise(F.pmod(row_spread(left), ways).cast("int")))
    return left.join(right, [*on, "_salt"], how).select(*columns)
