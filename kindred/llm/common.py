"""Expressions and helpers that several operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Java patterns of what stands between words.
SPACES = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word between such, without steps back.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"

#: ASCII only: letters to lower case, every other byte that is no letter or digit to a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


#: Bits that tell which keys may be among some ids.
PLACES = 1 << 23

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, as ``--py-files`` would, where their path does not have it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if root in known or os.path.basename(root) == "site-packages" or context.applicationId in _SHIPPED:
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "kindred"), "zip", root, "kindred")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def byte_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().translate(WORD_BYTES).split()


def ascii_lower(col: Column) -> Column:
    """A-Z to lower case; other characters stay (``lower`` would also change them)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column, separator: str = SPACES) -> Column:
    """Words of a text as an array; none for NULL."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), separator, -1), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Inside array functions Spark would otherwise repeat it for every element.
    """
    return F.transform(F.array(value), use)[0]


def row_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def null_safe_join(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that takes NULLs as equal; the key columns appear once."""
    b = b.withColumnsRenamed({n: f"_right_{n}" for n in names})
    test = F.lit(True)
    for n in names:
        test = test & F.col(n).eqNullSafe(F.col(f"_right_{n}"))
    joined = a.join(b, test, how)
    return joined if how.startswith("left_") else joined.drop(*[f"_right_{n}" for n in names])


def may_be_among(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``df`` with a boolean ``_may``: false only where the long ``key`` is none of ``ids`` (one column).

    What is broadcast is a bit for each of ``PLACES`` hashes, whatever the number of ids, so the rows of
    ``df`` stay where they are; only those that may be meant need an exact join.
    """
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(PLACES)).alias("_place")
    word, bit = F.expr("cast(_place div 64 as int)"), F.expr("shiftleft(1L, cast(_place % 64 as int))")
    words = ids.select(place(ids.columns[0])).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = df.select("*", place(key)).select("*", word.alias("_at"))
    met = placed.join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    return met.withColumn("_may", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_place", "_at", "_word", "_bits")


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with a function that yields one dictionary of columns per batch."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for columns in fn(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    return df.mapInArrow(run, kind)
