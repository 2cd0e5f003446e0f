"""Identity preparation: key tables, their upkeep, exclusions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.cleaning import EMAIL_PATTERN
from kindred.operators.skew import HOT_FLOOR, salted_join
from kindred.operators.staging import key_texts

PHONE_MAX = 10
HASH_LENGTH = 64


def _present(names: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(n) for n in names]).isNotNull()


def prep_project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct rows of the key columns as text under their aliases (column -> alias),
    with at least one key present."""
    aliases = sorted(columns.values())
    return df.select(*[F.col(c).cast("string").alias(a) for c, a in columns.items()]).select(*aliases).filter(_present(aliases)).distinct()


def _key_rows(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Key tuples of a source under ``_k0`` and so on, NULL as empty text."""
    renamed = df.select(*[F.col(c).cast("string").alias(a) for c, a in columns.items()])
    texts = key_texts(sorted(columns.values()))
    return renamed.select(*[t.alias(f"_k{i}") for i, t in enumerate(texts)]).distinct()


def _with_key(df: DataFrame, aliases: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_k{i}" for i in range(len(aliases))]
    for name, text in zip(names, key_texts(sorted(aliases))):
        df = df.withColumn(name, text)
    return df, names


def prep_delete_vanished(prep: DataFrame, src: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Prep rows whose key tuple the source still holds."""
    keyed, names = _with_key(prep, list(columns.values()))
    return keyed.join(_key_rows(src, columns), names, "left_semi").select(*prep.columns)


def prep_new_rows(src: DataFrame, prep: DataFrame, columns: Mapping[str, str], as_of: int) -> DataFrame:
    """Source key rows the prep table does not hold yet, stamped with the time."""
    aliases = sorted(columns.values())
    fresh = src.select(*[F.col(c).cast("string").alias(a) for c, a in columns.items()]).select(*aliases)
    fresh = fresh.filter(_present(aliases)).distinct().subtract(prep.select(*aliases))
    return fresh.withColumn("time", F.lit(as_of).cast("long"))


def input_cascade_delete(unif_input: DataFrame, prep: DataFrame, aliases: Sequence[str], source: str) -> DataFrame:
    """Drop rows of one source that its prep table no longer holds; other sources stay."""
    mine, others = unif_input.filter(F.col("source") == source), unif_input.filter(~F.col("source").eqNullSafe(source))
    keyed, names = _with_key(mine, list(aliases))
    held = _key_rows(prep, {a: a for a in aliases})
    return others.unionByName(keyed.join(held, names, "left_semi").select(*unif_input.columns))


def source_watermark(unif_input: DataFrame, source: str) -> int:
    return unif_input.filter(F.col("source") == source).agg(F.coalesce(F.max("time"), F.lit(0))).first()[0]


def input_append(prep: DataFrame, unif_input: DataFrame, aliases: Sequence[str], source: str) -> DataFrame:
    """Unified input plus the prep rows newer than what this source delivered before."""
    newer = prep.filter(F.col("time") > source_watermark(unif_input, source)).select(
        *sorted(aliases), "time", F.lit(source).alias("source"), F.col("time").alias("ingest_time")
    )
    return unif_input.unionByName(newer, allowMissingColumns=True)


def find_masked(df: DataFrame) -> DataFrame:
    """Values that privacy requests replaced: key_name, key_value."""
    phone = df.filter(F.length("phone") > PHONE_MAX).select(F.lit("phone").alias("key_name"), F.col("phone").alias("key_value"))
    email = df.filter((F.length("email") == HASH_LENGTH) & ~F.col("email").contains("@")).select(
        F.lit("email").alias("key_name"), F.col("email").alias("key_value")
    )
    return phone.unionByName(email)


def extend_exclusions(exclusions: DataFrame, masked: DataFrame, table: str) -> DataFrame:
    """Exclusion list plus the masked values it does not hold, once each."""
    fresh = masked.distinct().join(exclusions.select("key_name", "key_value").distinct(), ["key_name", "key_value"], "left_anti")
    note = F.concat(F.lit("DSAR masked "), F.col("key_name"))
    return exclusions.unionByName(
        fresh.select("key_value", "key_name", F.array(F.lit(table)).alias("tbls"), note.alias("note"))
    )


def apply_exclusions(
    df: DataFrame, exclusions: DataFrame, columns: Mapping[str, str] | None = None, floor: int = HOT_FLOOR
) -> DataFrame:
    """Replace listed values by NULL; ``columns`` maps a column to its key name.

    Values of any type are compared as text, as the list holds them.
    The list grows with the data, so its size decides whether it is broadcast.
    """
    columns = {"email": "email", "phone": "phone"} if columns is None else columns
    order, rows = df.columns, df.count()
    for column, key in columns.items():
        listed = (
            exclusions.filter(F.col("key_name") == key)
            .select(F.col("key_value").cast("string").alias("_text"))
            .distinct()
            .withColumn("_hit", F.lit(True))
        )
        keyed = df.withColumn("_text", F.col(column).cast("string"))
        joined = salted_join(keyed, listed, ["_text"], "left", floor=floor, total=rows)
        df = joined.withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*order)
    return df


def require_contact(df: DataFrame, columns: Sequence[str] = ("email", "phone")) -> DataFrame:
    """Rows with an e-mail or a phone."""
    return df.filter(_present(list(columns)))


def prep_long(parts: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Long form of one e-mail key: each part is (table, its name, key column, id column)."""
    frames = []
    for df, table, column, id_column in parts:
        rows = df.filter(F.col(column).isNotNull() & (F.col(column) != "") & F.col(column).rlike(EMAIL_PATTERN))
        frames.append(
            rows.select(
                F.lit(table).alias("source_table"),
                F.lit(column).alias("source_column"),
                F.lower(F.trim(F.col(column))).alias("key_value"),
                F.col(id_column).cast("string").alias("source_id"),
            ).distinct()
        )
    return reduce(DataFrame.unionByName, frames)


#: Pattern that a value of a key type has to meet; other key types take every text that is not empty.
KEY_PATTERNS = {"email": EMAIL_PATTERN, "phone": r"^\s*\+?[0-9][0-9 ().-]{5,}$"}


def prep_long_keys(parts: Sequence[tuple[DataFrame, str, str, str, str]], patterns: Mapping[str, str] = KEY_PATTERNS) -> DataFrame:
    """Long form of keys of any type: each part is (table, its name, key column, id column, key type).

    NULL, blank and, where the type has a pattern, other texts are left out. Keys of
    any column type are compared as lower-case text.
    """
    frames = []
    for df, table, column, id_column, key_type in parts:
        text = F.col(column).cast("string")
        valid = F.trim(text) != ""
        if key_type in patterns:
            valid = valid & text.rlike(patterns[key_type])
        frames.append(
            df.filter(valid).select(
                F.lit(key_type).alias("key_type"),
                F.lit(table).alias("source_table"),
                F.lit(column).alias("source_column"),
                F.lower(F.trim(text)).alias("key_value"),
                F.col(id_column).cast("string").alias("source_id"),
            ).distinct()
        )
    return reduce(DataFrame.unionByName, frames)


def key_distribution(prep: DataFrame) -> DataFrame:
    """Per key type: distinct values and rows."""
    # Two plain aggregations; a value with very many rows is counted down first.
    per_value = prep.groupBy("key_type", "key_value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("key_type").agg(F.count("key_value").alias("unique_keys"), F.sum("n").alias("total_records"))
