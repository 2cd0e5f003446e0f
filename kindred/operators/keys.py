"""Finding and profiling identifier columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names that identify a person, by kind.
IDENTIFIER_NAMES = {
    "email": [
        "email",
        "email_std",
        "email_address",
        "email_address_std",
        "user_email",
        "customer_email",
        "recipient_email",
        "recipient_email_std",
    ],
    "phone": ["phone", "phone_std", "phone_number", "mobile_phone", "customer_phone", "phone_mobile"],
    "user_id": [
        "user_id",
        "customer_id",
        "account_id",
        "member_id",
        "uid",
        "user_uuid",
        "cust_id",
        "client_id",
    ],
    "identity": ["profile_id", "identity_id", "external_id"],
    "cookie_device": ["cookie_id", "device_id", "visitor_id", "browser_id"],
}

PRIMITIVE = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


Vocabulary = Mapping[str, Sequence[str]]


def _kind_of(name: str, vocabulary: Vocabulary) -> str | None:
    return next((kind for kind, names in vocabulary.items() if name.lower() in names), None)


def detect_identifiers(schemas: Mapping[str, T.StructType], spark: SparkSession, vocabulary: Vocabulary = IDENTIFIER_NAMES) -> DataFrame:
    """Identifier columns of primitive type: table_name, column_name, data_type, identifier_type.

    ``vocabulary`` has the column names of every kind of identifier, in lower case.
    """
    rows = [
        (table, f.name, f.dataType.simpleString(), _kind_of(f.name, vocabulary))
        for table, schema in schemas.items()
        for f in schema.fields
        if _kind_of(f.name, vocabulary) and isinstance(f.dataType, PRIMITIVE)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, identifier_type string")


def exclusion_report(schemas: Mapping[str, T.StructType], spark: SparkSession, vocabulary: Vocabulary = IDENTIFIER_NAMES) -> DataFrame:
    """Tables without a usable identifier, their columns and the reason."""
    rows = []
    for table, schema in schemas.items():
        named = [f for f in schema.fields if _kind_of(f.name, vocabulary)]
        if any(isinstance(f.dataType, PRIMITIVE) for f in named):
            continue
        reason = "identifier columns are not primitive" if named else "no user identifier columns found"
        rows.append((table, ", ".join(schema.names), reason))
    return spark.createDataFrame(rows, "table_name string, available_columns string, reason string")


def profile_keys(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Per column: min, max, distinct values, rows and NULLs, in long form.

    Values are counted down first, so distinct counting never widens the rows. The
    smallest and largest value are found in the column's own type and then written as text.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    # A field per type; a value sits in the field of its column's type.
    fields = {kind.simpleString(): f"v{i}" for i, kind in enumerate(dict.fromkeys(kinds.values()))}
    held = lambda c: [(F.col(c) if fields[kinds[c].simpleString()] == v else F.lit(None).cast(t)).alias(v) for t, v in fields.items()]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), *held(c)) for c in columns])
    values = df.select(F.inline(pairs)).groupBy("column_name", *fields.values()).agg(F.count(F.lit(1)).alias("n"))
    empty = F.lit(True)
    for v in fields.values():
        empty = empty & F.col(v).isNull()
    outer = lambda of: F.coalesce(*[of(v).cast("string") for v in fields.values()])
    return values.groupBy("column_name").agg(
        outer(F.min).alias("min_value"),
        outer(F.max).alias("max_value"),
        F.count_if(~empty).alias("unique_count"),
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("null_count"),
    ).select(F.lit(table).alias("table_name"), "*")


def key_overlap(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Shared distinct values of one identifier between tables, with coverage of each side.

    One pass: every value carries the set of tables that hold it, so there is no
    self-join on values.
    """
    names = list(tables)
    values = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(i).alias("t"), F.col(c).cast("string").alias("v")) for i, (df, c) in enumerate(tables.values())],
    ).filter(F.col("v").isNotNull())
    held = values.groupBy("v").agg(*[F.bool_or(F.col("t") == i).alias(f"t{i}") for i in range(len(names))])
    counts = held.agg(
        *[F.count_if(F.col(f"t{i}") & F.col(f"t{j}")).alias(f"n_{i}_{j}") for i in range(len(names)) for j in range(i, len(names))]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(names[i]).alias("table_a"),
                F.lit(names[j]).alias("table_b"),
                F.col(f"n_{i}_{i}").alias("values_a"),
                F.col(f"n_{j}_{j}").alias("values_b"),
                F.col(f"n_{i}_{j}").alias("shared"),
            )
            for i in range(len(names))
            for j in range(i + 1, len(names))
        ]
    )
    pct = lambda side: F.round(F.col("shared") * 100.0 / F.nullif(F.col(side), F.lit(0)), 2)
    return counts.select(F.inline(rows)).withColumns({"coverage_a_pct": pct("values_a"), "coverage_b_pct": pct("values_b")})
