"""Union of a historical and an incremental table under the incremental schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.clock import epoch_text
from kindred.operators.state import new_rows

PROJECT = "hist_union"


def derive_names(name: Column) -> dict[str, Column]:
    """Table names that belong together, from any one of them."""
    base = F.regexp_replace(name, "_hist(union)?$", "")
    return {
        "inc_table": base,
        "hist_table": F.concat(base, F.lit("_hist")),
        "target_table": F.concat(base, F.lit("_histunion")),
    }


def derive_name_texts(name: str) -> tuple[str, str, str]:
    """The same for one plain name: incremental, historical, target."""
    base = name.removesuffix("_histunion").removesuffix("_hist")
    return base, f"{base}_hist", f"{base}_histunion"


def compare_schemas(inc: T.StructType, hist: T.StructType, spark: SparkSession) -> DataFrame:
    """Columns that differ: column_name, status, inc_type, hist_type."""
    left = {f.name: f.dataType.simpleString() for f in inc.fields}
    right = {f.name: f.dataType.simpleString() for f in hist.fields}
    rows = []
    for name in [*left, *[n for n in right if n not in left]]:
        if name not in right:
            rows.append((name, "inc_only", left[name], None))
        elif name not in left:
            rows.append((name, "hist_only", None, right[name]))
        elif left[name] != right[name]:
            rows.append((name, "type_differs", left[name], right[name]))
    return spark.createDataFrame(rows, "column_name string, status string, inc_type string, hist_type string")


def align_to(
    df: DataFrame,
    base: T.StructType,
    defaults: Mapping[str, Column] | None = None,
    keep_extra: bool = False,
) -> DataFrame:
    """Columns in base order; missing ones become a typed NULL or the given default."""
    defaults = defaults or {}
    columns = []
    for field in base.fields:
        if field.name in df.columns:
            columns.append(F.col(f"`{field.name}`"))
        else:
            columns.append(defaults.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name))
    if keep_extra:
        columns += [F.col(f"`{c}`") for c in df.columns if c not in base.names]
    return df.select(*columns)


def cast_align(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Named columns in one common type; what does not convert becomes NULL."""
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def _union(inc: DataFrame, hist: DataFrame, defaults: Mapping[str, Column] | None, keep_hist_only: bool) -> DataFrame:
    aligned = align_to(hist, inc.schema, defaults, keep_extra=keep_hist_only)
    return aligned.unionByName(inc, allowMissingColumns=keep_hist_only)


def hist_union_incremental(
    inc: DataFrame,
    hist: DataFrame,
    wm_inc: int = 0,
    wm_hist: int = 0,
    defaults: Mapping[str, Column] | None = None,
    keep_hist_only: bool = False,
) -> DataFrame:
    """Rows after each side's own watermark; duplicates stay."""
    return _union(new_rows(inc, wm_inc), new_rows(hist, wm_hist), defaults, keep_hist_only)


def hist_union_full(
    inc: DataFrame, hist: DataFrame, defaults: Mapping[str, Column] | None = None, keep_hist_only: bool = False
) -> DataFrame:
    """All rows of both sides, to replace the target."""
    return _union(inc, hist, defaults, keep_hist_only)


def hist_union_snapshot(inc: DataFrame) -> DataFrame:
    """The latest full snapshot replaces the target; history is not read."""
    return inc


CHANGE = "change"


def snapshot_changes(now: DataFrame, before: DataFrame | None, keys: Sequence[str], clock: str = "time") -> DataFrame:
    """Rows that differ between two snapshots: ``change`` is new, changed or vanished.

    Rows are compared by two hashes of all columns but the keys and the upload time; keys are equal
    where they are both NULL. A row that was not there before is new, or changed where its key
    was; a row of a key that is there no longer has vanished, at the time of the new snapshot. Equal
    rows count once. A column that was not there before counts as NULL.
    """
    names = now.columns
    if before is None:
        return now.withColumn(CHANGE, F.lit("new"))
    text = lambda cs: F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(cs)]), {"ignoreNullFields": "false"})
    compared = [c for c in names if c not in keys and c != clock]
    packed = text(compared) if compared else F.lit("")

    def side(df: DataFrame, is_now: bool) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in names])
        return df.select(text(keys).alias("_key"), F.struct(F.xxhash64(packed), F.md5(packed)).alias("_hash"), row.alias("_row"), F.lit(is_now).alias("_now"))

    both = side(now, True).unionByName(side(align_to(before, now.schema), False))
    rows = both.groupBy("_key", "_hash").agg(
        F.bool_or("_now").alias("_in_now"), F.bool_or(~F.col("_now")).alias("_in_before"), F.any_value("_row").alias("_row")
    )
    differ = rows.filter(F.col("_in_now") != F.col("_in_before")).select("_key", "_in_now", "_row")
    known = rows.groupBy("_key").agg(F.bool_or("_in_now").alias("_key_now"), F.bool_or("_in_before").alias("_key_before"))
    # One row per key on the right; a hot key on the left is cut by adaptive execution.
    told = differ.join(known, "_key").withColumn(
        CHANGE, F.when(F.col("_in_now"), F.when(F.col("_key_before"), "changed").otherwise("new")).when(~F.col("_key_now"), "vanished")
    )
    row = told.filter(F.col(CHANGE).isNotNull()).select("_row.*", CHANGE)
    if clock in names:
        latest = F.lit(now.agg(F.max(clock)).first()[0]).cast(now.schema[clock].dataType)
        row = row.withColumn(clock, F.when(F.col(CHANGE) == "vanished", F.coalesce(latest, F.col(clock))).otherwise(F.col(clock)))
    return row.select(*[F.col(f"`{c}`") for c in names], CHANGE)


def with_missing_side(spark: SparkSession, inc: DataFrame | None, hist: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Stand in an empty table for an absent side; both absent is an error."""
    if inc is None and hist is None:
        raise ValueError("neither the incremental nor the historical table exists")
    if inc is None:
        inc = spark.createDataFrame([], hist.schema)
    if hist is None:
        hist = spark.createDataFrame([], inc.schema)
    return inc, hist


def reconcile_counts(inc: DataFrame, hist: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of the three tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, df in (("inc", inc), ("hist", hist), ("histunion", target))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def origin_split(target: DataFrame, marker: str) -> DataFrame:
    """Rows by origin, told from a column only the incremental side fills."""
    origin = F.when(F.col(marker).isNull(), "from_hist").otherwise("from_inc")
    return target.groupBy(origin.alias("source")).agg(F.count(F.lit(1)).alias("row_count"))


def watermark_report(inc_log: DataFrame, project: str = PROJECT) -> DataFrame:
    """Committed values with a readable time, ordered by table."""
    return (
        inc_log.filter(F.col("project_name") == project)
        .withColumn("last_update_time", epoch_text(F.col("inc_value")))
        .orderBy("table_name", "inc_value")
    )
