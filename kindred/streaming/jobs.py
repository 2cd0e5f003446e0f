"""Structured Streaming forms of hist-union, staging and de-duplication.

All run with ``availableNow``: they take what has arrived since the last run and
stop. The stream's checkpoint stands in for the watermark log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from kindred.operators.histunion import align_to
from kindred.operators.staging import Rules, stage
from kindred.sources import tables


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_arrivals(rows: DataFrame, target: str, checkpoint: str, stored: bool) -> StreamingQuery:
    """Append a stream to a parquet folder, or to a stored table that batch jobs read.

    The batches of a stored table are committed under run ids made of the name of the
    checkpoint folder and the number of the batch. A batch that is written but was not
    checkpointed is repeated and adds nothing.
    """
    stream = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def write(batch: DataFrame, number: int) -> None:
        run_id = f"{stream}-batch{number}"
        if tables.has_run(batch.sparkSession, target, run_id):
            # The stream's state still has to take in the batch.
            batch.write.format("noop").mode("overwrite").save()
        else:
            tables.append(batch, target, run_id)

    if not stored:
        writer = rows.writeStream.format("parquet").option("path", target)
    else:
        writer = rows.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_hist_union(
    spark: SparkSession,
    inc_path: str,
    inc_schema: T.StructType,
    hist_path: str,
    hist_schema: T.StructType,
    target: str,
    checkpoint: str,
    defaults: Mapping[str, Column] | None = None,
    max_files: int | None = None,
    stored: bool = False,
) -> StreamingQuery:
    """Append what arrived on either side to the target, under the incremental schema.

    One query reads both folders, each with its own offsets.
    """
    inc = read_arrivals(spark, inc_path, inc_schema, max_files)
    hist = align_to(read_arrivals(spark, hist_path, hist_schema, max_files), inc_schema, defaults)
    return write_arrivals(hist.unionByName(inc), target, checkpoint, stored)


def stream_stage_upsert(
    spark: SparkSession,
    arrivals: str,
    schema: T.StructType,
    rules: Rules,
    source: str,
    as_of: int,
    root: str,
    checkpoint: str,
    buckets: int | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Clean and de-duplicate every batch, then upsert it. A replayed batch gives the same table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.upsert_table(stage(batch, rules, source, as_of), root, rules.keys, f"batch{batch_id}", buckets)

    rows = read_arrivals(spark, arrivals, schema, max_files)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedupe(
    spark: SparkSession,
    arrivals: str,
    schema: T.StructType,
    keys: Sequence[str],
    lateness: str,
    target: str,
    checkpoint: str,
    max_files: int | None = None,
    stored: bool = False,
) -> StreamingQuery:
    """Keep the first row per key seen within the lateness bound of ``time``.

    Rows with a NULL in their key are no duplicates of each other, unless the whole row repeats.
    """
    rows = read_arrivals(spark, arrivals, schema, max_files).withColumn("_event", F.timestamp_seconds("time"))
    whole = F.xxhash64(*[F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("\x00")) for f in schema.fields])
    keyless = F.when(F.greatest(*[F.col(f"`{k}`").isNull() for k in keys], F.lit(False)), whole)
    kept = rows.withColumn("_keyless", keyless).withWatermark("_event", lateness).dropDuplicatesWithinWatermark([*keys, "_keyless"])
    return write_arrivals(kept.drop("_event", "_keyless"), target, checkpoint, stored)
