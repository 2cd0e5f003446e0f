"""Intermediate tables on shared storage, to cut lineage in loops.

A written table survives lost executors, carries real sizes for adaptive
planning and is read back column by column.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="kindred-")
    return _LOCAL_ROOTS[context.applicationId]


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path object and its file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


class Scratch:
    """A private folder of intermediate tables for one run."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a frame that reads the written files."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bytes_of(self, name: str) -> int:
        jpath, fs = hadoop_path(self.spark, self.path(name))
        return fs.getContentSummary(jpath).getLength()

    def drop(self, name: str) -> None:
        """Remove a table that a later, fully written one has replaced."""
        jpath, fs = hadoop_path(self.spark, self.path(name))
        fs.delete(jpath, True)

    def close(self) -> None:
        """Remove the folder. Frames that still read from it must be done with."""
        jpath, fs = hadoop_path(self.spark, self.root)
        fs.delete(jpath, True)
