"""From raw documents to packed training sequences, a stage at a time.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and is written as parquet before the next one reads it. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import lexical_packing, line_frequency, near_copies, positional_index, quality_ledger, simhash_index
from kindred.llm.common import ship
from kindred.sources.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_ledger.stage(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return line_frequency.stage(docs, "source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: by SimHash, and of those left by shingles of five words at 0.8 or more."""
    scratch = Scratch(spark, "near-duplicates")
    return near_copies.stage(scratch.save(simhash_index.stage(docs), "kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return positional_index.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return lexical_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can neither hash shingles as the fingerprints need nor run the tokenizer;
#: tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
