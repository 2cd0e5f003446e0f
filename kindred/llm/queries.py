"""One registered query per operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    hard_negatives,
    html_blocks,
    lexical_packing,
    license_join,
    line_frequency,
    positional_index,
    prefix_counts,
    quality_ledger,
    simhash_index,
    suffix_ranges,
    token_store,
    turn_repair,
    url_equivalence,
)
from kindred.llm.common import ship
from kindred.llm.oracles import ORACLES
from kindred.sources.scratch import Scratch

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_frequency.drop_boilerplate(_table(spark, sf_dir, "documents"), "source")
    return done.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.source").alias("host"), "n_lines", "n_dropped", "clean_text")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.apply_policy(quality_ledger.ledger(_table(spark, sf_dir, "documents")))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*first, "n_word_lines", "n_shouted", "failure_bits", "policy")


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_index.components(_table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select(F.col("id").alias("doc_id"), fingerprint.alias("fingerprint"), F.col("component").alias("component_id"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_equivalence.verdicts(_table(spark, sf_dir, "pages"), url_equivalence.rule_table(spark))


def token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "token-store")
    root = scratch.path("store")
    token_store.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), root, scratch)
    return token_store.read(spark, root, sums=True)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positional_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), near=True)
    return rows.withColumnRenamed("id", "doc_id").drop("row")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.table(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_ranges.dedup(_table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("id", "doc_id").drop("kept")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(_table(spark, sf_dir, "conversations")))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label")))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": line_dedup,
    "op2_quality_ledger": quality_rules,
    "op3_simhash_index": simhash,
    "op4_url_equivalence": url_filter,
    "op5_token_store": token_file,
    "op6_positional_index": decontamination,
    "op7_prefix_counts": token_counts,
    "op8_lexical_packing": packing,
    "op9_suffix_ranges": suffix_dedup,
    "op10_license_join": license_scan,
    "op11_turn_repair": conversation_repair,
    "op12_hard_negatives": negatives,
    "op13_html_blocks": main_text,
}
