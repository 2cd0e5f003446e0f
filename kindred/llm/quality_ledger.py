"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and
one long of failure bits; a policy is a versioned mask of bits, so policies can
be changed, compared and ablated without reading a text again. Everything is
built-in expressions over one row, without a shuffle.

Defined results: a NULL or empty text has no words and fails the base rule; an
empty table gives an empty ledger; repeated rows are judged one by one; other
columns are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import let, words

#: Fixed limits of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.4
MEAN_WORD = (3.0, 10.0)
MAX_SHOUTED_SHARE = 0.3
MAX_WORDS = 100_000


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements, and its bit."""

    name: str
    bit: int
    fails: Column | str


#: Bit numbers never change once a ledger was stored with them.
RULES = [
    Rule("few_words", 0, f"n_words < {MIN_WORDS}"),
    Rule("repeated_windows", 1, f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("symbols", 2, f"n_symbols > {MAX_SYMBOLS_PER_WORD}D * n_words"),
    Rule("repeated_lines", 3, f"n_dup_lines > {MAX_DUP_LINE_SHARE}D * n_word_lines"),
    Rule("word_length", 4, f"word_chars < {MEAN_WORD[0]}D * n_words OR word_chars > {MEAN_WORD[1]}D * n_words"),
    Rule("shouting", 5, f"n_shouted > {MAX_SHOUTED_SHARE}D * n_words"),
    Rule("many_words", 6, f"n_words > {MAX_WORDS}"),
]

BASE_MASK = 0b0000011
#: Policies by version: the bits that reject a document.
POLICIES = {"v1": 0b0000011, "v2": 0b0111111, "v3": 0b1111111}
POLICY = "v2"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines", "n_shouted"]


def repeat_words(array: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    Windows are sorted by hash, then by their words, so equal ones stand together
    and a clash of hashes does no harm. Texts without two equal hashes, most of
    them, are not sorted.
    """
    n = F.size(array)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(array[i], array[i + 1], array[i + 2]))

    def covered(places: Column) -> Column:
        """Words in the windows that start at the sorted places."""
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    def windows() -> Column:
        at = lambda i: F.struct(
            F.xxhash64(array[i], array[i + 1], array[i + 2]).alias("h"),
            array[i].alias("a"),
            array[i + 1].alias("b"),
            array[i + 2].alias("c"),
            i.alias("p"),
        )
        return F.sort_array(F.transform(starts, at))

    def equal(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def twice(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1
        found = F.filter(
            sorted_windows,
            lambda x, i: F.when(i > 0, equal(x, sorted_windows[F.greatest(i - 1, F.lit(0))])).otherwise(False)
            | F.when(i < last, equal(x, sorted_windows[F.least(i + 1, last)])).otherwise(False),
        )
        return F.sort_array(F.transform(found, lambda x: x["p"]))

    any_twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(any_twice, covered(let(windows(), twice))).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its measurements; no other column."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = words(F.col("_text"))
    line_array = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    shouted = r"(?<![^\x20\x09-\x0D])[A-Z][A-Z!.,?;:]{2,}(?![^\x20\x09-\x0D])"
    of_words = let(
        split,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).alias("n_repeat_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        ),
    )
    of_lines = let(
        line_array,
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_word_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        ),
    )
    return base.select(
        "doc_id",
        of_words.alias("_w"),
        of_lines.alias("_l"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(shouted)).cast("long").alias("n_shouted"),
    ).select("doc_id", "_w.*", "_l.*", "n_symbols", "n_shouted")


def failure_bits(rules: list[Rule] = RULES) -> Column:
    """All rules of a measured row as one long."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        fails = F.expr(rule.fails) if isinstance(rule.fails, str) else rule.fails
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Measurements and failure bits of every document; what is stored."""
    measured = measure(docs, doc_id, text)
    return measured.withColumn("failure_bits", failure_bits(rules))


def passes(mask: int) -> Column:
    return F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long")) == 0


def apply_policy(rows: DataFrame, version: str = POLICY, policies: dict[str, int] = POLICIES) -> DataFrame:
    """Verdict of one policy over a ledger."""
    return rows.withColumns(
        {"base_failed": ~passes(BASE_MASK), "kept": passes(BASE_MASK) & passes(policies[version]), "policy": F.lit(version)}
    )


def ablations(rows: DataFrame, version: str = POLICY, policies: dict[str, int] = POLICIES, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    Only the counts of the distinct bit patterns, at most 2 to the number of
    rules, are expanded by rule.
    """
    mask = policies[version]
    patterns = rows.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("docs"))
    of_policy = [r for r in rules if mask >> r.bit & 1]
    listed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in of_policy])
    failed = F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long"))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("docs"))), F.lit(0)).alias
    return (
        patterns.select("failure_bits", "docs", F.inline(listed))
        .groupBy("rule", "bit")
        .agg(
            count(failed.bitwiseAND(F.col("bit")) != 0)("n_failed"),
            count(failed == F.col("bit"))("n_failed_alone"),
            count(failed.bitwiseAND(F.bitwise_not("bit")) == 0)("n_kept_without"),
            count(failed == 0)("n_kept"),
        )
    )


def stage(docs: DataFrame, version: str = POLICY) -> DataFrame:
    """The documents that the policy keeps, with the columns they came with."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wrapped = docs.select(row.alias("_doc"))
    judged = ledger(wrapped, "_doc", "_doc.text")
    return apply_policy(judged, version).filter("kept").select("doc_id.*")
