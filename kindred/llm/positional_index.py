"""Benchmark decontamination with a distributed positional inverted index.

The terms are runs of three words of the test items (all words of shorter items).
One scan of the training texts stores their postings: term, document, positions.
Rarest terms come first: every window of an item names its rarest term by the
counts of the whole corpus, and only the postings of these are shifted by their
place in the item to give alignments (document, item, shift). The alignments found
are intersected with the shifted postings of the item's other terms; a run of
neighbouring terms long enough is an exact match of the phrase, word by word.
Nothing is looked up in the texts again.

A proximity match holds a share of an item's terms at shifts that differ by little: its
words stand near each other as in the item, with some changed, added or left out.
Of an item with n terms of which m are asked for, one of the n - m + 1 rarest must
occur; the documents with such a term meet the postings of the item's other terms.

Test items are taken in blocks of at most ``BLOCK_WORDS`` words on average, one scan
each, so that what a scan carries along (the block's terms) has a bound whatever
the size of the benchmark. Terms held by a large share of the documents only meet
the few item places that name them, a join that AQE broadcasts by size or splits.

Defined results: a NULL or empty text has no words, no hits and is not
contaminated; an item without words never occurs; an item without an id is matched
but not named; rows that repeat an id are judged by their own text each; an empty
benchmark contaminates nothing, and no documents give no rows; a text of any length is
scanned whole by the task that reads it; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import byte_words, map_batches, null_safe_join, row_key
from kindred.sources.scratch import Scratch

#: Words of a window, words of a term, share of hit words that contaminates (one in 20).
WINDOW = 13
TERM = 3
SHARE = 20
#: Proximity: shifts fall into bins of ``SLOP`` + 1, two neighbouring bins are taken together and must hold this share of an item's terms.
SLOP = 10
NEAR_SHARE = 0.5
#: Words of test items per scan.
BLOCK_WORDS = 250_000

DOC = ["id", "row"]


class TestBlock:
    """Terms of some test items, numbered, with their places in the items."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.terms: dict[tuple[int, ...], int] = {}
        #: (item, its words, its window, its term length, its term at every place)
        self.items: list[tuple[int, int, int, int, list[int]]] = []
        self.ids = [i for i, _ in items]
        for number, (_, text) in enumerate(items):
            parts = [self.numbers.setdefault(w, len(self.numbers)) for w in byte_words(text)]
            if not parts:
                continue
            size = min(TERM, len(parts))
            places = [self.terms.setdefault(tuple(parts[i : i + size]), len(self.terms)) for i in range(len(parts) - size + 1)]
            self.items.append((number, len(parts), min(window, len(parts)), size, places))

    def finder(self) -> TermFinder:
        return TermFinder(self.numbers, self.terms)


class TermFinder:
    """Places of the block's terms in a text; travels with the tasks."""

    def __init__(self, numbers: dict[bytes, int], terms: dict[tuple[int, ...], int]):
        self.numbers, self.base, self.tables = numbers, len(numbers) + 1, {}
        for size in range(1, TERM + 1):
            found = sorted((self.key(t), n) for t, n in terms.items() if len(t) == size)
            if found:
                self.tables[size] = (np.array([k for k, _ in found], dtype=np.int64), np.array([n for _, n in found], dtype=np.int64))

    def key(self, term: tuple[int, ...]) -> int:
        out = 0
        for t in term:
            out = out * self.base + t + 1
        return out

    def find(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Words of the text, and (term, position) of every term in it."""
        parts = byte_words(text)
        get = self.numbers.get
        numbers = np.array([get(w, -1) for w in parts], dtype=np.int64) + 1
        terms, places = [], []
        for size, (keys, names) in self.tables.items():
            n = len(numbers) - size + 1
            if n <= 0:
                continue
            key, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
            for i in range(size):
                part = numbers[i : i + n]
                key, known = key * self.base + part, known & (part > 0)
            at = np.nonzero(known)[0]
            slot = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
            hit = keys[slot] == key[at]
            terms.append(names[slot[hit]])
            places.append(at[hit])
        empty = np.empty(0, dtype=np.int64)
        return len(parts), np.concatenate([empty, *terms]), np.concatenate([empty, *places])


def scan(docs: DataFrame, finder: TermFinder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``n_words`` and its postings, an array of (term, positions)."""
    carried = docs.sparkSession.sparkContext.broadcast(finder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        find = carried.value.find
        for batch in batches:
            n_words, postings = [], []
            for t in batch.column(2):
                n, terms, places = find(t.as_py())
                n_words.append(n)
                order = np.argsort(terms, kind="stable")
                terms, places = terms[order], places[order]
                heads = np.nonzero(np.diff(terms, prepend=-1))[0]
                lists = np.split(places, heads[1:]) if len(heads) else []
                postings.append([{"term": t, "positions": p} for t, p in zip(terms[heads].tolist(), [x.tolist() for x in lists])])
            yield {"id": batch.column(0), "row": batch.column(1), "n_words": n_words, "postings": postings}

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), row_key(F.col(text)).alias("row"), F.col(text))
    return map_batches(rows, run, "id long, row long, n_words long, postings array<struct<term:long,positions:array<int>>>")


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple]]:
    """The test items, some at a time."""
    items = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    words = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"] // 4
    blocks = max(1, -(-words // block_words))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    dealt = items.withColumn("block", block) if blocks > 1 else items.withColumn("block", F.lit(0))
    if blocks > 1:
        dealt = Scratch(benchmark.sparkSession, "items").save(dealt, "dealt")
    for b in range(blocks):
        yield [tuple(r) for r in dealt.filter(F.col("block") == b).select("item", "text").collect()]


class Index:
    """Stored postings of one block of test items."""

    def __init__(self, docs: DataFrame, block: TestBlock, scratch: Scratch, name: str, **columns):
        self.spark, self.block = docs.sparkSession, block
        scanned = scratch.save(scan(docs, block.finder(), **columns), f"{name}-scanned")
        self.docs = scanned.select(*DOC, "n_words")
        flat = scanned.filter(F.size("postings") > 0).select(*DOC, F.inline("postings"))
        self.postings = scratch.save(flat.distinct().hint("rebalance", "term"), f"{name}-postings")
        #: Corpus count of every term of the block.
        self.counts = dict(self.postings.groupBy("term").agg(F.sum(F.size("positions")).alias("n")).collect())

    def rarest(self) -> tuple[list[tuple], list[tuple]]:
        """(item, place, term) of the rarest term of every window, and of all terms of items that can occur."""
        anchors, rest = [], []
        for number, n, window, size, places in self.block.items:
            count = [self.counts.get(t, 0) for t in places]
            own = set()
            for start in range(n - window + 1):
                span = range(start, start + window - size + 1)
                if all(count[i] for i in span):
                    own.add(min(span, key=lambda i: (count[i], i)))
            anchors += [(number, i, places[i]) for i in sorted(own)]
            rest += [(number, i, t) for i, t in enumerate(places) if own]
        return anchors, rest

    def aligned(self, places: list[tuple]) -> DataFrame:
        """Postings shifted by the place of their term: document, item, place, shift."""
        named = self.spark.createDataFrame(places, "item int, place int, term long")
        met = self.postings.join(named, "term")
        return met.select(*DOC, "item", "place", F.explode("positions").alias("position")).select(
            *DOC, "item", "place", (F.col("position") - F.col("place")).alias("shift")
        )

    def matches(self, scratch: Scratch, name: str) -> DataFrame:
        """Exact matches: document, ``item``, and the words ``first`` to ``last`` of a run of windows."""
        anchors, rest = self.rarest()
        found = scratch.save(self.aligned(anchors).select(*DOC, "item", "shift").distinct(), f"{name}-aligned")
        all_terms = self.aligned(rest)
        inside = null_safe_join(all_terms, found, [*DOC, "item", "shift"], "left_semi")
        # At most the item's words per alignment.
        lists = inside.groupBy(*DOC, "item", "shift").agg(F.sort_array(F.collect_set("place")).alias("places"))
        sizes = self.spark.createDataFrame([(i[0], i[2], i[3]) for i in self.block.items] or [], "item int, window int, size int")
        wide = lists.join(sizes, "item")
        # Neighbouring places differ from their rank by the same number.
        runs = wide.select(*DOC, "item", "shift", "window", "size", F.posexplode("places").alias("rank", "place"))
        runs = runs.groupBy(*DOC, "item", "shift", "window", "size", (F.col("place") - F.col("rank")).alias("run")).agg(
            F.min("place").alias("a"), F.max("place").alias("b")
        )
        long = runs.filter(F.col("b") - F.col("a") + F.col("size") >= F.col("window"))
        return long.select(
            *DOC, "item", (F.col("a") + F.col("shift")).alias("first"), (F.col("b") + F.col("shift") + F.col("size") - 1).alias("last")
        )

    def near(self, scratch: Scratch, name: str, slop: int = SLOP, share: float = NEAR_SHARE) -> DataFrame:
        """Proximity matches, once per document and ``item``. An item found whole is one of them."""
        first, rest, needs = [], [], []
        for number, _, _, _, places in self.block.items:
            need = max(1, math.ceil(share * len(places) - 1e-9))
            count = [self.counts.get(t, 0) for t in places]
            known = [i for i in range(len(places)) if count[i]]
            if len(known) >= need:
                order = sorted(range(len(places)), key=lambda i: (count[i], i))
                first += [(number, places[i]) for i in order[: len(places) - need + 1] if count[i]]
                rest += [(number, i, places[i]) for i in known]
                needs.append((number, need))
        rare = self.spark.createDataFrame(first, "item int, term long").distinct()
        some = scratch.save(self.postings.join(rare, "term").select(*DOC, "item").distinct(), f"{name}-near")
        asked = some.join(self.spark.createDataFrame(rest, "item int, place int, term long"), "item")
        met = null_safe_join(asked, self.postings, [*DOC, "term"])
        shifts = met.select(*DOC, "item", "place", F.explode("positions").alias("position"))
        low = F.floor((F.col("position") - F.col("place")) / F.lit(slop + 1))
        bins = shifts.select(*DOC, "item", "place", F.explode(F.array(low - 1, low)).alias("bin")).distinct()
        held = bins.groupBy(*DOC, "item", "bin").agg(F.count(F.lit(1)).alias("n"))
        asked_for = self.spark.createDataFrame(needs, "item int, need int")
        return held.join(asked_for, "item").filter(F.col("n") >= F.col("need")).select(*DOC, "item").distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block_words: int = BLOCK_WORDS,
    near: bool = False,
) -> DataFrame:
    """Per row: id, row, n_words, n_hit, n_items, items_sha256, contaminated; with ``near`` also n_near_items, the
    number of items with a proximity match."""
    scratch = Scratch(docs.sparkSession, "contamination")
    all_docs, hits, close = None, [], []
    for number, items in enumerate(blocks_of(benchmark, item_id, text, block_words)):
        block = TestBlock(items)
        index = Index(docs, block, scratch, f"block{number}", doc_id=doc_id, text=text)
        all_docs = all_docs or index.docs
        names = docs.sparkSession.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(block.ids)], "item int, name string")
        hits.append(index.matches(scratch, f"block{number}").join(names, "item").select(*DOC, "name", "first", "last"))
        if near:
            close.append(index.near(scratch, f"block{number}").select(*DOC))
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    # Spans in order; each adds the words behind all spans before it.
    at = Window.partitionBy(*DOC).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select(*DOC, "first", "last").distinct().withColumn("seen", F.coalesce(F.max("last").over(at), F.lit(-1)))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first"), F.col("seen") + 1) + 1)
    covered = spans.groupBy(*DOC).agg(F.sum(fresh).cast("long").alias("n_hit"))
    # The items of a document, at most the benchmark's.
    named = found.groupBy(*DOC).agg(F.sort_array(F.collect_set("name")).alias("names"))
    joined = null_safe_join(all_docs, null_safe_join(covered, named, DOC), DOC, "left")
    none = F.array().cast("array<string>")
    out = joined.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "names": F.coalesce("names", none)})
    added = []
    if near:
        counted = reduce(DataFrame.unionByName, close).groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_near"))
        out = null_safe_join(out, counted, DOC, "left")
        added = [F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near_items")]
    return out.select(
        *DOC,
        "n_words",
        "n_hit",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        *added,
    )


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no test item contaminates, with the columns they came with."""
    bad = contamination(docs, benchmark).filter("contaminated").select("id", "row").distinct()
    wrapped = docs.select(
        F.col("doc_id").cast("long").alias("id"), row_key(F.col("text")).alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    )
    return null_safe_join(wrapped, bad, DOC, "left_anti").select("_doc.*")
