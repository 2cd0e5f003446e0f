"""Packing of documents into training sequences by lexical retrieval.

Every window of a long document that it fills alone is a sequence of its own,
made where the document is read. What is left (whole short documents, and the
rests of long ones) is packed in shards of bounded size: rests have a
locality key, the smallest hash among their ids of highest inverse frequency, and are
dealt out by ranges of it that hold equally many ids, so that similar texts share a shard and a group of copies of any
size is spread over as many shards as it needs. Each shard holds a BM25 inverted
index over its texts; the terms are token ids, so the document frequencies of the
whole corpus are one array as long as the vocabulary. A seed document asks the
index with all its ids for its nearest unused texts, which fill its window best first. Where the
next one does not fit it is cut; what is left of it stays in the index. So only
the last sequence of a shard is padded, and the padding is under one sequence per
``SHARD_TOKENS``.

Defined results: a NULL or empty text is the end id alone; rows that repeat an id
are documents of their own, also with the same text; equal scores go by the order of
the shard; very long texts fill windows of their own but for their rest; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import token_store, tokens
from kindred.llm.common import map_batches
from kindred.sources.scratch import Scratch

WINDOW = 2048
#: Tokens per shard, ids that make the locality key, neighbours that are sorted at first, the part of a shard's texts
#: (one in so many) that makes a term common, and the usual BM25 constants.
SHARD_TOKENS = 1_000_000
KEY_TERMS = 32
FIRST = 64
COMMON = 4
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, seq long, offset long"


def frequencies(encoded: DataFrame, size: int, kind: np.dtype) -> tuple[np.ndarray, int, float]:
    """Documents containing each id, documents, and their mean length, over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        tokens.forget()
        found, docs, total = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                ids = np.frombuffer(packed, dtype=kind)
                found[distinct_ids(ids)] += 1
                docs, total = docs + 1, total + len(ids)
        at = np.nonzero(found)[0]
        yield {"term": [-2, -1, *at.tolist()], "n": [docs, total, *found[at].tolist()]}

    counted = map_batches(encoded.select("packed"), run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    rows = dict(counted.collect())  # at most the vocabulary and two
    docs, total = rows.pop(-2, 0), rows.pop(-1, 0)
    out = np.zeros(size, dtype=np.int64)
    if rows:
        out[np.fromiter(rows, np.int64, len(rows))] = np.fromiter(rows.values(), np.int64, len(rows))
    return out, docs, total / max(docs, 1)


def inverse_frequency(found: np.ndarray, docs: int) -> np.ndarray:
    return np.log1p((docs - found + 0.5) / (found + 0.5)).astype(np.float32)


def distinct_ids(ids: np.ndarray) -> np.ndarray:
    """The distinct ids in order."""
    ordered = np.sort(ids)
    return ordered[_firsts(ordered)]


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Marks the first of equal neighbours."""
    out = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=out[1:])
    return out


def telling_terms(terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The ids of highest inverse frequency of a text."""
    if len(terms) <= KEY_TERMS:
        return terms
    return terms[np.argpartition(-idf[terms], KEY_TERMS)[:KEY_TERMS]]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A fixed hash of ids."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def split(encoded: DataFrame, kind: np.dtype, idf: np.ndarray, window: int = WINDOW) -> DataFrame:
    """Full windows (``rest`` NULL) and rests (``rest`` their ids, ``near`` the locality key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        seq, part = 0, 0
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "seq", "near", "rest")}

            def add(doc, start, ids, n, seq, near, rest):
                for k, v in zip(out, (doc, start, len(ids), _crc(ids), n, part, seq, near, rest)):
                    out[k].append(v)

            for doc, packed, own in zip(*[c.to_pylist() for c in batch.columns]):
                ids, part = np.frombuffer(packed, dtype=kind), own
                full = len(ids) // window * window
                for at in range(0, full, window):
                    add(doc, at, ids[at : at + window], len(ids), seq, None, None)
                    seq += 1
                if full < len(ids):
                    distinct = distinct_ids(ids)
                    telling = telling_terms(distinct, idf)
                    # Its number tells it from rests of the same document id and text.
                    add(doc, full, ids[full:], len(ids), seq, int(_mixed(telling).min()), ids[full:].tobytes())
                    seq += 1
            yield out

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, seq long, near long, rest binary"
    return map_batches(encoded.select("doc_id", "packed", F.spark_partition_id().alias("part")), run, schema)


class Shard:
    """BM25 index over the texts of a shard, and their greedy packing."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean: float):
        self.rests, self.idf = rests, idf
        self.lengths = np.array([len(r) for r in rests], dtype=np.int64)
        # Text and term of every id, in order.
        both = np.repeat(np.arange(len(rests)) << 32, self.lengths) + np.concatenate(rests)
        both.sort()
        at = np.flatnonzero(_firsts(both))
        tf = np.diff(at, append=len(both)).astype(np.float32)
        text, term = both[at] >> 32, both[at] & 0xFFFFFFFF
        self.terms = np.split(term, np.searchsorted(text, np.arange(1, len(rests))))
        # Postings by term: text and weight, as one array per term.
        norm = K1 * (1 - B + B * self.lengths[text] / max(mean, 1.0))
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.text, self.weight = text[order], weight[order]
        self.heads = np.searchsorted(term[order], np.arange(len(idf) + 1))
        # The weights of a common term are also a row over all texts; in all these are at most COMMON as many numbers as postings.
        common = np.flatnonzero(COMMON * np.diff(self.heads) >= len(rests))
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        often = self.row[term] >= 0
        self.rows = np.zeros((len(common), len(rests)), dtype=np.float32)
        self.rows[self.row[term[often]], text[often]] = weight[often]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every text for all ids of the seed."""
        terms = self.terms[seed]
        row = self.row[terms]
        rare = terms[row < 0]
        first = self.heads[rare]
        size = self.heads[rare + 1] - first
        at = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        found = np.bincount(self.text[at], weights=self.weight[at], minlength=len(self.rests))
        return found + self.rows[row[row >= 0]].sum(axis=0)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """All unused texts that share an id with the seed, best first; equal scores in the order of the shard."""
        scores = self.scores(seed)
        found = np.flatnonzero((scores > 0) & unused)
        # A window takes few: the others are sorted only if they are asked for.
        least = np.partition(scores[found], -FIRST)[-FIRST] if len(found) > FIRST else 0.0
        for some in (found[scores[found] >= least], found[scores[found] < least]):
            yield from some[np.argsort(-scores[some], kind="stable")].tolist()

    def pack(self, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, first id, length, sequence, offset) of every piece."""
        unused = np.ones(len(self.rests), dtype=bool)
        taken = np.zeros(len(self.rests), dtype=np.int64)  # ids of each text already placed
        seq, room, following = -1, 0, 0
        cut: int | None = None
        while True:
            if cut is not None:
                seed, cut = cut, None
            else:
                # A new seed: the next text in locality order, also where the neighbours ran out before the window was full.
                while following < len(unused) and not unused[following]:
                    following += 1
                if following == len(unused):
                    return
                seed = following
            if room == 0:
                seq, room = seq + 1, window
            unused[seed] = False
            for text in chain([seed], self.neighbours(seed, unused)):
                unused[text] = False
                first = int(taken[text])
                length = min(room, int(self.lengths[text]) - first)
                yield text, first, length, seq, window - room
                taken[text] += length
                room -= length
                if taken[text] < self.lengths[text]:
                    cut = text  # the window is full; its rest seeds the next one
                if room == 0:
                    break


def pack_rests(rests: DataFrame, kind: np.dtype, idf: np.ndarray, mean: float, window: int = WINDOW) -> DataFrame:
    """One shard per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        # A worker that has encoded before would hold its pieces beside the shard.
        tokens.forget()
        rows = [r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns])]
        if not rows:
            return
        texts = [np.frombuffer(r[4], dtype=kind) for r in rows]
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "seq", "offset")}
        for text, first, length, seq, offset in Shard(texts, idf, mean).pack(window):
            doc, start, n, own, _ = rows[text]
            piece = texts[text][first : first + length]
            for k, v in zip(out, (doc, start + first, length, _crc(piece), n, own, seq, offset)):
                out[k].append(v)
        yield out

    return map_batches(rests.select("doc_id", "start", "doc_tokens", F.spark_partition_id().alias("part"), "rest"), run, PIECES)


def dealt(rests: DataFrame, shard_tokens: int) -> DataFrame:
    """The rests, one shard per partition, in the order of the locality key.

    A key is the hash of one id, so the tokens of every key are at most as many numbers as the
    vocabulary. Laid end to end in key order they give a shard to every place; a rest takes its place
    among those of its key by a hash. A shard so has about ``shard_tokens``, whatever the lengths of its rests.
    """
    spread = F.xxhash64("doc_id", "ids_crc32", "part", "seq")
    total = rests.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // shard_tokens))
    before = Window.orderBy("near").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rests.groupBy("near").agg(F.sum("length").alias("_size"))
    starts = sizes.select("near", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_size") * (F.pmod(spread, F.lit(1 << 20)) / F.lit(1 << 20))
    shard = F.least(F.floor(place * F.lit(shards) / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int")
    placed = rests.join(F.broadcast(starts), "near").withColumn("_shard", shard).drop("_size", "_start")
    return placed.repartitionById(shards, F.col("_shard")).drop("_shard").sortWithinPartitions("near", spread, "doc_id", "start")


def pack(docs: DataFrame, path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, **columns) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    size, kind = tokens.load(path).get_vocab_size(), tokens.kind(path)
    encoded = scratch.save(token_store.encode(docs, path, **columns), "encoded")
    found, n_docs, mean = frequencies(encoded, size, kind)
    idf = inverse_frequency(found, n_docs)
    cut = scratch.save(split(encoded, kind, idf, window), "cut")
    rests = dealt(cut.filter(F.col("rest").isNotNull()), shard_tokens)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # Even numbers for full windows, odd ones for packed shards; a partition has fewer than 2^32 sequences.
    number = lambda odd: (F.shiftleft(F.shiftleft(F.col("part").cast("long"), 32) + F.col("seq"), 1) + odd).alias("sequence_id")
    full = cut.filter(F.col("rest").isNull()).select(*columns[:5], number(0), F.lit(0).cast("long").alias("offset"))
    packed = pack_rests(rests, kind, idf, mean, window).select(*columns[:5], number(1), "offset")
    return full.unionByName(packed)
