"""Removal of repeated passages through range-partitioned, sorted suffixes.

A byte goes if a 100-byte string that starts earlier in the corpus covers it. A
full suffix array would send at least 100 bytes for every byte of text, so the
suffixes are sampled so that no match is lost: every 100-byte window names the
32-byte string inside it with the smallest hash, which depends on the window's
bytes alone, and the suffix starting there stands for all windows that name it (35
on average). Equal windows name equal suffixes at the same distance.

1. *Suffixes.* Per document: the leading 32 bytes (``lead``), all bytes that its
   windows span (``span``, with their layout), both as 64-bit hashes with different
   bases, and the place. Suffixes whose lead and span were met before in the same
   stretch of a task are known copies and not sent.
2. *Sort.* Sampled splitters deal the suffixes to ranges of (lead, span, document,
   place); each range is sorted by these keys. Neighbours then tell everything: the
   same lead and span as the row before is a copy, the same lead with another span
   on either side is a partial match. Splitters may cut a group anywhere, so one
   key with a third of the rows is spread over many ranges; rows at the ends of a
   range are compared with the neighbouring ranges' ends.
3. *Partial matches* are taken apart. A window that names the lead holds half of
   the other 68 bytes to its left or to its right, so only the sides that another
   suffix of the lead shares are followed; their single windows are hashed and go
   through the same sort.
4. *Spans* of all copies are united per document and cut out.

Documents are ordered by id, NULL first, then by a hash of their text. Defined
results: a NULL text has no bytes; a text shorter than 100 bytes keeps all; rows
that repeat id and text are one document and get its result; overlapping matches
inside one text count; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import map_batches, row_key
from kindred.sources.scratch import Scratch

MATCH = 100
LEAD = 32
#: Bytes of text within which copies are found before the shuffle, bytes taken at a time, and rows per range.
STRETCH = 32 << 20
SLICE = 4 << 20
RANGE_ROWS = 500_000

#: Odd bases of the two hashes (fixed values: suffixes are stored under them), and their inverses modulo 2^64.
BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
_WORD = 1 << 64
DOC = ["id", "row"]
SUFFIX = "lead long, span long, id long, row long, start int, windows int"


class Hasher:
    """Hashes of all substrings of a byte string from running sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, _WORD)
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate((self.up, self.up * np.uint64(pow(self.base, k, _WORD))))
            self.down = np.concatenate((self.down, self.down * np.uint64(pow(self.inverse, k, _WORD))))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice, at: np.ndarray | slice) -> np.ndarray:
        """Mixed hashes of the substrings from ``starts`` to ``ends``."""
        h = (sums[ends] - sums[starts]) * self.down[at]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


_HASHERS: list[Hasher] = []


def hashers() -> list[Hasher]:
    if not _HASHERS:
        _HASHERS.extend(Hasher(b) for b in BASES)
    return _HASHERS


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[: len(out) - (width - reach)], out[width - reach :]) if reach < width else out


def suffixes(data: bytes) -> tuple[np.ndarray, ...]:
    """lead, span, start, windows of every sampled suffix; ``start`` is the place of its first window."""
    one, two = hashers()
    found = []
    for begin in range(0, max(len(data) - MATCH + 1, 0), SLICE):
        text = np.frombuffer(data, dtype=np.uint8)[begin : begin + SLICE + MATCH - 1]
        sums = one.sums(text)
        grams = len(text) - LEAD + 1
        leads = one.of(sums, slice(0, grams), slice(LEAD, LEAD + grams), slice(0, grams))
        # The hash decides, then the leftmost place: SLICE and more fit in 24 bits.
        ranked = (leads >> np.uint64(24) << np.uint64(24)) | np.arange(grams, dtype=np.uint64)
        named = (lowest(ranked, MATCH - LEAD + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.concatenate(([0], np.nonzero(np.diff(named))[0] + 1))
        count = np.diff(np.concatenate((first, [len(named)])))
        sums = two.sums(text)
        span = two.of(sums, first, first + count + MATCH - 1, first)
        layout = ((named[first] - first) << 32 | count).astype(np.uint64)
        span = span + layout * np.uint64(0x94D049BB133111EB)
        span ^= span >> np.uint64(31)
        found.append((leads[named[first]].view(np.int64), span.view(np.int64), begin + first, count))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(c) for c in zip(*found))


def repeats(keys: list[np.ndarray], places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by keys and places, and which rows in it repeat the keys of an earlier place."""
    order = np.lexsort([*places[::-1], *keys[::-1]])
    if not len(order):
        return order, np.zeros(0, dtype=bool)
    fresh = np.zeros(len(order), dtype=bool)
    fresh[0] = True
    for k in keys:
        fresh[1:] |= np.diff(k[order]) != 0
    group = np.cumsum(fresh) - 1
    heads = np.nonzero(fresh)[0][group]
    later = np.zeros(len(order), dtype=bool)
    for p in places:
        later |= p[order] != p[order][heads]
    return order, later


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), row_key(F.col(text)).alias("row"), F.col(text).alias("text"))


def _order(ids: list[int | None]) -> np.ndarray:
    """NULL ids before all others."""
    return np.array([-(1 << 63) if i is None else i for i in ids], dtype=np.int64)


def sample_suffixes(docs: DataFrame) -> DataFrame:
    """Suffixes of ``docs`` (id, row, text), with ``known`` where a copy stands earlier in the same stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        held: list[tuple] = []
        size = 0

        def flush() -> dict[str, list]:
            lead, span, ids, rows, start, windows = (np.concatenate(c) for c in zip(*held))
            order, later = repeats([lead, span], [ids, rows, start])
            known = np.empty(len(order), dtype=bool)
            known[order] = later  # the rows stay in the order of the documents, which stores well
            out = dict(zip(("lead", "span", "id", "row", "start", "windows"), (lead, span, ids, rows, start, windows)))
            return {k: pa.array(v) for k, v in out.items()} | {"known": pa.array(known)}

        for batch in batches:
            ids, rows = _order(batch.column(0).to_pylist()), batch.column(1).to_pylist()
            for i, t in enumerate(batch.column(2)):
                data = (t.as_py() or "").encode()
                lead, span, start, windows = suffixes(data)
                if len(lead):
                    same = np.full(len(lead), 1, dtype=np.int64)
                    held.append((lead, span, same * ids[i], same * rows[i], start.astype(np.int32), windows.astype(np.int32)))
                    size += len(data)
                if size > STRETCH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_batches(docs, run, f"{SUFFIX}, known boolean")


def neighbours(rows: DataFrame, scratch: Scratch, name: str, partial: bool) -> DataFrame:
    """Sort suffixes by range and tell what their neighbours show.

    Returned are the rows that repeat lead and span of an earlier place (``copy``),
    and, if ``partial`` ones are asked for, with ``copy`` false the first rows of their
    lead and span whose lead others share.
    """
    sort = ["lead", "span", "id", "row", "start"]
    n = max(1, -(-rows.count() // RANGE_ROWS))
    ranged = rows.select(*sort, "windows").repartitionByRange(n, *sort).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        lead, span, ids, row, start, windows, part = (c.to_numpy() for c in table.columns)
        order, copy = repeats([lead, span], [ids, row, start])
        lead, span = lead[order], span[order]
        new_lead = np.concatenate(([True], np.diff(lead) != 0))
        new_span = new_lead | np.concatenate(([True], np.diff(span) != 0))
        of_lead = np.cumsum(new_lead) - 1
        shared = np.bincount(of_lead, weights=new_span)[of_lead] > 1
        # The first group may go on from the range before, the outer leads may be shared with both neighbours.
        opens = (lead == lead[0]) & (span == span[0])
        outer = (lead == lead[0]) | (lead == lead[-1])
        take = np.nonzero(copy | opens | ((shared | outer) & ~copy & partial))[0]
        out = {c: pa.array(v[order][take]) for c, v in (("id", ids), ("row", row), ("start", start), ("windows", windows), ("part", part))}
        yield out | {
            "lead": pa.array(lead[take]), "span": pa.array(span[take]), "copy": pa.array(copy[take]), "shared": pa.array(shared[take]),
            "opens": pa.array(opens[take]), "first": pa.array(lead[take] == lead[0]), "last": pa.array(lead[take] == lead[-1]), "end": pa.array(np.zeros(len(take), dtype=bool)),
        }
        # One row for the range itself: its outer keys, as (lead, span) and (id, row).
        yield {
            "lead": [lead[0]], "span": [span[0]], "id": [lead[-1]], "row": [span[-1]], "start": [0], "windows": [0], "part": [part[0]],
            "copy": [False], "shared": [False], "opens": [False], "first": [False], "last": [False], "end": [True],
        }

    kind = f"{SUFFIX}, part int, copy boolean, shared boolean, opens boolean, first boolean, last boolean, end boolean"
    told = scratch.save(map_batches(ranged, run, kind), name)
    # One row per range, in the order of the ranges.
    at = Window.orderBy("part")
    ends = told.filter("end").select(
        "part",
        F.lag("id").over(at).alias("lead_before"),
        F.lag("row").over(at).alias("span_before"),
        F.lead("lead").over(at).alias("lead_after"),
    )
    goes_on = F.col("opens") & F.col("lead").eqNullSafe(F.col("lead_before")) & F.col("span").eqNullSafe(F.col("span_before"))
    beside = (F.col("first") & F.col("lead").eqNullSafe(F.col("lead_before"))) | (F.col("last") & F.col("lead").eqNullSafe(F.col("lead_after")))
    judged = told.filter("NOT end").join(ends, "part").withColumns({"copy": F.col("copy") | goes_on, "shared": F.col("shared") | beside})
    return judged.filter(F.col("copy") | (F.col("shared") & F.lit(partial))).select("lead", "span", *DOC, "start", "windows", "copy")


def contexts(docs: DataFrame, partial: DataFrame) -> DataFrame:
    """Partly matching suffixes with the bytes their windows span (``bytes``), the place of the lead in them
    (``at``), and hashes of the lead with half of a window's other bytes to its left and right (NULL at a text's end)."""
    # At most the suffixes of the document.
    wanted = partial.groupBy(*DOC).agg(F.collect_set(F.struct("start", "windows", "lead")).alias("wanted"))
    half = (MATCH - LEAD) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        names = ("lead", "id", "row", "start", "windows", "at", "left_side", "right_side", "bytes")
        one = hashers()[0]
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            for doc, row, t, spans in zip(*[c for c in batch.columns]):
                data, doc, row = (t.as_py() or "").encode(), doc.as_py(), row.as_py()
                for part in spans.as_py():
                    begin, count = part["start"], part["windows"]
                    own = data[begin : begin + count + MATCH - 1]
                    text = np.frombuffer(own, dtype=np.uint8)
                    # Where the lead stands: it is the span's lowest, found by its hash.
                    sums = one.sums(text)
                    leads = one.of(sums, slice(0, len(text) - LEAD + 1), slice(LEAD, len(text) + 1), slice(0, len(text) - LEAD + 1))
                    low = count - 1  # every window holds the lead, so it starts in the last one
                    at = low + int(np.nonzero(leads[low : MATCH - LEAD + 1].view(np.int64) == part["lead"])[0][0])
                    side = lambda a, b: int.from_bytes(hashlib.blake2b(own[a:b], digest_size=8).digest(), "little", signed=True)
                    left = side(at - half, at + LEAD) if at >= half else None
                    right = side(at, at + LEAD + half) if at + LEAD + half <= len(own) else None
                    for k, v in zip(names, (part["lead"], doc, row, begin, count, at, left, right, own)):
                        out[k].append(v)
            yield out

    joined = _ordered(docs).join(wanted, DOC).select(*DOC, "text", "wanted")
    return map_batches(joined, run, "lead long, id long, row long, start int, windows int, at int, left_side long, right_side long, bytes binary")


def windows_of(found: DataFrame) -> DataFrame:
    """Single windows of the sides that several suffixes of a lead share, as suffixes whose ``span`` is the window itself."""
    half = (MATCH - LEAD) // 2

    def shared(side: str) -> DataFrame:
        counted = found.filter(F.col(side).isNotNull()).groupBy("lead", side).agg(F.count(F.lit(1)).alias("n"))
        return counted.filter("n > 1").select("lead", side, F.lit(True).alias(f"follow_{side}"))

    # The joins of a hot lead are split by AQE.
    sided = found
    for side in ("left_side", "right_side"):
        sided = sided.join(shared(side), ["lead", side], "left")
    follow = sided.filter("follow_left_side OR follow_right_side").select(
        "lead", *DOC, "start", "windows", "at", "bytes", F.coalesce("follow_left_side", F.lit(False)), F.coalesce("follow_right_side", F.lit(False))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        two = hashers()[1]
        for batch in batches:
            held: list[tuple] = []
            for lead, doc, row, begin, count, place, own, left, right in zip(*[c.to_pylist() for c in batch.columns]):
                p = np.arange(count)
                reach = place - p  # bytes of the window before the lead
                p = p[(left & (reach >= half)) | (right & (MATCH - LEAD - reach >= half))]
                sums = two.sums(np.frombuffer(own, dtype=np.uint8))
                held.append((p * 0 + lead, two.of(sums, p, p + MATCH, p).view(np.int64), p * 0 + doc, p * 0 + row, p + begin))
            if not held:
                continue
            lead, span, ids, rows, start = (np.concatenate(c) for c in zip(*held))
            order, later = repeats([lead, span], [ids, rows, start])
            out = dict(zip(("lead", "span", "id", "row", "start"), (c[order] for c in (lead, span, ids, rows, start.astype(np.int32)))))
            yield {k: pa.array(v) for k, v in out.items()} | {"windows": pa.array(np.ones(len(order), dtype=np.int32)), "known": pa.array(later)}

    return map_batches(follow, run, f"{SUFFIX}, known boolean")


def _ordered(docs: DataFrame) -> DataFrame:
    """NULL ids as the smallest long, as in the suffixes."""
    return docs.withColumn("id", F.coalesce("id", F.lit(-(1 << 63))))


def copied_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Bytes that stand earlier: id (NULL as the smallest long), row, ``first``, ``last``; may overlap."""
    place = [*DOC, "start", "windows"]
    sampled = scratch.save(sample_suffixes(docs), "suffixes")
    known = scratch.save(sampled.filter("known").select(*place), "known")
    told = scratch.save(neighbours(sampled.filter("NOT known"), scratch, "sorted", True), "judged")
    scratch.drop("suffixes")
    scratch.drop("sorted")
    single = scratch.save(windows_of(scratch.save(contexts(docs, told.filter("NOT copy")), "contexts")), "windows")
    again = neighbours(single.filter("NOT known"), scratch, "sorted-windows", False)
    found = [known, told.filter("copy").select(*place), single.filter("known").select(*place), again.filter("copy").select(*place)]
    copies = found[0]
    for more in found[1:]:
        copies = copies.unionByName(more)
    return copies.select(*DOC, F.col("start").alias("first"), (F.col("start") + F.col("windows") + MATCH - 2).alias("last"))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and their maximal runs."""
    kept, at, removed, runs, reach = [], 0, 0, 0, -1
    for first, last in sorted(spans):
        if last <= reach:
            continue
        if first > reach + 1 or reach < 0:
            runs += 1
        begin = max(first, reach + 1)
        kept.append(data[at:begin])
        removed += last - begin + 1
        at, reach = last + 1, last
    kept.append(data[at:])
    return b"".join(kept), removed, runs


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, and the ``kept`` bytes."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    slim = _documents(docs, doc_id, text)
    # At most the suffixes and windows of the document.
    spans = copied_spans(slim, scratch).groupBy(*DOC).agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for doc, t, found in zip(batch.column(0), batch.column(1), batch.column(2)):
                data, doc = (t.as_py() or "").encode(), doc.as_py()
                kept, removed, runs = cut(data, [(x["first"], x["last"]) for x in found.as_py() or ()])
                for k, v in zip(out, (None if doc == -(1 << 63) else doc, len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept)):
                    out[k].append(v)
            yield out

    joined = _ordered(slim).join(spans, DOC, "left").select("id", "text", "spans")
    return map_batches(joined, run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
