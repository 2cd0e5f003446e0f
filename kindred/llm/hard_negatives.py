"""Hard negatives by exact integer scores, several candidates in one wide integer.

A component x becomes floor(256 x). Candidates' components are biased to be
nonnegative and packed side by side into fields of one wide integer, one such
integer per component and group of candidates (Kronecker substitution). An anchor
multiplies each of its biased components once with the packed integer and adds
up; as no field can overflow into the next, the fields of the sum are the biased
scores of all candidates of the group, and taking the bias out gives them exactly.
The wide integers are doubles as long as two fields fit into their 53 exact bits,
so that a matrix product does the multiplying and adding; else they are Python
integers with eight fields of any width. Field widths follow from bounds measured over all rows.

The anchors are a stated query set. They meet all rows in rounds of a bounded
number of anchors: a round is broadcast, every partition of the rows keeps the
best of each anchor, and these few are merged. The first scan of a round finds
the positives, the second the negatives inside the range of each positive.

Defined results: rows with a NULL label, a NULL vector or a NULL or non-finite
component take no part; components that a shorter vector lacks count as 0; a row
without vec_id is no anchor and comes last among ties; rows that repeat a vec_id
are rows of their own, so a repetition of an anchor may be its positive; an
anchor without positives, or a positive without negatives in its range, gives no
rows; a score beyond 64 bits is returned as the nearest long; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import map_batches
from kindred.sources.scratch import Scratch

SCALE = 256
#: Positives of an anchor, negatives of a positive, and the range of a negative's score in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Anchors per round, and those and the candidates of one matrix product.
ROUND_ANCHORS, TILE_ANCHORS, TILE_ROWS = 8_192, 512, 4_096
#: Bits of a double's exact integers; fields of a Python integer.
DOUBLE_BITS, WIDE_FIELDS = 53, 8
LONG = np.iinfo(np.int64)


def prepared(rows: DataFrame, every: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows that take part: ``rid``, ``vec_id``, ``label``, ``parts`` (integers held as doubles), ``anchor``."""
    # A name of its own per column: the table may have a column of any name.
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    # Not finite, or not after scaling.
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v * F.lit(float(SCALE))) == F.lit(float("inf"))))
    sound = own.filter(F.col("label").isNotNull() & F.col("x").isNotNull()).filter(~odd)
    parts = F.transform("x", _floor)
    anchor = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    return sound.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", parts.alias("parts"), anchor.alias("anchor"))


def _floor(v):
    """floor(256 v) as a double, also beyond 64 bits, where doubles are whole anyway."""
    scaled = v * F.lit(float(SCALE))
    return F.when(F.abs(scaled) < F.lit(float(1 << 53)), F.floor(scaled).cast("double")).otherwise(scaled)


class Fields:
    """How candidates are packed, from the dimension and the ranges of anchors' and candidates' components."""

    def __init__(self, dim: int, anchors: tuple[int, int], candidates: tuple[int, int]):
        self.dim, (self.low_a, high_a), (self.low_b, high_b) = dim, anchors, candidates
        top = max(1, dim) * (high_a - self.low_a) * (high_b - self.low_b)
        self.bits = max(1, top.bit_length())
        self.doubles = 2 * self.bits <= DOUBLE_BITS
        self.fields = 2 if self.doubles else WIDE_FIELDS
        self.kind = np.dtype(np.float64) if self.doubles else np.dtype(object)

    def matrix(self, vectors: list[np.ndarray], low: int) -> np.ndarray:
        """Biased components, a row per vector; missing ones are 0 before the bias."""
        out = np.zeros((len(vectors), self.dim))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        if self.doubles:
            return out - low
        return np.array([[int(v) - low for v in row] for row in out.tolist()], dtype=object).reshape(len(vectors), self.dim)

    def pack(self, biased: np.ndarray) -> np.ndarray:
        """Wide integers of groups of candidates: dimension x groups."""
        groups = -(-len(biased) // self.fields)
        wide = np.zeros((groups, self.dim), dtype=self.kind)
        for f in range(self.fields):
            part = biased[f * groups : (f + 1) * groups]
            wide[: len(part)] += part * (2.0 ** (self.bits * f) if self.doubles else 1 << (self.bits * f))
        return wide.T

    def scores(self, anchors: np.ndarray, wide: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Exact scores of anchors x candidates, both biased; ``wide`` are the packed candidates."""
        sums = anchors @ wide
        out = []
        for _ in range(self.fields - 1):
            rest = np.floor(sums * 2.0**-self.bits) if self.doubles else sums >> self.bits
            out.append(sums - rest * (2.0**self.bits if self.doubles else 1 << self.bits))
            sums = rest
        biased = np.concatenate([*out, sums], axis=1)[:, : len(candidates)]
        own, theirs = anchors.sum(axis=1), candidates.sum(axis=1)
        # (a - low_a)(b - low_b), summed, holds the score and these three terms.
        bias = self.low_b * own[:, None] + self.low_a * theirs[None, :] + self.dim * self.low_a * self.low_b
        exact = biased + bias
        return exact.astype(np.int64) if self.doubles else exact


def best(scores: np.ndarray, fits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the places of the ``most`` highest scores that fit, ties by place, and which of them are there."""
    rows, n = scores.shape
    if scores.dtype == object:
        at, there = np.zeros((rows, most), dtype=np.int64), np.zeros((rows, most), dtype=bool)
        for i in range(rows):
            order = sorted(np.flatnonzero(fits[i]).tolist(), key=lambda j: (-scores[i, j], j))[:most]
            at[i, : len(order)], there[i, : len(order)] = order, True
        return at, there
    # Score and place as one number, so that there are no ties.
    key = np.where(fits, scores * n + (n - 1 - np.arange(n)), LONG.min)
    if n > most:
        at = np.argpartition(key, n - most, axis=1)[:, n - most :]
    else:
        at = np.broadcast_to(np.arange(n), (rows, n))
    return at, np.take_along_axis(key, at, axis=1) != LONG.min


def _clip(value) -> int:
    return min(max(int(value), LONG.min), LONG.max)


#: What is kept of a candidate: the anchor's place in the round, the positive's place, and the candidate.
FOUND = "anchor int, slot int, score long, wide string, rid long, vec_id long"


def scan(rows: DataFrame, anchors: list, fields: Fields, slots: list[list[tuple[int, int]]] | None, most: int) -> DataFrame:
    """The best candidates of every partition for each anchor of a round.

    Without ``slots`` these are the rows of the anchor's label but itself (slot 0). With them, the rows of
    other labels for each slot, a range of scores. ``wide`` has the digits of a score beyond 64 bits.
    """
    rids = np.array([a.rid for a in anchors], dtype=np.int64)
    labels = np.array([a.label for a in anchors], dtype=np.int64)
    carried = rows.sparkSession.sparkContext.broadcast(([np.array(a.parts) for a in anchors], slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        vectors, ranges = carried.value
        mine = fields.matrix(vectors, fields.low_a)
        kept: dict[tuple[int, int], list[tuple]] = {}
        # The score that a further candidate has to reach.
        n_slots = 1 if ranges is None else max(map(len, ranges), default=0)
        cut = np.full((len(mine), n_slots), LONG.min, dtype=np.int64)

        def tile(rid: np.ndarray, ids: list, label: np.ndarray, parts: list[np.ndarray]) -> None:
            order = np.lexsort((rid, np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is None for i in ids])))
            rid, label, ids = rid[order], label[order], [ids[i] for i in order.tolist()]
            theirs = fields.matrix([parts[i] for i in order.tolist()], fields.low_b)
            wide = fields.pack(theirs)
            for first in range(0, len(mine), TILE_ANCHORS):
                part = slice(first, first + TILE_ANCHORS)
                scores = fields.scores(mine[part], wide, theirs)
                same = labels[part, None] == label[None, :]
                if ranges is None:
                    asked = [(0, same & (rids[part, None] != rid[None, :]))]
                else:
                    asked = []
                    for slot in range(max(map(len, ranges[part]), default=0)):
                        bounds = [r[slot] if slot < len(r) else (1, 0) for r in ranges[part]]
                        low, high = (np.array(b, dtype=scores.dtype)[:, None] for b in zip(*bounds))
                        asked.append((slot, ~same & (scores >= low) & (scores <= high)))
                for slot, fits in asked:
                    at, there = best(scores, fits & (scores >= cut[part, slot, None]), most)
                    for a, b in zip(*np.nonzero(there)):
                        j = at[a, b]
                        kept.setdefault((first + int(a), slot), []).append((-int(scores[a, j]), ids[j] is None, ids[j] or 0, int(rid[j])))
            for (a, slot), found in kept.items():
                if len(found) > most:
                    found.sort()
                    del found[most:]
                    cut[a, slot] = _clip(-found[-1][0])

        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> None:
            nonlocal held, n
            table = pa.Table.from_batches(held)
            rid, label = table.column("rid").to_numpy(), table.column("label").to_numpy()
            ids, parts = table.column("vec_id").to_pylist(), [np.array(p) for p in table.column("parts").to_pylist()]
            for i in range(0, len(ids), TILE_ROWS):
                end = i + TILE_ROWS
                tile(rid[i:end], ids[i:end], label[i:end], parts[i:end])
            held, n = [], 0

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= TILE_ROWS:
                flush()
        if n:
            flush()
        out: dict[str, list] = {k: [] for k in ("anchor", "slot", "score", "wide", "rid", "vec_id")}
        for (a, slot), found in kept.items():
            for score, unnamed, vid, r in sorted(found)[:most]:
                clipped = _clip(-score)
                row = (a, slot, clipped, None if clipped == -score else str(-score), r, None if unnamed else vid)
                for k, v in zip(out, row):
                    out[k].append(v)
        yield out

    return map_batches(rows.select("rid", "vec_id", "label", "parts"), run, FOUND)


def _merged(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best over all partitions, with their ``rank`` from 1."""
    # Beyond 64 bits longer digits are further from 0.
    above, below = (F.when(F.col("score") > 0, F.col("wide")), F.when(F.col("score") < 0, F.col("wide")))
    digits = [F.desc(F.length(above)), F.desc(above), F.asc(F.length(below)), F.asc(below)]
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), *digits, F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _ranges(score: int) -> tuple[int, int]:
    """Lowest and highest score n with LOW score <= 100 n <= HIGH score."""
    return -(-LOW * score // 100), HIGH * score // 100


def mine(rows: DataFrame, every: int = 100, round_anchors: int = ROUND_ANCHORS, **columns) -> DataFrame:
    """Per anchor (a vec_id divisible by ``every``), positive and rank: ids and scores.

    At most ``round_anchors`` anchors, and five positives of each, are on the driver at a time.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    ready = scratch.save(prepared(rows, every, **columns), "rows")
    numbers = ready.select(
        F.col("anchor"), F.size("parts").alias("dim"), F.array_min("parts").alias("low"), F.array_max("parts").alias("high")
    )
    one = numbers.agg(
        F.max("dim").alias("dim"), F.min("low").alias("low"), F.max("high").alias("high"), F.count_if("anchor").alias("anchors")
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not one.anchors:
        return spark.createDataFrame([], schema)
    # Zero is in the range, as missing components are zero.
    span = (int(min(one.low or 0.0, 0.0)), int(max(one.high or 0.0, 0.0)))
    fields = Fields(one.dim or 0, span, span)
    rounds = -(-one.anchors // round_anchors)
    numbered = ready.filter("anchor").withColumn("round", F.pmod(F.xxhash64("rid"), F.lit(rounds)).cast("int"))
    asked = scratch.save(numbered.repartition(rounds, "round"), "anchors")
    mined: list[str] = []
    for number in range(rounds):
        batch = asked.filter(F.col("round") == number).orderBy("rid").collect()  # about ``round_anchors`` rows
        for first in range(0, len(batch), round_anchors):
            part = batch[first : first + round_anchors]
            positives = _merged(scan(ready, part, fields, None, POSITIVES), POSITIVES).orderBy("anchor", "rank").collect()  # five per anchor
            slots: list[list[tuple[int, int]]] = [[] for _ in part]
            named = []
            for p in positives:
                exact = int(p.wide) if p.wide is not None else p.score
                named.append((p.anchor, len(slots[p.anchor]), part[p.anchor].vec_id, p.vec_id, p.score))
                slots[p.anchor].append(_ranges(exact))
            negatives = _merged(scan(ready, part, fields, slots, NEGATIVES), NEGATIVES)
            pairs = spark.createDataFrame(named, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
            done = negatives.join(F.broadcast(pairs), ["anchor", "slot"]).select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
            mined.append(scratch.path(f"mined-{number}-{first}"))
            done.write.parquet(mined[-1])
    for name in ("rows", "anchors"):
        scratch.drop(name)
    return spark.read.schema(schema).parquet(*mined)
