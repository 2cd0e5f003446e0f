"""SimHash near-duplicates through an inverted index of fingerprint bytes.

A fingerprint has eight positional bytes. Two fingerprints that differ in at
most four bits agree in at least four of them, so they share at least one of the
70 choices of four positions. The index posts every distinct fingerprint under
its 70 (choice, bytes) keys; members of a key are paired, their shared positional
bytes are tallied, pairs below four are dropped, and the rest is verified bit by
bit. A key of four bytes is rare enough that the pairs stay in proportion to the
fingerprints, which a single byte's list would not.

Copies meet before the index, as one fingerprint. Keys with more than ``MAX_KEY``
members (large groups of near copies) are not paired at all: their members are
posted under the 2,081 points within two bits of them. Two fingerprints differ in
at most four bits exactly if they share such a point, and a point has at most
2,081 members, so this way is exact and linear in the members.

Defined results: a text without words (NULL too) has fingerprint zero and is
linked like any other; rows that repeat an id with different texts link their
fingerprints; a NULL id gets the smallest id its fingerprint reaches, NULL if
there is none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import map_batches, may_be_among
from kindred.llm.components import roots
from kindred.sources.scratch import Scratch

#: Words per shingle, bits that may differ, seed of the shingle hash.
SHINGLE = 4
MAX_BITS = 4
SEED = 42
BYTES = 8
#: Members of a key up to which they are paired. A member of a larger key costs 2,081 points instead.
MAX_KEY = 64

#: 256 x 8: the bits of every byte value, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: a bit is set if it is set in over half of the shingles' hashes."""
    parts = (text or "").encode().lower().split()  # bytes: A-Z and ASCII spaces only
    if not parts:
        return 0
    if len(parts) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        line = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: len(parts) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    of_bytes = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, BYTES)
    counts = np.concatenate([np.bincount(of_bytes[:, i], minlength=256) @ _BITS for i in range(BYTES)])
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            yield {"id": batch.column(0), "fp": [fingerprint(t.as_py()) for t in batch.column(1)]}

    return map_batches(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text)), run, "id long, fp long")


def _choices() -> list[int]:
    """Masks of every choice of ``BYTES - MAX_BITS`` byte positions, as signed longs."""
    masks = []
    for positions in combinations(range(BYTES), BYTES - MAX_BITS):
        mask = sum(0xFF << 8 * p for p in positions)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def shared_bytes(a: Column, b: Column) -> Column:
    """Tally of equal positional bytes."""
    x, tally = a.bitwiseXOR(b), F.lit(0)
    for p in range(BYTES):
        tally = tally + F.when(F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
    return tally


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def postings(prints: DataFrame) -> DataFrame:
    """The inverted index: every ``fp`` with its ``node`` under its 70 (choice, key) pairs."""
    masks = F.array(*[F.lit(m) for m in _choices()])
    return prints.select("fp", "node", F.posexplode(masks).alias("choice", "mask")).select(
        F.col("choice").cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "node"
    )


def points(prints: DataFrame) -> DataFrame:
    """Every ``fp`` under all points within two bits of it."""
    flips = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(64)]]
    one = F.array(*[F.lit(m) for m in flips])
    # Each pair of flips once: the second lies behind the first, or is no flip.
    second = F.when(F.col("i") == 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.concat(F.array(F.lit(0).cast("long")), F.slice(one, F.col("i") + 2, F.lit(65)))
    )
    return (
        prints.select("node", "fp", F.posexplode(one).alias("i", "m"))
        .select("node", F.col("fp").bitwiseXOR(F.col("m")).alias("p"), F.explode(second).alias("m2"))
        .select("node", F.col("p").bitwiseXOR(F.col("m2")).alias("point"))
    )


def links(prints: DataFrame, scratch: Scratch, max_key: int = MAX_KEY) -> DataFrame:
    """Links ``x``, ``y`` that join exactly the fingerprints of at most ``MAX_BITS`` differing bits.

    ``prints`` has distinct ``fp`` and their ``node``. Members of a large key are
    linked through their points, which joins the same fingerprints.
    """
    at = Window.partitionBy("choice", "key")
    sized = postings(prints).withColumn("members", F.count(F.lit(1)).over(at)).filter(F.col("members") > 1)
    index = scratch.save(sized, "index")
    small = index.filter(F.col("members") <= max_key).drop("members")
    other = small.select("choice", "key", F.col("fp").alias("fp2"), F.col("node").alias("y"))
    near = (F.col("fp") < F.col("fp2")) & (shared_bytes(F.col("fp"), F.col("fp2")) >= BYTES - MAX_BITS)
    near = near & (differing_bits(F.col("fp"), F.col("fp2")) <= MAX_BITS)
    pairs = small.join(other, (small["choice"] == other["choice"]) & (small["key"] == other["key"]) & near)
    paired = pairs.select(F.col("node").alias("x"), "y").distinct()
    crowd = index.filter(F.col("members") > max_key).select("fp", "node").distinct()
    meet = points(crowd).groupBy("point").agg(F.min("node").alias("x"), F.collect_set("node").alias("ys")).filter(F.size("ys") > 1)
    crowded = meet.select("x", F.explode("ys").alias("y")).filter(F.col("x") != F.col("y")).distinct()
    return paired.unionByName(crowded)


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_key: int = MAX_KEY) -> DataFrame:
    """``id``, ``fp`` and ``component`` (smallest id reachable, itself included) of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, doc_id, text), "fingerprints")
    prints = scratch.save(rows.filter(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("node")), "distinct")
    found = links(prints, scratch, max_key)
    # An id with several texts joins their fingerprints.
    repeated = rows.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("id IS NOT NULL AND a <> b").select("id")
    own = rows.join(repeated, "id", "left_semi").join(prints, "fp").select(F.col("id").alias("x"), F.col("node").alias("y"))
    stars = roots(found.unionByName(own), scratch)
    of_print = prints.join(stars, prints["node"] == stars["node"], "left").select(
        prints["fp"], F.coalesce("root", prints["node"]).alias("component")
    )
    return rows.join(of_print, "fp", "left").select("id", "fp", "component")


def stage(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id; the columns stay.

    Of rows that repeat an id the one with the smallest text stays; rows without an
    id cannot be told apart and stay unless their group has a document with one.
    """
    scratch = Scratch(docs.sparkSession, "simhash-stage")
    verdicts = scratch.save(components(docs).select("id", "component"), "verdicts")
    found = verdicts.filter(F.col("component").isNull() | (F.col("id") == F.col("component")))
    # Read twice below.
    wanted = scratch.save(found.groupBy("id").agg(F.count(F.lit(1)).alias("rows")), "wanted")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wrapped = docs.select(F.col("doc_id").alias("_id"), row.alias("_doc"))
    # Most ids have one row, and it stays; such a text is not moved.
    looked = verdicts.filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("component"))
    flagged = may_be_among(wrapped, "_id", looked.filter("rows > 1 OR id <> component").select("id"))
    plain = flagged.filter(~F.col("_may") & F.col("_id").isNotNull()).select("_doc.*")
    wrapped = flagged.filter(F.col("_may") | F.col("_id").isNull()).drop("_may")
    # An id of one row needs no order.
    alone = wanted.filter((F.col("rows") == 1) & F.col("id").isNotNull())
    single = wrapped.join(alone, wrapped["_id"] == alone["id"], "left_semi").select("_doc.*")
    several = wanted.filter((F.col("rows") > 1) | F.col("id").isNull())
    kept = wrapped.join(several, wrapped["_id"].eqNullSafe(several["id"]), "left_semi")
    first = Window.partitionBy("_id").orderBy("_doc.text")
    ranked = kept.withColumn("_rank", F.row_number().over(first))
    ranked = ranked.filter((F.col("_rank") == 1) | F.col("_id").isNull()).select("_doc.*")
    return plain.unionByName(single).unionByName(ranked)
