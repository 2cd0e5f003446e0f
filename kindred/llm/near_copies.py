"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Texts with equal sets meet by a digest. The others are put into buckets by bands of
MinHash values: two sets of similarity s share one with probability 1 - (1 - s^6)^16,
0.99 at 0.8 and more above. A bucket of any size yields a linear number of pairs, which
are verified on whole sets: first every member with the bucket's smallest id, which
joins a group of near copies at once; then, in ``ROUNDS`` further rounds, a member of
each group with one of the first group of its bucket, other members and groups each time, and
from the second round on in finer buckets of two bands. So pages that share a template are pairs only a few times each. Only ids travel in
pairs; a set is sent once per pair that is really looked at.

Defined results: texts of up to five words are one shingle; texts without words
are equal; an id with several texts joins the groups of all; rows with a NULL id
stay; very long texts are hashed in blocks; ties go to the smaller id; columns of other
names pass through, whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import map_batches, may_be_among
from kindred.llm.components import roots
from kindred.sources.scratch import Scratch

SHINGLE = 5
#: Similarity as a fraction.
PART, WHOLE = 4, 5
SEED = 42
#: Bands and values of each, shingles hashed at a time, and rounds after the first.
BANDS, VALUES, BLOCK, ROUNDS = 16, 6, 4_096, 3


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, dtype=np.int64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first = max(1, len(parts) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts[:first].tolist(), ends[len(parts) - first :].tolist())]
    return np.unique(np.array(hashes, dtype=np.uint64).view(np.int64))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the hash functions, from a fixed rule."""
    numbers = [xxhash.xxh64_intdigest(str(i), SEED) for i in range(2 * BANDS * VALUES)]
    return np.array(numbers[::2], dtype=np.uint64) | np.uint64(1), np.array(numbers[1::2], dtype=np.uint64)


def bands(hashes: np.ndarray, by: np.ndarray, plus: np.ndarray) -> list[int]:
    """One number per band of a set's least values."""
    values = hashes.view(np.uint64)
    least = np.full(len(by), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(values), BLOCK):
        mixed = values[i : i + BLOCK, None] * by[None, :] + plus[None, :]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
    rows = least.reshape(BANDS, VALUES)
    return [xxhash.xxh64_intdigest(bytes([n]) + rows[n].tobytes(), SEED) - (1 << 63) for n in range(BANDS)]


def signatures(rows: DataFrame) -> DataFrame:
    """Per row: ``id``, the digest of its set, its size, and its band numbers; none for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        by, plus = _permutations()
        for batch in batches:
            out: dict[str, list] = {"id": batch.column(0).to_pylist(), "digest": [], "n": [], "keys": []}
            for text in batch.column(1):
                found = shingles(text.as_py())
                out["digest"].append(xxhash.xxh3_128_digest(found.tobytes()))
                out["n"].append(len(found))
                out["keys"].append(bands(found, by, plus) if len(found) else [])
            yield out

    return map_batches(rows, run, "id long, digest binary, n int, keys array<long>")


def sets(rows: DataFrame) -> DataFrame:
    """``id`` and the whole set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            yield {"id": batch.column(0).to_pylist(), "hashes": [shingles(t.as_py()).tolist() for t in batch.column(1)]}

    return map_batches(rows, run, "id long, hashes array<long>")


def verified(pairs: DataFrame, whole: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs ``x``, ``y`` of at least the similarity."""
    # Sets of other ids are not moved.
    whole = may_be_among(whole, "id", pairs.select(F.explode(F.array("x", "y")).alias("id"))).filter("_may").drop("_may")
    two = pairs.join(whole.select(F.col("id").alias("y"), F.col("hashes").alias("hy")), "y").join(whole.select(F.col("id").alias("x"), F.col("hashes").alias("hx")), "x")
    sized = two.select("x", "y", (F.size("hx") + F.size("hy")).alias("both"), F.size(F.array_intersect("hx", "hy")).alias("shared"))
    return scratch.save(sized.filter(WHOLE * F.col("shared") >= PART * (F.col("both") - F.col("shared"))).select("x", "y"), f"{name}-links")


def links(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Links ``x``, ``y`` that join the ids of near copies."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull())
    found = scratch.save(signatures(rows), "signatures")
    # Equal digests have equal keys.
    grouped = found.groupBy("digest").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    nodes = scratch.save(grouped, "nodes")
    copies = found.select("id", "digest").join(nodes.select("digest", "node"), "digest").filter("id <> node").select(F.col("id").alias("x"), F.col("node").alias("y"))
    joined = scratch.save(copies, "copies")
    # The smallest id and the number of members of every bucket, without a window over it. All bands of a text
    # travel only with what shares a bucket.
    posted = nodes.select("digest", "node", F.explode("keys").alias("key"))
    heads = posted.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members")).filter("members > 1").drop("members")
    shared = scratch.save(posted.select("digest", "key").join(heads, "key"), "shared")
    index = scratch.save(shared.join(nodes, "digest").select("key", "node", "n", "keys", "head"), "index")
    # Sets of what has a bucket in common with another text, by its smallest id.
    named = index.select(F.col("node").alias("id")).distinct()
    # A few more do no harm, so no text is moved to find them.
    whole = scratch.save(sets(may_be_among(rows, "id", named).filter("_may").select("id", "text")), "sets")
    for name in ("signatures", "nodes", "shared"):
        scratch.drop(name)
    fits = lambda n, m: (WHOLE * n >= PART * m) & (WHOLE * m >= PART * n)
    sizes = index.select(F.col("node").alias("head"), F.col("n").alias("m")).distinct()
    first = index.filter("node <> head").select("head", "node", "n").distinct().join(sizes, "head").filter(fits(F.col("n"), F.col("m")))
    tried = scratch.save(first.select(F.col("head").alias("x"), F.col("node").alias("y")), "tried-0")
    joined = joined.unionByName(verified(tried, whole, scratch, "round-0"))
    for number in range(1, ROUNDS + 1):
        stars = scratch.save(roots(joined, scratch), f"stars-{number}")
        grouped = index.join(stars, "node", "left").select("key", "keys", "node", "n", F.coalesce("root", "node").alias("group"))
        if number > 1:
            # Finer buckets, of two bands at a time.
            pairs = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.get("keys", i), F.get("keys", (i + number - 1) % BANDS)))
            grouped = grouped.select("keys", "node", "n", "group").distinct().withColumn("key", F.explode(pairs))
        # One member of each group in a bucket, another one in every round; the first group's is what the others are tried with.
        one = grouped.groupBy("key", "group").agg(F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), "node", "n")).alias("m"))
        lowest = one.groupBy("key").agg(F.min(F.struct(F.xxhash64("group", F.lit(number)).alias("h"), "group", "m")).alias("low"), F.count(F.lit(1)).alias("groups"))
        met = one.join(lowest.filter("groups > 1"), "key").filter(F.col("group") != F.col("low.group")).filter(fits(F.col("m.n"), F.col("low.m.n")))
        met = met.select(F.least("m.node", "low.m.node").alias("x"), F.greatest("m.node", "low.m.node").alias("y")).distinct()
        new = scratch.save(met.join(tried, ["x", "y"], "left_anti"), f"tried-{number}")
        joined = joined.unionByName(verified(new, whole, scratch, f"round-{number}"))
        tried = tried.unionByName(new)
    scratch.drop("sets")
    scratch.drop("index")
    return joined


def stage(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that are near copies, also through others, of one with a smaller id."""
    scratch = Scratch(docs.sparkSession, "near-copies")
    dropped = roots(links(docs, scratch, doc_id, text), scratch).select(F.col("node").alias("_dropped"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    flagged = may_be_among(docs.select(F.col(doc_id).alias("_id"), row.alias("_doc")), "_id", dropped)
    # Only texts that may go are moved.
    stay = flagged.filter("_may").join(dropped, F.col("_id") == F.col("_dropped"), "left_anti")
    return flagged.filter("NOT _may").select("_doc.*").unionByName(stay.select("_doc.*"))
