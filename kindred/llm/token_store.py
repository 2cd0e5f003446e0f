"""Token ids as a table of blocks, every document compressed on its own.

Documents are serialized as arrays of little-endian unsigned 16-bit ids (32-bit
for larger vocabularies). One zstandard dictionary is trained on the arrays of a
bounded sample and shared by all documents, which makes short documents small
although each can be read alone. A block is one row of a parquet table: the hash
of the dictionary, the document ids, the offset of every frame in ``data`` (one
more than documents), the tokens of every document, and the token the block starts at
within its part; a small table has the token every part starts at. Blocks are written in ascending document order through Spark's
committed writer, so a lost executor repeats its task and nothing else; parquet
statistics of ``first_doc`` and ``last_doc`` lead a lookup to its block.

Defined results: a NULL or empty text is the end id alone; rows that repeat an id
follow each other, ordered by their frames; rows without an id come first;
an empty table is a store without blocks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.llm import tokens
from kindred.llm.common import map_batches
from kindred.sources.scratch import Scratch

#: Bound of the sample that the dictionary is trained on, and size of the dictionary, in bytes.
SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 4_096
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: Bytes of frames per block and per partition.
BLOCK_BYTES = 1 << 20
PARTITION_BYTES = 16 << 20

BLOCKS = (
    "part int, seq int, first_doc long, last_doc long, dictionary string, width int, "
    "doc_ids array<long>, offsets array<long>, n_tokens array<long>, start long, tokens long, data binary"
)
DECODED = "doc_id long, start long, n_tokens long, ids binary, width int"
SUMS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end: int = tokens.END) -> DataFrame:
    """``doc_id``, ``packed`` ids with the end id, and their ``bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        enc = tokens.encoder(path)
        last = np.array([end], dtype=enc.kind).tobytes()
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in tokens.runs(batch.column(1)):
                packed = [p + last for p in enc.encode(texts)]
                yield {"doc_id": ids.slice(at, len(texts)), "packed": packed, "bytes": [len(p) for p in packed]}
                at += len(texts)

    return map_batches(docs.select(F.col(doc_id).cast("long"), F.col(text)), run, "doc_id long, packed binary, bytes long")


def train_dictionary(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES
) -> bytes:
    """Dictionary from the documents that come first by the hash of their id; ids of at most ``most`` starts of
    ``SAMPLE_BYTES`` characters reach the driver. Empty where there is too little to train on."""
    start = F.substring(text, 1, SAMPLE_BYTES).alias("text")
    first = docs.select(F.col(doc_id).alias("doc_id"), start).orderBy(F.xxhash64("doc_id"), "text").limit(most)
    samples = [bytes(r.packed) for r in encode(first, path).select("packed").collect()]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def frames(docs: DataFrame, path: str, dictionary: bytes, doc_id: str = "doc_id", text: str = "text", end: int = tokens.END) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the compressed ids (``frame``) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        enc, press = tokens.encoder(path), _compressor(dictionary)
        last = np.array([end], dtype=enc.kind).tobytes()
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in tokens.runs(batch.column(1)):
                packed = [p + last for p in enc.encode(texts)]
                n = [len(p) // enc.kind.itemsize for p in packed]
                yield {"doc_id": ids.slice(at, len(texts)), "n_tokens": n, "frame": [press.compress(p) for p in packed]}
                at += len(texts)

    return map_batches(docs.select(F.col(doc_id).cast("long"), F.col(text)), run, "doc_id long, n_tokens long, frame binary")


def blocks(ordered: DataFrame, dictionary: bytes, width: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of partitions that are in document order; ``start`` counts from the partition's first token."""
    digest = hashlib.sha256(dictionary).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        seq = start = held = part = 0
        ids, data, counts = [], [], []

        def block() -> dict[str, list]:
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in data]))).tolist()
            named = [i for i in ids if i is not None]
            return {
                "part": [part], "seq": [seq], "first_doc": [named[0] if named else None], "last_doc": [named[-1] if named else None],
                "dictionary": [digest], "width": [width], "doc_ids": [list(ids)], "offsets": [offsets], "n_tokens": [list(counts)],
                "start": [start], "tokens": [sum(counts)], "data": [b"".join(data)],
            }

        for batch in batches:
            for doc, n, frame, own in zip(*[c.to_pylist() for c in batch.columns]):
                part = own
                if data and held + len(frame) > block_bytes:
                    yield block()
                    seq, start, held = seq + 1, start + sum(counts), 0
                    ids, data, counts = [], [], []
                ids.append(doc)
                data.append(frame)
                counts.append(n)
                held += len(frame)
        if data:
            yield block()

    return map_batches(ordered.select("doc_id", "n_tokens", "frame", F.spark_partition_id().alias("part")), run, BLOCKS)


def write(docs: DataFrame, path: str, root: str, scratch: Scratch, **columns) -> None:
    """Write the store of ``docs`` under ``root``: tables ``blocks``, ``parts`` and ``dictionary``."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path, **columns)
    width = tokens.kind(path).itemsize
    made = scratch.save(frames(docs, path, dictionary, **columns), "frames")
    total = made.agg(F.coalesce(F.sum(F.length("frame")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // PARTITION_BYTES))
    # The second key spreads rows that share an id or have none.
    spread = F.xxhash64("frame")
    ordered = made.repartitionByRange(parts, F.col("doc_id"), spread).sortWithinPartitions("doc_id", spread, "frame")
    blocks(ordered, dictionary, width).write.mode("overwrite").parquet(f"{root}/blocks")
    scratch.drop("frames")
    # One row per partition written; partitions follow each other in document order.
    sizes = spark.read.schema(BLOCKS).parquet(f"{root}/blocks").groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("base"))
    bases.write.mode("overwrite").parquet(f"{root}/parts")
    meta = [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary), width)]
    spark.createDataFrame(meta, "sha256 string, dictionary binary, width int").coalesce(1).write.mode("overwrite").parquet(f"{root}/dictionary")


def _decode(frames: DataFrame, dictionary: bytes, digest: str, wanted: Sequence[int] | None, sums: bool) -> DataFrame:
    only = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        press = _decompressor(dictionary)
        # A block at a time: a batch of blocks and all that is packed in it would be many times as large.
        for row in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)):
            if row["dictionary"] != digest:
                raise ValueError("a block names another dictionary than the store's")
            starts = row["start"] + np.concatenate(([0], np.cumsum(row["n_tokens"])))
            take = [i for i, d in enumerate(row["doc_ids"]) if only is None or d in only]
            at, width = row["offsets"], row["width"]
            ids = (press.decompress(row["data"][at[i] : at[i + 1]]) for i in take)
            out = {
                "doc_id": [row["doc_ids"][i] for i in take], "start": [int(starts[i]) for i in take],
                "n_tokens": [row["n_tokens"][i] for i in take],
            }
            if sums:
                out["ids_crc32"] = [zlib.crc32(np.frombuffer(p, dtype=f"<u{width}").astype("<u4").tobytes()) for p in ids]
            else:
                out |= {"ids": list(ids), "width": [width] * len(take)}
            yield out

    rows = frames.select("doc_ids", "offsets", "n_tokens", "start", "dictionary", "width", "data")
    return map_batches(rows, run, SUMS if sums else DECODED)


def read(spark: SparkSession, root: str, doc_ids: Sequence[int] | None = None, sums: bool = False) -> DataFrame:
    """All documents of a store, or the named ones: then only their blocks are read and only their frames decompressed.

    With ``sums`` the CRC-32 of every document's ids as unsigned 32-bit integers stands in place of the ids.
    """
    meta = spark.read.parquet(f"{root}/dictionary").first()
    rows = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    if doc_ids is not None:
        near = F.lit(False)
        for d in doc_ids:
            near = near | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
        rows = rows.filter(near)
    bases = spark.read.schema("part int, base long").parquet(f"{root}/parts")
    rows = rows.join(bases, "part").withColumn("start", F.col("start") + F.col("base"))
    return _decode(rows, bytes(meta["dictionary"]), meta["sha256"], doc_ids, sums)
