"""Tables on shared storage: append, replace, swap, upsert.

A table is a folder of parquet folders under ``data`` and of numbered manifests
under ``_manifests``. A manifest names the schema, the key columns and number of
buckets of an upserted table, the runs committed so far, and the folders that are
the content. Every change writes new folders and then one new manifest, whose
rename makes the change visible; a crash before it leaves the old content whole.
One writer at a time; readers are not disturbed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace as changed

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.staging import affected_rows, key_is_empty, key_texts, untouched_rows
from kindred.sources.scratch import Scratch, hadoop_path

BUCKET = "_bucket"
BASE = "base"
#: Start of the names of parts that are replaced one by one.
PART = "part:"
#: Size of a key bucket, from which the number of buckets follows, and the fewest of them.
BUCKET_BYTES = 256 << 20
MIN_BUCKETS = 16


@dataclass(frozen=True)
class Manifest:
    """What a table is made of. ``parts`` has the folders of the base, of every run, and of every bucket.

    ``marks`` has, by name, what has to be written elsewhere once the last run's data is there (a
    watermark, a ledger row). It is published with the data, so a repeat finds what the run had fixed.
    """

    schema: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    runs: list[str] = field(default_factory=list)
    keys: list[str] | None = None
    buckets: int | None = None
    marks: dict[str, list] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class Conflict(RuntimeError):
    """Another writer has published the version this one was about to."""


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A parquet path or a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def _versions(spark: SparkSession, root: str) -> list[int]:
    jpath, fs = hadoop_path(spark, f"{root}/_manifests")
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest_path(root: str, version: int) -> str:
    return f"{root}/_manifests/v{version:08d}.json"


def _read_manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    jpath, fs = hadoop_path(spark, _manifest_path(root, version))
    stream = fs.open(jpath)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _current(spark: SparkSession, root: str) -> tuple[int, Manifest | None]:
    versions = _versions(spark, root)
    return (versions[-1], _read_manifest(spark, root, versions[-1])) if versions else (0, None)


def _publish(spark: SparkSession, root: str, version: int, manifest: Manifest) -> None:
    """Make ``manifest`` the current one: written aside, then renamed."""
    aside, fs = hadoop_path(spark, f"{root}/_manifests/.{uuid.uuid4().hex}")
    stream = fs.create(aside)
    try:
        stream.write(bytearray(json.dumps(asdict(manifest)), "utf-8"))
    finally:
        stream.close()
    target, _ = hadoop_path(spark, _manifest_path(root, version))
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, True)
        raise Conflict(f"version {version} of {root} exists already")


def _write(df: DataFrame, root: str) -> str:
    """A new folder of the table with the rows of ``df``."""
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    return folder


def _read(spark: SparkSession, root: str, manifest: Manifest, names: Sequence[str] | None = None) -> DataFrame:
    """Content of all parts, or of the named ones, in the stored schema; a column a folder lacks is NULL."""
    folders = [f for n, fs in manifest.parts.items() if names is None or n in names for f in fs]
    if not folders:
        return spark.createDataFrame([], manifest.struct)
    return spark.read.schema(manifest.struct).parquet(*[f"{root}/{f}" for f in folders])


def _merged_schema(stored: T.StructType, new: T.StructType, root: str) -> T.StructType:
    """The stored columns and then the new ones. A change of type is refused."""
    known = {f.name: f for f in stored.fields}
    for f in new.fields:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"{root}: column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*stored.fields, *[T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known]])


def _schema_text(schema: T.StructType) -> str:
    return json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).jsonValue())


def exists(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def load(spark: SparkSession, root: str) -> DataFrame:
    """Current content."""
    _, manifest = _current(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no table at {root}")
    return _read(spark, root, manifest)


def replace(df: DataFrame, root: str, run_id: str | None = None, marks: Mapping[str, list] | None = None) -> None:
    """New content and schema; the runs before it count no longer. Readers of the old version are not disturbed."""
    spark = df.sparkSession
    version, _ = _current(spark, root)
    runs = [] if run_id is None else [run_id]
    _publish(spark, root, version + 1, Manifest(_schema_text(df.schema), {BASE: [_write(df, root)]}, runs, marks=dict(marks or {})))


def replace_part(df: DataFrame, root: str, part: str) -> None:
    """New rows for one named part; the folders of all other parts stay. New columns are added, NULL in the other parts."""
    spark = df.sparkSession
    create_if_absent(spark, root, df.schema)
    version, manifest = _current(spark, root)
    if manifest.buckets:
        raise ValueError(f"{root} is kept by upserts, not by parts")
    schema = _merged_schema(manifest.struct, df.schema, root)
    parts = manifest.parts | {f"{PART}{part}": [_write(df, root)]}
    _publish(spark, root, version + 1, changed(manifest, schema=_schema_text(schema), parts=parts))
    vacuum(spark, root)


def load_part(spark: SparkSession, root: str, part: str) -> DataFrame:
    """Content of one named part; empty if there is none."""
    _, manifest = _current(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no table at {root}")
    return _read(spark, root, manifest, [f"{PART}{part}"])


def create_if_absent(spark: SparkSession, root: str, schema: T.StructType | str) -> bool:
    """Empty table with the schema; False when there is one already."""
    if exists(spark, root):
        return False
    struct = spark.createDataFrame([], schema).schema
    _publish(spark, root, 1, Manifest(_schema_text(struct)))
    return True


def append(df: DataFrame, root: str, run_id: str, marks: Mapping[str, list] | None = None) -> None:
    """Add rows. Repeating a run id replaces the rows it added; a run that was compacted meanwhile is left as it is.

    New columns are added to the table, NULL in older rows; a change of type is refused.
    """
    spark = df.sparkSession
    create_if_absent(spark, root, df.schema)
    version, manifest = _current(spark, root)
    if manifest.buckets:
        raise ValueError(f"{root} is kept by upserts; a plain append would leave several rows per key")
    part = f"run:{run_id}"
    if run_id in manifest.runs and part not in manifest.parts:
        return
    schema = _merged_schema(manifest.struct, df.schema, root)
    parts = manifest.parts | {part: [_write(df, root)]}
    runs = manifest.runs if run_id in manifest.runs else [*manifest.runs, run_id]
    _publish(spark, root, version + 1, changed(manifest, schema=_schema_text(schema), parts=parts, runs=runs, marks=_marked(manifest, marks)))


def _marked(manifest: Manifest, marks: Mapping[str, list] | None) -> dict[str, list]:
    """Marks of this run take the place of the ones before, which its caller has seen to."""
    return manifest.marks if marks is None else dict(marks)


def marks(spark: SparkSession, root: str) -> dict[str, list]:
    """What the last marked run left to be written elsewhere."""
    _, manifest = _current(spark, root)
    return {} if manifest is None else manifest.marks


def run_count(spark: SparkSession, root: str, run_id: str) -> int:
    """Rows that a run added, from the footers of its files; 0 once it is compacted."""
    _, manifest = _current(spark, root)
    return 0 if manifest is None or f"run:{run_id}" not in manifest.parts else _read(spark, root, manifest, [f"run:{run_id}"]).count()


def has_run(spark: SparkSession, root: str, run_id: str) -> bool:
    """Did this run already add its rows?"""
    _, manifest = _current(spark, root)
    return manifest is not None and run_id in manifest.runs


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Remove all but the last ``keep`` older versions, and the folders that none of the rest names."""
    versions = _versions(spark, root)
    kept = versions[-(keep + 1) :]
    used = {f for v in kept for fs in _read_manifest(spark, root, v).parts.values() for f in fs}
    for v in versions[: -(keep + 1)]:
        jpath, fs = hadoop_path(spark, _manifest_path(root, v))
        fs.delete(jpath, True)
    data, fs = hadoop_path(spark, f"{root}/data")
    if not fs.exists(data):
        return
    for status in fs.listStatus(data):
        folder = f"data/{status.getPath().getName()}"
        if not any(u == folder or u.startswith(f"{folder}/") for u in used):
            fs.delete(status.getPath(), True)
        elif folder not in used:
            for inner in fs.listStatus(status.getPath()):
                name = inner.getPath().getName()
                if name.startswith(f"{BUCKET}=") and f"{folder}/{name}" not in used:
                    fs.delete(inner.getPath(), True)


def swap_commit(df: DataFrame, root: str, keep: int = 1, run_id: str | None = None, marks: Mapping[str, list] | None = None) -> None:
    """Replace, then remove all but the last ``keep`` older versions."""
    replace(df, root, run_id, marks)
    vacuum(df.sparkSession, root, keep)


def compact(spark: SparkSession, root: str) -> None:
    """Rewrite many small files as files of the advisory partition size. Runs, keys, buckets and named parts stay."""
    version, manifest = _current(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no table at {root}")
    if manifest.buckets:
        parts = _write_buckets(_read(spark, root, manifest), root, manifest.keys, manifest.buckets)
    else:
        named = {n: [n] for n in manifest.parts if n.startswith(PART)}
        groups = named | {BASE: [n for n in manifest.parts if n not in named]}
        parts = {n: [_write(_read(spark, root, manifest, ns).hint("rebalance"), root)] for n, ns in groups.items() if ns or not named}
    _publish(spark, root, version + 1, changed(manifest, parts=parts))
    vacuum(spark, root)


def write_bucketed(df: DataFrame, table: str, columns: Sequence[str], buckets: int = 512, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by the join columns, so that joins on them need no shuffle."""
    # One shuffle by the bucket columns keeps the number of files low; a bucket that
    # is too large for one task is split into several files.
    laid_out = df.hint("rebalance", buckets, *columns)
    writer = laid_out.write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def table_stats(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """Per table: does it exist, rows, columns, format."""
    rows = []
    for name, root in roots.items():
        if exists(spark, root):
            df = load(spark, root)
            rows.append((name, True, df.count(), ", ".join(df.columns), "parquet"))
        else:
            rows.append((name, False, None, None, None))
    return spark.createDataFrame(rows, "table_name string, exists boolean, row_count bigint, columns string, format string")


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its key; -1 where the whole key is empty."""
    return F.when(key_is_empty(keys), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*key_texts(keys)), F.lit(buckets)).cast("int"))


def _write_buckets(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> dict[str, list[str]]:
    """A new folder with the rows by bucket; its parts. Oversized buckets are split, small ones merged."""
    folder = f"data/{uuid.uuid4().hex}"
    placed = df.withColumn(BUCKET, _bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    placed.write.partitionBy(BUCKET).parquet(f"{root}/{folder}")
    jpath, fs = hadoop_path(df.sparkSession, f"{root}/{folder}")
    found = [s.getPath().getName() for s in fs.listStatus(jpath)]
    return {f"b{n.split('=')[1]}": [f"{folder}/{n}"] for n in found if n.startswith(f"{BUCKET}=")}


def _bytes_of(spark: SparkSession, root: str) -> int:
    jpath, fs = hadoop_path(spark, f"{root}/data")
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def upsert_table(
    work: DataFrame, root: str, keys: Sequence[str], run_id: str, buckets: int | None = None, marks: Mapping[str, list] | None = None
) -> None:
    """Upsert into a stored table, rewriting only the key buckets the work rows touch.

    Rows with an all-empty key replace nothing. A run that is committed is not
    repeated. The number of buckets is stored with the table: by default it follows
    from its size at the first upsert, and a call with another number lays the table
    out anew. ``work`` is evaluated once.
    """
    spark, keys = work.sparkSession, list(keys)
    create_if_absent(spark, root, work.schema)
    version, manifest = _current(spark, root)
    if run_id in manifest.runs:
        return
    if manifest.keys is not None and manifest.keys != keys:
        raise ValueError(f"{root} is kept by {manifest.keys}, not by {keys}")
    schema = _merged_schema(manifest.struct, work.schema, root)
    manifest = changed(manifest, schema=_schema_text(schema))
    wanted = buckets or manifest.buckets or max(MIN_BUCKETS, -(-_bytes_of(spark, root) // BUCKET_BYTES))
    scratch = Scratch(spark, "upsert")
    added = scratch.save(work, "work")
    if manifest.buckets != wanted:
        # First upsert, or another number of buckets: everything is laid out.
        kept, rest = untouched_rows(_read(spark, root, manifest), added, keys), {}
    else:
        touched = {f"b{r[0]}" for r in added.select(_bucket_of(keys, wanted)).distinct().collect()}  # at most the buckets
        kept = untouched_rows(_read(spark, root, manifest, sorted(touched - {"b-1"})), added, keys)
        rest = {n: fs for n, fs in manifest.parts.items() if n not in touched or n == "b-1"}
    parts = _write_buckets(kept.unionByName(added, allowMissingColumns=True), root, keys, wanted)
    # Rows without a key only ever accumulate.
    loose = rest.get("b-1", []) + parts.get("b-1", [])
    merged = rest | parts | ({"b-1": loose} if loose else {})
    _publish(
        spark, root, version + 1,
        changed(manifest, parts=merged, runs=[*manifest.runs, run_id], keys=keys, buckets=wanted, marks=_marked(manifest, marks)),
    )
    vacuum(spark, root)
    scratch.close()


def replace_keys(added: DataFrame, gone: DataFrame, root: str, keys: Sequence[str], run_id: str, buckets: int | None = None) -> None:
    """Remove the rows of the keys in ``gone``, then add rows, whatever their keys.

    Only the key buckets of ``gone`` are rewritten; to the others the new rows are
    added as further files. A run that is committed is not repeated. A new table gets
    ``buckets``, or a number that follows from the size of ``added``.
    """
    spark, keys = added.sparkSession, list(keys)
    create_if_absent(spark, root, added.schema)
    version, manifest = _current(spark, root)
    if run_id in manifest.runs:
        return
    if manifest.parts and manifest.keys != keys:
        raise ValueError(f"{root} is kept by {manifest.keys}, not by {keys}")
    manifest = changed(manifest, schema=_schema_text(_merged_schema(manifest.struct, added.schema, root)))
    scratch = Scratch(spark, "replace-keys")
    gone = scratch.save(gone.select(*keys).distinct(), "gone")
    wanted = manifest.buckets or buckets
    if not wanted:
        # The number follows from the size; else the rows are read once, below.
        added = scratch.save(added, "added")
        wanted = max(MIN_BUCKETS, -(-scratch.bytes_of("added") // BUCKET_BYTES))
    touched = {f"b{r[0]}" for r in gone.select(_bucket_of(keys, wanted)).distinct().collect()} - {"b-1"}  # at most the buckets
    touched &= set(manifest.parts)
    kept = untouched_rows(_read(spark, root, manifest, sorted(touched)), gone, keys)
    new = _write_buckets(kept.unionByName(added, allowMissingColumns=True), root, keys, wanted)
    parts = {n: fs for n, fs in manifest.parts.items() if n not in touched}
    for name, folders in new.items():
        parts[name] = parts.get(name, []) + folders
    _publish(spark, root, version + 1, changed(manifest, parts=parts, runs=[*manifest.runs, run_id], keys=keys, buckets=wanted))
    vacuum(spark, root)
    scratch.close()


def replace_by_keys(df: DataFrame, root: str, keys: Sequence[str], buckets: int, run_id: str) -> None:
    """New content and schema, laid out for ``replace_keys``."""
    spark, keys = df.sparkSession, list(keys)
    version, _ = _current(spark, root)
    parts = _write_buckets(df, root, keys, buckets)
    _publish(spark, root, version + 1, Manifest(_schema_text(df.schema), parts, [run_id], keys, buckets))
    vacuum(spark, root)


def load_keys(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Rows of a table kept by keys whose key is in ``wanted``; only their buckets are read."""
    _, manifest = _current(spark, root)
    if manifest is None or not manifest.buckets:
        raise FileNotFoundError(f"no table kept by keys at {root}")
    named = {f"b{r[0]}" for r in wanted.select(_bucket_of(manifest.keys, manifest.buckets)).distinct().collect()}  # at most the buckets
    return affected_rows(_read(spark, root, manifest, sorted(named - {"b-1"})), wanted, manifest.keys)


def folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Folders of the current content by part: a folder that stays was not rewritten."""
    _, manifest = _current(spark, root)
    return {} if manifest is None else manifest.parts
