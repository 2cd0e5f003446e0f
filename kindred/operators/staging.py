"""Clean, join, de-duplicate and upsert staging tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions import cleaning as C
from kindred.functions import jsontext as J
from kindred.functions.clock import epoch_text
from kindred.operators.skew import is_comparable, salted_join

MAX_COLUMNS = 200
INGEST_CLOCK = "time"
JSON_MAP = "map<string,string>"
# Parts of a column name that suggest JSON or a date.
JSON_HINTS = ("json", "attr", "metadata", "details")
DATE_HINTS = ("date", "timestamp", "created", "updated", "_at")

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def classify_columns(schema: T.StructType) -> dict[str, str]:
    """Cleaning rule per column, from its name and type; no data is read."""
    rules = {}
    for f in schema.fields:
        name, kind = f.name.lower(), f.dataType
        if name == INGEST_CLOCK:
            rules[f.name] = "keep"
        elif isinstance(kind, T.BooleanType):
            rules[f.name] = "boolean"
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            rules[f.name] = "date"
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            rules[f.name] = "keep"
        elif isinstance(kind, NUMERIC_TYPES):
            is_epoch = isinstance(kind, T.LongType) and any(h in name for h in ("timestamp", "_at", "unixtime"))
            rules[f.name] = "epoch" if is_epoch else "numeric"
        elif "email" in name:
            rules[f.name] = "email"
        elif "phone" in name:
            rules[f.name] = "phone"
        elif any(h in name for h in JSON_HINTS):
            rules[f.name] = "json"
        elif any(h in name for h in DATE_HINTS):
            rules[f.name] = "date"
        else:
            rules[f.name] = "string"
    return rules


def clean_columns(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Apply one rule per column; a column without a rule is kept."""
    out: list[Column] = []
    for f in df.schema.fields:
        col, rule = F.col(f"`{f.name}`"), rules.get(f.name, "keep")
        if rule in ("keep", "json"):
            out.append(col)
        elif rule == "string":
            out.append(C.std_string(col).alias(f.name))
        elif rule == "email":
            out += C.std_email(f.name, col)
        elif rule == "phone":
            out += C.std_phone(f.name, col)
        elif rule == "date":
            out += C.std_date(f.name, col)
        elif rule == "iso_utc":
            out += C.std_iso_utc(f.name, col)
        elif rule == "epoch":
            out += C.std_epoch(f.name, col)
        elif rule == "numeric" and isinstance(f.dataType, T.DecimalType):
            out.append(col)  # exact already
        elif rule == "numeric":
            out.append(C.std_numeric(col, f.dataType.simpleString()).alias(f.name))
        elif rule == "boolean":
            out.append(C.std_boolean(col).alias(f.name))
        else:
            raise ValueError(f"unknown rule {rule!r} for column {f.name}")
    return df.select(*out)


def json_keys(df: DataFrame, name: str, fraction: float | None = None) -> DataFrame:
    """Distinct keys found in the data, two levels deep, with the kind of value.

    Reads every row unless a sampling ``fraction`` is asked for.
    """
    rows = df.select(F.col(name).alias("j")).filter(F.col("j").isNotNull())
    if fraction is not None:
        rows = rows.sample(fraction, seed=7)
    level1 = rows.select(F.explode(F.from_json("j", JSON_MAP)).alias("k1", "v")).withColumn("kind", _json_kind(F.col("v")))
    own = F.struct("k1", F.lit(None).cast("string").alias("k2"), "kind")
    children = F.map_entries(F.from_json(F.when(F.col("kind") == "object", F.col("v")), JSON_MAP))
    child = lambda c: F.struct(F.col("k1"), c["key"].alias("k2"), _json_kind(c["value"]).alias("kind"))
    below = F.coalesce(F.transform(children, child), F.array().cast("array<struct<k1:string,k2:string,kind:string>>"))
    found = level1.select(F.inline(F.concat(F.array(own), below)))
    # Between scalar and array the simpler kind is kept; the keys of an object have rows of their own.
    return found.groupBy("k1", "k2").agg(F.max("kind").alias("kind"))


def _json_kind(text: Column) -> Column:
    return F.when(text.startswith("{"), "object").when(text.startswith("["), "array").otherwise("scalar")


def collect_json_keys(df: DataFrame, name: str, limit: int | None = None, fraction: float | None = None) -> list[tuple[list[str], str]]:
    """Key paths in a fixed order for ``json_flatten``; each becomes a column. With a ``limit``, more keys are an error."""
    keys = json_keys(df, name, fraction).orderBy("k1", "k2")
    found = (keys if limit is None else keys.limit(limit + 1)).collect()
    if limit is not None and len(found) > limit:
        raise ValueError(f"column {name} holds more than {limit} JSON keys; name the ones to extract")
    return [([r.k1] if r.k2 is None else [r.k1, r.k2], r.kind) for r in found]


def _json_type(keys: Sequence[tuple[Sequence[str], str]]) -> T.StructType:
    """Type that covers all wanted keys, at most two levels deep."""
    tree: dict[str, dict | str] = {}
    for path, kind in keys:
        if len(path) == 1:
            tree[path[0]] = kind
        else:
            tree.setdefault(path[0], {})[path[1]] = kind

    def of(node) -> T.DataType:
        if isinstance(node, dict):
            return T.StructType([T.StructField(k, of(v)) for k, v in node.items()])
        return T.ArrayType(T.StringType()) if node == "array" else T.StringType()

    return of(tree)


def json_column_names(name: str, keys: Sequence[tuple[Sequence[str], str]]) -> list[str]:
    """The columns that ``json_flatten`` adds. Of paths that differ in case alone the first has the plain name, the others end in ``_2``, ``_3``, ..."""
    out, seen = [], {}
    for path, kind in keys:
        if kind != "object":
            alike = tuple(step.lower() for step in path)
            seen[alike] = seen.get(alike, 0) + 1
            out.append(J.json_column_name(name, path) + (f"_{seen[alike]}" if seen[alike] > 1 else ""))
    return out


def _by_position(kind: T.DataType) -> T.DataType:
    """The same type with fields named by their place, for Spark finds fields of a struct whatever their case."""
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType([T.StructField(f"f{i}", _by_position(f.dataType)) for i, f in enumerate(kind.fields)])


def _at(col: Column, kind: T.DataType, path: Sequence[str]) -> Column:
    """Value at a path in a column of ``_by_position(kind)``."""
    for step in path:
        i = kind.fieldNames().index(step)
        col, kind = col.getField(f"f{i}"), kind[i].dataType
    return col


def json_flatten(df: DataFrame, name: str, keys: Sequence[tuple[Sequence[str], str]]) -> DataFrame:
    """One column per scalar or array key; the raw column stays.

    Every document is parsed once, whatever the number of keys. A key that is an
    object in some rows and a value in others gives its own column, NULL where it is
    an object, and those of its children, read from its text. Keys that differ in
    case alone are different keys.
    """
    wanted = [(path, kind) for path, kind in keys if kind != "object"]
    names = json_column_names(name, wanted)
    clash = {n for n in names if names.count(n) > 1 or n in df.columns}
    if clash:
        raise ValueError(f"JSON keys of {name} give the same column twice: {sorted(clash)}")
    plain = {path[0] for path, _ in wanted if len(path) == 1}
    mixed = {path[0] for path, _ in wanted if len(path) == 2} & plain
    whole = _json_type([(path, kind) for path, kind in wanted if path[0] not in mixed] + [([root], "scalar") for root in sorted(mixed)])
    parsed, below = df.withColumn("_json", F.from_json(name, whole).cast(_by_position(whole))), {}
    for i, root in enumerate(sorted(mixed)):
        kind = _json_type([([path[1]], kind) for path, kind in wanted if len(path) == 2 and path[0] == root])
        parsed = parsed.withColumn(f"_json{i}", F.from_json(_at(F.col("_json"), whole, [root]), kind).cast(_by_position(kind)))
        below[root] = (F.col(f"_json{i}"), kind)
    out = []
    for (path, kind), column in zip(wanted, names):
        value = _at(*below[path[0]], path[1:]) if path[0] in mixed and len(path) == 2 else _at(F.col("_json"), whole, path)
        if path[0] in mixed and len(path) == 1:
            value = F.when(~value.startswith("{"), value)
            value = F.from_json(value, T.ArrayType(T.StringType())) if kind == "array" else value
        out.append((value if kind == "array" else F.nullif(F.upper(value), F.lit(""))).alias(column))
    return parsed.select(*df.columns, *out)


#: Keys found in the JSON columns of a stored table, in the order of their discovery.
KEY_REGISTRY_SCHEMA = "column_name string, k1 string, k2 string, kind string, place int"


def new_json_keys(df: DataFrame, names: Sequence[str], registry: DataFrame) -> list[tuple[str, str, str | None, str, int]]:
    """Rows to add to the registry for what ``df`` holds in its JSON columns.

    A key keeps the kind it was found with, so that its column keeps its type; only
    an object, which has no column of its own, may turn out to be a value as well.
    """
    known = {(r.column_name, r.k1, r.k2, r.kind) for r in registry.collect()}  # one row per output column
    place, out = len(known), []
    for name in names:
        for path, kind in collect_json_keys(df, name):
            k1, k2 = path[0], path[1] if len(path) == 2 else None
            kinds = {k for k in ("object", "array", "scalar") if (name, k1, k2, k) in known}
            if not kinds or (kinds == {"object"} and kind != "object"):
                out.append((name, k1, k2, kind, place + len(out)))
    return out


def registered_paths(registry: DataFrame, names: Sequence[str]) -> dict[str, list[tuple[list[str], str]]]:
    """What ``Rules.json`` takes, in registry order."""
    found: dict[str, list[tuple[list[str], str]]] = {n: [] for n in names}
    for r in sorted(registry.collect(), key=lambda r: r.place):
        found.setdefault(r.column_name, []).append(([r.k1] if r.k2 is None else [r.k1, r.k2], r.kind))
    return found


def unnest(df: DataFrame, name: str, position: str | None = None) -> DataFrame:
    """One row per array element; rows with no element stay, with NULL."""
    others = [c for c in df.columns if c != name]
    if position:
        return df.select(*others, F.posexplode_outer(name).alias(position, name))
    return df.select(*others, F.explode_outer(name).alias(name))


def cap_columns(df: DataFrame, limit: int = MAX_COLUMNS) -> tuple[DataFrame, list[str]]:
    """First ``limit`` columns, and the names left out; for callers who ask for it, ``stage`` keeps all."""
    return df.select(*[f"`{c}`" for c in df.columns[:limit]]), df.columns[limit:]


def add_metadata(df: DataFrame, source: str, as_of: int) -> DataFrame:
    return df.select("*", F.lit(source).alias("source_system"), epoch_text(F.lit(as_of)).alias("load_timestamp"))


def join_dim(df: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Sequence[str], suffix: str = "_dim") -> DataFrame:
    """Left join on cleaned columns; only the asked columns come along, suffixed.

    ``on`` maps a column of ``df`` to one of ``dim``. Whether the dimension is
    small enough to broadcast is left to its measured size.
    """
    keys = list(on)
    side = dim.select(
        *[F.col(d).alias(c) for c, d in on.items()],
        *[F.col(c).alias(f"{c}{suffix}") for c in columns],
    )
    return salted_join(df, side, keys, "left")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row per key tuple: the first by ``order`` (column, descending?), NULLs last.

    NULL keys form one group. The remaining columns break ties, so the result is
    the same on every run. The row limit is applied before the shuffle as well,
    so a hot key moves one row per task.
    """
    ranks = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in order]
    named = {c for c, _ in order} | set(keys)
    sortable = [f.name for f in df.schema.fields if f.name not in named and is_comparable(f.dataType)]
    ranks += [F.col(c).desc_nulls_last() for c in sorted(sortable)]
    window = Window.partitionBy(*keys).orderBy(*ranks)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def key_texts(keys: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]


def key_is_empty(keys: Sequence[str]) -> Column:
    """True when every part of the key is NULL or empty."""
    empty = F.lit(True)
    for text in key_texts(keys):
        empty = empty & (text == "")
    return empty


def replaced_keys(work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-empty key tuples of the work rows, as text."""
    texts = [t.alias(f"_k{i}") for i, t in enumerate(key_texts(keys))]
    return work.filter(~key_is_empty(keys)).select(*texts).distinct()


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Adds the key texts, NULL where the whole key is empty, so that such rows match nothing."""
    names, empty = [f"_k{i}" for i in range(len(keys))], key_is_empty(keys)
    return df.withColumns({n: F.when(~empty, t) for n, t in zip(names, key_texts(keys))}), names


def affected_rows(target: DataFrame, work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows an upsert is about to replace."""
    keyed, names = _keyed(target, keys)
    return salted_join(keyed, replaced_keys(work, keys), names, "left_semi").select(*target.columns)


def untouched_rows(target: DataFrame, work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows an upsert keeps."""
    keyed, names = _keyed(target, keys)
    return salted_join(keyed, replaced_keys(work, keys), names, "left_anti").select(*target.columns)


def upsert(target: DataFrame, work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose key is in ``work``, plus all of ``work``.

    Keys compare part by part. An all-empty key deletes nothing.
    """
    return untouched_rows(target, work, keys).unionByName(work)


@dataclass
class Join:
    dim: DataFrame
    on: Mapping[str, str]
    columns: Sequence[str]


@dataclass
class Rules:
    """How one table is staged; everything is optional."""

    columns: Mapping[str, str] | None = None
    json: Mapping[str, Sequence[tuple[Sequence[str], str]]] = field(default_factory=dict)
    joins: Sequence[Join] = ()
    keys: Sequence[str] = ()
    order: Sequence[tuple[str, bool]] = ()
    custom: Callable[[DataFrame], DataFrame] | None = None
    find_json: bool = False


def searched_columns(df: DataFrame, rules: Rules) -> list[str]:
    """JSON columns whose keys have to be found in the data."""
    return [n for n, kind in classify_columns(df.schema).items() if kind == "json" and n not in rules.json] if rules.find_json else []


def stage(df: DataFrame, rules: Rules, source: str, as_of: int) -> DataFrame:
    """Clean, then join on cleaned columns, then de-duplicate. All columns are staged.

    With ``find_json`` the keys of JSON columns that the rules do not name are found
    in the data and flattened as well. Raw JSON columns stay as they came.
    """
    wanted = dict(rules.json)
    if rules.find_json:
        for name in searched_columns(df, rules):
            wanted[name] = collect_json_keys(df, name)
    kept = list(wanted)
    for name, keys in wanted.items():
        df = json_flatten(df, name, keys)
        kept += json_column_names(name, keys)
    plan = dict(classify_columns(df.schema) if rules.columns is None else rules.columns)
    plan.update({c: "keep" for c in kept})
    df = clean_columns(df, plan)
    if rules.custom:
        df = rules.custom(df)
    for join in rules.joins:
        df = join_dim(df, join.dim, join.on, join.columns)
    df = add_metadata(df, source, as_of)
    return dedupe(df, rules.keys, rules.order) if rules.keys else df


def guard_types(df: DataFrame, date_columns: Sequence[str] = ()) -> DataFrame:
    """Raise unless the output keeps the contract: no TIMESTAMP or BOOLEAN, ``time``
    present, all four outputs per date column."""
    faults = [
        f"{f.name} is {f.dataType.simpleString()}"
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType))
    ]
    if INGEST_CLOCK not in df.columns:
        faults.append("time is missing")
    for name in date_columns:
        faults += [
            f"{out} is missing" for out in (name, f"{name}_std", f"{name}_unixtime", f"{name}_date") if out not in df.columns
        ]
    if faults:
        raise ValueError("; ".join(faults))
    return df


def select_rules(rules_table: DataFrame, db: str, table: str) -> DataFrame:
    """Rules of exactly one table."""
    return rules_table.filter((F.col("db_name") == db) & (F.col("table_name") == table))


def load_rules(rules_table: DataFrame, db: str, table: str, fallback: Mapping | None = None) -> dict:
    """Dedupe columns and extra rules: the rules table first, then the caller, then none."""
    row = select_rules(rules_table, db, table).first()
    if row is None:
        return dict(fallback or {})
    split = lambda text: [c.strip() for c in (text or "").split(",") if c.strip()]
    order = []
    for item in split(row["order_by_columns"]):
        name, _, direction = item.partition(" ")
        order.append((name, direction.strip().lower() != "asc"))
    found = {
        "keys": split(row["partition_columns"]),
        "order": order,
        "additional": json.loads(row["additional_rules"]) if row["additional_rules"] else {},
    }
    if not found["keys"] and fallback:
        found["keys"], found["order"] = fallback.get("keys", []), fallback.get("order", [])
    return found


def rules_from(found: Mapping, joins: Mapping[str, DataFrame] | None = None) -> Rules:
    """``Rules`` from what ``load_rules`` returns.

    Of the additional rules, ``columns`` names cleaning rules, ``json`` lists the key
    paths to extract per column (``a`` or ``a.b``; or "all" to find them), and ``joins``
    describes dimensions by name: ``{"table", "on", "columns"}``; ``joins`` has their frames.
    """
    more = found.get("additional", {})
    known = {"columns", "json", "joins"}
    if unknown := set(more) - known:
        raise ValueError(f"unknown additional rules: {sorted(unknown)}")
    listed = more.get("json", {})
    paths = {} if listed == "all" else {c: [(p.split(".", 1), "scalar") for p in keys] for c, keys in listed.items()}
    dims = [Join((joins or {})[j["table"]], j["on"], j["columns"]) for j in more.get("joins", ())]
    return Rules(
        columns=more.get("columns"), json=paths, joins=dims, keys=found.get("keys", ()), order=found.get("order", ()), find_json=listed == "all"
    )
