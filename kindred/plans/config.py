"""What to unify: keys, tables, canonical ids and master tables."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import IllegalArgumentException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from kindred.functions.hashing import key_masks


@dataclass(frozen=True)
class Key:
    name: str
    valid_regexp: str | None = None
    invalid_texts: tuple = ()


@dataclass(frozen=True)
class KeyColumn:
    column: str
    key: str


@dataclass(frozen=True)
class Table:
    name: str
    key_columns: tuple[KeyColumn, ...]
    database: str = ""


@dataclass(frozen=True)
class CanonicalId:
    name: str
    merge_by_keys: tuple[str, ...]
    merge_iterations: int | None = None
    key_priorities: tuple[int, ...] | None = None

    def ns(self, key: str) -> int:
        return self.merge_by_keys.index(key) + 1

    def priority(self, ns: int) -> int:
        return self.key_priorities[ns - 1] if self.key_priorities else ns


@dataclass(frozen=True)
class SourceColumn:
    table: str
    column: str
    order_by: str = "time"
    priority: int | None = None
    order: str = "last"


@dataclass(frozen=True)
class Attribute:
    name: str
    source_columns: tuple[SourceColumn, ...]
    array_elements: int | None = None

    def ranked(self) -> list[SourceColumn]:
        """Sources by priority, then by place in the list."""
        numbered = [(s.priority if s.priority is not None else i + 1, i, s) for i, s in enumerate(self.source_columns)]
        return [s for _, _, s in sorted(numbered, key=lambda t: t[:2])]


@dataclass(frozen=True)
class Master:
    name: str
    canonical_id: str
    attributes: tuple[Attribute, ...]


@dataclass(frozen=True)
class Config:
    keys: tuple[Key, ...]
    tables: tuple[Table, ...]
    canonical_ids: tuple[CanonicalId, ...]
    master_tables: tuple[Master, ...] = field(default=())
    name: str = "unification"

    def key(self, name: str) -> Key:
        return next(k for k in self.keys if k.name == name)

    def table_id(self, name: str) -> int:
        return [t.name for t in self.tables].index(name) + 1

    def iterations(self, canonical: CanonicalId) -> int:
        """Planned loop steps: as configured, else from the number of keys and tables."""
        if canonical.merge_iterations is not None:
            return canonical.merge_iterations
        guess = 2 + len(canonical.merge_by_keys) + len(self.tables) // 2
        return min(max(guess, 2), 10)


def from_dict(raw: Mapping) -> Config:
    """Build a config from plain dicts and lists, as a YAML reader returns them."""
    return Config(
        name=raw.get("name", "unification"),
        keys=tuple(Key(k["name"], k.get("valid_regexp"), tuple(k.get("invalid_texts") or ())) for k in raw["keys"]),
        tables=tuple(
            Table(t["table"], tuple(KeyColumn(c["column"], c["key"]) for c in t["key_columns"]), t.get("database", ""))
            for t in raw["tables"]
        ),
        canonical_ids=tuple(
            CanonicalId(
                c["name"],
                tuple(c["merge_by_keys"]),
                c.get("merge_iterations"),
                tuple(c["key_priorities"]) if c.get("key_priorities") else None,
            )
            for c in raw["canonical_ids"]
        ),
        master_tables=tuple(
            Master(
                m["name"],
                m["canonical_id"],
                tuple(
                    Attribute(
                        a["name"],
                        tuple(
                            SourceColumn(
                                s["table"], s["column"], s.get("order_by", "time"), s.get("priority"), s.get("order", "last")
                            )
                            for s in a["source_columns"]
                        ),
                        a.get("array_elements"),
                    )
                    for a in m.get("attributes", ())
                ),
            )
            for m in raw.get("master_tables", ())
        ),
    )


def pattern_fault(pattern: str) -> str | None:
    """What is wrong with a pattern, by the compiler of the JVM where it will run; by Python's without a session."""
    session = SparkSession.getActiveSession()
    if session is not None:
        try:
            session._jvm.java.util.regex.Pattern.compile(pattern)
        except IllegalArgumentException as error:
            return str(error).splitlines()[0]
        return None
    try:
        re.compile(pattern)
    except re.error as error:
        return str(error)
    return None


def _repeated(names) -> list[str]:
    return sorted(n for n, c in Counter(names).items() if c > 1)


def check_config(cfg: Config, schemas: Mapping[str, T.StructType] | None = None) -> Config:
    """Raise with every fault found; return the config when it is sound."""
    faults: list[str] = []
    key_names = [k.name for k in cfg.keys]
    table_names = [t.name for t in cfg.tables]
    for label, values in (("keys", cfg.keys), ("tables", cfg.tables), ("canonical_ids", cfg.canonical_ids)):
        if not values:
            faults.append(f"{label} is empty")
    faults += [f"duplicate key {n}" for n in _repeated(key_names)]
    faults += [f"duplicate table {n}" for n in _repeated(table_names)]
    for key in cfg.keys:
        if key.valid_regexp:
            if fault := pattern_fault(key.valid_regexp):
                faults.append(f"key {key.name}: bad regexp, {fault}")
    used = {kc.key for t in cfg.tables for kc in t.key_columns}
    for table in cfg.tables:
        if not table.key_columns:
            faults.append(f"table {table.name} has no key columns")
        faults += [f"table {table.name}: unknown key {kc.key}" for kc in table.key_columns if kc.key not in key_names]
        if schemas is not None:
            if table.name not in schemas:
                faults.append(f"table {table.name} is missing")
                continue
            present = schemas[table.name].names
            faults += [f"table {table.name}: no column {kc.column}" for kc in table.key_columns if kc.column not in present]
            if "time" not in present:
                faults.append(f"table {table.name}: no column time")
            faults += [
                f"table {table.name} already has a column {c.name}" for c in cfg.canonical_ids if c.name in present
            ]
    for canonical in cfg.canonical_ids:
        faults += [f"{canonical.name}: unknown merge key {k}" for k in canonical.merge_by_keys if k not in key_names]
        faults += [f"{canonical.name}: no table provides {k}" for k in canonical.merge_by_keys if k not in used]
        try:
            key_masks(len(canonical.merge_by_keys))
        except ValueError as error:
            faults.append(f"{canonical.name}: {error}")
        if canonical.merge_iterations is not None and canonical.merge_iterations < 1:
            faults.append(f"{canonical.name}: merge_iterations must be positive")
        if canonical.key_priorities and len(canonical.key_priorities) != len(canonical.merge_by_keys):
            faults.append(f"{canonical.name}: one priority per merge key is needed")
    canonical_names = [c.name for c in cfg.canonical_ids]
    for master in cfg.master_tables:
        if master.canonical_id not in canonical_names:
            faults.append(f"master {master.name}: unknown canonical id {master.canonical_id}")
        faults += [f"master {master.name}: duplicate attribute {n}" for n in _repeated(a.name for a in master.attributes)]
        for attribute in master.attributes:
            for source in attribute.source_columns:
                where = f"master {master.name}.{attribute.name}"
                if source.table not in table_names:
                    faults.append(f"{where}: unknown table {source.table}")
                elif schemas is not None and source.table in schemas:
                    present = schemas[source.table].names
                    faults += [f"{where}: no column {c}" for c in (source.column, source.order_by) if c not in present]
                if source.order not in ("last", "first"):
                    faults.append(f"{where}: order must be first or last")
    if faults:
        raise ValueError("; ".join(faults))
    return cfg
