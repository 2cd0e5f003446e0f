"""Reading JSON held as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN_KEY = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def json_path(keys: Sequence[str]) -> str:
    """JSON path; keys with other than plain characters use bracket notation."""
    steps = [f".{k}" if set(k) <= _PLAIN_KEY else f"['{k}']" for k in keys]
    return "$" + "".join(steps)


def json_column_name(column: str, keys: Sequence[str]) -> str:
    """Lower-case output name ``column_parent_child`` without odd characters."""
    text = "_".join([column, *keys]).lower().replace(" ", "_").replace("$", "")
    return "".join(c for c in text if c.isalnum() or c == "_")


def json_scalar(col: Column, keys: Sequence[str]) -> Column:
    """Upper-cased scalar, NULL when empty."""
    return F.nullif(F.upper(F.get_json_object(col, json_path(keys))), F.lit(""))


def json_array(col: Column, keys: Sequence[str]) -> Column:
    """Array of text, NULL when the value is no array."""
    raw = F.get_json_object(col, json_path(keys))
    return F.when(raw.startswith("["), F.from_json(raw, "array<string>"))


def json_cast(col: Column, keys: Sequence[str], data_type: str, default=None) -> Column:
    """Typed value with a fallback."""
    value = F.get_json_object(col, json_path(keys)).try_cast(data_type)
    return value if default is None else F.coalesce(value, F.lit(default).cast(data_type))
