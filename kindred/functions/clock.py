"""Time patterns and text forms. The session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directive to Java date pattern.
STRPTIME_DIRECTIVES = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
}


def java_pattern(strptime_format: str) -> str:
    """Translate a strptime format to the pattern Spark parses with."""
    out, i = [], 0
    while i < len(strptime_format):
        directive = strptime_format[i : i + 2]
        if directive in STRPTIME_DIRECTIVES:
            out.append(STRPTIME_DIRECTIVES[directive])
            i += 2
        elif strptime_format[i] == "%":
            raise ValueError(f"unknown directive {directive!r} in {strptime_format!r}")
        else:
            char = strptime_format[i]
            out.append(f"'{char}'" if char.isalpha() else char)
            i += 1
    return "".join(out)


# How each kind of source writes a window bound.
BOUND_STYLES = ("micros", "millis_z", "iso", "sql")


def format_window_bound(ts: Column, style: str) -> Column:
    """Render a timestamp as a source expects it."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    if style == "micros":
        return F.concat(seconds, F.lit(".000000"))
    if style == "millis_z":
        return F.concat(seconds, F.lit(".000Z"))
    if style == "iso":
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if style == "sql":
        return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
    raise ValueError(f"style must be one of {BOUND_STYLES}")


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_text(seconds: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds as UTC text."""
    return F.date_format(F.timestamp_seconds(seconds), pattern)
