"""When a raw value may serve as an identity key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_valid(col: Column, invalid_texts: Sequence[str | None] = (), valid_regexp: str | None = None) -> Column:
    """True for a usable key, false otherwise; NULL is never usable.

    The pattern may match anywhere in the text.
    """
    text = col.cast("string")
    ok = text.isNotNull()
    if valid_regexp:
        ok = ok & text.rlike(valid_regexp)
    banned = [t for t in invalid_texts if t is not None]
    if banned:
        ok = ok & ~text.isin(banned)
    return F.coalesce(ok, F.lit(False))
