"""Canonical id of a leader: a masked, shortened SHA-256 as 12 URL-safe characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One 9-byte mask per key position, position 1 first.
KEY_MASKS = [
    "0ffdbcf0c666ce190d",
    "61a821f2b646a4e890",
    "acd2206c3f88b3ee27",
    "e2b8c47f5a94d1e36f",
    "7c3f9e8b2d156a0492",
    "4f6a1c8e7b359d2841",
    "9b2e5f7a4c8d1e6307",
    "3a7c9f2e6b8d4e1529",
    "8e4f7a1c9b6d2e5083",
    "2c6f9e4a7b1d8e3567",
]


def key_masks(count: int) -> list[str]:
    """Masks for ``count`` merge keys; more keys than masks is an error."""
    if count > len(KEY_MASKS):
        raise ValueError(f"{count} merge keys, but only {len(KEY_MASKS)} have a mask")
    return KEY_MASKS[:count]


def _xor_word(digest: Column, mask: Column, start: int) -> Column:
    """32 bits of the digest against 32 bits of the mask, as 8 hex digits.

    Half words keep the parsed numbers inside a signed long.
    """
    def number(text: Column) -> Column:
        return F.conv(F.substring(text, start, 8), 16, 10).cast("long")

    return F.lpad(F.conv(number(digest).bitwiseXOR(number(mask)).cast("string"), 10, 16), 8, "0")


def canonical_hash(id_col: Column, mask: Column) -> Column:
    """Bytes 1-8 of SHA-256(id) under the mask, then the mask's last byte, URL-safe base64."""
    digest = F.sha2(id_col, 256)
    hex_text = F.concat(_xor_word(digest, mask, 1), _xor_word(digest, mask, 9), F.substring(mask, 17, 2))
    return F.translate(F.base64(F.unhex(hex_text)), "+/=", "-_")


def mask_of(ns: Column, count: int) -> Column:
    """Mask text of a 1-based key position."""
    return F.element_at(F.array(*[F.lit(m) for m in key_masks(count)]), ns.cast("int"))
