"""Exact token counts of every prefix of a text, by dynamic programming.

For every prefix of a pre-token there is exactly one token that can end its
byte-pair encoding: a suffix whose pair with the token before it the tokenizer
encodes as just these two. So the count of a prefix is the count of a shorter
prefix plus one, and all prefixes of a pre-token cost little more than one. A
text's table is one signed byte per character, the change of the count; a running
sum gives the count at every prefix, without encoding anything again.

Counts may fall by a character (a merge completes), so "fits the budget" is
answered by the longest prefix within it.

Defined results: a NULL or empty text has no tokens and an empty table; repeated
rows are counted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import tokens
from kindred.llm.common import map_batches

LIMIT = 512
#: Pieces a worker remembers at most; a quarter as many pre-tokens.
MEMO = 1_500_000
#: Pairs of tokens a worker remembers at most.
PAIRS = 1_000_000
#: The pattern that splits text before merging (a fixed value of the vocabulary), with white space spelled out.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^W\p{L}\p{N}]+|[W]+(?![^W])|[W]+".replace("W", tokens.WHITE)
)
WHITE_RUN = regex.compile(f"[{tokens.WHITE}]*")
#: Of these, prefixes that end inside are split at the apostrophe.
CONTRACTIONS = {"'re", "'ve", "'ll"}


class PrefixCounter:
    """Count changes per character for a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = tokens.load(path)
        back = {c: b for b, c in tokens.byte_alphabet().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        tokens_of = [bytes(back[c] for c in t) for t in vocab if all(c in back for c in t)]
        self.longest = max(map(len, tokens_of))
        state = json.loads(self.tokenizer.to_str())
        added = sorted((t["content"] for t in state.get("added_tokens", ())), key=len, reverse=True)
        #: The leftmost added token, the longest of several.
        self.whole = regex.compile("|".join(map(regex.escape, added))) if added else None
        # Rank of the merge that makes a token of two; what makes a pair break up is a merge of an earlier rank.
        self.merges = {}
        for rank, m in enumerate(state["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.setdefault((bytes(back[c] for c in a), bytes(back[c] for c in b)), rank)
        #: By token: which tokens before it leave it alone.
        self.after: dict[bytes, dict[bytes, bool]] = {t: {} for t in tokens_of}
        self.n_pairs = 0
        self.words: dict[str, list[int]] = {}
        self.memo: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """Plain byte-pair encoding of a short byte string."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.merges.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            pair, out, i = None, [], 0
            at = ranks.index(best)
            pair = (parts[at], parts[at + 1])
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, a: bytes, b: bytes) -> bool:
        """Does ``b`` stay a token of its own after ``a`` (empty: at the start)?"""
        if self.n_pairs > PAIRS:
            self.after = {t: {} for t in self.after}
            self.n_pairs = 0
        known = self.after[b][a] = self.merge(a + b) == ([a, b] if a else [b])
        self.n_pairs += 1
        return known

    def word(self, word: bytes) -> list[int]:
        """Counts of all byte prefixes of one pre-token, from one byte on."""
        last, counts, size = [b""], [0], 0
        for end in range(1, len(word) + 1):
            # One token fits, in whatever order they are tried; most often the last one grows or a new one begins.
            size += 1
            t = word[end - size : end]
            if (after := self.after.get(t)) is None or not (after[a] if (a := last[end - size]) in after else self.fits(a, t)):
                for size in range(1, min(end, self.longest) + 1):
                    t = word[end - size : end]
                    if (after := self.after.get(t)) is None:
                        continue
                    a = last[end - size]
                    if after[a] if a in after else self.fits(a, t):
                        break
                else:
                    raise ValueError(f"no token ends the prefix {word[:end]!r}")
            last.append(t)
            counts.append(counts[end - size] + 1)
        return counts[1:]

    def part(self, part: str) -> list[int]:
        """Counts of all character prefixes of one pre-token."""
        known = self.words.get(part)
        if known is None:
            known = self.word(part.encode())
            if not part.isascii():
                ends = np.cumsum([len(c.encode()) for c in part]) - 1
                known = [known[e] for e in ends.tolist()]
            if part in CONTRACTIONS:
                known[1] = self.word(b"'")[-1] + self.word(part[1].encode())[-1]
            if len(part) <= tokens.LONGEST:
                if len(self.words) > MEMO // 4:
                    self.words.clear()
                self.words[part] = known
        return known

    def plain(self, piece: str) -> list[int]:
        """Counts of all prefixes of white space followed by other characters, without added tokens."""
        if piece[:1] == " " and piece[1:-1].isalpha():
            # A word after one space, perhaps with a mark behind it, needs no splitting.
            if piece[-1].isalpha():
                return [1, *self.part(piece)[1:]]
            if piece[-1] in ".,":
                of_word = self.part(piece[:-1])
                return [1, *of_word[1:], of_word[-1] + 1]
        white = WHITE_RUN.match(piece).end()
        # White space that ends a prefix is one pre-token; before other characters its last character is not part of it.
        counts = list(self.white(piece[:white]))
        base = at = 0
        for part in SPLIT.findall(piece):
            of_part = self.part(part)
            counts += [base + c for c in of_part[max(0, white - at) :]]
            base, at = base + of_part[-1], at + len(part)
        return counts

    def white(self, run: str) -> list[int]:
        """Counts of all prefixes of a run of white space."""
        return self.part(run) if run else []

    def counts(self, piece: str) -> list[int]:
        """Counts of all prefixes of a piece. An added token is one token once it is complete, and splits the text."""
        out: list[int] = []
        base = at = 0
        for found in self.whole.finditer(piece) if self.whole else ():
            before, added = piece[at : found.start()], found[0]
            own = self.plain(before + added[:-1])
            out += [base + c for c in own]
            base += (own[len(before) - 1] if before else 0) + 1
            out.append(base)
            at = found.end()
        return out + [base + c for c in self.plain(piece[at:])] if at < len(piece) else out

    def changes(self, text: str | None) -> bytes:
        """Change of the count by each character of a text."""
        out = []
        for piece in tokens.PIECE.findall(text or ""):
            known = self.memo.get(piece)
            if known is None:
                counts = self.counts(piece)
                known = bytes(b - a & 255 for a, b in zip([0, *counts], counts))
                if len(piece) <= tokens.LONGEST:
                    if len(self.memo) > MEMO:
                        self.memo.clear()
                    self.memo[piece] = known
            out.append(known)
        return b"".join(out)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The worker's counter of a vocabulary file; kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def running(table: bytes) -> np.ndarray:
    """Tokens of every prefix, from the empty one on."""
    changes = np.frombuffer(zstandard.ZstdDecompressor().decompress(table), dtype=np.int8)
    return np.concatenate(([0], np.cumsum(changes, dtype=np.int64)))


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.nonzero(counts <= budget)[0][-1])


def table(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its bytes, tokens, whether they exceed ``limit``, the characters of the longest
    prefix within it, and the compressed table of all prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        count = counter(path)
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in tokens.chunks(batch.column(1)):
                n_bytes, n_tokens, cut, tables = [], [], [], []
                for t in texts:
                    changes = count.changes(t)
                    counts = np.cumsum(np.frombuffer(changes, dtype=np.int8), dtype=np.int64)
                    n = int(counts[-1]) if len(counts) else 0
                    n_bytes.append(len((t or "").encode()))
                    n_tokens.append(n)
                    within = len(counts) if n <= limit else longest_within(np.concatenate(([0], counts)), limit)
                    cut.append(within)
                    tables.append(press.compress(changes))
                yield {
                    "doc_id": ids.slice(at, len(texts)), "n_bytes": n_bytes, "n_tokens": n_tokens,
                    "over_limit": [n > limit for n in n_tokens], "chars_within_limit": cut, "prefix_table": tables,
                }
                at += len(texts)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within_limit long, prefix_table binary"
    return map_batches(docs.select(F.col(doc_id).cast("long"), F.col(text)), run, schema)


def within_budget(tables: DataFrame, budget: int) -> DataFrame:
    """Per document the characters of the longest prefix of at most ``budget`` tokens, and its tokens, from the stored tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            counts = [running(t) for t in batch.column(1).to_pylist()]
            cut = [longest_within(c, budget) for c in counts]
            yield {"doc_id": batch.column(0), "chars": cut, "n_tokens": [int(c[i]) for c, i in zip(counts, cut)]}

    return map_batches(tables.select("doc_id", "prefix_table"), run, "doc_id long, chars long, n_tokens long")
