"""Token ids of whole texts through the tokenizers library, with a memo per piece.

The pre-tokenizers used here never join the end of a word with white space after
it. So a text can be cut before every run of white space, and its ids are those of
its pieces one after the other. A run of texts is cut as one array of bytes, and its
distinct pieces are found in Arrow. Each Python worker keeps the ids of the pieces it
has met, as Arrow arrays too; the library is asked for new pieces only.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space by the Unicode property, as the pre-tokenizers see it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Pieces that a worker remembers, the longest one worth it, and bytes of texts that are cut and looked up at a time.
MEMO_PIECES = 1_500_000
LONGEST = 64
RUN_BYTES = 16 << 20
#: What a piece counts for one run of texts later.
FADING = 0.9

#: Marks that no pre-token begins with in any other way (an apostrophe may, and special tokens have angles and bars).
MARKS = ".,;:!?*&#%$)"

#: Per byte: 1 for white space, 2 where a longer character that may be white space begins, 3 for marks, 4 for A-Z and a-z.
_LONG_WHITE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{WHITE}]", c)]
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[b for b in range(128) if re.match(f"[{WHITE}]", chr(b))]] = 1
_KINDS[[c[0] for c in _LONG_WHITE]] = 2
_KINDS[list(MARKS.encode())] = 3
_KINDS[[b for b in range(128) if chr(b).isalpha()]] = 4

END = 1
_ENCODERS: dict[str, Encoder] = {}


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def kind(path: str) -> np.dtype:
    """Integers that hold the ids of a vocabulary file."""
    return np.dtype("<u2" if load(path).get_vocab_size() <= 1 << 16 else "<u4")


def byte_alphabet() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words:
    """Ids of single words straight from the library's model, past its splitting and normalizing.

    For a word of Latin letters after one space or line end, perhaps with a run of
    ``MARKS`` behind it, these have one outcome: the word and the run are pre-tokens.
    """

    LONGEST_RUN = 8
    PROBES = ["Word", " word", "\nÉté,", " naïve.", "x.", " Straße,", "\nB", " end.***", " a&&&", "\nSo!!", " b.).", " c,###", " d;:?%%%"]

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.alphabet = tokenizer, tokenizer.model, byte_alphabet()
        config = json.loads(tokenizer.to_str())
        self.space = self.alphabet[32]
        #: A vocabulary without a normalizer keeps spaces and case, the other kind drops both.
        self.spaced = config["normalizer"] is None
        self.runs: dict[str, list[int]] = {}
        self.line = self._ids("\n") if self.spaced else []
        self.works = all(self.ids(p) == self._ids(p) for p in self.PROBES)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, piece: str) -> list[int] | None:
        """None where the piece is not such a word."""
        head = piece[0]
        body = piece[1:] if head in " \n" else piece
        word = body.rstrip(MARKS)
        if not word.isalpha():
            return None
        marks = body[len(word) :]
        run = self.runs.get(marks)
        if run is None:
            run = self._ids(marks) if marks else []
            if len(marks) <= self.LONGEST_RUN and len(self.runs) < 100_000:
                self.runs[marks] = run
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            if max(word) >= "\u0250" or not unicodedata.is_normalized("NFC", word):
                return None
            word = "".join([self.alphabet[b] for b in word.encode()])
        if self.spaced and head == " ":
            word = self.space + word
        out = [t.id for t in self.model.tokenize(word)]
        if head == "\n":
            out = self.line + out
        return out + run if run else out


def cuts(data: np.ndarray, offsets: np.ndarray, marks: bool) -> np.ndarray:
    """Where pieces begin in the UTF-8 bytes of texts: at every text that is not empty and every run of white space.

    With ``marks`` (see ``Words``) also at a mark that ends a piece of nothing else but letters after a space or line end.
    """
    kinds = _KINDS[data]
    white = kinds == 1
    lead = np.flatnonzero(kinds == 2)
    for length in (2, 3):
        code = sum(data[np.minimum(lead + i, len(data) - 1)].astype(np.int32) << 8 * (length - 1 - i) for i in range(length))
        wide = lead[np.isin(code, [int.from_bytes(c) for c in _LONG_WHITE if len(c) == length])]
        for i in range(length):
            white[wide + i] = True
    begins = white.copy()
    begins[1:] &= ~white[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(begins)
    if not marks:
        return starts
    last = np.append(starts[1:], len(data)) - 1
    marked = np.flatnonzero((kinds[last] == 3) & (last - starts > 1))
    first, last = starts[marked], last[marked]
    others = np.cumsum(kinds != 4, dtype=np.int32)
    plain = (others[last - 1] == others[first]) & ((kinds[first] == 4) | (data[first] == 32) | (data[first] == 10))
    begins[last[plain]] = True
    return np.flatnonzero(begins)


class Memo:
    """Packed ids by piece; those of pieces that are not there are made when they are asked for.

    Beyond ``most`` pieces, those met in many runs of texts or lately stay.
    """

    def __init__(self, make: Callable[[list[str]], pa.Array], most: int = MEMO_PIECES):
        self.make, self.most = make, most
        self.pieces, self.packed = pa.array([], pa.string()), pa.array([], pa.binary())
        self.score = np.empty(0, dtype=np.float32)

    def of(self, pieces: pa.Array) -> pa.Array:
        """Packed ids of distinct pieces, in their order."""
        # The pieces asked for are hashed, not the many more that are known.
        met = pc.fill_null(pc.index_in(self.pieces, value_set=pieces), -1).to_numpy()
        known = np.flatnonzero(met >= 0)
        at = np.full(len(pieces), -1, dtype=np.int64)
        at[met[known]] = known
        new = pieces.take(pa.array(np.flatnonzero(at < 0)))
        at[at < 0] = len(self.pieces) + np.arange(len(new))
        held, packed = pa.concat_arrays([self.pieces, new]), pa.concat_arrays([self.packed, self.make(new.to_pylist())])
        self.score = np.concatenate([self.score * np.float32(FADING), np.zeros(len(new), dtype=np.float32)])
        self.score[at] += 1
        self.keep(held, packed)
        return packed.take(pa.array(at))

    def keep(self, pieces: pa.Array, packed: pa.Array) -> None:
        stay = np.flatnonzero(pc.binary_length(pieces).to_numpy() <= LONGEST)
        if len(stay) > self.most:
            stay = np.sort(stay[np.argpartition(-self.score[stay], self.most * 2 // 3)[: self.most * 2 // 3]])
        if len(stay) < len(pieces):
            pieces, packed, self.score = pieces.take(pa.array(stay)), packed.take(pa.array(stay)), self.score[stay]
        self.pieces, self.packed = pieces, packed


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit (or 32-bit) integers."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.words = Words(self.tokenizer)
        self.kind = kind(path)
        self.letter = "H" if self.kind.itemsize == 2 else "I"
        self.memo = Memo(self.make)

    def make(self, pieces: list[str]) -> pa.Array:
        """Packed ids of pieces, from the model or else from the whole library."""
        flat, ends = array(self.letter), [0]
        for piece in pieces:
            ids = self.words.ids(piece) if self.words.works else None
            flat.extend(self.tokenizer.encode(piece, add_special_tokens=False).ids if ids is None else ids)
            ends.append(len(flat))
        offsets = np.array(ends, dtype=np.int64) * self.kind.itemsize
        data = np.frombuffer(flat, dtype=f"=u{self.kind.itemsize}").astype(self.kind) if flat else np.empty(0, dtype=self.kind)
        return pa.Array.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])

    def encode(self, texts: Iterable[str | None] | pa.Array) -> list[bytes]:
        """Ids of every text, packed."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        return [packed for run in runs(pc.fill_null(column.cast(pa.string()), "")) for packed in self.run(run)]

    def run(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of an array of strings without NULLs, packed."""
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        if offsets[0] == offsets[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = cuts(data, offsets, self.words.works)
        ends = np.append(starts, len(data)).astype(np.int32)
        met = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        ids = self.memo.of(met.dictionary).take(met.indices)
        _, places, packed = ids.buffers()
        places = np.frombuffer(places, dtype=np.int32)[np.searchsorted(starts, offsets)].tolist()
        view = memoryview(packed) if packed is not None else b""
        return [bytes(view[a:b]) for a, b in zip(places, places[1:])]

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=self.kind)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give up the worker's encoders and what they remember; for tasks that come after all encoding."""
    _ENCODERS.clear()


def runs(column: pa.Array, most: int = RUN_BYTES) -> Iterable[pa.Array]:
    """Slices of a column of texts, alike and of about ``most`` bytes at most."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    each = -(-int(ends[-1]) // -(-int(ends[-1]) // most)) if len(ends) else most
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + each, side="right")))
        yield column.slice(at, to - at)
        at = to


def chunks(column: pa.Array, most: int = 1_000_000) -> Iterable[list]:
    """The same as lists; a batch of long texts is never held as Python strings at once."""
    for run in runs(column, most):
        yield run.to_pylist()
