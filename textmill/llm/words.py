"""Words of whole Arrow string batches as numpy arrays.

A batch of texts is looked at as one UTF-8 byte buffer.  Words are maximal
runs of bytes for which a 256-entry table is true, so a word never crosses a
row, and every array below is as long as the number of words (or, for short
moments, of bytes in one slice).  Nothing here loops over words in Python.

Word and window names are 64-bit polynomial hashes with a final mix; callers
that need exactness compare the words themselves or a second name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 2 << 20
HASH_BYTES = 1 << 16  # byte-wide temporaries of this many entries stay in cache

#: words split at space and the five ASCII white-space controls
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: words of ASCII digits, ASCII letters and everything beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
#: A-Z to a-z, other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection of 64-bit values (splitmix)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """b^i and b^-i modulo 2^64 for an odd b, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            made = []
            for b in (self.base, self.inverse):
                a = np.full(size, b, dtype=U64)
                a[0] = 1
                made.append(np.multiply.accumulate(a))
            self.up, self.down = made
        return self.up, self.down


_BYTE_POWERS = _Powers(0x9E3779B97F4A7C15)
_WORD_POWERS = (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))
_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


@dataclass
class Words:
    """Words of consecutive rows: byte spans and, per row, its first word."""

    data: np.ndarray       # uint8, the slice's bytes (lower-cased if asked)
    start: np.ndarray      # int64, first byte of each word
    end: np.ndarray        # int64, one past the last byte
    row_first: np.ndarray  # int64, rows + 1

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.row_first) - 1), np.diff(self.row_first))

    def hashes(self) -> np.ndarray:
        """64-bit name of each word, equal for equal bytes anywhere."""
        return self.names([(self.start, self.end)])[0]

    def affixes(self, prefixes: list[int], suffixes: list[int]) -> list[np.ndarray]:
        """Names of the words, then of their first and last so many bytes."""
        spans = [(self.start, np.minimum(self.start + k, self.end)) for k in prefixes]
        spans += [(np.maximum(self.end - k, self.start), self.end) for k in suffixes]
        return self.names([(self.start, self.end), *spans])

    def names(self, spans: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Names of byte spans, each inside its word."""
        out = [np.empty(len(self.start), dtype=U64) for _ in spans]
        at, n = 0, len(self.start)
        while at < n:  # segments of words, so that byte-wide temporaries stay small
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + HASH_BYTES, side="right")))
            lo, hi = int(self.start[at]), int(self.end[to - 1])
            up, down = _BYTE_POWERS.get(hi - lo + 1)
            sums = np.empty(hi - lo + 1, dtype=U64)
            sums[0] = 0
            np.cumsum(_BYTE_VALUE[self.data[lo:hi]] * up[: hi - lo], out=sums[1:])
            for o, (start, end) in zip(out, spans):
                s, e = start[at:to] - lo, end[at:to] - lo
                o[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
            at = to
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def span_names(h: np.ndarray, first: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Name of each run h[first:end]; ``which`` picks one of two hashes."""
    up, down = _WORD_POWERS[which].get(len(h) + 1)
    sums = np.empty(len(h) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(U64))


def window_names(h: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Name of each run of ``width`` consecutive values (len - width + 1)."""
    first = np.arange(max(0, len(h) - width + 1))
    return span_names(h, first, first + width, which)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of about ``max_bytes``;
    a longer text makes a piece of its own."""
    data, offsets = text_buffer(col)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
        yield at, to, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False) -> Words:
    """Words of the rows that ``offsets`` cut out of ``data``."""
    if lower:
        data = LOWER[data]
    inside = table[data]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length, one after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64) - np.repeat(ends - lengths, lengths)
