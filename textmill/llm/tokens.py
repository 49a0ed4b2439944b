"""Token ids of whole texts with the ``tokenizers`` library.

A text is cut only at places where the tokenizer itself must cut, each piece
(a word, mostly) is encoded once per worker and kept, and the ids of a batch
are put together with numpy.  The cut rule follows from the tokenizer file:

* ``drop``: white space separates and yields no token, so a text is its words;
* ``keep``: GPT-2 style byte-level pattern, whose matches never continue from
  a visible character into white space, so a piece is white space plus what
  follows it;
* otherwise whole texts are encoded.

Both patterns also end a match between an ASCII letter and ASCII punctuation
other than the apostrophe, so pieces are cut there too; where the normaliser
folds case, ASCII letters are folded beforehand.

Strings of added tokens in a text yield their ids, as in the tokenizer itself:
each is a piece of its own, neither cut nor folded.  Where added tokens match
by other rules than their plain string, whole texts are encoded.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from textmill.llm.store import trim
from textmill.llm.words import LOWER, NOT_SPACE, Words, ragged, slices

END_ID = 1
#: pieces kept per worker; beyond, those met in one slice only are forgotten
KEPT_PIECES = 1 << 20
LEARN_AT_ONCE = 4096

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, dtype=bool)  # ASCII punctuation without the apostrophe
_MARK[0x21:0x7F] = True
_MARK[0x30:0x3A] = _MARK[0x27] = False
_MARK &= ~_LETTER


def cut_rule(spec: dict) -> str | None:
    for token in spec.get("added_tokens") or []:
        if any(token.get(x) for x in ("single_word", "lstrip", "rstrip", "normalized")) or re.search(r"\s", token["content"]):
            return None
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "keep"
    parts = pre.get("pretokenizers") or [{}]
    steps = [x.get("type") for x in (norm or {}).get("normalizers", [])]
    if (parts[0].get("type") == "Split" and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
            and set(steps) <= {"NFC", "Replace", "Lowercase"} and "[^\\s\\p{L}\\p{N}]+" in parts[0]["pattern"].get("Regex", "")):
        return "drop"
    return None


class Encoder:
    """One tokenizer file with the ids of the pieces met so far."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule = cut_rule(spec)
        self.folds = any(x.get("type") == "Lowercase" for x in (spec.get("normalizer") or {}).get("normalizers", []))
        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((x["content"].encode("utf-8") for x in spec.get("added_tokens") or []), key=len, reverse=True)
        self.added = [x for x in added if x]  # the longest first
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self._forget()

    def _forget(self) -> None:
        self.names = np.empty(0, dtype=np.uint64)  # sorted
        self.at = self.n = self.met = np.empty(0, dtype=np.int32)  # place and number of ids, slices met in
        self.pool = np.empty(0, dtype=np.uint32)

    def _keep(self, keep: np.ndarray) -> None:
        size, at = self.n[keep], self.at[keep]
        self.pool = self.pool[np.repeat(at, size) + ragged(size)]
        self.names, self.n = self.names[keep], size
        self.at = (np.cumsum(size) - size).astype(np.int32)

    def thin(self) -> None:
        """Keep the pieces met in several slices since the last time."""
        self._keep(self.met > 1)
        self.met = np.zeros(len(self.names), dtype=np.int32)

    def _added(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int]]:
        """Byte spans of added tokens' strings inside rows, from left to right."""
        raw, out, at = data.tobytes(), [], 0
        if not any(x in raw for x in self.added):
            return out
        pattern = re.compile(b"|".join(re.escape(x) for x in self.added))
        while m := pattern.search(raw, at):
            end = int(offs[np.searchsorted(offs, m.start(), side="right")])  # of the row it begins in
            token = next((x for x in self.added if raw.startswith(x, m.start(), end)), None)
            at = m.start() + (len(token) if token else 1)
            if token:
                out.append((m.start(), at))
        return out

    def _pieces(self, data: np.ndarray, offs: np.ndarray) -> Words:
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offs] = True
        space = ~NOT_SPACE[data]
        added = self._added(data, offs) if self.rule else []
        if self.rule and len(data) > 1:
            letter, mark = _LETTER[data], _MARK[data]
            cut[1:-1] |= letter[:-1] & mark[1:]
        if self.rule == "drop":
            if self.folds:
                whole, data = data, LOWER[data]
                for a, b in added:
                    data[a:b] = whole[a:b]
            cut[:-1] |= space
            cut[1:] |= space
        elif self.rule == "keep" and len(data) > 1:
            visible = (data > 0x20) & (data < 0x7F)  # Unicode white space begins beyond ASCII ...
            two = np.zeros(len(data), dtype=bool)    # ... and not in two-byte characters from U+00C0
            two[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
            cut[1:-1] |= space[1:] & (visible | two)[:-1]
        for a, b in added:
            cut[a + 1: b] = False
            cut[[a, b]] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        if self.rule == "drop":
            text = ~space[start]
            start, end = start[text], end[text]
        return Words(data, start, end, np.searchsorted(start, offs))

    def _learn(self, w: Words, names: np.ndarray, first: np.ndarray, used: np.ndarray) -> None:
        raw, ids, n = w.data.tobytes(), [], []
        spans = list(zip(w.start[first].tolist(), w.end[first].tolist()))
        for at in range(0, len(spans), LEARN_AT_ONCE):
            texts = [raw[s:e].decode("utf-8") for s, e in spans[at: at + LEARN_AT_ONCE]]
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                got = e.ids
                n.append(len(got))
                ids += got
        flat, n = np.array(ids, dtype=np.uint32), np.array(n, dtype=np.int32)
        if len(self.names) + len(names) > KEPT_PIECES:
            keep = (self.met > 1) | np.isin(self.names, used)
            if keep.sum() + len(names) > KEPT_PIECES:
                keep = np.isin(self.names, used)
            self._keep(keep)
            self.met = np.ones(len(self.names), dtype=np.int32)
        at = (np.cumsum(n) - n + len(self.pool)).astype(np.int32)
        where = np.searchsorted(self.names, names)  # both are sorted
        self.names = np.insert(self.names, where, names)
        self.n, self.at = np.insert(self.n, where, n), np.insert(self.at, where, at)
        self.met, self.pool = np.insert(self.met, where, 0), np.concatenate([self.pool, flat])

    def encode(self, data: np.ndarray, offs: np.ndarray, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, row offsets into them)."""
        w, rows = self._pieces(data, offs), len(offs) - 1
        names = w.hashes()
        unique, first, where = np.unique(names, return_index=True, return_inverse=True)
        at = np.searchsorted(self.names, unique)
        new = np.ones(len(unique), dtype=bool)
        inside = at < len(self.names)
        new[inside] = self.names[at[inside]] != unique[inside]
        if new.any():
            self._learn(w, unique[new], first[new], unique)
            at = np.searchsorted(self.names, unique)
        self.met[at] += 1
        n = self.n[at][where]
        tokens = self.pool[np.repeat(self.at[at][where], n) + ragged(n)]
        ends = np.concatenate([[0], np.cumsum(n)])[w.row_first]
        if end_id is None:
            return tokens, ends
        out = np.empty(len(tokens) + rows, dtype=np.uint32)
        out[np.arange(len(tokens)) + np.repeat(np.arange(rows), np.diff(ends))] = tokens
        ends = ends + np.arange(rows + 1)
        out[ends[1:] - 1] = end_id
        return out, ends


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop the worker's rare pieces, at the end of a task."""
    for e in _ENCODERS.values():
        e.thin()


def id_type(path: str) -> np.dtype:
    """Smallest unsigned type that holds all ids."""
    return np.dtype("<u2") if encoder(path).vocabulary <= 1 << 16 else np.dtype("<u4")


def encodes(run):
    """A batch function that encodes: rare pieces go when its task ends."""
    @functools.wraps(run)
    def forgetting(batches):
        try:
            yield from run(batches)
        finally:
            forget()
            trim()
    return forgetting


def encoded(path: str, col: pa.Array, end_id: int | None = END_ID) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets) of slices of a text column."""
    e = encoder(path)
    for lo, hi, data, offs in slices(col):
        yield lo, hi, *e.encode(data, offs, end_id)
