"""Periodic runs of words by recompression: a run-length grammar answers exact
extensions for candidates on a harmonic grid.

A run is a stretch of words with smallest period q (words q apart are equal)
and at least ``max(shortest, 2 q)`` words that no neighbouring word extends
keeping that period.

* **Grammar.**  The words of a batch, with a symbol of its own before each text
  and after the last, are compressed in rounds: maximal blocks of one symbol
  become one symbol for (symbol, length), then the alphabet is halved by a bit
  of a hash of the symbol and each left-right pair becomes one symbol.  Symbols
  are numbered exactly (equal number = equal parts), so equal symbols spell
  equal words.  Of each round the symbols before block compression are kept,
  with the rest of their block to both sides.
* **Extensions.**  How far the words from two places agree is found by jumps:
  equal symbols at both places are passed at once, the rest of a block of
  them too; after a jump a round higher is tried, after a mismatch a round lower.
  All candidates of a slice go together; a query needs some jumps a round.
* **Harmonic grid.**  A run of period q holds ``g = max(q, shortest - q)`` words
  in a row that equal the word q after them, so it holds one at a multiple of g:
  the sum of n / g over all q is O(n log n) candidates.  Where the words at
  such a place and next to it on one side do not agree there is no run of q;
  only the others are extended, in both directions.  Of several periods of one
  maximal stretch the smallest is its period (Fine and Wilf).

Texts without candidates need no grammar.  Work grows as n log n words, memory
with the words of a slice (2 MiB of text, or one longer text).

Defined results: null text counts as no words and stays null in ``collapsed``;
an empty text or table has no runs; repeated rows and rows of equal or null ids
are texts of their own; other columns pass through, and of the same names as the
added ones (``n_words``, ``runs``, ``collapsed``) are replaced.  Words are named
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import prepare
from textmill.llm.words import NOT_SPACE, U64, Words, mix, ragged, slices, split_words

SHORTEST = 12
GRID = 1 << 20  # candidates looked at together
ROUNDS = 64     # a bound only: rounds end when nothing is left to compress


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """A number from 0 for each (a, b), equal for equal pairs; the place of
    one of each; how many."""
    _, first, number = np.unique((a.astype(np.int64) << 32) | b.astype(np.int64), return_index=True, return_inverse=True)
    return number.astype(np.int32), first, len(first)


def _block_rest(name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of maximal blocks of one symbol; symbols to each one's block end,
    and from its block start, itself included."""
    first = np.ones(len(name), dtype=bool)
    first[1:] = name[1:] != name[:-1]
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(name)))
    back = ragged(size).astype(np.int32) + 1
    return at, np.repeat(size, size).astype(np.int32) - back + 1, back


class Grammar:
    """Run-length grammar of one sequence of symbols ``name`` (int32).  The
    first and the last symbol must occur nowhere else."""

    def __init__(self, name: np.ndarray) -> None:
        n = len(name)
        spelled = [np.ones(int(name.max()) + 1, dtype=np.int64)]  # words of each symbol
        symbols = len(spelled[0])
        place = np.arange(n, dtype=np.int64)
        self.top = np.zeros(n, dtype=np.int32)  # highest round with a symbol beginning here
        rounds = []
        for level in range(ROUNDS):
            at, ahead, back = _block_rest(name)
            rounds.append((place, name, ahead, back))
            self.top[place] = level
            width = np.concatenate(spelled)
            spelled = [width]
            # blocks
            size = back[np.append(at[1:], len(name)) - 1]
            new, place, long = name[at], place[at], size > 1
            if long.any():
                number, one, k = _numbered(new[long], size[long])
                spelled.append(width[new[long][one]] * size[long][one])
                new = new.copy()
                new[long] = symbols + number
                symbols += k
            # pairs
            right = (mix(new.astype(U64) + U64((level + 1) * 0x9FB21C651E98DF25 % (1 << 64))) >> U64(63)).astype(bool)
            pair = np.flatnonzero(~right[:-1] & right[1:])
            if len(pair):
                width = np.concatenate(spelled)
                spelled = [width]
                number, one, k = _numbered(new[pair], new[pair + 1])
                spelled.append(width[new[pair][one]] + width[new[pair + 1][one]])
                new = new.copy()
                new[pair] = symbols + number
                symbols += k
                keep = np.ones(len(new), dtype=bool)
                keep[pair + 1] = False
                new, place = new[keep], place[keep]
            name = new
            if len(name) <= 3:
                break
        self.width = np.concatenate(spelled)
        # the symbols of all rounds that begin at one place, in order of rounds
        self.base = np.concatenate([[0], np.cumsum(self.top[:-1] + 1, dtype=np.int64)])
        index = np.empty(int(self.top.sum(dtype=np.int64)) + n, dtype=np.int32)
        total = 0
        for level, (place, *_) in enumerate(rounds):
            index[self.base[place] + level] = np.arange(total, total + len(place), dtype=np.int32)
            total += len(place)
        self.index = index
        self.name, self.ahead, self.back = (np.concatenate([r[k] for r in rounds]) for k in (1, 2, 3))

    def _agree(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        out = np.zeros(len(i), dtype=np.int64)
        live = np.arange(len(i))
        i, j = i.copy(), j.copy()
        level = np.minimum(self.top[i], self.top[j])
        while len(live):
            a, b = self.index[self.base[i] + level], self.index[self.base[j] + level]
            if not forward:  # the symbol that ends here is the one before
                a, b = a - 1, b - 1
            rest = self.ahead if forward else self.back
            same = self.name[a] == self.name[b]
            step = np.where(same, np.minimum(rest[a], rest[b]) * self.width[self.name[a]], 0)
            out[live] += step
            if not forward:
                step = -step
            i, j = i + step, j + step
            level = np.where(same, np.minimum(level + 1, np.minimum(self.top[i], self.top[j])), level - 1)
            on = level >= 0
            live, i, j, level = live[on], i[on], j[on], level[on]
        return out

    def ahead_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of symbols that agree from i and from j (i < j) on."""
        return self._agree(i, j, True)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of symbols that agree backwards before i and before j."""
        return self._agree(i, j, False)


def _candidates(name: np.ndarray, lo: np.ndarray, hi: np.ndarray, shortest: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, period, period's grid step) of grid places at which the words
    agree with those a period later, for texts name[lo:hi]; ``name`` has a
    symbol of its own before each text and at its end."""
    periods = (hi - lo) // 2
    lo, hi, periods = (x[hi - lo >= shortest] for x in (lo, hi, periods))
    text = np.repeat(np.arange(len(lo)), periods)
    q = ragged(periods) + 1
    step = np.maximum(q, shortest - q)
    n = (hi[text] - lo[text] - q - 1) // step + 1  # grid places with a word q later
    upto = np.cumsum(n)
    at = 0
    while at < len(q):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + GRID, side="right")))
        own = np.repeat(np.arange(at, to), n[at:to])
        i = lo[text[own]] + ragged(n[at:to]) * step[own]
        j = i + q[own]
        hit = np.flatnonzero(name[i] == name[j])
        i, j, own = i[hit], j[hit], own[hit]
        # of g places in a row around this one, half of the others lie on one side
        for d in (1, 2):
            wide = (step[own] - 1) // 2 >= d
            by = np.where(wide, d, 0)
            ahead = name[i + by] == name[np.minimum(j + by, len(name) - 1)]
            back = name[i - by] == name[j - by]
            if d == 1:
                right, left = ahead, back
            else:
                keep = (right & ahead) | (left & back)
        i, own = i[keep], own[keep]
        yield i, q[own], step[own]
        at = to


def runs(words: Words, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs, by row, start and period;
    starts count the words of the row from 0."""
    rows = len(words.row_first) - 1
    n = np.diff(words.row_first)
    _, number = np.unique(words.hashes(), return_inverse=True)
    # text r lies at lo[r]:hi[r], a symbol of its own before it and after the last
    lo = words.row_first[:-1] + np.arange(rows) + 1
    hi = lo + n
    name = np.empty(len(words) + rows + 1, dtype=np.int32)
    kinds = int(number.max()) + 1 if len(number) else 0
    name[np.append(lo - 1, len(name) - 1)] = kinds + np.arange(rows + 1)
    name[np.arange(len(words)) + words.row + 1] = number
    found = [np.empty((0, 4), dtype=np.int64)]
    grammar, first, held, more = None, [], 0, _candidates(name, lo, hi, shortest)
    for part in more:  # texts without candidates stay out of the grammar, if they are known in time
        first.append(part)
        held += len(part[0])
        if held > GRID:
            break
    keep = np.ones(rows, dtype=bool)
    if held <= GRID:
        keep[:] = False
        for i, _, _ in first:
            keep[np.searchsorted(lo, i, side="right") - 1] = True
    for i, q, step in chain(first, more):
        if not len(i):
            continue
        if grammar is None:
            size = (n + 1)[keep]
            grammar = Grammar(np.append(name[np.repeat(lo[keep] - 1, size) + ragged(size)], kinds + rows))
            shift = np.zeros(rows, dtype=np.int64)
            shift[keep] = np.cumsum(size) - size - (lo[keep] - 1)
        row = np.searchsorted(lo, i, side="right") - 1
        a = i + shift[row]
        back, ahead = grammar.before(a, a + q), grammar.ahead_of(a, a + q)
        ok = back + ahead >= step
        row, start, end = row[ok], (i - back)[ok], (i + q + ahead)[ok]
        found.append(_smallest(np.column_stack([row, start - lo[row], end - start, q[ok]])))
        if len(found) > 16:
            found = [_smallest(np.concatenate(found))]
    out = _smallest(np.concatenate(found))
    out = out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]
    return out[:, 0], out[:, 1], out[:, 2], out[:, 3]


def _smallest(found: np.ndarray) -> np.ndarray:
    """One row for each (row, start, length): its smallest period."""
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    return found[first]


def _marked(shortest: int, at: int, kept_columns: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(at)):
                w = split_words(data, offs, NOT_SPACE)
                row, start, length, period = runs(w, shortest)
                rows = hi - lo
                count = np.bincount(row, minlength=rows)
                edges = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                listed = pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"]))
                change = np.zeros(len(w) + 1, dtype=np.int64)  # words after a run's first period go
                first = w.row_first[row] + start
                np.add.at(change, first + period, 1)
                np.add.at(change, first + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                some = np.zeros(rows, dtype=bool)
                some[row] = True
                kept, raw = [], data.tobytes()
                texts = batch.column(at).slice(lo, rows)
                null = texts.is_null().to_numpy(zero_copy_only=False)
                for r in range(rows):
                    a, b = w.row_first[r], w.row_first[r + 1]
                    s, e = w.start[a:b], w.end[a:b]
                    if some[r]:
                        s, e = s[~gone[a:b]], e[~gone[a:b]]
                    kept.append(None if null[r] else b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist())]).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, rows) for c in kept_columns], pa.array(np.diff(w.row_first), pa.int64()),
                     listed.cast(kind), pa.array(kept, pa.string())],
                    names=[*[batch.schema.names[c] for c in kept_columns], "n_words", "runs", "collapsed"])
    return run


def mark_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with n_words (long), runs (array of start, length, period, by
    start and period) and collapsed: the words left when each run keeps its
    first period only, joined by one space."""
    prepare(docs.sparkSession)
    kept = [i for i, c in enumerate(docs.columns) if c not in ("n_words", "runs", "collapsed")]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in (docs.schema.fields[i] for i in kept)]
    added = ["n_words long", "runs array<struct<start:long,length:long,period:long>>", "collapsed string"]
    return docs.mapInArrow(_marked(shortest, docs.columns.index(text), kept), ", ".join(schema + added))


def longest(runs_column: str = "runs"):
    """The run of greatest length (then smallest start, then period) or null."""
    best = F.array_max(F.transform(runs_column, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    return F.when(best.isNotNull(), F.struct((-best["back"]).alias("start"), best["length"].alias("length"),
                                             (-best["small"]).alias("period")))
