"""Substring dedup by recompression: words covered by a repeated window go.

Each text is a string of word names.  A round replaces maximal runs of one
symbol by a symbol for (symbol, length), then splits the alphabet into left
and right symbols by one bit of a hash of (symbol, round) and replaces every
left-right pair by a symbol for the pair.  A new name is a 64-bit hash of
(round, parts), so all tasks give the same parts the same name: the naming is
global without a dictionary.  Equal substrings get equal symbols except near
their ends.  How near is known exactly: every symbol carries its *context*, the
span of words that decided it; two texts that agree on that span have the same
symbol there.

A window (``window`` consecutive words) that holds the whole context of a
symbol therefore shares that symbol with every equal window.  So:

1. every distinct text is parsed; of the last round's symbols whose context it
   holds, each window elects the one of the smallest name (equal windows elect
   equal symbols).  The windows that elect one symbol are consecutive; the words
   they cover are the symbol's *block*;
2. symbols, named by the words of their contexts, and blocks are counted over
   all texts.  A window whose symbol occurs once is not repeated; if a block occurs again, all its windows are repeated;
   only where one symbol has several different blocks are single windows
   compared, once for each different block (also windows that hold no symbol,
   as in long runs of one word, so no window is lost);
3. windows named more than once, by 96 bits of all their words, are repeated.
   Words that repeated windows cover are removed.

Exact copies are collapsed to one row per distinct text first: all windows of
a text that occurs twice are repeated.  Equal symbols, blocks and windows of one
batch are combined before each shuffle, so that even a passage of every text
arrives as one row a batch; no group is gathered but the places in one text.

Defined results: null text has no words and stays null; a text without
removed words stays as it was, byte for byte, otherwise it becomes its kept
words joined by one space; an empty text or table changes nothing; repeated
rows and rows with equal or null ids count as texts of their own; columns
keep their names, added ones replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.store import prepare
from textmill.llm.words import NOT_SPACE, U64, Words, mix, slices, span_names, split_words

WINDOW = 50
ROUNDS = 4
FAR = 1 << 40  # beyond any text


class Symbols:
    """Symbols of consecutive texts: name, text, context [lo, hi) in words."""

    def __init__(self, name: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.name, self.row, self.lo, self.hi = name, row, lo, hi

    def name_runs(self, level: int) -> Symbols:
        """Maximal runs of one symbol become one; to know that it ends, a run
        needs its neighbours."""
        n = len(self.name)
        if n == 0:
            return self
        first = np.ones(n, dtype=bool)
        first[1:] = (self.name[1:] != self.name[:-1]) | (self.row[1:] != self.row[:-1])
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, n))
        name, row = self.name[at], self.row[at]
        long = length > 1
        name[long] = mix(name[long] * U64(0x9FB21C651E98DF25) + length[long].astype(U64) * U64(0xC2B2AE3D27D4EB4F)
                         + U64(2 * level + 1))
        lo, hi = np.minimum.reduceat(self.lo, at), np.maximum.reduceat(self.hi, at)
        return Symbols(name, row, *_with_neighbours(row, lo, hi, np.ones(len(at), bool), np.ones(len(at), bool)))

    def name_pairs(self, level: int) -> Symbols:
        """Left symbols followed by right symbols become one.  A pair is
        decided by its two parts; a left symbol that stays needs its right
        neighbour, a right symbol that stays its left one."""
        n = len(self.name)
        if n == 0:
            return self
        right = (mix(self.name + U64(0x632BE59BD9B4E019 * (level + 1) % (1 << 64))) >> U64(63)).astype(bool)
        pair = np.zeros(n, dtype=bool)  # a pair starts here
        pair[:-1] = ~right[:-1] & right[1:] & (self.row[1:] == self.row[:-1])
        second = np.zeros(n, dtype=bool)
        second[1:] = pair[:-1]
        lo, hi = _with_neighbours(self.row, self.lo, self.hi, right & ~second, ~right & ~pair)
        at = np.flatnonzero(pair)
        lo[at] = np.minimum(self.lo[at], self.lo[at + 1])
        hi[at] = np.maximum(self.hi[at], self.hi[at + 1])
        name = self.name.copy()
        name[at] = mix(name[at] * U64(0x8CB92BA72F3D8DD7) + name[at + 1] * U64(0xD1B54A32D192ED03) + U64(2 * level + 2))
        keep = ~second
        return Symbols(name[keep], self.row[keep], lo[keep], hi[keep])


def _with_neighbours(row, lo, hi, left: np.ndarray, right: np.ndarray):
    """Contexts widened to those of the neighbours asked for; where a text
    begins or ends there is none, and no window can decide the symbol."""
    before, after = np.full(len(row), -FAR), np.full(len(row), FAR)
    same = row[1:] == row[:-1]
    before[1:] = np.where(same, lo[:-1], -FAR)
    after[:-1] = np.where(same, hi[1:], FAR)
    return np.where(left, np.minimum(lo, before), lo), np.where(right, np.maximum(hi, after), hi)


def parse(words: Words, rounds: int = ROUNDS) -> Symbols:
    """Symbols after ``rounds`` rounds over each row of ``words``."""
    at = np.arange(len(words), dtype=np.int64)
    s = Symbols(words.hashes(), words.row, at, at + 1)
    for level in range(rounds):
        s = s.name_runs(level).name_pairs(level)
    return s


def elect(symbols: Symbols, words: Words, window: int) -> tuple[np.ndarray, np.ndarray, Symbols]:
    """(first words of all windows, elected symbol or -1 of each, the usable
    symbols that these number)."""
    usable = (symbols.hi - symbols.lo <= window).nonzero()[0]
    name, lo, hi = symbols.name[usable], symbols.lo[usable], symbols.hi[usable]
    last = np.repeat(words.row_first[1:], np.diff(words.row_first))
    p = np.flatnonzero(np.arange(len(words)) + window <= last)
    # contexts begin and end in the order of their symbols, so a window's symbols are a range
    a = np.searchsorted(lo, p)
    count = np.searchsorted(hi, p + window, side="right") - a
    chosen = np.full(len(p), -1, dtype=np.int64)
    best, width = np.arange(len(name)), 1  # best[i]: smallest of name[i : i + width], leftmost if equal
    while len(best) and (todo := (count >= width)).any():
        now = todo & (count < 2 * width)
        i, j = best[a[now]], best[a[now] + count[now] - width]
        chosen[now] = np.where(name[j] < name[i], j, i)
        if len(best) <= width:
            break
        best = np.where(name[best[width:]] < name[best[:-width]], best[width:], best[:-width])
        width *= 2
    return p, chosen, Symbols(name, symbols.row[usable], lo, hi)


def blocks(p: np.ndarray, chosen: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elected symbols in order, first word and end of each one's block)."""
    if not len(chosen):
        return chosen, p, p
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], len(chosen)) - 1
    ok = chosen[first] >= 0
    return chosen[first[ok]], p[first[ok]], p[last[ok]] + window


def _parsed(batch: pa.RecordBatch, window: int, rounds: int):
    """Per slice: first row, end row, words, windows, elected symbols, usable
    symbols, first usable symbol of each text."""
    for lo, hi, data, offs in slices(batch.column(2)):
        words = split_words(data, offs, NOT_SPACE)
        p, chosen, s = elect(parse(words, rounds), words, window)
        yield lo, hi, words, p, chosen, s, np.searchsorted(s.row, np.arange(hi - lo))


def _upper(x: np.ndarray) -> np.ndarray:
    return (x >> U64(32)).astype(np.uint32).view(np.int32)


def _symbols(window: int, rounds: int):
    """A row per elected symbol: its name, its block's (128 bits together), the
    text and its ordinal there.  Further equal blocks of the batch are marked as found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for lo, _, words, p, chosen, s, begin in _parsed(batch, window, rounds):
                got, first, end = blocks(p, chosen, window)
                h, row = words.hashes(), s.row[got]
                parts.append((span_names(h, s.lo[got], s.hi[got], 0), span_names(h, first, end, 1),
                              k1[row + lo], k2[row + lo], (got - begin[row]).astype(np.int32)))
            if not parts:
                continue
            name, block, t1, t2, at = (np.concatenate(c) for c in zip(*parts))
            group, n = _groups(name, block)
            found = np.ones(len(name), dtype=bool)
            found[group] = False
            copies = np.zeros(len(name), dtype=np.int32)
            copies[group] = n
            name = np.where(found, mix(t1.view(np.uint64) + at.astype(U64)), name)  # dealt anywhere
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(block.view(np.int64)), pa.array(t1), pa.array(t2), pa.array(at),
                 pa.array(copies)], names=["name", "block", "k1", "k2", "at", "n"])
    return run


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of each distinct key, number of its rows)."""
    if not len(keys[0]):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


#: of a symbol's block: repeated; repeated and compared window by window; only compared
FOUND, SHOWN, ASKED = 1, 2, 3
#: of a row of windows: asked about; only shown to others; known to be repeated
ASK, SHOW, KNOWN = 0, 1, 2


def _windows(window: int, rounds: int):
    """Windows to compare (96-bit name, text, first word) and known ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            marks, asked, known = batch.column(3), [], []
            for lo, hi, words, p, chosen, s, begin in _parsed(batch, window, rounds):
                part = marks.slice(lo, hi - lo)
                status = np.zeros(len(s.name) + 1, dtype=np.int8)
                status[-1] = ASKED  # windows without a symbol
                sizes = part.value_lengths().fill_null(0).to_numpy()
                if sizes.sum():
                    packed = part.flatten().to_numpy()
                    status[np.repeat(begin, sizes) + packed // 4] = packed % 4
                first_word, row = words.row_first, words.row
                of = status[chosen]
                h = words.hashes()
                at = p[of >= SHOWN]
                asked.append((span_names(h, at, at + window, 0), _upper(span_names(h, at, at + window, 1)), row[at] + lo,
                              at - first_word[row[at]], np.where(of[of >= SHOWN] == SHOWN, SHOW, ASK)))
                got, first, end = blocks(p, chosen, window)
                ok = (status[got] == FOUND) | (status[got] == SHOWN)
                first, end = first[ok], end[ok]
                known.append((row[first] + lo, first - first_word[row[first]], end - first - window + 1))
            if not asked:
                continue
            w1, w2, r, at, kind = (np.concatenate(c) for c in zip(*asked))
            group, n = _groups(w1, w2)
            twice = np.zeros(len(w1), dtype=np.int64)  # rows of the batch that share the name
            order = np.lexsort((w2, w1))
            twice[order] = np.repeat(n, n)
            sure = (twice > 1) & (kind == ASK)
            kr, ka, kn = (np.concatenate(c) for c in zip(*known))
            sr, sa, sn = _ranges(r[sure], at[sure])
            kr, ka, kn = np.concatenate([kr, sr]), np.concatenate([ka, sa]), np.concatenate([kn, sn])
            kind = np.where(twice > 1, SHOW, kind)[group]
            rows = np.concatenate([r[group], kr])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([w1[group], mix(k1[kr].view(np.uint64) + ka.astype(U64))]).view(np.int64)),
                 pa.array(np.concatenate([w2[group], np.zeros(len(kr), dtype=np.int32)])), pa.array(k1[rows]),
                 pa.array(k2[rows]), pa.array(np.concatenate([at[group], ka]).astype(np.int32)),
                 pa.array(np.concatenate([np.ones(len(group)), kn]).astype(np.int32)),
                 pa.array(np.concatenate([kind, np.full(len(kr), KNOWN)]).astype(np.int32))],
                names=["w1", "w2", "k1", "k2", "at", "n", "kind"])
    return run


def _ranges(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of a row as (row, first, number)."""
    if not len(row):
        return row, at, at
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)))
    return row[first], at[first], np.diff(np.append(first, len(row)))


def _cut(window: int, keep_layout: bool):
    """Texts without the words that windows at the listed places cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated, copies = batch.column(3), batch.column(4).to_numpy()
            for lo, hi, data, offs in slices(batch.column(2)):
                words = split_words(data, offs, NOT_SPACE)
                n, rows = len(words), hi - lo
                per_row = np.diff(words.row_first)
                part = repeated.slice(lo, rows)
                sizes = part.value_lengths().fill_null(0).to_numpy()
                edge = np.zeros(n + 1, dtype=np.int64)
                if sizes.sum():
                    packed = part.flatten().to_numpy()
                    at = np.repeat(words.row_first[:-1], sizes) + (packed >> 32)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + (packed & 0xFFFFFFFF) - 1 + window, -1)
                gone = np.cumsum(edge)[:n] > 0
                row = words.row
                gone |= ((copies[lo:hi] > 1) & (per_row >= window))[row]
                removed = np.bincount(row[gone], minlength=rows)
                text = _joined(words, offs, ~gone, np.zeros(rows, bool) if not keep_layout else removed == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), batch.column(1).slice(lo, rows), pa.array(per_row.astype(np.int64)),
                     pa.array(removed.astype(np.int64)), text], names=["k1", "k2", "n_words", "n_removed", "kept"])
    return run


def _joined(words: Words, offs: np.ndarray, keep: np.ndarray, whole: np.ndarray) -> pa.Array:
    """Per row its kept words joined by one space, or the row as it was."""
    data = words.data.copy()
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[words.start[keep]] += 1
    edge[words.end[keep]] -= 1
    take = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    row = words.row[keep]
    gap = words.end[keep][:-1][row[1:] == row[:-1]]  # a kept word follows in the row: a separator stands here
    for r in np.flatnonzero(whole):
        take[offs[r]: offs[r + 1]] = True
    gap = gap[~take[gap]]
    data[gap], take[gap] = 0x20, True
    ends = np.concatenate([[0], np.cumsum(take)])[offs].astype(np.int32)
    return pa.StringArray.from_buffers(len(offs) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[take].tobytes()))


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, rounds: int = ROUNDS,
                   keep_layout: bool = True) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text`` and columns n_words,
    n_removed.  ``keep_layout=False`` also joins the words of untouched texts
    by one space."""
    prepare(docs.sparkSession)
    key = [F.xxhash64(F.col(text)).alias("k1"), F.hash(F.col(text)).alias("k2")]
    rest = [c for c in docs.columns if c not in (text, "n_words", "n_removed")]
    texts = (docs.where(F.col(text).isNotNull()).select(*key, F.col(text).alias("t"))
             .groupBy("k1", "k2").agg(F.any_value("t").alias("t"), F.count("*").alias("copies")))
    # every use takes all columns, so that one exchange of the texts serves them all
    symbols = texts.mapInArrow(_symbols(window, rounds), "name long, block long, k1 long, k2 int, at int, n int")
    dealt = symbols.repartition("name")
    found = F.col("n") == 0  # an equal block of its batch stands for it
    same = Window.partitionBy("name", found, "block")
    ordered = same.orderBy("k1", "k2", "at")
    counted = (dealt.withColumn("lead", F.row_number().over(ordered) == 1).withColumn("of_block", F.sum("n").over(same))
               .withColumn("different", F.sum(F.col("lead").cast("long")).over(Window.partitionBy("name", found))))
    status = (F.when(found, FOUND).when(F.col("different") == 1, F.when(F.col("of_block") > 1, FOUND))
              .when(F.col("of_block") == 1, ASKED).when(F.col("lead"), SHOWN).otherwise(FOUND))
    marks = (counted.select("k1", "k2", (F.col("at").cast("long") * 4 + status).alias("mark")).where("mark IS NOT NULL")
             .groupBy("k1", "k2").agg(F.collect_list("mark").alias("marks")))

    windows = texts.join(marks, ["k1", "k2"], "left").select("k1", "k2", "t", "marks", "copies").mapInArrow(
        _windows(window, rounds), "w1 long, w2 int, k1 long, k2 int, at int, n int, kind int")
    known = F.col("kind") == KNOWN
    shared = F.count("*").over(Window.partitionBy("w1", "w2", known))
    hits = (windows.repartition("w1").withColumn("shared", shared)
            .where(known | ((F.col("kind") == ASK) & (F.col("shared") > 1)))
            .select("k1", "k2", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("n").cast("long")).alias("hit"))
            .groupBy("k1", "k2").agg(F.collect_list("hit").alias("hits")))

    cut = texts.join(hits, ["k1", "k2"], "left").select("k1", "k2", "t", "hits", "copies").mapInArrow(
        _cut(window, keep_layout), "k1 long, k2 int, n_words long, n_removed long, kept string")
    ids = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], *key,
                      F.col(text).isNull().alias("none"))
    out = ids.join(cut, ["k1", "k2"], "left").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.when(~F.col("none"), F.col("kept")).alias(text),
        F.when(F.col("none"), 0).otherwise(F.col("n_words")).cast("long").alias("n_words"),
        F.when(F.col("none"), 0).otherwise(F.col("n_removed")).cast("long").alias("n_removed"))
    return out.select(*[f"`{c}`" for c in docs.columns if c not in ("n_words", "n_removed")], "n_words", "n_removed")
