"""Spelling variant grouping: generated edits, Bloom filters, an exact join.

Words (distinct, with counts) are near if they differ by exactly one inserted,
deleted or replaced code point.

1. **Counting.**  Runs of letters of whole texts are counted batch by batch in
   numpy, then summed by Spark: a word of every document arrives as one row a
   batch.
2. **Filters.**  The vocabulary is sharded by word length.  Each length has a
   blocked Bloom filter: a word sets ``BITS`` bits of one 64-bit block.  Spark
   combines the words of a block by bitwise or; a filter holds about
   ``WORD_BITS`` bits a word.  Filters of one pass together have at most
   ``filter_bytes`` (the broadcast's bound); lengths that do not fit go into
   further passes over the vocabulary, and a length that is larger alone gets
   a filter of the whole bound, with more false positives and the same result.
3. **Neighbourhoods.**  Each word probes its deletions in the filter of the
   length below, and its replacements by later letters in that of its own.
   Every near pair is met once: an insertion is the longer word's deletion.
   An edit's name is a polynomial hash, taken from the word's own in O(1).
4. **Exact join.**  Positives, as (name of the word, name of the edit), are
   joined to the vocabulary by both names; pairs that are not one edit apart
   go.  So false positives and equal names cost work but change nothing.

A word's form is the near word of greatest count (ties: the smallest) if that
count is at least twice its own; the root follows forms to the last.  Counts
double along forms, so pointer jumping ends after a few rounds, whatever the
chains; each round is written to the shared folder.

A hot word is one row after the batches' counting; a word has at most some
180 near words a letter.  Work grows with the letters of the vocabulary times
the alphabet.

Defined results: null and empty texts have no words; null ids count as empty;
repeated rows count again; an empty table gives no words; other columns are
ignored.  Long words take part whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import prepare, written
from textmill.llm.words import LOWER, U64, Words, mix, ragged, slices, split_words

MIN_LENGTH = 5
MIN_COUNT = 3
DROP_EVERY = 97
FILTER_BYTES = 16 << 20
WORD_BITS = 24
BITS = 5
PROBES = 1 << 18  # edits looked at together
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: code points of lower-cased words in ascending order: A-Z do not occur
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.int64)
_VALUE = mix((LETTERS + 1).astype(U64) * U64(0xD6E8FEB86659FD93))


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offs: np.ndarray) -> Words:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z."""
    low = LOWER[data]
    two = low == 0xC3  # the first of two bytes of U+00C0 to U+00FF
    inside = ((low >= 0x61) & (low <= 0x7A)) | two
    inside[1:] |= two[:-1]
    marks = np.where(inside, np.uint8(0x61), np.uint8(0x20))  # a table of single bytes cannot tell them
    table = np.zeros(256, dtype=bool)
    table[0x61] = True
    w = split_words(marks, offs, table)
    return Words(low, w.start, w.end, w.row_first)


def _crcs(w: Words, prefixes: list[bytes]) -> np.ndarray:
    """Unsigned crc32 of each word after its row's prefix."""
    state = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)[w.row] ^ np.uint32(0xFFFFFFFF)
    size = w.end - w.start
    order = np.argsort(-size, kind="stable")
    state, at, left = state[order], w.start[order], size[order]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))  # words longer than k bytes
        state[:n] = _CRC[(state[:n] ^ w.data[at[:n] + k]) & 0xFF] ^ (state[:n] >> 8)
    out = np.empty(len(state), dtype=np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _code_points(w: Words) -> np.ndarray:
    seconds = np.concatenate([[0], np.cumsum(w.data == 0xC3)])
    return (w.end - w.start) - (seconds[w.end] - seconds[w.start])


def _counted(min_length: int, drop_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, offs in slices(batch.column(1)):
                w = letter_runs(data, offs)
                length = _code_points(w)
                raw, counts = w.data.tobytes(), {}
                plain = np.ones(len(w), dtype=bool)
                if drop_every:
                    crc = _crcs(w, [("" if i is None else str(i)).encode() + b":" for i in ids[lo:hi]])
                    plain = crc % np.uint32(drop_every) != 0
                    for i in np.flatnonzero(~plain & (length > min_length)).tolist():
                        word = raw[w.start[i]: w.end[i]].decode("utf-8")
                        at = int(crc[i]) % len(word)
                        word = word[:at] + word[at + 1:]
                        counts[word] = counts.get(word, 0) + 1
                take = np.flatnonzero(plain & (length >= min_length))
                some = Words(w.data, w.start[take], w.end[take], np.array([0, len(take)]))
                _, first, n = np.unique(some.hashes(), return_index=True, return_counts=True)
                words = [raw[s:e].decode("utf-8") for s, e in zip(some.start[first].tolist(), some.end[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words + list(counts), pa.string()), pa.array([*n.tolist(), *counts.values()], pa.int64())],
                    names=["word", "n"])
    return run


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n): lower-cased runs of letters of at least ``min_length`` code
    points and ``min_count`` occurrences.  Of a run in a document whose crc32(id:run)
    is divisible by ``drop_every`` (0: none), one code point is left out first."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("t")).where("t IS NOT NULL")
    counted = rows.mapInArrow(_counted(min_length, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- names, filters ---------------------------------------------------------------------

def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, letters as places in LETTERS, name) of words of equal length,
    of at most about ``PROBES`` edits each."""
    words = words.to_pylist()
    length = np.array([len(x) for x in words], dtype=np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    start = np.concatenate([[0], np.cumsum(length)])
    powers = _powers(int(length.max(initial=0)))
    for n in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == n)
        for at in range(0, len(rows), max(1, PROBES // (n * len(LETTERS)))):
            some = rows[at: at + max(1, PROBES // (n * len(LETTERS)))]
            code = np.searchsorted(LETTERS, points[start[some][:, None] + np.arange(n)])
            yield some, code, (_VALUE[code] * powers[:n]).sum(axis=1, dtype=U64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _finished(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + U64(length * 0xA0761D6478BD642F % (1 << 64)))


def _bits(name: np.ndarray) -> np.ndarray:
    """The bits of a name in its block."""
    out = np.zeros(name.shape, dtype=U64)
    for k in range(BITS):
        out |= U64(1) << ((name >> U64(6 * k)) & U64(63))
    return out


def _block(name: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    return ((name >> U64(32)) * np.asarray(blocks, dtype=U64)) >> U64(32)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) with the word's length and name."""
    for batch in batches:
        length, name = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows, dtype=U64)
        for rows, code, total in _by_length(batch.column(0)):
            length[rows], name[rows] = code.shape[1], _finished(total, code.shape[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length), pa.array(name.view(np.int64))],
                                         names=["word", "n", "length", "name"])


def _set_bits(blocks: dict[int, int], first: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, name = (batch.column(k).to_numpy() for k in (0, 1))
            name = name.view(U64)
            own = np.array([blocks[x] for x in length.tolist()], dtype=U64)
            at = _block(name, own).astype(np.int64) + np.array([first[x] for x in length.tolist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(_bits(name).view(np.int64))], names=["block", "bits"])
    return run


def passes(counts: dict[int, int], filter_bytes: int) -> list[dict[int, int]]:
    """Blocks of each word length, in passes of at most ``filter_bytes``."""
    most, out, used = max(1, filter_bytes // 8), [], 0
    for length in sorted(counts):
        blocks = min(most, max(1, -(-counts[length] * WORD_BITS // 64)))
        if not out or used + blocks > most:
            out.append({})
            used = 0
        out[-1][length] = blocks
        used += blocks
    return out


def _probe(filters, blocks: dict[int, int], first: dict[int, int]):
    """Edits of words that the filters hold: (word's name, edit's name)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filters.value

        def held(name: np.ndarray, length: int) -> np.ndarray:
            want = _bits(name)
            return (bits[first[length] + _block(name, blocks[length]).astype(np.int64)] & want) == want

        for batch in batches:
            whole = batch.column(1).to_numpy().view(U64)
            sources, edits = [], []
            for rows, code, total in _by_length(batch.column(0)):
                n = code.shape[1]
                powers = _powers(n)
                if n - 1 in blocks:
                    terms = _VALUE[code] * powers[:n]
                    upto = np.cumsum(terms, axis=1, dtype=U64)
                    name = _finished((upto - terms) + (total[:, None] - upto) * U64(INVERSE), n - 1)
                    fresh = np.ones(code.shape, dtype=bool)  # of equal letters in a row one
                    fresh[:, 1:] = code[:, 1:] != code[:, :-1]
                    i, k = np.nonzero(fresh & held(name, n - 1))
                    sources.append(whole[rows[i]])
                    edits.append(name[i, k])
                if n in blocks:
                    part = max(1, PROBES // (len(rows) * len(LETTERS)))  # of a very long word not all places at once
                    for at in range(0, n, part):
                        old = code[:, at: at + part]
                        change = (_VALUE[None, None, :] - _VALUE[old][:, :, None]) * powers[at: at + old.shape[1]][None, :, None]
                        name = _finished(total[:, None, None] + change, n)
                        i, k, c = np.nonzero((np.arange(len(LETTERS)) > old[:, :, None]) & held(name, n))
                        sources.append(whole[rows[i]])
                        edits.append(name[i, k, c])
            if sources:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (sources, edits)], names=["source", "edit"])
    return run


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, n_a, b, n_b) of all near words of ``words`` (word, n; distinct, of the
    letters of LETTERS), each pair once."""
    spark = words.sparkSession
    prepare(spark)
    named = written(words.select("word", "n").mapInArrow(_named, "word string, n long, length int, name long"), "spelling-words")
    counts = {r.length: r.k for r in named.groupBy("length").agg(F.count("*").alias("k")).collect()}  # a row a length
    positives = []
    for blocks in passes(counts, filter_bytes):
        lengths, first, at = list(blocks), {}, 0
        for x in lengths:
            first[x], at = at, at + blocks[x]
        own = named.where(F.col("length").isin(lengths)).select("length", "name")
        set_ = own.mapInArrow(_set_bits(blocks, first), "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
        rows = set_.toArrow()  # at most a row a block, so twice filter_bytes
        bits = np.zeros(at, dtype=U64)
        bits[rows.column("block").to_numpy()] = rows.column("bits").to_numpy().view(U64)
        del rows
        filters = spark.sparkContext.broadcast(bits)
        probing = named.where(F.col("length").isin(sorted({y for x in lengths for y in (x, x + 1)}))).select("word", "name")
        positives.append(written(probing.mapInArrow(_probe(filters, blocks, first), "source long, edit long"), "spelling-edits"))
        filters.destroy()
    if not positives:
        return named.limit(0).select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    edits = positives[0]
    for more in positives[1:]:
        edits = edits.unionByName(more)
    left = named.select(F.col("name").alias("source"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = named.select(F.col("name").alias("edit"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = edits.join(right, "edit").join(left, "source").where((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    # words of equal names may meet in both orders
    one, other = F.struct(F.col("a").alias("w"), F.col("n_a").alias("n")), F.struct(F.col("b").alias("w"), F.col("n_b").alias("n"))
    return near.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y")).distinct().select(
        F.col("x.w").alias("a"), F.col("x.n").alias("n_a"), F.col("y.w").alias("b"), F.col("y.n").alias("n_b"))


def variants(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word of ``words`` (word, n): word, n, n_near, form, form_n, root."""
    words = written(words.select("word", "n"), "spelling-vocabulary")
    pairs = near_pairs(words, filter_bytes)
    both = pairs.select(F.col("a").alias("word"), "n_a", F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word")).alias("other")).union(
        pairs.select(F.col("b"), F.col("n_b"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("word"))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    grown = -F.col("best.less") >= 2 * F.col("n")
    out = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(grown, F.col("best.word")).alias("form"),
        F.when(grown, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # (word, at): where the word's forms have been followed to; ``at`` jumps to where it has got itself
    now = out.where("form IS NOT NULL").select("word", F.col("form").alias("at"))
    while True:
        met = written(now.join(now.select(F.col("word").alias("at"), F.col("at").alias("next")), "at", "left"), "spelling-roots")
        now = met.select("word", F.coalesce("next", "at").alias("at"))
        if met.where("next IS NOT NULL").isEmpty():
            break
    return out.join(now.withColumnRenamed("at", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
