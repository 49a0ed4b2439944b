"""Best-fit packing: best-two-fit over all documents at once.

A document's ids are cut at multiples of ``length`` only if there are more.  A
sequence is filled greedily, always with the largest piece left that fits; then,
if it holds several pieces and some room, its smallest is replaced by the two
pieces left that together fill the widened gap most, if that is tighter.

What a sequence holds depends on the number of pieces of each size alone, and
there are at most ``length`` sizes.  So:

1. documents are encoded once and written with their pieces; a piece's rank
   among those of its size is counted inside its task, and a running sum over
   tasks (a row a task and size) makes it global;
2. the number of pieces of each size (at most ``length`` rows) is packed on the
   driver.  Equal sequences come as one pattern with its repeats, until a
   size runs short: some patterns a size, however many documents there are;
3. each piece finds its pattern by its size and rank (binary search) and from
   the rank its sequence and its offset.

Nothing is grouped by size or sequence, so no size is a hot key, and there is
one packing of the corpus, not one a group.  Which of several pieces of one size
takes which place follows from the order of the input's splits.

Defined results: null text counts as empty (the end id alone); repeated rows
are packed as documents of their own; null ids are allowed; an empty table gives
no pieces; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.store import prepare, written
from textmill.llm.tokens import END_ID, encoded, encodes, id_type
from textmill.llm.words import ragged

LENGTH = 4096
RANKS = 1 << 48  # beyond any number of pieces


def best_two(counts: np.ndarray, over: int, limit: int) -> tuple[int, int] | None:
    """The two sizes above ``over`` of the largest sum up to ``limit``, of the
    pieces left (``counts`` by size); ties: the larger one largest."""
    sizes = np.flatnonzero(counts[over + 1: limit]) + over + 1
    if not len(sizes):
        return None
    # each with the largest one up to itself that goes with it; of one size there must be two
    at = np.searchsorted(sizes, np.minimum(sizes, limit - sizes), side="right") - 1
    alone = (at >= 0) & (sizes[at] == sizes) & (counts[sizes] < 2)
    at = np.where(alone, at - 1, at)
    total = np.where(at >= 0, sizes + sizes[at], -1)
    best = len(total) - 1 - int(total[::-1].argmax())
    return (int(sizes[best]), int(sizes[at[best]])) if total[best] > 0 else None


def patterns(counts: np.ndarray) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Sequences in the order in which they are filled, equal ones together:
    ((size, pieces of it) in order of place, how often).  ``counts`` are the
    numbers of pieces by size, up to the capacity."""
    counts = np.asarray(counts, dtype=np.int64).copy()
    capacity = len(counts) - 1
    left = np.flatnonzero(counts).tolist()  # sizes in ascending order
    while left:
        filled, room, k = [], capacity, len(left)
        while k := bisect_right(left, room, 0, k):
            size = left[k - 1]
            n = min(int(counts[size]), room // size)
            filled.append((size, n))
            room -= n * size
            k -= 1
        taken = dict(filled)
        used = dict(taken)
        smallest, n = filled[-1]
        if room and len(filled) + n > 2 and (two := best_two(counts, room, room + smallest)) and sum(two) > smallest:
            filled[-1] = (smallest, n - 1)
            used[smallest] -= 1
            for size in two:
                used[size] = taken[size] = used.get(size, 0) + 1
            filled = [x for x in filled if x[1]] + ([(two[0], 2)] if two[0] == two[1] else [(two[0], 1), (two[1], 1)])
        times = min((int(counts[s]) - taken[s]) // n + 1 for s, n in used.items() if n)
        for size, n in used.items():
            counts[size] -= n * times
            if n and not counts[size]:
                left.remove(size)
        yield filled, times


def places(counts: np.ndarray) -> np.ndarray:
    """Rows (size * RANKS + first rank, pieces a sequence, first sequence,
    first offset) in ascending order: of a size the pieces from that rank on."""
    rank = np.zeros(len(counts), dtype=np.int64)
    out, sequence = [], 0
    for filled, times in patterns(counts):
        offset = 0
        for size, n in filled:
            out.append((size * RANKS + int(rank[size]), n, sequence, offset))
            rank[size] += n * times
            offset += size * n
        sequence += times
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 4)


def _pieces(tokenizer: str, length: int, end_id: int):
    @encodes
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = id_type(tokenizer)
        seen = np.zeros(length + 1, dtype=np.int64)  # pieces of each size in this task so far
        for batch in batches:
            for lo, _, ids, ends in encoded(tokenizer, batch.column(2), end_id):
                total = np.diff(ends)
                n = -(-total // length)
                row, piece = np.repeat(np.arange(len(n)), n), ragged(n)
                size = np.minimum(total[row] - piece * length, length)
                order = np.argsort(size, kind="stable")
                some = np.bincount(size, minlength=length + 1)
                rank = np.empty(len(size), dtype=np.int64)
                rank[order] = ragged(some) + np.repeat(seen, some)
                seen += some
                offsets = np.append(ends[:-1][row] + piece * length, ends[-1]).astype(np.int32) * dtype.itemsize
                binary = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.tobytes()),
                                                                             pa.py_buffer(ids.astype(dtype).tobytes())])
                where = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), pa.array(rank), batch.column(1).take(where), pa.array(piece), pa.array(size), binary],
                    names=["task", "rank", "doc_id", "piece", "length", "ids"])
    return run


def _placed(table: np.ndarray, length: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, piece, size, before, rank, ids = batch.columns
            key = size.to_numpy() * RANKS + rank.to_numpy() + before.to_numpy()
            at = np.searchsorted(table[:, 0], key, side="right") - 1
            first, n, sequence, offset = table[at].T
            k = key - first
            yield pa.RecordBatch.from_arrays(
                [doc, piece, pa.array(piece.to_numpy() * length), size, pa.array(sequence + k // n),
                 pa.array(offset + k % n * size.to_numpy()),
                 pa.array([np.frombuffer(x, dtype=dtype).astype("<u4").tobytes() for x in ids.to_pylist()], pa.binary())],
                names=["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"])
    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, sequence_id, offset and
    ids (little-endian unsigned 32-bit)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.spark_partition_id().cast("long").alias("task"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    pieces = written(rows.mapInArrow(_pieces(tokenizer, length, end_id),
                                     "task long, rank long, doc_id long, piece long, length long, ids binary"), "two-fit-pieces")
    counted = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))  # a row a task and size
    counts = np.zeros(length + 1, dtype=np.int64)
    for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        counts[r.length] = r.n
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (pieces.join(before, ["task", "length"]).select("doc_id", "piece", "length", "before", "rank", "ids")
            .mapInArrow(_placed(places(counts), length, id_type(tokenizer).str),
                        "doc_id long, piece long, start long, length long, sequence_id long, offset long, ids binary"))
