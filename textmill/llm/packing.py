"""Packing documents into sequences: first-fit decreasing over a tournament tree.

A document's ids are cut at multiples of ``length``; whole pieces are sequences
of their own, and the rest is packed first-fit decreasing.  Pieces are dealt to
groups by a seeded hash of their task and their number in it, so that null and
repeated ids and texts spread too; groups are packed independently, each by one
task, and their number follows from a bound on the number of pieces (documents +
bytes / length for a byte-level vocabulary), so a group holds about
``group_pieces`` pieces of at most ``length`` ids whatever the input.  Bins lie at the leaves of
a tournament tree of free space; the leftmost bin that fits is found in
O(log bins).

Defined results: null text counts as empty (the end id alone); repeated rows are
packed as documents of their own; null ids are allowed; an empty table gives no
pieces; extra columns are ignored; ties in length go by id, start and ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import partitions, prepare
from textmill.llm.tokens import END_ID, encoded, encodes, id_type

LENGTH = 2048
GROUP_PIECES = 4096
SEED = 17
TASK_PIECES = 1 << 40  # beyond those of any task


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size, in the given order: the leftmost bin with room."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    free = [capacity] * (2 * leaves)  # a node holds the most free space below it
    out = []
    for size in sizes:
        if size > capacity:
            raise ValueError(f"{size} does not fit into {capacity}")
        i = 1
        while i < leaves:
            i *= 2
            if free[i] < size:
                i += 1
        out.append(i - leaves)
        free[i] -= size
        while i > 1:
            i //= 2
            most = max(free[2 * i], free[2 * i + 1])
            if free[i] == most:
                break
            free[i] = most
    return out


def _pieces(tokenizer: str, length: int, end_id: int):
    @encodes
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, made = id_type(tokenizer), 0
        for batch in batches:
            for lo, _, ids, ends in encoded(tokenizer, batch.column(1), end_id):
                total = np.diff(ends)
                n = -(-total // length)
                row = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * length
                size = np.minimum(total[row] - start, length)
                at = ends[:-1][row] + start  # pieces follow each other in ``ids``
                offsets = np.append(at, ends[-1]).astype(np.int32) * dtype.itemsize
                binary = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.tobytes()),
                                                                             pa.py_buffer(ids.astype(dtype).tobytes())])
                number = batch.column(2)[0].as_py() * TASK_PIECES + made + np.arange(len(row))
                made += len(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + lo)), pa.array(start), pa.array(size), pa.array(total[row]), binary,
                     pa.array(number)], names=["doc_id", "start", "length", "doc_tokens", "ids", "number"])
    return run


def _pack(length: int, dtype: str):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                                                ("ids", "ascending")])
        size = group.column("length").to_numpy()
        whole = int((size == length).sum())
        bins = np.concatenate([np.arange(whole), whole + np.array(first_fit(size[whole:].tolist(), length), dtype=np.int64)]
                              ).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(size[order])
        first = np.searchsorted(bins[order], bins[order])
        offset = np.empty(len(size), dtype=np.int64)
        offset[order] = ends - size[order] - (ends - size[order])[first]
        wide = [np.frombuffer(x, dtype=dtype).astype("<u4").tobytes() for x in group.column("ids").to_pylist()]
        number = group.column("group").to_numpy()
        return pa.table({
            "doc_id": group.column("doc_id"), "start": group.column("start"), "length": group.column("length"),
            "doc_tokens": group.column("doc_tokens"), "sequence_id": number * (1 << 32) + bins, "offset": offset,
            "ids": pa.array(wide, pa.binary())})
    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         group_pieces: int = GROUP_PIECES, end_id: int = END_ID, seed: int = SEED) -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, sequence_id, offset
    and ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"),
                       F.spark_partition_id().cast("long").alias("p"))
    # a byte gives at most one token, so this bounds the pieces without encoding
    bound = rows.agg((F.count("*") + F.coalesce(F.sum(F.octet_length("t")), F.lit(0)) / length).alias("n")).first().n
    groups = max(1, -(-int(bound) // group_pieces))
    pieces = rows.mapInArrow(_pieces(tokenizer, length, end_id),
                             "doc_id long, start long, length long, doc_tokens long, ids binary, number long")
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(groups)).cast("long")).drop("number")
    return dealt.repartition(min(groups, 4 * partitions(spark)), "group").groupBy("group").applyInArrow(
        _pack(length, id_type(tokenizer).str),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
