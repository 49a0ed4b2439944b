"""Token ids as Arrow stream files of fixed-size-list batches.

Documents are range-partitioned by id, and each task writes its range as one
stream file: batches of ``batch`` rows of ``ids: fixed_size_list<uintN>[length]``
and ``mask: fixed_size_list<bool>[length]``, a document after the other without
gaps, the last sequence padded with 0 (mask false).  All batches but the last
have equally many rows, so sequence i is row ``i % batch`` of batch
``i // batch``; a memory-mapped file is read without copying.  A second stream
file holds each document's id, start and token count in the first.

The manifest (a row per file of a successful task) is written to the shared
folder; readers go through it.  Global starts are prefix sums over its rows.

Defined results: null text counts as empty (the end id alone); rows of equal id
are ordered by text hash and text; null ids come first; an empty table gives no
files; extra columns are ignored; a text of any length crosses sequences and
batches freely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.store import (attempt_name, open_input, open_output, partitions, prepare, shared_folder, written)
from textmill.llm.tokens import END_ID, encoded, encodes, id_type

LENGTH = 2048
BATCH = 256
_MANIFEST = "part long, path string, docs_path string, docs long, tokens long, sequences long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Fills fixed-length sequences with ids and writes them batch by batch."""

    def __init__(self, sink, dtype: np.dtype, length: int = LENGTH, batch: int = BATCH) -> None:
        self.sink, self.length, self.size, self.dtype = sink, length, length * batch, dtype
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
                                 ("mask", pa.list_(pa.bool_(), length))])
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.tokens = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.tokens += len(ids)
        if self.n_held >= self.size:
            every = np.concatenate(self.held)
            whole = len(every) // self.size * self.size
            for at in range(0, whole, self.size):
                self._batch(every[at: at + self.size], self.size)
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _batch(self, ids: np.ndarray, used: int) -> None:
        mask = np.arange(len(ids)) < used
        self.stream.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(a), self.length) for a in (ids, mask)], schema=self.schema))
        self.sequences += len(ids) // self.length

    def close(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            padded = np.zeros(-(-len(ids) // self.length) * self.length, dtype=self.dtype)
            padded[: len(ids)] = ids
            self._batch(padded, len(ids))
        self.stream.close()
        self.sink.close()


class SequenceFile:
    """Random access to the sequences and masks of one file; a local file is
    memory-mapped and its arrays are views."""

    def __init__(self, uri: str) -> None:
        self.table = pa.ipc.open_stream(open_input(uri)).read_all()
        self.length = self.table.schema.field("ids").type.list_size
        self.batch = self.table.column("ids").chunk(0).__len__() if self.table.num_rows else 1

    def __len__(self) -> int:
        return self.table.num_rows

    def _row(self, name: str, i: int) -> pa.Array:
        if not 0 <= i < len(self):
            raise IndexError(i)
        chunk = self.table.column(name).chunk(i // self.batch)
        at = (chunk.offset + i % self.batch) * self.length
        return chunk.values.slice(at, self.length)

    def ids(self, i: int) -> np.ndarray:
        return self._row("ids", i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        return self._row("mask", i)


def _write(tokenizer: str, folder: str, length: int, batch_rows: int, end_id: int):
    @encodes
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = docs = None
        n_docs, paths = 0, (attempt_name(folder, "tokens", ".arrow"), attempt_name(folder, "docs", ".arrow"))
        for batch in batches:
            if batch.num_rows and out is None:
                out = SequenceWriter(open_output(paths[0]), id_type(tokenizer), length, batch_rows)
                docs_sink = open_output(paths[1])
                docs = pa.ipc.new_stream(docs_sink, _DOCS)
            for lo, hi, ids, ends in encoded(tokenizer, batch.column(1), end_id):
                docs.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(ends[:-1] + out.tokens), pa.array(np.diff(ends))],
                    schema=_DOCS))
                out.add(ids)
                n_docs += hi - lo
        if out is not None:
            out.close()
            docs.close()
            docs_sink.close()
            row = (TaskContext.get().partitionId(), *paths, n_docs, out.tokens, out.sequences)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row],
                                             names=[x.split()[0] for x in _MANIFEST.split(", ")])
    return run


def write_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 batch: int = BATCH, end_id: int = END_ID) -> DataFrame:
    """Write all documents in id order; the manifest."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("h"))
    order = [F.col("id").asc_nulls_first(), "h"]
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "t").select("id", "t")
    return written(ranged.mapInArrow(_write(tokenizer, shared_folder(spark, "tokens"), length, batch, end_id), _MANIFEST),
                   "token-manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, docs_path, before in zip(*(batch.column(i).to_pylist() for i in range(3))):
            tokens = pa.ipc.open_stream(open_input(path))
            held, at = np.empty(0, dtype=np.uint16), 0  # ids at..at+len(held) of the file
            for docs in pa.ipc.open_stream(open_input(docs_path)):
                starts, sizes = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                crcs = np.empty(docs.num_rows, dtype=np.int64)
                for i, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
                    crc = 0
                    while n:
                        if s >= at + len(held):
                            at += len(held)
                            held = tokens.read_next_batch().column(0).values.to_numpy(zero_copy_only=True)
                        part = held[s - at: s - at + n]
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        s, n = s + len(part), n - len(part)
                    crcs[i] = crc
                yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts + before), docs.column(2), pa.array(crcs)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, a file per task;
    start counts the ids of all documents before."""
    spark = manifest.sparkSession
    prepare(spark)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.select("path", "docs_path", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")).alias("b"))
    return files.repartition(partitions(spark), "path").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")
