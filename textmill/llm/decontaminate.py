"""Benchmark decontamination by a broadcast hash set of test n-grams.

The benchmark's windows (13 consecutive normalised words, or a whole shorter
item) become a sorted array of 64-bit names, broadcast in blocks of at most
``block_windows`` names; a longer benchmark is scanned block by block and the
hits are merged, so what is broadcast never grows with the benchmark and no
window is dropped.  Each task names all word windows of its texts with numpy,
looks the names up, and confirms every hit by comparing the words themselves.

Normalisation: A-Z to a-z; words are runs of ASCII letters, digits and
characters beyond ASCII.

Defined results: null or wordless text has no words and no hits; an item
without words (or null) has no windows; an item with a null id still marks
words but is not listed; repeated items or rows each get the same result;
an empty benchmark or table gives no hits; columns of ``docs`` keep their
names, and the added ones replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.store import prepare, written
from textmill.llm.words import ALNUM, slices, split_words, window_names

WINDOW = 13
BLOCK_WINDOWS = 1_000_000
#: a first look at a window costs one bit of this many
FILTER_BITS = 22

SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in slices(batch.column(1)):
                w = split_words(data, offs, ALNUM, lower=True)
                h = w.hashes()
                out_id, out_name, out_width, out_words = [], [], [], []
                for r in range(hi - lo):
                    a, b = int(w.row_first[r]), int(w.row_first[r + 1])
                    width = min(window, b - a)
                    if not width:
                        continue
                    words = [w.word(i) for i in range(a, b)]
                    names = window_names(h[a:b], width)
                    for i, name in enumerate(names.view(np.int64).tolist()):
                        out_id.append(ids[lo + r].as_py())
                        out_name.append(name)
                        out_width.append(width)
                        out_words.append(b" ".join(words[i: i + width]))
                yield pa.record_batch([pa.array(out_id, pa.string()), pa.array(out_name, pa.int64()),
                                       pa.array(out_width, pa.int32()), pa.array(out_words, pa.binary())],
                                      names=["item", "name", "width", "words"])
    return run


class _Block:
    """One broadcast block: widths, sorted names, and their words and items."""

    def __init__(self, rows: list) -> None:
        self.of: dict[int, list[tuple[int, bytes, frozenset[str]]]] = {}
        for width, name, words, items in rows:
            self.of.setdefault(name & 0xFFFFFFFFFFFFFFFF, []).append((width, words, frozenset(items)))
        by_width: dict[int, list[int]] = {}
        for name, found in self.of.items():
            for width in {x[0] for x in found}:
                by_width.setdefault(width, []).append(name)
        self.names = {k: np.sort(np.array(v, dtype=np.uint64)) for k, v in by_width.items()}
        self.filters = {}
        for width, names in self.names.items():
            self.filters[width] = np.zeros(1 << FILTER_BITS, dtype=bool)
            self.filters[width][(names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, w, h: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(first word, width, items) of confirmed windows inside rows."""
        for width, names in self.names.items():
            got = window_names(h, width)
            at = np.flatnonzero(self.filters[width][(got >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = at[last[at] >= at + width]  # inside one row
            found = np.searchsorted(names, got[at])
            at = at[names[np.minimum(found, len(names) - 1)] == got[at]]
            for p in at.tolist():
                words = b" ".join(w.word(i) for i in range(p, p + width))
                for known_width, known, items in self.of[int(got[p])]:
                    if known_width == width and known == words:
                        yield p, width, items


def _scan(block, n_cols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: _Block = block.value
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(n_cols)):
                w = split_words(data, offs, ALNUM, lower=True)
                last = np.repeat(w.row_first[1:], np.diff(w.row_first))
                row = w.row
                spans: dict[int, list[tuple[int, int]]] = {}
                items: dict[int, set[str]] = {}
                for p, width, ids in b.hits(w, w.hashes(), last):
                    r = int(row[p])
                    spans.setdefault(r, []).append((p, p + width))
                    items.setdefault(r, set()).update(ids)
                merged = [_merge([(x - int(w.row_first[r]), y - int(w.row_first[r])) for x, y in spans.get(r, [])])
                          for r in range(hi - lo)]
                yield pa.record_batch(
                    [batch.column(i).slice(lo, hi - lo) for i in range(n_cols + 1)]
                    + [pa.array(np.diff(w.row_first), pa.int64()),
                       pa.array([[{"first": x, "end": y} for x, y in m] for m in merged],
                                pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                       pa.array([sorted(items.get(r, ())) for r in range(hi - lo)], pa.list_(pa.string()))],
                    names=[f"c{i}" for i in range(n_cols + 1)] + ["n_words", "spans", "items"])
    return run


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, hit word spans (``first``, ``end``, merged) and
    the sorted ids of the items that occur."""
    spark = docs.sparkSession
    prepare(spark)
    windows = (
        benchmark.select(F.col(item_id).cast("string"), F.col(item_text))
        .mapInArrow(_item_windows(window), "item string, name long, width int, words binary")
        .groupBy("width", "name", "words").agg(F.collect_set("item").alias("items"))
    )
    windows = written(windows, "benchmark-windows")
    total = windows.count()
    blocks = max(1, -(-total // block_windows))
    added = ["n_words", "spans", "items"]
    keep = [c for c in docs.columns if c != text and c not in added]
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias(f"c{len(keep)}"))
    base = out.schema
    for k in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == k)
        rows = [(r.width, r.name, bytes(r.words), r["items"]) for r in part.toLocalIterator()]  # bounded block
        block = spark.sparkContext.broadcast(_Block(rows))
        schema = T.StructType([*base.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", SPAN),
                               T.StructField("items", T.ArrayType(T.StringType()))])
        if k:
            out = out.withColumnsRenamed({"spans": "old_spans", "items": "old_items"}).drop("n_words")
            carried = out.select(*base.names[:-1], "old_spans", "old_items", base.names[-1])
            carried_schema = carried.schema
            out = carried.mapInArrow(
                _scan(block, len(carried.columns) - 1),
                T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(carried_schema.fields)],
                              *schema.fields[-3:]]))
            names = [*base.names[:-1], "old_spans", "old_items", base.names[-1], *added]
            out = out.toDF(*names)
            out = out.select(
                *base.names, "n_words", _merge_columns("old_spans", "spans").alias("spans"),
                F.array_sort(F.array_union("old_items", "items")).alias("items"))
        else:
            out = out.mapInArrow(_scan(block, len(base.names) - 1), schema)
    return out.toDF(*keep, text, *added).select(*[f"`{c}`" for c in docs.columns if c not in added], *added)


def _merge_columns(a: str, b: str):
    """Union of two lists of disjoint spans as disjoint spans."""
    every = F.array_sort(F.concat(F.col(a), F.col(b)))
    return F.aggregate(
        every, F.array().cast(SPAN),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["first"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["first"].alias("first"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(s))))


def hit_words(spans: str = "spans"):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])


def is_contaminated(share: int = 20):
    """At least one word in ``share`` is hit."""
    n_hit = hit_words()
    return (n_hit > 0) & (n_hit * share >= F.col("n_words"))


def remove_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cut the hit spans out of the text of ``contamination`` rows: everything
    from a span's first to its last word; other text stays as it was."""
    prepare(docs.sparkSession)
    at, cols = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, done = batch.column(cols.index("spans")).to_pylist(), []
            for lo, hi, data, offs in slices(batch.column(at)):
                w = split_words(data, offs, ALNUM)
                for r in range(hi - lo):
                    if batch.column(at)[lo + r].as_py() is None:
                        done.append(None)
                        continue
                    piece, first, parts = int(offs[r]), int(w.row_first[r]), []
                    for s in spans[lo + r] or []:
                        parts.append(data[piece: w.start[first + s["first"]]].tobytes())
                        piece = int(w.end[first + s["end"] - 1])
                    parts.append(data[piece: offs[r + 1]].tobytes())
                    done.append(b"".join(parts).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(done, pa.string()) if i == at else batch.column(i) for i in range(len(cols))], names=cols)

    return docs.mapInArrow(run, docs.schema)


def items_digest(items: str = "items"):
    """sha256 of the comma-joined item ids in string order."""
    return F.sha2(F.array_join(F.array_sort(F.col(items)), ",").cast("binary"), 256)


__all__ = ["contamination", "hit_words", "is_contaminated", "items_digest", "remove_spans"]
