"""Language identification and distribution tables.

B1 is a multinomial naive Bayes over hashed byte trigrams of the lower-cased
text.  The model is a table of fixed width (``BUCKETS`` weights a language),
whatever the corpus; training counts it in one pass (each batch adds up its
own table before the shuffle), and scoring is row-local: one Arrow batch
function over a broadcast model of checked size, no shuffle, no word left
out.  Learn from one part of the rows and judge on another
(``learning_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import ship_package

BUCKETS = 4093
MAX_LANGUAGES = 1000  # of a model: bounds what is broadcast
STEP_BYTES = 1 << 21
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def learning_rows(id_col: Column, folds: int = 5) -> Column:
    """A fixed share of the ids, (folds - 1) of folds, to learn from."""
    return F.conv(F.substring(F.md5(id_col.cast("string")), 1, 7), 16, 10).cast("long") % folds != 0


def trigrams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bucket of each trigram, its row) of pieces of a
    batch; null is empty and trigrams stay inside their row."""
    texts = texts.fill_null("") if texts.null_count else texts
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + STEP_BYTES, side="right")) - 1)
        part = texts.slice(at, to - at)
        width = np.int64 if pa.types.is_large_string(part.type) else np.int32
        offs = np.frombuffer(part.buffers()[1], dtype=width)[part.offset: part.offset + to - at + 1]
        data = _LOWER[np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)[offs[0]: offs[-1]]].astype(np.int64)
        row = np.repeat(np.arange(to - at), np.diff(offs))
        inside = row[2:] == row[:-2]
        code = (data[:-2] * 65536 + data[1:-1] * 256 + data[2:]) % BUCKETS
        yield at, to, code[inside], row[2:][inside]
        at = to


def distribution(df: DataFrame, lang_col: str = "language") -> DataFrame:
    """(language, n) over all rows, incl. 'unknown'."""
    return df.groupBy(F.col(lang_col).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def top_k(dist: DataFrame, k: int) -> DataFrame:
    """Most frequent languages, ties by name (TakeOrderedAndProject)."""
    return dist.orderBy(F.desc("n"), F.asc("language")).limit(k)


def shares(dist: DataFrame) -> DataFrame:
    """Share per language; the total comes from a window over the
    aggregated table, which has one row per language."""
    total = F.sum("n").over(Window.partitionBy())
    return dist.select("language", "n", F.when(total > 0, F.col("n").cast("double") / total.cast("double"))
                       .otherwise(F.lit(0.0)).alias("share"))


def keep_target(df: DataFrame, target: str, lang_col: str = "language") -> DataFrame:
    """Rows of the target language."""
    return df.where(F.col(lang_col) == F.lit(target))


def target_share(df: DataFrame, target: str, lang_col: str = "language") -> DataFrame:
    return df.agg(F.avg((F.col(lang_col) == F.lit(target)).cast("double")).alias("target_share"))


@dataclass
class Profile:
    """Languages with their log prior and log weights of all buckets."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray  # languages x buckets
    documents: int = 0   # learned from


def train_profile(labelled: DataFrame, text_col: str = "text", label_col: str = "language", alpha: float = 1.0) -> Profile:
    """Count trigram buckets by label over all given rows with a label."""
    rows = labelled.select(F.col(label_col).alias("l"), F.col(text_col).alias("t")).where("l IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            names = sorted(set(labels))
            own = np.array([names.index(x) for x in labels], dtype=np.int64)
            table = np.zeros((len(names), BUCKETS), dtype=np.int64)
            for lo, _, code, row in trigrams(batch.column(1)):
                table += np.bincount(own[lo + row] * BUCKETS + code, minlength=table.size).reshape(table.shape)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.bincount(own, minlength=len(names))),
                                              pa.array(list(table), pa.list_(pa.int64()))], names=["l", "docs", "c"])

    ship_package(labelled.sparkSession)
    parts = rows.mapInArrow(count, "l string, docs long, c array<long>")
    sums = parts.select("l", F.posexplode(F.concat(F.array("docs"), "c")).alias("k", "c")).groupBy("l", "k").agg(F.sum("c").alias("c"))
    # fixed width: the number of documents, then a count a bucket
    got = sums.groupBy("l").agg(F.array_sort(F.collect_list(F.struct("k", "c"))).alias("c")).orderBy("l").limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: not a language column")
    names, table = [r.l for r in got], np.array([[x.c for x in r.c] for r in got], dtype=np.float64).reshape(-1, BUCKETS + 1)
    counts, n = table[:, 1:], table[:, 0]
    return Profile(names, np.log(n) - np.log(n.sum()) if names else n,
                   np.log(counts + alpha) - np.log(counts.sum(axis=1, keepdims=True) + alpha * BUCKETS), int(n.sum()))


def detect(df: DataFrame, profile: Profile, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """Adds ``out_col`` = most likely language (the first by name if equal),
    ``'unknown'`` without a letter or without a model."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(profile)

    @F.arrow_udf("string")
    def label(texts: pa.Array) -> pa.Array:
        p, out = shared.value, []
        for lo, hi, code, row in trigrams(texts):
            score = np.stack([np.bincount(row, weights=w[code], minlength=hi - lo) + b
                              for w, b in zip(p.weights, p.prior)], axis=1)
            out += [p.languages[i] for i in score.argmax(axis=1)]
        return pa.array(out, pa.string())

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if not profile.languages:
        return df.withColumn(out_col, F.lit("unknown"))
    return df.withColumn(out_col, F.when(letters, label(F.col(text_col))).otherwise(F.lit("unknown")))
