"""Toxicity scores by a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings of itself and of its first 4, 5 and 6
bytes (so inflected forms share); filters of 1, 2 and 3 words run over whole
texts, each is pooled to its maximum, and a logistic layer gives the score.
One embedding dimension starts as how much more often than by chance a bucket
occurs in labelled texts, the rest at random; all of them are trained.

Fitting takes at most ``per_class`` labelled rows of each class, drawn by a
hash of the id.  Each class has half of ``sample_bytes`` characters; if its
texts are longer together, the longest ones are held to windows spread over
them, so every drawn row is learned from.  Scoring takes every whole text, in
one pass over the table and without a shuffle.

Thresholds are calibrated by language on rows left out of the fit: the
language is guessed from the text alone by word counts of the sample, a
language with too few labelled rows uses the common threshold, and the score
is shifted so that its threshold lies at 0.5.

Defined results: null, empty and wordless texts get the score of a text in
which no filter fires; without labelled rows of both classes every score is 0;
rows with null labels or ids are not learned from; of several labels of one id
the highest counts; ``docs`` keeps its columns, added ones replace columns of
the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.samples import fair_length, held_to
from textmill.llm.store import prepare, tidy, trim, written
from textmill.llm.words import ALNUM, U64, Words, mix, slices, split_words

BUCKETS = 1 << 16
DIM = 12
PREFIXES = [4, 5, 6]
WIDTHS = (1, 2, 3)
FILTERS = 8
PER_CLASS = 2000
SAMPLE_BYTES = 32 << 20
EPOCHS = 8
CHUNK = 50_000  # words whose activations are held at once
LEAST_ROWS = 25  # of each class, for a threshold of a language's own


@dataclass
class Model:
    embedding: np.ndarray            # buckets x dim
    filters: list[np.ndarray]        # per width: width x dim x filters
    bias: np.ndarray                 # of all filters
    out: np.ndarray
    out_bias: float
    languages: list[str]
    language_words: np.ndarray       # buckets x languages, log weights
    thresholds: np.ndarray           # logits, by language; the last is the common one


def word_buckets(words: Words) -> np.ndarray:
    """words x (1 + prefixes) embedding rows."""
    names = words.affixes(PREFIXES, [])
    return np.stack([(mix(h + U64(i)) % U64(BUCKETS)).astype(np.int32) for i, h in enumerate(names)], axis=1)


def _convolve(model: Model, x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Activations before pooling; words beyond the text count as zero."""
    out = []
    for width, f in zip(WIDTHS, model.filters):
        y = x @ f[0]
        for o in range(1, width):
            inside = (row[o:] == row[:-o])[:, None]
            y[:-o] += (x[o:] @ f[o]) * inside
        out.append(y)
    return np.concatenate(out, axis=1) + model.bias


def pooled(model: Model, buckets: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """rows x filters: the maximum of each filter over the text, at least 0."""
    best = np.zeros((rows, len(model.bias)), dtype=np.float32)
    ahead = max(WIDTHS) - 1
    for at in range(0, len(row), CHUNK):
        to = min(len(row), at + CHUNK)
        b, r = buckets[at: to + ahead], row[at: to + ahead]
        x = model.embedding[b[:, 0]]
        for i in range(1, b.shape[1]):
            x += model.embedding[b[:, i]]
        y, r = _convolve(model, x, r)[: to - at], r[: to - at]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        best[r[first]] = np.maximum(best[r[first]], np.maximum.reduceat(y, first, axis=0))
    return best


def logits(model: Model, best: np.ndarray) -> np.ndarray:
    return best @ model.out + model.out_bias


def guess_language(model: Model, buckets: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Index of each row's likeliest language; the number of languages if no
    word tells."""
    n = len(model.languages)
    if not n:
        return np.zeros(rows, dtype=np.int64)
    score = np.stack([np.bincount(row, weights=model.language_words[buckets[:, 0], i], minlength=rows) for i in range(n)], axis=1)
    return np.where(np.ptp(score, axis=1) > 0, score.argmax(axis=1), n)


def scores(model: Model, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Score of each text of a slice."""
    words = split_words(data, offs, ALNUM, lower=True)
    rows, row, buckets = len(offs) - 1, words.row, word_buckets(words)
    best = pooled(model, buckets, row, rows)
    language = guess_language(model, buckets, row, rows)
    return 1 / (1 + np.exp(-np.clip(logits(model, best).astype(np.float64) - model.thresholds[language], -30, 30)))


def fit(texts: list[str] | pa.Array, toxic: np.ndarray, language: list[str | None], calibrate: np.ndarray, seed: int = 7,
        epochs: int = EPOCHS) -> Model | None:
    """Train on the rows that ``calibrate`` leaves, set thresholds on the others."""
    toxic = np.asarray(toxic, dtype=bool)
    if not len(texts) or not (toxic & ~calibrate).any() or not (~toxic & ~calibrate).any():
        return None
    parts, counts = [], []
    rows = len(texts)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    for _, _, data, offs in slices(texts):  # the driver holds buckets, not words
        words = split_words(data, offs, ALNUM, lower=True)
        parts.append(word_buckets(words))
        counts.append(np.diff(words.row_first))
    del texts, data, words
    buckets = np.concatenate(parts)
    row_first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(row_first))
    del parts
    rng = np.random.default_rng(seed)
    fitted = np.flatnonzero(~calibrate)

    # how often each bucket occurs in toxic texts, beyond chance and shrunk for rare ones
    seen = np.zeros((2, BUCKETS))
    ends = np.append(np.flatnonzero(np.diff(row_first[1:] // CHUNK)) + 1, rows)  # about CHUNK words, whole texts
    for lo, hi in zip(np.append(0, ends[:-1]), ends):
        at = slice(row_first[lo], row_first[hi])
        for c in range(buckets.shape[1]):
            pairs = np.unique(row[at].astype(np.int64) * BUCKETS + buckets[at, c])
            r, b = pairs // BUCKETS, pairs % BUCKETS
            ok = ~calibrate[r]
            for k in (0, 1):
                seen[k] += np.bincount(b[ok & (toxic[r] == k)], minlength=BUCKETS)
    share = toxic[fitted].mean()
    n = seen.sum(axis=0)
    told = (seen[1] - share * n) / np.sqrt(share * (1 - share) * n + 3)
    model = Model(rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32),
                  [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32),
                  rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0, [], np.zeros((BUCKETS, 0)), np.zeros(1))
    model.embedding[:, 0] = np.clip(told, -4, 8)
    _train(model, buckets, row, row_first, toxic, fitted, rng, epochs)

    model.languages = sorted({x for x in language if x is not None})
    count = np.zeros((BUCKETS, len(model.languages)))
    own = np.array([model.languages.index(x) if x is not None else -1 for x in language], dtype=np.int64)
    for i in range(len(model.languages)):
        count[:, i] = np.bincount(buckets[own[row] == i, 0], minlength=BUCKETS)
    model.language_words = np.log((count + 0.1) / (count.sum(axis=0) + 0.1 * BUCKETS)).astype(np.float32)
    model.language_words -= model.language_words.mean(axis=1, keepdims=True)

    best = pooled(model, buckets, row, rows)
    z, told_language = logits(model, best), guess_language(model, buckets, row, rows)
    held = calibrate if toxic[calibrate].any() and (~toxic[calibrate]).any() else ~calibrate
    common = _threshold(z[held], toxic[held])
    model.thresholds = np.full(len(model.languages) + 1, common)
    for i in range(len(model.languages)):
        at = held & (told_language == i)
        if min(toxic[at].sum(), (~toxic[at]).sum()) >= LEAST_ROWS:
            model.thresholds[i] = _threshold(z[at], toxic[at])
    return model


def _threshold(z: np.ndarray, toxic: np.ndarray) -> float:
    """Middle of the widest gap among cuts of the highest F1."""
    order = np.argsort(z)
    z, y = z[order].astype(np.float64), toxic[order]
    below = np.concatenate([[0], np.cumsum(y)])     # toxic ones lost by cutting before i
    found, marked = y.sum() - below, len(y) - np.arange(len(y) + 1)
    f1 = 2 * found / np.maximum(marked + y.sum(), 1)
    cuts = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    gap = np.concatenate([[1], z[1:] - z[:-1], [1]])
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[top[gap[top].argmax()]])


def _train(model: Model, buckets, row, row_first, toxic, fitted, rng, epochs: int) -> None:
    """Minibatch Adam; pooling passes each gradient to one window a filter."""
    share = toxic[fitted].mean()
    weight = np.where(toxic, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    params = [*model.filters, model.bias, model.out, np.zeros(1, dtype=np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    adagrad = np.full(BUCKETS, 1e-2, dtype=np.float32)
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fitted), max(1, len(fitted) // 32)):
            take = np.concatenate([np.arange(row_first[i], row_first[i + 1]) for i in part]).astype(np.int64)
            b = buckets[take]
            size = row_first[part + 1] - row_first[part]
            r = np.repeat(np.arange(len(part)), size)
            if not len(r):
                continue
            x = model.embedding[b].sum(axis=1)
            y = _convolve(model, x, r)
            begin = np.cumsum(size) - size
            best, where = np.zeros((len(part), y.shape[1]), dtype=np.float32), np.zeros((len(part), y.shape[1]), dtype=np.int64)
            for j in np.flatnonzero(size):
                where[j] = y[begin[j]: begin[j] + size[j]].argmax(axis=0) + begin[j]
                best[j] = np.maximum(y[where[j], np.arange(y.shape[1])], 0)
            p = 1 / (1 + np.exp(-np.clip(best @ model.out + params[-1][0], -30, 30)))
            d = ((p - toxic[part]) * weight[part] / len(part)).astype(np.float32)
            d_best = np.outer(d, model.out) * (best > 0)
            grads = [np.zeros_like(f) for f in model.filters]
            touched, d_rows = [], []
            for k, (width, f) in enumerate(zip(WIDTHS, model.filters)):
                for c in range(FILTERS):
                    g = d_best[:, k * FILTERS + c]
                    at = where[:, k * FILTERS + c]
                    for o in range(width):
                        pos = np.minimum(at + o, len(r) - 1)
                        ok = (at + o < len(r)) & (r[pos] == np.arange(len(part))) & (g != 0)
                        grads[k][o, :, c] = g[ok] @ x[pos[ok]]
                        touched.append(pos[ok])
                        d_rows.append(g[ok, None] * f[o, :, c])
            grads += [d_best.sum(axis=0), best.T @ d + 1e-3 * model.out, np.array([d.sum()], dtype=np.float32)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= (0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
            at, g = np.concatenate(touched), np.concatenate(d_rows)
            for c in range(b.shape[1]):
                ids = b[at, c]
                np.add.at(adagrad, ids, (g * g).sum(axis=1))
                np.add.at(model.embedding, ids, -0.02 * g / np.sqrt(adagrad[ids])[:, None])
    model.out_bias = float(params[-1][0])


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", lang: str | None = "lang", per_class: int = PER_CLASS,
          sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fit on a bounded sample; ``may_learn`` is a condition on ``docs``."""
    prepare(docs.sparkSession)
    model = fit(*_sample(docs, labels, may_learn, doc_id, text, label, lang, per_class, sample_bytes))
    trim()
    return model


def _sample(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str, text: str, label: str, lang: str | None,
            per_class: int, sample_bytes: int) -> tuple[pa.Array, np.ndarray, list[str | None], np.ndarray]:
    """The arguments of ``fit``."""
    known = (labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y")).dropna()
             .groupBy("i").agg(F.max("y").alias("y")))
    languages = F.col(lang) if lang else F.lit(None).cast("string")
    rows = docs.where(may_learn & F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("i"), F.col(text).alias("t"), languages.alias("l"))
    # one pass finds the ids, one takes their texts; all the rest reads that table
    first = Window.partitionBy("y").orderBy(F.xxhash64("i"), "i")
    part = (rows.select("i").distinct().join(known, "i").where("y IN (0, 1)")
            .withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_class).drop("r"))
    part = written(part, "toxicity-ids")
    found = written(rows.join(F.broadcast(part), "i").withColumn("h", F.xxhash64("i", "t")).dropDuplicates(["h"])  # 2 * per_class ids
                    .withColumn("n", F.length("t")), "toxicity-texts")
    texts, ys, langs, cal = [], [], [], []
    for y in (1, 0):
        own = found.where(F.col("y") == y)
        sizes = own.select("h", "n").orderBy("h").limit(per_class).collect()
        if not sizes:
            continue
        most = fair_length([r.n for r in sizes], sample_bytes // 2)
        taken = own.where(F.col("h") <= sizes[-1].h).select("i", F.xxhash64("i").alias("k"), held_to(F.col("t"), F.lit(most)).alias("t"), "l")
        taken = sorted(taken.collect(), key=lambda r: (r.k, r.i, r.t))  # at most sample_bytes / 2 characters
        if not taken:
            raise RuntimeError(f"labelled texts of class {y} exist, but none was taken")
        texts += [r.t for r in taken]
        langs += [r.l for r in taken]
        cal += [r.i for r in taken]
        ys += [y] * len(taken)
        del taken
    calibrate = mix(np.array([hash_of(i) for i in cal], dtype=U64)) % U64(5) == 0 if cal else np.zeros(0, bool)
    return pa.array(texts, pa.large_string()), np.array(ys, dtype=bool), langs, calibrate


def hash_of(value) -> int:
    import zlib

    return zlib.crc32(str(value).encode("utf-8")) + 1


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score``."""
    prepare(docs.sparkSession)
    keep = [c for c in docs.columns if c != "score"]
    if model is None:
        return docs.select(*[f"`{c}`" for c in keep], F.lit(0.0).alias("score"))
    shared, at = docs.sparkSession.sparkContext.broadcast(model), keep.index(text)  # of fixed size
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    names = [*plain.columns, "score"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [scores(shared.value, data, offs) for _, _, data, offs in slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got) if got else [], pa.float64())],
                                             names=names)

    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*keep, "score")
