"""Language identification by a linear-chain conditional random field.

Words are labelled in context: a word's emission is the sum of hashed weights
of the word itself (lexicon), its first 2 and 3 and last 2, 3 and 4 bytes
(affixes) and its byte trigrams; learned transitions couple neighbours; the
marginals come from forward-backward.  A document's language is the label of
the largest share of marginals over all its words, its score that share; word
labels themselves tell where a code-switched text changes language.  A chain
covers at most ``CHAIN`` consecutive words, so that texts of any length are
labelled in rectangular numpy blocks.

Fitting (gradient ascent on the chain likelihood, each word carrying its
document's label) takes a hash sample of about ``per_language`` documents a
language, at least one.  Each language has an equal share of ``sample_bytes``
characters; if its texts are longer together, the longest ones are held to
windows spread over them.  Every language is learned: beyond ``WEIGHTS`` in all,
each has fewer weights, and steps and blocks hold fewer words.  Scoring takes
every whole text in one pass without a shuffle.

Defined results: null text and text without a letter give ``und`` and score 0,
as does any text if nothing could be learned; letters without a word (none
exist in the word alphabet) cannot occur; null labels are not learned from;
``docs`` keeps its columns, added ones replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.samples import fair_length, held_to
from textmill.llm.store import prepare
from textmill.llm.words import ALNUM, U64, Words, mix, ragged, slices, split_words

UNKNOWN = "und"
BUCKETS = 1 << 16
PREFIXES, SUFFIXES = [2, 3], [2, 3, 4]
CHAIN = 64
PER_LANGUAGE = 400
WEIGHTS = 1 << 24        # emission weights of all languages together
STEP_NUMBERS = 1 << 25   # characters x languages of a training step
BLOCK_NUMBERS = 1 << 21  # words x languages that are labelled at once
SAMPLE_BYTES = 32 << 20
EPOCHS = 3


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # buckets + 1 x labels; the last row stays zero
    transition: np.ndarray   # labels x labels


def buckets_for(languages: int) -> int:
    """Weights of one language: a power of two, so that all stay bounded."""
    return min(BUCKETS, 1 << max(8, (WEIGHTS // languages).bit_length() - 1))


class Features:
    """Feature buckets of the distinct words of a slice."""

    def __init__(self, words: Words, buckets: int = BUCKETS) -> None:
        h = words.hashes()
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        order = np.argsort(first)  # in text order, as the hashing of affixes wants it
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.of_word = place[inverse]
        first = first[order]
        own = Words(words.data, words.start[first], words.end[first], np.array([0, len(first)]))
        named = own.affixes(PREFIXES, SUFFIXES)
        self.fixed = np.stack([(mix(x + U64(i)) % U64(buckets)).astype(np.int32) for i, x in enumerate(named)], axis=1)
        # byte trigrams, at least one place a word (the zero row if it is too short)
        self.sizes = np.maximum(own.end - own.start - 2, 1)
        at = np.repeat(own.start, self.sizes) + ragged(self.sizes)
        last = len(words.data) - 1
        d = words.data.astype(np.uint64)
        code = (d[at] << U64(16)) | (d[np.minimum(at + 1, last)] << U64(8)) | d[np.minimum(at + 2, last)]
        self.grams = (mix(code + U64(1 << 32)) % U64(buckets)).astype(np.int32)
        self.grams[np.repeat(own.end - own.start < 3, self.sizes)] = buckets
        self.begin = np.cumsum(self.sizes) - self.sizes

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Distinct words x labels."""
        if not len(self.sizes):
            return np.zeros((0, weights.shape[1]), dtype=np.float32)
        out = np.add.reduceat(weights[self.grams], self.begin, axis=0)
        for i in range(self.fixed.shape[1]):
            out += weights[self.fixed[:, i]]
        return out

    def add_gradient(self, weights: np.ndarray, g: np.ndarray, rate: float) -> None:
        """Add distinct-word gradients to all buckets they were read from."""
        g = (rate * g).astype(np.float32)
        for i in range(self.fixed.shape[1]):
            np.add.at(weights, self.fixed[:, i], g)
        np.add.at(weights, self.grams, np.repeat(g, self.sizes, axis=0))
        weights[-1] = 0


def chains(row_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, length) of each chain."""
    n = np.diff(row_first)
    per_row = -(-n // CHAIN)
    k = ragged(per_row)
    first = np.repeat(row_first[:-1], per_row) + k * CHAIN
    return first, np.minimum(np.repeat(row_first[1:], per_row) - first, CHAIN)


def forward_backward(emission: np.ndarray, length: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals chains x CHAIN x labels, expected transitions): scaled
    recursions over all chains at once; places beyond a chain are zero."""
    n, steps, k = emission.shape
    live = np.arange(steps)[None, :] < length[:, None]
    psi = np.exp(emission - emission.max(axis=2, keepdims=True))
    psi[~live] = 1
    move = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(psi), np.empty_like(psi)
    for t in range(steps):
        a = psi[:, 0] if t == 0 else np.where(live[:, t, None], (alpha[:, t - 1] @ move) * psi[:, t], alpha[:, t - 1])
        alpha[:, t] = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-30)
    beta[:, -1] = 1
    for t in range(steps - 2, -1, -1):
        b = np.where(live[:, t + 1, None], (beta[:, t + 1] * psi[:, t + 1]) @ move.T, 1)
        beta[:, t] = b / b.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(axis=2, keepdims=True), 1e-30)
    gamma[~live] = 0
    # xi: alpha_t move psi_{t+1} beta_{t+1}, normalised for each place
    right = psi[:, 1:] * beta[:, 1:]
    norm = ((alpha[:, :-1] @ move) * right).sum(axis=2)
    scale = live[:, 1:] / np.maximum(norm, 1e-30)
    pairs = ((alpha[:, :-1] * scale[:, :, None]).reshape(-1, k).T @ right.reshape(-1, k)) * move
    return gamma, pairs


def _block(values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Word rows laid out as chains x CHAIN."""
    at = first[:, None] + np.minimum(np.arange(CHAIN)[None, :], length[:, None] - 1)
    return values[at]


def marginals(model: Model, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first word, end word, their marginals x labels) of bounded blocks, also
    inside one long text."""
    first, length = chains(words.row_first)
    step = max(1, BLOCK_NUMBERS // (CHAIN * len(model.labels)))
    for at in range(0, len(first), step):
        a, n = first[at: at + step], length[at: at + step]
        lo, hi = int(a[0]), int(a[-1] + n[-1])
        begin, end = int(words.start[lo]), int(words.end[hi - 1])
        own = Words(words.data[begin:end], words.start[lo:hi] - begin, words.end[lo:hi] - begin, np.array([0, hi - lo]))
        f = Features(own, len(model.weights) - 1)
        emission = f.emissions(model.weights)[f.of_word]
        gamma, _ = forward_backward(_block(emission, a - lo, n), n, model.transition)
        yield lo, hi, gamma[np.arange(CHAIN)[None, :] < n[:, None]]


def fit(texts: list[str], langs: list[str], seed: int = 11, epochs: int = EPOCHS) -> Model | None:
    if not texts:
        return None
    labels = sorted(set(langs))
    k = len(labels)
    buckets, place = buckets_for(k), {x: i for i, x in enumerate(labels)}
    model = Model(labels, np.zeros((buckets + 1, k), dtype=np.float32), np.zeros((k, k), dtype=np.float32))
    own = np.array([place[x] for x in langs])
    share = np.bincount(own, minlength=k)
    rng = np.random.default_rng(seed)
    rate = 0.1
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for part in _steps(order, np.array([len(x) for x in texts]) * k):
            raw = [texts[i].encode("utf-8") for i in part]
            data = np.frombuffer(b"".join(raw), dtype=np.uint8)
            words = split_words(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]), ALNUM, lower=True)
            if not len(words):
                continue
            f = Features(words, buckets)
            first, length = chains(words.row_first)
            emission = f.emissions(model.weights)[f.of_word]
            gamma, pairs = forward_backward(_block(emission, first, length), length, model.transition)
            live = np.arange(CHAIN)[None, :] < length[:, None]
            expected = np.zeros((len(words), k), dtype=np.float32)
            expected[(first[:, None] + np.arange(CHAIN)[None, :])[live]] = gamma[live]
            y = own[part][words.row]
            weight = (len(texts) / (k * share[y])).astype(np.float32)[:, None]  # languages count alike
            d = -expected
            d[np.arange(len(y)), y] += 1
            d *= weight
            total = np.stack([np.bincount(f.of_word, weights=d[:, j], minlength=len(f.sizes)) for j in range(k)], axis=1)
            seen = np.bincount(f.of_word, minlength=len(f.sizes))[:, None]
            f.add_gradient(model.weights, total / np.sqrt(seen), rate)
            same = np.bincount(y, minlength=k).astype(np.float64) - np.bincount(own[part], weights=-(-np.diff(words.row_first) // CHAIN), minlength=k)
            model.transition += (rate * (np.diag(same) - pairs) / max(1.0, same.sum())).astype(np.float32)
        rate *= 0.5
    return model


def _steps(order: np.ndarray, numbers: np.ndarray) -> Iterator[np.ndarray]:
    """About 24 texts each, fewer where they would take more than STEP_NUMBERS."""
    for part in np.array_split(order, max(1, len(order) // 24)):
        step = (np.cumsum(numbers[part]) - numbers[part]) // STEP_NUMBERS
        yield from np.split(part, np.flatnonzero(np.diff(step)) + 1)


def train(docs: DataFrame, may_learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          per_language: int = PER_LANGUAGE, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fit on a hash sample of the rows that ``may_learn`` allows."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.where(may_learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), F.xxhash64(F.col(doc_id), F.lit(5)).alias("h"),
        F.col(doc_id).isNotNull().alias("known"))
    # a null id does not tell rows apart, their texts do
    rows = rows.withColumn("h", F.when(F.col("known"), F.col("h")).otherwise(F.xxhash64("t", F.lit(5)))).drop("known")
    counts = rows.groupBy("l").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    if not counts:
        return None
    chance = spark.createDataFrame([(r.l, min(1.0, per_language / r.n), r.least) for r in counts], "l string, chance double, least long")
    drawn = (rows.join(F.broadcast(chance), "l")
             .where((F.pmod("h", F.lit(1 << 30)) < F.col("chance") * (1 << 30)) | (F.col("h") == F.col("least")))
             .select("l", "h", "t", F.xxhash64("t").alias("x")).dropDuplicates(["l", "h", "x"]))
    sizes = drawn.groupBy("l").agg(F.collect_list(F.length("t")).alias("n")).collect()
    most = spark.createDataFrame([(r.l, fair_length(r.n, sample_bytes // len(sizes))) for r in sizes], "l string, most int")
    held = drawn.join(F.broadcast(most), "l").select("l", "h", held_to(F.col("t"), F.col("most")).alias("t"))
    texts, langs = [], []
    for r in held.orderBy("h", "t").toLocalIterator():
        texts.append(r.t)
        langs.append(r.l)
    if set(langs) != {r.l for r in counts}:
        raise RuntimeError("a language has labelled texts, but none was taken")
    return fit(texts, langs)


def predict(docs: DataFrame, model: Model | None, text: str = "text", word_labels: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score; ``word_labels`` adds the label of
    each word of the text in order."""
    prepare(docs.sparkSession)
    added = ["lang_pred", "score", *["word_labels"] * word_labels]
    keep = [c for c in docs.columns if c not in added]
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        extra = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")]
        if word_labels:
            extra.append(F.array().cast("array<string>").alias("word_labels"))
        return docs.select(*[f"`{c}`" for c in keep], *extra)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), keep.index(text)  # of fixed size
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], letters.alias("letters"))
    fields = [*plain.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if word_labels:
        fields.append(T.StructField("word_labels", T.ArrayType(T.StringType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            known = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in slices(batch.column(at)):
                words = split_words(data, offs, ALNUM, lower=True)
                row, total = words.row, np.zeros((hi - lo, len(m.labels)))
                label = np.empty(len(words), dtype=np.int32)
                for a, b, gamma in marginals(m, words):
                    at_row = np.flatnonzero(np.append(True, row[a + 1: b] != row[a: b - 1]))
                    total[row[a:b][at_row]] += np.add.reduceat(gamma, at_row, axis=0, dtype=np.float64)
                    label[a:b] = gamma.argmax(axis=1)
                best, n = total.argmax(axis=1), np.maximum(np.diff(words.row_first), 1)
                ok = known[lo:hi].astype(bool)
                share = np.clip(total[np.arange(hi - lo), best] / n, 0, 1)
                out = [*[batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)],
                       pa.array([m.labels[b] if k else UNKNOWN for b, k in zip(best, ok)], pa.string()),
                       pa.array(np.where(ok, share, 0.0))]
                if word_labels:
                    names_of = np.array(m.labels, dtype=object)[label]
                    out.append(pa.ListArray.from_arrays(pa.array(words.row_first, pa.int32()), pa.array(names_of, pa.string())))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return plain.mapInArrow(run, T.StructType(fields)).toDF(*keep, *added)
