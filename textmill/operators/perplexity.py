"""Sampled perplexity with a built-in bigram scorer.

* G1 sample: the first ``sample_size`` rows by a seeded hash order
  (``xxhash64``, or ``md5`` to be reproducible in SQL engines) - a global
  top-k, planned as TakeOrderedAndProject.
* G2 score: add-k smoothed word-bigram model trained on the whole corpus in
  Spark.  Only the bigrams and previous words that occur in the sample are
  counted (a semi-join against the sample's distinct keys), so the counts
  table is bounded by the sample, not by the corpus.  Score =
  exp(mean negative log-likelihood); texts with fewer than two words get
  null.  Whole texts are scored unless ``max_length`` is set.
* G3/G4 statistics and status in one row.

A scorer is a function (corpus, sampled, cfg) -> (original_index, perplexity).
``bigram_scores`` is one; ``batch_scorer`` makes one of any model that scores
lists of texts: it runs over the sample's Arrow batches, loads the model once a
Python worker, and gives null where the model fails.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PerplexityConfig
from ..session import reliable_checkpoint, ship_package

Scorer = Callable[[DataFrame, DataFrame, PerplexityConfig], DataFrame]
Model = Callable[[list[str], int | None], list[float | None]]

IDX = "original_index"
WORD_SPLIT = r"[^\p{L}\p{N}']+"


def words(text):
    return F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")


def sample(df: DataFrame, cfg: PerplexityConfig = PerplexityConfig(), key: str = "xxhash64") -> DataFrame:
    nonblank = df.filter(F.col("text").isNotNull() & (F.trim("text") != ""))
    if key == "md5":
        h = F.md5(F.concat(F.lit(f"{cfg.seed}:"), F.col(IDX).cast("string")))
    else:
        h = F.xxhash64(F.lit(int(cfg.seed)), F.col(IDX))
    return nonblank.orderBy(h, F.col(IDX)).limit(int(cfg.sample_size))


def score_sample(corpus: DataFrame, sampled: DataFrame, cfg: PerplexityConfig = PerplexityConfig(),
                 scorer: Scorer | None = None) -> DataFrame:
    """(original_index, perplexity) for every sampled row."""
    sampled = reliable_checkpoint(sampled.select(IDX, "text"))  # at most sample_size rows, read several times
    return (scorer or bigram_scores)(corpus, sampled, cfg)


#: models of this Python worker by name
_MODELS: dict[str, Model] = {}


def batch_scorer(name: str, load: Callable[[], Model]) -> Scorer:
    """A scorer of a model that ``load`` returns: a function of a list of texts
    and the number of tokens to score at most (None: all), which gives a
    perplexity or None for each.

    Blank texts are not given to the model.  If it raises, the batch's texts are
    given one by one, and those for which it raises again get null, like None, NaN and
    infinity."""
    def scores(corpus: DataFrame, sampled: DataFrame, cfg: PerplexityConfig) -> DataFrame:
        ship_package(sampled.sparkSession)
        most = cfg.max_length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from textmill.operators.perplexity import _MODELS

            if name not in _MODELS:
                _MODELS[name] = load()
            model = _MODELS[name]

            def tried(texts: list[str]) -> list[float | None]:
                try:
                    return list(model(texts, most))
                except Exception:  # noqa: BLE001 - any fault of the model is a null score
                    return [None] if len(texts) == 1 else [x for t in texts for x in tried([t])]

            for batch in batches:
                texts = batch.column(1).to_pylist()
                live = [i for i, t in enumerate(texts) if t and t.strip()]
                out: list[float | None] = [None] * len(texts)
                for i, x in zip(live, tried([texts[i] for i in live]) if live else [], strict=True):
                    out[i] = float(x) if x is not None and math.isfinite(x) else None
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=[IDX, "perplexity"])

        return sampled.select(F.col(IDX).cast("long").alias(IDX), "text").mapInArrow(run, f"{IDX} long, perplexity double")
    return scores


def bigram_scores(corpus: DataFrame, sampled: DataFrame, cfg: PerplexityConfig) -> DataFrame:
    """Add-k bigrams, counted over the corpus for the keys of the sample."""
    k = float(cfg.smoothing)
    sw = sampled.select(IDX, words(F.col("text")).alias("w"))
    if cfg.max_length:
        sw = sw.withColumn("w", F.slice("w", 1, int(cfg.max_length)))
    pairs = sw.select(IDX, F.explode(F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))),
                                                   F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0)))))
                      .alias("p")).select(IDX, F.col("p")["0"].alias("prev"), F.col("p")["1"].alias("cur"))
    keys = pairs.select("prev", "cur").distinct()
    prevs = keys.select("prev").distinct()
    cw = corpus.select(words(F.col("text")).alias("w"))
    cpairs = cw.select(F.explode(F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))),
                                              F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0)))))
                       .alias("p")).select(F.col("p")["0"].alias("prev"), F.col("p")["1"].alias("cur"))
    big = cpairs.join(keys, ["prev", "cur"], "left_semi").groupBy("prev", "cur").agg(F.count(F.lit(1)).alias("c2"))
    # one count of all words gives both the vocabulary and the unigrams
    words_all = reliable_checkpoint(cw.select(F.explode("w").alias("prev")).groupBy("prev").agg(F.count(F.lit(1)).alias("c1")))
    v = words_all.count()
    uni = words_all.join(prevs, "prev", "left_semi")
    scored = (pairs.join(big, ["prev", "cur"], "left").join(uni, "prev", "left")
              .select(IDX, (F.log(F.coalesce("c2", F.lit(0)) + k)
                            - F.log(F.coalesce("c1", F.lit(0)) + F.lit(k * v))).alias("lp")))
    per_doc = scored.groupBy(IDX).agg(F.exp(-F.avg("lp")).alias("perplexity"))
    return sampled.select(IDX).join(per_doc, IDX, "left")


def stats(scores: DataFrame, model_name: str = "bigram") -> DataFrame:
    """mean, median, population std, min, max, p25, p75 (linear), count."""
    p = F.col("perplexity")
    n = F.count(p)
    return scores.agg(
        F.lit(True).alias("enabled"), F.lit(model_name).alias("model_name"),
        n.alias("samples_evaluated"),
        F.avg(p).alias("mean_perplexity"), F.percentile(p, 0.5).alias("median_perplexity"),
        F.stddev_pop(p).alias("std_perplexity"), F.min(p).alias("min_perplexity"),
        F.max(p).alias("max_perplexity"), F.percentile(p, 0.25).alias("p25_perplexity"),
        F.percentile(p, 0.75).alias("p75_perplexity"),
        F.count(F.lit(1)).alias("_rows"),
    ).withColumn("error", F.when(F.col("_rows") == 0, F.lit("no samples"))
                 .when(F.col("samples_evaluated") == 0, F.lit("no valid scores computed"))).drop("_rows")


def disabled(spark) -> DataFrame:
    """The status row of a run without this stage."""
    return spark.createDataFrame([(False, 0, "disabled")], "enabled boolean, samples_evaluated long, error string")
