"""Safety stage: prefilter -> toxicity (skipped for 'safe' rows) -> PII
(skipped for toxic rows) -> keep / drop, with stage metrics.

The three result structs are computed in one projection; CASE branches
short-circuit, so skipped rows never evaluate the skipped rules.  Callers
that read the annotation more than once (metrics and filter) should persist
it first (``plans.corpus_run`` does)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SafetyConfig
from ..functions import pii as PII
from ..functions import patterns as P
from ..functions import safety as S
from .blocklist import add_found


def annotate(df: DataFrame, cfg: SafetyConfig = SafetyConfig(), text_col: str = "text",
             blocklist: DataFrame | None = None) -> DataFrame:
    """Adds prefilter, toxicity, pii and drop_reason.  ``blocklist`` (word, weight)
    takes the place of the configuration's words; it may be of any size."""
    find = None if blocklist is None else lambda rows, words, out: add_found(rows, words, blocklist, out)
    text = F.col(text_col)
    empty = text.isNull() | (text == "")
    out = S.add_prefilter(df, text_col, cfg, "prefilter")
    pf = F.col("prefilter")
    skip = (pf["tag"] == "safe") & F.lit(bool(cfg.prefilter_safe_skip_toxicity) and bool(cfg.enabled))
    out = S.add_toxicity(out, text_col, "prefilter", cfg, "_scored", active=~empty & ~skip, find=find)
    tox = (F.when(empty, S.empty_toxicity(pf["tag"]))
           .when(skip, S.empty_toxicity(F.lit("safe"), "prefilter_safe", pf["metadata"]["safe_reasons"]))
           .otherwise(F.col("_scored")))
    out = out.withColumn("toxicity", tox).drop("_scored")
    ents = tuple(e for e in cfg.pii_entities if e in P.PII_J)
    toxic = F.lit(False) if not cfg.enabled else (~skip & F.coalesce(F.col("toxicity.is_toxic"), F.lit(False)))
    out = out.withColumn("_toxic", toxic)
    if cfg.enable_pii and ents:
        # counts staged in their own column; toxic rows are not scanned
        out = out.withColumn("_pii_n", F.when(~empty & ~F.col("_toxic"), PII.pii_counts(text, ents, cfg.max_chars_scanned)))
        detected = PII.detect_pii_from_counts(F.col("_pii_n"), ents, cfg.pii_max_matches)
        out = out.withColumn("pii", F.when(F.col("_pii_n").isNull(), PII.empty_pii()).otherwise(detected))
    else:
        out = out.withColumn("pii", PII.empty_pii())
    if not cfg.enabled:
        return out.withColumn("drop_reason", F.lit(None).cast("string")).drop("_toxic", "_pii_n")
    reason = (F.when(empty, F.lit(None))
              .when(F.col("_toxic"), F.lit("toxic"))
              .when(F.col("pii.has_pii"), F.lit("contains_pii")))
    return out.withColumn("drop_reason", reason.cast("string")).drop("_toxic", "_pii_n")


def kept(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("drop_reason").isNull())


def _scored(text_col: str = "text"):
    """Rows that went through toxicity scoring."""
    t = F.col(text_col)
    return ~(t.isNull() | (t == "")) & F.col("toxicity.signals.skip_reason").isNull()


def _times(entity: str) -> Column:
    """Occurrences of a PII type in a row."""
    return F.size(F.filter("pii.pii_types", lambda y: y == entity))


TAGS = ("safe", "unknown", "suspect")


def metric_columns(text_col: str = "text", entities: tuple[str, ...] = tuple(P.PII_ENTITIES)) -> dict[str, Column]:
    """Aggregates over annotated rows: totals, drops and averages, rows of each
    prefilter tag, PII hits of each type in rows dropped for PII.  Averages of
    scanned characters and scores divide by all non-empty rows (skipped ones
    included); the window average divides by scored rows only."""
    t = F.col(text_col)
    empty = t.isNull() | (t == "")
    scored = _scored(text_col)
    total = F.count(F.lit(1))
    empties = F.count_if(empty)
    n_scored = F.count_if(scored)
    nonempty = F.greatest(F.lit(1), total - empties)
    pii = F.col("drop_reason") == "contains_pii"
    return {
        "total_samples": total,
        "kept_samples": F.count_if(F.col("drop_reason").isNull()),
        "toxic_dropped": F.count_if(F.col("drop_reason") == "toxic"),
        "pii_dropped": F.count_if(pii),
        "empty_texts": empties,
        "avg_chars_scanned": F.coalesce(F.sum(F.when(scored, F.col("toxicity.char_span"))), F.lit(0)) / nonempty,
        "avg_toxicity_score": F.coalesce(F.sum(F.when(scored, F.col("toxicity.score"))), F.lit(0.0)) / nonempty,
        "avg_windows_scored": F.when(n_scored > 0, F.sum(F.when(scored, F.col("toxicity.signals.window_count"))) / n_scored)
        .otherwise(F.lit(0.0)),
        **{f"tag__{x}": F.count_if(F.col("prefilter.tag") == x) for x in TAGS},
        **{f"pii__{x}": F.coalesce(F.sum(F.when(pii, _times(x))), F.lit(0)) for x in entities},
    }


def metrics(annotated: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: totals, drops and averages."""
    return annotated.agg(*[v.alias(k) for k, v in metric_columns(text_col).items() if "__" not in k])


def prefilter_counts(annotated: DataFrame) -> DataFrame:
    """(tag, n) of the prefilter over all rows."""
    return annotated.groupBy(F.col("prefilter.tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def flagged_token_top(annotated: DataFrame, k: int = 20, id_col: str = "original_index") -> DataFrame:
    """Most frequent flagged tokens over all scored rows; ties by first
    occurrence (document order, then position).

    Rows are selected inside the generator (``explode`` of a conditional
    array), not by a filter: a filter on a derived column would be pushed
    below the projection and re-evaluate the whole rule set."""
    tokens = F.when(_scored(), F.col("toxicity.flagged_tokens"))
    ex = annotated.select(id_col, F.posexplode(tokens).alias("pos", "token"))
    agg = ex.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(id_col, "pos")).alias("_first"))
    return agg.orderBy(F.desc("n"), F.asc("_first")).limit(k).drop("_first")


def pii_type_counts(annotated: DataFrame) -> DataFrame:
    """PII hits (capped by the match budget) of rows dropped for PII."""
    types = F.when(F.col("drop_reason") == "contains_pii", F.col("pii.pii_types"))
    return (annotated.select(F.explode(types).alias("pii_type"))
            .groupBy("pii_type").agg(F.count(F.lit(1)).alias("n")))
