"""The report of a run: all metric and chart tables from what the stages
observed, with a guard for every input that is missing.

Stage figures are plain dicts of scalars, observed while the stage was written
(``corpus_run``), so they cost no pass of their own.  The kept rows are read
once for the statistics, which also give the bounds of the histograms and the
quartiles of the box plot; each chart is then one narrow aggregation over the
written stage tables.  Charts are not rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import language, perplexity, report

#: visible range of the chart of characters
CHAR_LIMIT = 20_000
#: score from which a kept row counts as toxic where the safety stage is unknown
TOXIC_SCORE = 1.5

Figures = dict  # name -> scalar


def one_row(spark: SparkSession, figures: Figures) -> DataFrame:
    """A one-row table of scalars."""
    kinds = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
    schema = T.StructType([T.StructField(k, kinds.get(type(v), T.DoubleType())) for k, v in figures.items()])
    return spark.createDataFrame([tuple(figures.values())], schema)


def counts_of(spark: SparkSession, figures: Figures | None, prefix: str, name: str) -> DataFrame:
    """(name, n) of the figures ``prefix__...`` that are not zero."""
    rows = [(k[len(prefix) + 2:], int(v)) for k, v in (figures or {}).items() if k.startswith(prefix + "__") and v]
    return spark.createDataFrame(sorted(rows, key=lambda r: (-r[1], r[0])), f"{name} string, n long")


def drop_reason_counts(clean: Figures | None, safety: Figures | None, tokens: Figures | None, dedup: Figures | None,
                       kept_reasons: dict | None = None) -> dict[str, int]:
    """Dropped rows by stage and reason; zeros are left out.  Without the
    cleaning stage, its reasons are taken from the kept rows."""
    def reasons(figures: Figures | None) -> dict:
        return {k.removeprefix("reason__"): int(v) for k, v in (figures or {}).items() if k.startswith("reason__") and v}

    cleaning = reasons(clean) if clean is not None else {
        k: n for k, n in (kept_reasons or {}).items() if k in ("too_short", "too_long")}
    out = {f"cleaning_{k}": n for k, n in cleaning.items()}
    out |= {f"safety_{k}": int(safety[c]) for k, c in (("toxic", "toxic_dropped"), ("contains_pii", "pii_dropped"))
            if safety and safety[c]}
    out |= {f"tokenization_{k}": n for k, n in reasons(tokens).items()}
    if dedup and dedup["duplicates_removed"]:
        out["deduplication_duplicate"] = int(dedup["duplicates_removed"])
    return out


def kept_figures(kept: DataFrame) -> Figures:
    """Statistics of the kept rows in one pass; what a missing column would
    give is left out."""
    have = kept.columns
    chars = F.col("char_length") if "char_length" in have else F.length("text") if "text" in have else None
    columns = {"total_samples": F.count(F.lit(1))}
    for prefix, c in (("token", F.col("token_count") if "token_count" in have else None), ("char", chars)):
        if c is not None:
            columns |= {f"n_{prefix}": F.count(c), f"avg_{prefix}_length": F.avg(c), f"median_{prefix}_length": F.percentile(c, 0.5),
                        f"min_{prefix}_length": F.min(c), f"max_{prefix}_length": F.max(c),
                        f"q1_{prefix}": F.percentile(c, 0.25), f"q3_{prefix}": F.percentile(c, 0.75)}
    if "pii" in have:
        columns["pii_hits"] = F.coalesce(F.sum(F.when(F.col("pii.has_pii"), F.size("pii.pii_types"))), F.lit(0))
    if "toxicity" in have:
        columns["toxic_rows"] = F.count_if(F.col("toxicity.score") >= TOXIC_SCORE)
    return kept.agg(*[v.alias(k) for k, v in columns.items()]).first().asDict()


def statistics(figures: Figures, safety: Figures | None, dedup: Figures | None) -> Figures:
    """The kept rows' statistics with the rates of the stages; without the
    safety stage its rates come from the kept rows, without deduplication its
    rate is 0."""
    n = figures["total_samples"]
    if safety is not None:
        rows, toxic, pii = safety["total_samples"], safety["toxic_dropped"], safety["pii_dropped"]
    else:
        rows, toxic, pii = n, figures.get("toxic_rows", 0), figures.get("pii_hits", 0)
    out = {"total_samples": n, "duplicate_rate": float(dedup["duplicate_rate"]) if dedup else 0.0,
           "pii_detection_rate": pii / rows if rows else 0.0, "toxicity_rate": toxic / rows if rows else 0.0}
    for prefix in ("token", "char"):
        if figures.get(f"n_{prefix}"):
            names = ("avg", "median", "min", "max") if prefix == "token" else ("avg", "median")
            out |= {f"{x}_{prefix}_length": float(figures[f"{x}_{prefix}_length"]) for x in names}
    return out


def throughput(spark: SparkSession, stages: list[tuple], final_rows: int, seconds: float) -> DataFrame:
    """(kind, stage, rows_in, rows_out, seconds, rows_per_sec): a row a stage,
    then total, average and peak."""
    rows = [("stage", *s) for s in stages]
    if stages:
        timed = [s for s in stages if s[2]]
        peak = max(timed or stages, key=lambda s: s[4])
        rate = final_rows / seconds if seconds > 0 else 0.0
        rows += [("total", "run", stages[0][1], final_rows, seconds, rate),
                 ("average", "run", None, final_rows, seconds, rate),
                 ("peak", peak[0], peak[1], peak[2], peak[3], peak[4])]
    return spark.createDataFrame(rows, "kind string, stage string, rows_in long, rows_out long, seconds double, rows_per_sec double")


def summary(kept: Figures, languages: dict[str, int] | None = None, target: str = "en", clean: Figures | None = None,
            safety: Figures | None = None, dedup: Figures | None = None, tokens: Figures | None = None,
            rates: tuple[float, float] | None = None) -> list[tuple[str, float]]:
    """(metric, value) over all stages that are there, in the order of the
    summary table; rates are shares, not per cent."""
    out: list[tuple[str, float]] = []
    if dedup:
        out += [("samples_after_deduplication", dedup["kept_samples"]), ("duplicates_removed", dedup["duplicates_removed"]),
                ("duplicate_rate", dedup["duplicate_rate"])]
    if clean:
        out.append(("samples_after_cleaning", clean["kept_samples"]))
    if tokens:
        out += [("samples_after_tokenization", tokens["kept_samples"]), ("avg_token_length", tokens["avg_token_length"]),
                ("median_token_length", tokens["median_token_length"])]
    if safety:
        n = safety["total_samples"]
        out += [("samples_after_safety", safety["kept_samples"]), ("toxic_dropped", safety["toxic_dropped"]),
                ("pii_dropped", safety["pii_dropped"]), ("pii_detection_rate", safety["pii_dropped"] / n if n else 0.0),
                ("toxicity_rate", safety["toxic_dropped"] / n if n else 0.0)]
    loaded = sum((languages or {}).values())
    if languages:
        out += [("samples_loaded", loaded), ("samples_after_language_filter", languages.get(target, 0))]
    out.append(("final_samples", kept["total_samples"]))
    if loaded:
        out.append(("retention_rate", kept["total_samples"] / loaded))
    if rates:
        out += [("average_rows_per_sec", rates[0]), ("peak_rows_per_sec", rates[1])]
    return [(k, float(v)) for k, v in out]


def build(kept: DataFrame, languages: DataFrame | None = None, target: str = "en", clean: Figures | None = None,
          safety: Figures | None = None, flagged: DataFrame | None = None, dedup: Figures | None = None,
          tokens: Figures | None = None, scores: DataFrame | None = None, stages: list[tuple] | None = None,
          seconds: float = 0.0) -> dict[str, DataFrame]:
    """The report's tables by name; a table whose input is missing is not there.

    ``kept`` are the final rows; ``languages`` (language, n); ``clean``, ``safety``,
    ``dedup`` and ``tokens`` the figures of these stages (``metric_columns``);
    ``flagged`` (token, n); ``scores`` the sampled perplexities; ``stages`` rows
    (stage, rows_in, rows_out, seconds, rows_per_sec)."""
    spark = kept.sparkSession
    out: dict[str, DataFrame] = {}
    figures = kept_figures(kept)
    out["statistics"] = one_row(spark, statistics(figures, safety, dedup))
    for prefix, col, limit in (("token", "token_count", None), ("char", "char_length", CHAR_LIMIT)):
        if col in kept.columns and figures.get(f"n_{prefix}"):
            bounds = figures[f"min_{prefix}_length"], figures[f"max_{prefix}_length"]
            out[f"{prefix}_histogram"] = report.histogram(kept, col, 50, limit, bounds)
            out[f"{prefix}_boxplot"] = report.boxplot(kept, col, [figures[f"q1_{prefix}"], figures[f"median_{prefix}_length"],
                                                                  figures[f"q3_{prefix}"]])
    kept_reasons = None
    if "drop_reason" in kept.columns:
        out["kept_drop_reasons"] = report.final_reasons(kept)
        if clean is None:
            kept_reasons = {r.reason: r.n for r in out["kept_drop_reasons"].collect()}  # a row a reason
    drops = drop_reason_counts(clean, safety, tokens, dedup, kept_reasons)
    out["drop_reason_counts"] = spark.createDataFrame(sorted(drops.items(), key=lambda x: (-x[1], x[0])), "reason string, n long")
    if clean is not None:
        out["cleaning_drop_reasons"] = counts_of(spark, clean, "reason", "drop_reason")
    if safety is not None:
        out["pii_type_counts"] = counts_of(spark, safety, "pii", "pii_type")
        out["prefilter_tags"] = counts_of(spark, safety, "tag", "tag")
    elif "pii" in kept.columns:
        out["pii_type_counts"] = (kept.select(F.explode(F.when(F.col("pii.has_pii"), F.col("pii.pii_types"))).alias("pii_type"))
                                  .groupBy("pii_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "pii_type"))
    if flagged is not None:
        out["toxic_removals"] = flagged
    listed = None
    if languages is not None:
        listed = {r.language: r.n for r in languages.collect()}  # a row a language
        out["language_distribution"] = language.shares(languages)
        out["language_top"] = language.top_k(languages, 5)
    if scores is not None:
        out["perplexity_histogram"] = report.histogram(scores, "perplexity", 50)
        out["perplexity_stats"] = perplexity.stats(scores)
    else:
        out["perplexity_stats"] = perplexity.disabled(spark)
    rates = None
    if stages:
        n = figures["total_samples"]
        out["throughput"] = throughput(spark, stages, n, seconds)
        rates = (n / seconds if seconds > 0 else 0.0, max(s[4] for s in stages))
    out["summary"] = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(summary(figures, listed, target, clean, safety, dedup, tokens, rates))],
        "place int, metric string, value double")
    return out
