"""Metric and chart tables: kept-row statistics, histograms, box-plot
summary, unified drop table, long (metric, value) table.  Charts are not
rendered; each chart's data is a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def length_stats(df: DataFrame, col: str, prefix: str) -> DataFrame:
    c = F.col(col)
    return df.agg(F.avg(c).alias(f"avg_{prefix}"), F.percentile(c, 0.5).alias(f"median_{prefix}"),
                  F.min(c).alias(f"min_{prefix}"), F.max(c).alias(f"max_{prefix}"),
                  F.count(c).alias(f"n_{prefix}"))


def histogram(df: DataFrame, col: str, bins: int = 50, upper_limit: float | None = None,
              bounds: tuple[float, float] | None = None) -> DataFrame:
    """``bins`` equal-width bins between min and max (``bounds``, if already
    known), the last closed; empty bins are present with n = 0.  ``upper_limit``
    keeps the bins whose lower edge is below it (the chart's visible range)."""
    spark: SparkSession = df.sparkSession
    if bounds is None:  # two passes over the column, written once
        df = reliable_checkpoint(df.select(col))
        bounds = tuple(df.agg(F.min(col), F.max(col)).first())  # two scalars
    if bounds[0] is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n long")
    lo, hi = float(bounds[0]), float(bounds[1])
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.when(x >= F.lit(hi), F.lit(bins - 1)).otherwise(F.floor((x - F.lit(lo)) / F.lit(width))).cast("int")
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    scaffold = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (scaffold.join(counts, "bin", "left")
           .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                   (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                   F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    if upper_limit is not None:
        out = out.filter(F.col("lower") < F.lit(float(upper_limit)))
    return out


def boxplot(df: DataFrame, col: str, quartiles: list[float] | None = None) -> DataFrame:
    """Quartiles (linear; ``quartiles``, if already known), whiskers = extreme
    values within 1.5 IQR."""
    c = F.col(col)
    q = quartiles if quartiles is not None else df.agg(F.percentile(c, [0.25, 0.5, 0.75]).alias("q")).first()["q"]
    if q is None or q[0] is None:
        return df.sparkSession.createDataFrame([], "q1 double, median double, q3 double, whisker_low double, "
                                                   "whisker_high double, avg double, min double, max double")
    q1, med, q3 = (float(v) for v in q)
    iqr = q3 - q1
    lo_fence, hi_fence = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
        F.min(F.when(c >= F.lit(lo_fence), c)).cast("double").alias("whisker_low"),
        F.max(F.when(c <= F.lit(hi_fence), c)).cast("double").alias("whisker_high"),
        F.avg(c).alias("avg"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))


def drop_summary(clean_drops: DataFrame | None = None, safety_metrics: DataFrame | None = None,
                 token_drops: DataFrame | None = None, dedup_metrics: DataFrame | None = None) -> DataFrame:
    """Unified (reason, n) with stage prefixes; zero safety and dedup
    counts are omitted."""
    parts = []
    if clean_drops is not None:
        parts.append(clean_drops.select(F.concat(F.lit("cleaning_"), "drop_reason").alias("reason"), "n"))
    if safety_metrics is not None:
        parts.append(safety_metrics.select(F.lit("safety_toxic").alias("reason"), F.col("toxic_dropped").alias("n")))
        parts.append(safety_metrics.select(F.lit("safety_contains_pii").alias("reason"), F.col("pii_dropped").alias("n")))
    if token_drops is not None:
        parts.append(token_drops.select(F.concat(F.lit("tokenization_"), "drop_reason").alias("reason"), "n"))
    if dedup_metrics is not None:
        parts.append(dedup_metrics.select(F.lit("deduplication_duplicate").alias("reason"),
                                          F.col("duplicates_removed").alias("n")))
    if not parts:
        raise ValueError("no stage tables given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(~(F.col("reason").startswith("safety_") | F.col("reason").startswith("dedup")) | (F.col("n") > 0))


def rates(safety_metrics: DataFrame) -> DataFrame:
    """Share of the rows entering the safety stage that it drops, by reason."""
    n = F.col("total_samples")
    return safety_metrics.select(*[F.when(n > 0, F.col(c) / n).otherwise(F.lit(0.0)).alias(a) for c, a in (
        ("pii_dropped", "pii_detection_rate"), ("toxic_dropped", "toxicity_rate"))])


def final_reasons(kept: DataFrame) -> DataFrame:
    """Drop reasons left on kept rows (none, unless a stage kept a dropped row)."""
    return kept.where("drop_reason IS NOT NULL").groupBy(F.col("drop_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def summary_table(tables: dict[str, DataFrame], rows_with_text: int, rows_final: int) -> DataFrame:
    """(metric, value) of one-row tables by prefix, and the retention."""
    any_table = next(iter(tables.values()))
    keep = any_table.sparkSession.createDataFrame(
        [("retention", str(rows_final / rows_with_text if rows_with_text else 0.0))], "metric string, value string")
    for prefix, table in tables.items():
        keep = keep.unionByName(long_table(table, f"{prefix}_"))
    return keep


def long_table(one_row: DataFrame, prefix: str = "") -> DataFrame:
    """One-row metrics DataFrame -> (metric, value) rows (values as text)."""
    cols = one_row.columns
    stack = ", ".join(f"'{prefix}{c}', CAST(`{c}` AS STRING)" for c in cols)
    return one_row.selectExpr(f"stack({len(cols)}, {stack}) as (metric, value)")
