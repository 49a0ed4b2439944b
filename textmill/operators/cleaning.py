"""Cleaning stage: markup removal, control characters, whitespace, length
bounds.  One projection annotates every row with ``drop_reason``; the kept
rows and the per-reason counts are both read from that annotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..functions import text as T
from .staging import once


def length_reason(n: Column, min_chars: int, max_chars: int) -> Column:
    """Both bounds inclusive, on code points."""
    return (F.when(n < min_chars, F.lit("too_short"))
            .when(n > max_chars, F.lit("too_long")))


def annotate(df: DataFrame, cfg: CleanConfig = CleanConfig(), text_col: str = "text") -> DataFrame:
    """Adds ``original_length``, ``char_length``, ``drop_reason``; replaces
    the text by its cleaned form.  Empty or null text -> ``empty_text``."""
    raw = F.col(text_col)
    cleaned = T.clean_text(raw, cfg.remove_html, cfg.normalize_whitespace, cfg.lowercase)
    out = once(df.withColumn("original_length", F.length(raw).cast("int")), "_clean", cleaned)
    n = F.length("_clean").cast("int")
    reason = (F.when(raw.isNull() | (raw == ""), F.lit("empty_text"))
              .otherwise(length_reason(n, cfg.min_chars, cfg.max_chars)))
    return (out.withColumn("drop_reason", reason)
            .withColumn(text_col, F.when(F.col("drop_reason").isNull(), F.col("_clean")))
            .withColumn("char_length", F.when(F.col("drop_reason").isNull(), n))
            .drop("_clean"))


def kept(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("drop_reason").isNull())


def drop_counts(annotated: DataFrame) -> DataFrame:
    """(drop_reason, n) for the dropped rows: partial + final aggregation."""
    return (annotated.filter(F.col("drop_reason").isNotNull())
            .groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n")))


REASONS = ("empty_text", "too_short", "too_long")


def metric_columns() -> dict[str, Column]:
    """Aggregates over annotated rows: totals and each reason."""
    reason = F.col("drop_reason")
    return {"total_samples": F.count(F.lit(1)), "kept_samples": F.count_if(reason.isNull()),
            "dropped_samples": F.count_if(reason.isNotNull()), **{f"reason__{r}": F.count_if(reason == r) for r in REASONS}}


def metrics(annotated: DataFrame) -> DataFrame:
    """One row: total, kept, dropped."""
    columns = metric_columns()
    return annotated.agg(*[columns[c].alias(c) for c in ("total_samples", "kept_samples", "dropped_samples")])
