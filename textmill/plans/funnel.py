"""The minimum slice: documents -> clean -> PII -> exact dedup, reported as
rows per (language, outcome)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..functions import pii as PII
from ..operators import cleaning, dedup
from ..sources import tables


def funnel(spark: SparkSession, sf_dir: str, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    annotated = cleaning.annotate(docs, cfg)
    cleaned = cleaning.kept(annotated).withColumn("pii", PII.detect_pii(F.col("text")))
    no_pii = cleaned.filter(~F.col("pii.has_pii"))
    deduped = dedup.annotate_exact(no_pii)
    outcome = (annotated.filter(F.col("drop_reason").isNotNull())
               .select("language", F.concat(F.lit("cleaning_"), F.col("drop_reason")).alias("outcome"))
               .unionByName(cleaned.filter(F.col("pii.has_pii"))
                            .select("language", F.lit("safety_contains_pii").alias("outcome")))
               .unionByName(deduped.select("language", F.when(F.col("is_duplicate"), "deduplication_duplicate")
                                           .otherwise("kept").alias("outcome"))))
    return outcome.groupBy("language", "outcome").agg(F.count(F.lit(1)).alias("n"))
