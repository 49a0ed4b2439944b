"""The driver's parquet tables mapped onto the row model.

Only the needed columns are selected, so the scan prunes the rest
(``ReadSchema`` shows the projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> (original_index, text, url, language, source).

    ``doc_id`` is the dense order column; ``lang`` is the language label."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("original_index"),
        F.col("text"),
        F.lit(None).cast("string").alias("url"),
        F.col("lang").alias("language"),
        F.col("source"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> (original_index, text, url): raw HTML as the document text."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("long").alias("original_index"),
        F.col("html").alias("text"),
        F.col("url"),
    )
