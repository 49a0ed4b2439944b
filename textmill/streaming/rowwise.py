"""Row-level stages on a stream.

Cleaning, safety (prefilter, toxicity, PII) and fingerprints are
stateless per row, so the same transforms apply to a streaming DataFrame.
Stages that need the whole corpus (first-occurrence dedup, packing,
shuffling) are batch-only; ``write_batches`` hands each micro-batch to a
batch function, which may run them per batch."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig, SafetyConfig
from ..operators import cleaning, safety


def document_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                    max_files_per_trigger: int = 1) -> DataFrame:
    """documents-shaped files -> stream of (original_index, text, url, language)."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt)
    if path.rstrip("/").endswith("." + fmt):  # one file: stream its folder, filtered to its name
        folder, name = path.rstrip("/").rsplit("/", 1)
        raw = reader.option("pathGlobFilter", name).load(folder)
    else:
        raw = reader.load(path)
    return raw.select(F.col("doc_id").alias("original_index"), "text",
                      F.lit(None).cast("string").alias("url"), F.col("lang").alias("language"))


def annotate_stream(stream: DataFrame, clean_cfg: CleanConfig = CleanConfig(),
                    safety_cfg: SafetyConfig = SafetyConfig()) -> DataFrame:
    """clean + safety annotation; ``stage_drop`` names the first stage that
    drops the row (null = kept)."""
    cleaned = cleaning.annotate(stream, clean_cfg).withColumnRenamed("drop_reason", "clean_drop")
    text_ok = F.col("clean_drop").isNull()
    annotated = safety.annotate(cleaned.withColumn("text", F.when(text_ok, F.col("text"))), safety_cfg)
    return annotated.withColumn(
        "stage_drop", F.when(~text_ok, F.concat(F.lit("cleaning_"), "clean_drop"))
        .when(F.col("drop_reason").isNotNull(), F.concat(F.lit("safety_"), "drop_reason")))


def write_batches(annotated: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  once: bool = True):
    """foreachBatch sink with a checkpoint location (exactly-once batch ids)."""
    w = annotated.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w
    return w.start()
