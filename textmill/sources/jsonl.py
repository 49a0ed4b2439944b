"""JSONL scan with the dense row index of the input order.

One object per line; lines are stripped, blank lines skipped; a line that
is not a JSON object is counted as corrupt.  A missing, null or empty text, and
the falsy values 0, false, [] and {}, are no document and take no index; any
other value that is not a string takes its index but has no language
(``unknown``), so no document comes of it.  ``original_index`` counts in file
order (files by path, then by position).

The index is built per file split: ``(file_path, file_block_start)`` is a
bucket of consecutive lines whose size is bounded by the split size; a
window inside each bucket numbers its rows, and each bucket is shifted by
the number of valid rows in the buckets before it (a table with one row per
split)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

SCHEMA = "text string, url string"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def load_jsonl(spark: SparkSession, path: str, with_status: bool = False) -> DataFrame:
    """-> (original_index, text, url); with ``with_status`` every non-blank
    line is returned with ``status`` in ('ok', 'corrupt', 'no_text')."""
    lines = read_lines(spark, path)
    stripped = F.trim(F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    parsed = (lines.withColumn("_line", stripped).filter(F.col("_line") != "")
              .withColumn("_obj", F.when(F.col("_line").startswith("{"), F.from_json("_line", SCHEMA))))
    # from_json yields a struct of nulls for a malformed object; the key
    # list is null for anything that is not a valid JSON object
    raw = F.variant_get(F.try_parse_json("_line"), "$.text", "variant")
    kind = F.schema_of_variant(raw)
    shown = F.col("_obj.text")
    falsy = shown.isNull() | shown.isin("", "[]", "{}", "false") | (shown.try_cast("double") == 0)
    status = (F.when(F.col("_obj").isNull() | F.json_object_keys("_line").isNull(), F.lit("corrupt"))
              .when(F.when(kind == "STRING", shown == "").otherwise(falsy), F.lit("no_text"))
              .when(kind != "STRING", F.lit("not_string"))
              .otherwise(F.lit("ok")))
    rows = parsed.withColumn("status", status)
    valid = rows.filter(F.col("status").isin("ok", "not_string")).select("_file", "_block", "_pos", "status", "_obj")
    within = valid.withColumn("_r", F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_pos")) - 1)
    per_split = valid.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_split.select("_file", "_block", F.coalesce(F.sum("_n").over(
        Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    indexed = (within.join(offsets, ["_file", "_block"]).filter(F.col("status") == "ok")
               .select((F.col("_off") + F.col("_r")).cast("long").alias("original_index"),
                       F.col("_obj.text").alias("text"), F.col("_obj.url").alias("url")))
    if with_status:
        return rows.select("_file", "_pos", "status")
    return indexed


def load_counts(spark: SparkSession, path: str) -> DataFrame:
    """(status, n) over non-blank lines: corrupt lines are counted, not
    only logged."""
    return load_jsonl(spark, path, with_status=True).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
