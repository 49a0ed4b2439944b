"""Contiguous shards of nearly equal bytes (DataFrame functions only).

Rows are ordered by the key.  Narrow rows (key, size, check sum; no text) are
range-partitioned by that order and written once, with the number of their
range; per-range totals give each range its global byte and row offset, so a
running sum inside each range is a global prefix sum and no task sees more
than its range.  Shard = the target interval of ``total / shards`` bytes that
holds the row's middle byte.

Defined results: null text counts as empty (size = ``overhead``); rows of
equal key are ordered by text check sum and size, so repeated rows stay apart
and deterministic; null keys come first; an empty table gives no rows; extra
columns are not carried (join on the key), so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.store import partitions, written


def text_size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                   overhead: int = 8) -> DataFrame:
    """(key, size, text_crc32, shard, slot): shard 0..shards-1, contiguous in
    key order; slot counts the rows of a shard from 0 in that order."""
    narrow = docs.select(
        F.col(key).alias("key"),
        text_size(F.col(text), overhead).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
    )
    order = ["key", "crc", "size"]
    ranged = narrow.repartitionByRange(partitions(docs.sparkSession), *[F.col(c).asc_nulls_first() for c in order])
    # the range number is fixed by writing it: a later re-run may sample other ranges
    rows = written(ranged.withColumn("range", F.spark_partition_id()), "shard-rows")

    # one row per range: totals, then exclusive prefix sums over the ranges
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), zero).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), zero).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.join(F.broadcast(offsets), "range")  # a row per range: bounded by the partition count
        .withColumn("end", F.col("bytes_before") + F.sum("size").over(upto))
        .withColumn("index", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
            f"CAST((2 * end - size) * {shards} DIV (2 * GREATEST(total, 1)) AS INT)")))
    )
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # a row per shard
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("index") - F.col("first")).alias("slot"))
