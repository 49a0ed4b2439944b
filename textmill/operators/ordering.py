"""Global order without a single partition.

A running sum (or rank) in the order of a key: the rows, narrowed to what the
order and the sum need, are range-partitioned by the key and written once with
the number of their range; a window sums inside each range, and per-range
totals (a row per partition) give each range its offset.  Nothing is assumed
of the keys (dense or sparse, numbers or hashes), and the size of a range
follows from the session's partition count.  Callers join the result back by
key; texts and tokens never pass through the windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import reliable_checkpoint


def exclusive_prefix_sum(df: DataFrame, order: list, value: Column, out: str) -> DataFrame:
    """``df`` (a narrow frame) with ``out`` = sum of ``value`` over all rows
    before this one in ``order``."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.withColumn("_val", value.cast("long")).repartitionByRange(parts, *order)
    rows = reliable_checkpoint(ranged.withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    totals = rows.groupBy("_range").agg(F.sum("_val").alias("_t"))
    offsets = totals.select("_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    return (rows.withColumn("_within", F.coalesce(F.sum("_val").over(within), F.lit(0)))
            .join(F.broadcast(offsets), "_range")
            .withColumn(out, (F.col("_off") + F.col("_within")).cast("long"))
            .drop("_range", "_val", "_within", "_off"))


def rank(df: DataFrame, order: list, out: str = "rank") -> DataFrame:
    """0-based dense position in ``order``."""
    return exclusive_prefix_sum(df, order, F.lit(1), out)
