"""The row-level stages run unchanged on a streaming DataFrame and give the
same drops as the batch transforms."""

import os

from pyspark.sql import functions as F

from textmill.operators import cleaning, safety
from textmill.session import scratch_path
from textmill.sources import tables
from textmill.streaming import rowwise
from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    out = []

    def collect(batch_df, epoch_id):
        out.extend(r.asDict() for r in batch_df.select("original_index", "stage_drop").collect())

    stream = rowwise.document_stream(spark, os.path.join(SF_SMALL, "documents.parquet"))
    q = rowwise.write_batches(rowwise.annotate_stream(stream), collect, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination(300)
    got = {r["original_index"]: r["stage_drop"] for r in out}

    batch = cleaning.annotate(tables.documents(spark, SF_SMALL)).withColumnRenamed("drop_reason", "clean_drop")
    ok = F.col("clean_drop").isNull()
    ann = safety.annotate(batch.withColumn("text", F.when(ok, F.col("text"))))
    expect = {r[0]: r[1] for r in ann.select(
        "original_index",
        F.when(~ok, F.concat(F.lit("cleaning_"), "clean_drop"))
        .when(F.col("drop_reason").isNotNull(), F.concat(F.lit("safety_"), "drop_reason"))).collect()}
    assert got == expect
