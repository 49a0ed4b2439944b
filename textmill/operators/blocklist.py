"""A blocklist kept as a table (word, weight), of any size.

A small table (its counted size is checked) is broadcast and looked up row by
row in Arrow batches: no shuffle, and the plan does not grow with the words.
Beyond the bound the words of the rows are exploded and joined to the table.
Both give the same hits as the literal map of a configuration."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_package

BROADCAST_BYTES = 32 << 20
ENTRY_BYTES = 150  # of a word in a Python dict, besides its letters
SALTS = 16
FOUND_T = "array<struct<word:string,weight:double>>"


def weighted_words(table: DataFrame) -> DataFrame:
    """(word, weight) in lower case, a row a word: empty words and zero weights
    go, a missing weight is 1, of several weights the largest counts."""
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in table.columns else F.lit(1.0)
    return (table.select(F.lower("word").alias("word"), weight.alias("weight")).where("word != ''")
            .groupBy("word").agg(F.max("weight").alias("weight")).where("weight != 0"))


def add_found(df: DataFrame, words: str, table: DataFrame, out: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Adds ``out``: the listed ones of the array column ``words``, in order and
    with their weights; empty for null."""
    spark = df.sparkSession
    listed = reliable_checkpoint(weighted_words(table))
    size = listed.agg(F.coalesce(F.sum(F.octet_length("word")), F.lit(0)) + F.count("*") * ENTRY_BYTES).first()[0]
    if size <= broadcast_bytes:
        ship_package(spark)
        shared = spark.sparkContext.broadcast({r.word: r.weight for r in listed.toLocalIterator()})
        return df.withColumn(out, F.coalesce(_looked_up(shared)(F.col(words)), F.array().cast(FOUND_T)))
    rows = reliable_checkpoint(df.withColumn("_row", F.monotonically_increasing_id()))  # the number must not change
    salt = F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int").alias("salt")
    each = rows.select("_row", salt, F.posexplode(words).alias("pos", "word"))
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = each.join(salted, ["word", "salt"]).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("pos", "word", "weight"))).alias("hits"))  # at most the words of a row
    found = F.transform("hits", lambda x: F.struct(x["word"].alias("word"), x["weight"].alias("weight")))
    return rows.join(hits.select("_row", found.alias(out)), "_row", "left").withColumn(
        out, F.coalesce(out, F.array().cast(FOUND_T))).drop("_row")


def _looked_up(shared):
    @F.arrow_udf(FOUND_T)
    def look_up(words: pa.Array) -> pa.Array:
        weights = shared.value
        flat = words.flatten().to_pylist()
        n = words.value_lengths().fill_null(0).to_pylist()
        at, names, values, ends = 0, [], [], [0]
        for k in n:
            for w in flat[at: at + k]:
                if w in weights:
                    names.append(w)
                    values.append(weights[w])
            at += k
            ends.append(len(names))
        found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], names=["word", "weight"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
    return look_up

