"""Corpus pipeline: stages over ``documents``, each one operator of the llm
subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; other columns of the input pass
through.  Rows are dropped by the first, second and fourth stage, the third
shortens texts (and renews ``n_chars`` of these), the last places pieces.

Defined results: null or empty texts pass every filter and are packed as the
end id alone; null ids pass; repeated rows are near duplicates of each other, so
one stays; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontaminate, near_dup, packing, recompress, toxicity
from textmill.llm.store import mark_written, release_written, written
from textmill.sources.tables import table

#: words of a repeated passage: shorter repeats are left alone
REPEAT_WORDS = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    may_learn = toxicity.fold(F.col("doc_id"), 5) != 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), may_learn)
    scored = toxicity.score(docs.withColumnsRenamed({"score": "score_before"}), model)
    return scored.where("score < 0.5").drop("score").withColumnsRenamed({"score_before": "score"}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id."""
    return near_dup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``REPEAT_WORDS`` words or more that occur again go."""
    out = recompress.remove_repeats(docs.withColumnsRenamed({"n_words": "words_before", "n_removed": "removed_before"}),
                                    window=REPEAT_WORDS)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.drop("n_words", "n_removed").withColumnsRenamed(
        {"words_before": "n_words", "removed_before": "n_removed"}).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in 20 lies in a benchmark window go."""
    added = ["n_words", "spans", "items"]
    marked = decontaminate.contamination(docs.withColumnsRenamed({c: f"{c}_before" for c in added}),
                                         table(spark, sf_dir, "benchmark"))
    return marked.where(~decontaminate.is_contaminated()).drop(*added).withColumnsRenamed(
        {f"{c}_before": c for c in added}).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: a trained classifier and a tokenizer have no SQL form; tests/llm compares with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote is deleted when the next
    one's table stands."""
    docs, mark = table(spark, sf_dir, "documents"), mark_written()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        release_written(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)
