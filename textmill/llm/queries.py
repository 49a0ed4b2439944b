"""The registered queries of the subpackage: each applies one operator with
production parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (ann_tree, crf_lang, decontaminate, near_dup, oracle, packing, period_runs, recompress, shard_bytes,
                          spelling, token_arrow, toxicity, two_fit, warc)
from textmill.sources.tables import table

SHARDS = 24


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_arrow.write_tokens(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return token_arrow.read_documents(manifest)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_bytes.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = crf_lang.train(docs, ~held_out)
    return crf_lang.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = recompress.remove_repeats(docs, window=35, keep_layout=False)
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = two_fit.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def _looped() -> Column:
    """Texts of the documents whose crc32(doc_id) is divisible by ten, their
    words from one on repeating with a period; other texts as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    w = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(w).cast("long")
    a = g % n
    made = F.transform(F.array(F.struct(w.alias("w"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))),
                       lambda x: F.array_join(F.transform(x["w"], lambda word, i: F.when(i < x["a"], word).otherwise(
                           F.get(x["w"], (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " "))
    return F.when((h % 10 == 0) & (n > 0), F.get(made, 0)).otherwise(F.col("text"))


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _looped().alias("text"))
    marked = period_runs.mark_runs(docs).withColumn("best", period_runs.longest())
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return marked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_token_arrow": op1_token_arrow,
    "op2_nearest": op2_nearest,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_near_dedup": op7_near_dedup,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_two_fit": op11_two_fit,
    "op12_period_runs": op12_period_runs,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = dict(oracle.SQL)
