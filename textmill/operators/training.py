"""Training export: row checks, consistency pass, packing into fixed
blocks, seeded shuffle, shard assignment and per-shard metadata.

Packing never builds the token stream: each document knows its offset in
the stream (a bucketed prefix sum of ``token_count + 1``), emits one slice
per block it touches, and blocks are re-assembled by ``groupBy(block)``,
each group holding at most ``block_size`` tokens."""

from __future__ import annotations

from ..session import reliable_checkpoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TrainingConfig
from ..functions import pii as PII
from ..functions.url import source_from_url
from . import ordering
from .staging import once

IDX = "original_index"
REQUIRED = ["text", "tokens", "token_count", "language", "source", "license", "char_length",
            "dedupe_hash", "pii_types", "pii_redacted"]


# --------------------------------------------------------------------------- I2

def add_missing_fields(df: DataFrame) -> DataFrame:
    """source from the URL, license 'unknown', dedupe_hash from the content
    hash (else SHA-256 of the text), pii_types and pii_redacted (= has PII)."""
    cols = set(df.columns)
    out = df
    if "source" not in cols:
        out = out.withColumn("source", source_from_url(F.col("url")) if "url" in cols else F.lit("web"))
    if "license" not in cols:
        out = out.withColumn("license", F.lit("unknown"))
    if "dedupe_hash" not in cols:
        h = F.when(F.col("text") != "", F.sha2(F.col("text"), 256))
        if "content_hash" in cols:
            h = F.coalesce(F.col("content_hash"), h)
        out = out.withColumn("dedupe_hash", h)
    if "pii_types" not in cols:
        out = out.withColumn("pii_types", F.coalesce(F.col("pii.pii_types"), F.array().cast("array<string>"))
                             if "pii" in cols else F.array().cast("array<string>"))
    if "pii_redacted" not in cols:
        out = out.withColumn("pii_redacted", F.coalesce(F.col("pii.has_pii"), F.lit(False))
                             if "pii" in cols else F.lit(False))
    return out


# --------------------------------------------------------------------------- I3-I4

def validate_preconditions(df: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """Adds ``valid`` and ``drop_reason``; the last failing check names the
    reason (empty tokens, then too few chars, then too few tokens)."""
    out = add_missing_fields(df)
    for c in REQUIRED:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None))
    present = [F.col(c).isNotNull() for c in REQUIRED]
    tc = F.coalesce(F.col("token_count"), F.lit(0))
    cl = F.coalesce(F.col("char_length"), F.lit(0))
    few_tokens = tc < cfg.min_tokens
    few_chars = cl < cfg.min_chars
    empty_tokens = F.col("tokens").isNull() | (F.size("tokens") == 0)
    reason = (F.when(empty_tokens, F.lit("empty_tokens"))
              .when(few_chars, F.concat(F.lit("too_few_chars_"), cl.cast("string")))
              .when(few_tokens, F.concat(F.lit("too_few_tokens_"), tc.cast("string"))))
    all_present = present[0]
    for p in present[1:]:
        all_present = all_present & p
    return (out.withColumn("valid", all_present & ~few_tokens & ~few_chars & ~empty_tokens)
            .withColumn("drop_reason", F.coalesce(reason, F.col("drop_reason") if "drop_reason" in df.columns
                                                  else F.lit(None).cast("string"))))


def precondition_report(validated: DataFrame) -> DataFrame:
    """Long table (field, missing, present) plus totals in one row each."""
    aggs = [F.count(F.lit(1)).alias("total_samples"), F.count_if("valid").alias("valid_samples")]
    for c in REQUIRED:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"missing__{c}"))
    wide = validated.agg(*aggs)
    stack = ", ".join(f"'{c}', missing__{c}" for c in REQUIRED)
    return wide.selectExpr("total_samples", "valid_samples",
                           f"stack({len(REQUIRED)}, {stack}) as (field, missing)") \
        .withColumn("present", F.col("total_samples") - F.col("missing"))


# --------------------------------------------------------------------------- I5-I6

def consistency_pass(validated: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """Over the valid rows: ``consistency_reason`` = empty_sequence,
    out_of_vocab, unredacted_pii (whole text, case-sensitive patterns, when
    not flagged pii_redacted), or an existing drop reason; null = kept."""
    v = validated.filter(F.col("valid"))
    empty = F.col("tokens").isNull() | (F.size("tokens") == 0)
    oov = F.exists("tokens", lambda t: (t < 0) | (t > cfg.vocab_size - 1))
    text = F.col("text")
    unredacted = (text.isNotNull() & (text != "") & PII.has_unredacted_pii(text)
                  & ~F.coalesce(F.col("pii_redacted"), F.lit(False)))
    reason = (F.when(empty, F.lit("empty_sequence")).when(oov, F.lit("out_of_vocab"))
              .when(unredacted, F.lit("unredacted_pii")).otherwise(F.col("drop_reason")))
    return once(v, "consistency_reason", reason)


def consistency_report(checked: DataFrame) -> DataFrame:
    """One row: totals, out-of-vocab and empty counts, duplicates among rows
    that reached the duplicate check, and the duplicate rate over all rows."""
    reached = ~F.coalesce(F.col("consistency_reason").isin("empty_sequence", "out_of_vocab", "unredacted_pii"),
                          F.lit(False))
    dup = F.coalesce(F.col("is_duplicate"), F.lit(False)) if "is_duplicate" in checked.columns else F.lit(False)
    total = F.count(F.lit(1))
    dups = F.count_if(reached & dup)
    return checked.agg(
        total.alias("total_samples"),
        F.count_if(F.col("consistency_reason").isNull()).alias("consistent_samples"),
        F.count_if(F.col("consistency_reason").isNotNull()).alias("dropped_samples"),
        F.count_if(F.col("consistency_reason") == "out_of_vocab").alias("out_of_vocab_count"),
        F.count_if(F.col("consistency_reason") == "empty_sequence").alias("empty_sequences"),
        dups.alias("total_duplicates"),
        F.when(total > 0, dups / total).otherwise(F.lit(0.0)).alias("duplicate_rate"),
    )


def consistency_drop_counts(checked: DataFrame) -> DataFrame:
    return (checked.filter(F.col("consistency_reason").isNotNull())
            .groupBy(F.col("consistency_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n")))


def consistency_pii_counts(checked: DataFrame) -> DataFrame:
    """PII types of rows that reached the PII-type count."""
    reached = ~F.coalesce(F.col("consistency_reason").isin("empty_sequence", "out_of_vocab", "unredacted_pii"),
                          F.lit(False))
    return (checked.select(F.explode(F.when(reached, F.col("pii_types"))).alias("pii_type"))
            .groupBy("pii_type").agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------------------- J1-J4

def corpus_mode(df: DataFrame, col: str, default: str) -> str:
    """Most frequent value, ties by first occurrence (a scalar)."""
    row = (df.filter(F.col(col).isNotNull() & (F.col(col) != ""))
           .groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.min(IDX).alias("first"))
           .orderBy(F.desc("n"), F.asc("first")).limit(1).collect())
    return row[0][col] if row else default


def pack_blocks(docs: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> tuple[DataFrame, dict]:
    """Concatenate token lists in ``original_index`` order with EOS between
    documents (none after the last), cut into blocks of ``block_size``; a
    short last block is kept iff it has at least ``block_size // 2`` tokens.

    Returns (blocks, summary)."""
    B, eos = int(cfg.block_size), int(cfg.eos_token)
    # the input is read by several jobs below: evaluated once, in the shared folder
    docs = reliable_checkpoint(docs.select(IDX, "tokens", "language", "source"))
    d = docs.filter(F.col("tokens").isNotNull() & (F.size("tokens") > 0)).select(IDX, "tokens")
    sized = d.select(IDX, F.size("tokens").alias("n"))
    placed = ordering.exclusive_prefix_sum(sized, [IDX], F.col("n") + 1, "start")
    stats = sized.agg(F.coalesce(F.sum(F.col("n") + 1), F.lit(0)).alias("len")).first()
    total = max(int(stats["len"]) - 1, 0)
    d = d.join(placed, IDX)
    full, tail = divmod(total, B)
    n_blocks = full + (1 if tail > 0 and tail >= B // 2 else 0)
    language = corpus_mode(docs, "language", "en")
    source = corpus_mode(docs, "source", "web")
    end = F.least(F.col("start") + F.col("n") + 1, F.lit(total))
    first_b = F.floor(F.col("start") / B).cast("long")
    last_b = F.least(F.floor((end - 1) / B).cast("long"), F.lit(n_blocks - 1))
    stream = F.concat("tokens", F.array(F.lit(eos).cast("int")))
    pieces = (d.filter(F.col("start") < F.lit(n_blocks * B))
              .withColumn("_stream", stream).withColumn("_end", end)
              .select("start", "_stream", "_end",
                      F.explode(F.sequence(first_b, F.greatest(last_b, first_b))).alias("block_index"))
              .filter(F.col("block_index") < n_blocks))
    lo = F.greatest(F.col("start"), F.col("block_index") * B)
    hi = F.least(F.col("_end"), (F.col("block_index") + 1) * B)
    pieces = pieces.select("block_index", (lo - F.col("block_index") * B).alias("off"),
                           F.slice("_stream", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))
    blocks = (pieces.groupBy("block_index")
              .agg(F.array_sort(F.collect_list(F.struct("off", "piece"))).alias("_p"))
              .select("block_index", F.flatten(F.transform("_p", lambda x: x["piece"])).alias("tokens")))
    blocks = blocks.select(
        F.col("tokens"),
        F.size("tokens").cast("int").alias("token_count"),
        F.format_string("block_%08d", F.col("block_index")).alias("sample_id"),
        F.col("block_index").cast("long").alias("block_index"),
        (F.col("block_index") > 0).alias("is_continuation"),
        F.lit(0).alias("chunk_index"),
        F.lit("concatenation_fixed_blocks").alias("chunking_strategy"),
        F.lit(language).alias("language"),
        F.lit(source).alias("source"),
        F.lit(None).cast("string").alias("url"),
        (F.size("tokens") * 4).cast("int").alias("char_length"),
    )
    summary = {"strategy": "concatenation_fixed_blocks", "block_size": B, "eos_token": eos,
               "total_input_samples": int(docs.count()), "total_blocks": n_blocks, "total_tokens": total,
               "avg_tokens_per_block": (total / n_blocks) if n_blocks else 0}
    return blocks, summary


# --------------------------------------------------------------------------- J5-J8

def summary_table(spark, summary: dict) -> DataFrame:
    """The summary of ``pack_blocks`` as a one-row table."""
    return spark.createDataFrame(
        [(summary["strategy"], summary["block_size"], summary["eos_token"], summary["total_input_samples"], summary["total_blocks"],
          summary["total_tokens"], float(summary["avg_tokens_per_block"]))],
        "strategy string, block_size int, eos_token int, total_input_samples long, total_blocks long, total_tokens long, "
        "avg_tokens_per_block double")


def shuffle_and_shard(blocks: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """Seeded permutation (order by xxhash64(seed, block_index), then
    block_index) and shard = rank // shard_size.  Ranks are computed on
    (hash, index) rows and joined back to the blocks."""
    if cfg.shuffle_key == "md5":
        # the same permutation is expressible in SQL engines without xxhash64
        h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{int(cfg.shuffle_seed)}:"), F.col("block_index").cast("string"))),
                               1, 15), 16, 10).cast("long")
    else:
        h = F.xxhash64(F.lit(int(cfg.shuffle_seed)), F.col("block_index"))
    ranked = ordering.rank(blocks.select("block_index", h.alias("_h")), ["_h", "block_index"], "rank").drop("_h")
    return blocks.join(ranked, "block_index").withColumn(
        "shard_id", F.floor(F.col("rank") / int(cfg.shard_size)).cast("int"))


def shard_meta(sharded: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return (sharded.groupBy("shard_id").agg(
        total.alias("num_samples"), F.sum("token_count").alias("num_tokens"),
        F.avg("token_count").alias("avg_tokens"), F.min("token_count").alias("min_tokens"),
        F.max("token_count").alias("max_tokens"))
        .withColumn("filename", shard_name(F.col("shard_id"))))


def shard_name(shard_id: Column) -> Column:
    """The folder that holds a written shard, below the sink's path."""
    return F.format_string("shard_id=%d", shard_id)


def describe_shards(meta: DataFrame, cfg: TrainingConfig, dedup_metrics: DataFrame | None = None,
                    pii_counts: DataFrame | None = None, drops: DataFrame | None = None) -> DataFrame:
    """Shard meta with what holds for all shards: tokenizer, seed, version,
    duplicate rate, PII types and drop reasons as maps.  The three tables are a
    row, a row per PII type and a row per drop reason."""
    rate = dedup_metrics.select("duplicate_rate").first()[0] if dedup_metrics is not None else 0.0

    def as_map(df: DataFrame | None, key: str) -> Column:
        rows = [] if df is None else df.select(key, F.col("n").cast("long")).orderBy(key).collect()
        if not rows:
            return F.create_map().cast("map<string,long>")
        return F.create_map(*[F.lit(x) for r in rows for x in (r[0], int(r[1]))])

    return meta.select(
        "*", F.lit(cfg.tokenizer_name).alias("tokenizer"), F.lit(int(cfg.shuffle_seed)).alias("shuffle_seed"),
        F.lit(cfg.pipeline_version).alias("pipeline_version"), F.lit(float(rate or 0.0)).alias("duplicate_rate"),
        as_map(pii_counts, "pii_type").alias("pii_summary"), as_map(drops, "reason").alias("drop_reasons"),
        F.current_timestamp().alias("created_at"))


def sharding_summary(meta: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return meta.agg(n.alias("total_shards"), F.coalesce(F.sum("num_samples"), F.lit(0)).alias("total_samples"),
                    F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("total_tokens"),
                    F.when(n > 0, F.sum("num_samples") / n).otherwise(F.lit(0.0)).alias("avg_samples_per_shard"),
                    F.when(n > 0, F.sum("num_tokens") / n).otherwise(F.lit(0.0)).alias("avg_tokens_per_shard"))


def mixture(meta: DataFrame) -> DataFrame:
    """The mixture manifest as a table, a row per shard: one domain 'web',
    weight 1.0, licence 'unknown'."""
    return meta.select(F.lit("web").alias("name"), F.col("filename").alias("shard"), F.lit(1.0).alias("weight"),
                       F.lit("unknown").alias("license"))
