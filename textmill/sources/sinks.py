"""Sinks and shard QA: clean / tokenised / training shards, metrics,
re-read validation and the checksummed dataset index.

Shards are ``rank // shard_size`` of a global order (see
``operators.ordering``); each shard is one partition written in rank order
under ``shard_id=<n>/``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.pii import has_unredacted_pii
from ..operators import ordering

IDX = "original_index"


def _write_sharded(df: DataFrame, shard_size: int, path: str, fmt: str, cols: list, **options) -> None:
    ranked = ordering.rank(df.select(IDX), [IDX], "_rank")  # ids only; texts are joined back
    sharded = df.join(ranked, IDX).withColumn("shard_id", F.floor(F.col("_rank") / int(shard_size)).cast("int"))
    (sharded.repartition("shard_id").sortWithinPartitions("shard_id", "_rank")
     .select("shard_id", *cols).write.mode("overwrite").partitionBy("shard_id")
     .options(**options).format(fmt).save(path))


def write_clean_shards(df: DataFrame, path: str, shard_size: int = 10_000, compression: str | None = None) -> None:
    """text, url, char_length, language in original order; nulls kept."""
    opts = {"ignoreNullFields": "false"}
    if compression:
        opts["compression"] = compression
    _write_sharded(df, shard_size, path, "json",
                   ["text", "url", "char_length", "language"], **opts)


def write_tokenized_shards(df: DataFrame, path: str, shard_size: int = 10_000) -> None:
    """tokens, token_count and a JSON metadata string, as Parquet."""
    meta = F.to_json(F.struct("url", "char_length", "language", IDX), {"ignoreNullFields": "false"})
    t = df.filter(F.col("tokens").isNotNull()).withColumn("metadata", meta)
    _write_sharded(t, shard_size, path, "parquet",
                   ["tokens", "token_count", "metadata"])


TRAINING_COLS = ["tokens", "token_count", "language", "source", "url", "char_length", "sample_id",
                 "is_continuation", "chunk_index"]


def write_training_shards(sharded: DataFrame, path: str) -> None:
    """Blocks with ``shard_id`` and ``rank`` (from shuffle_and_shard)."""
    (sharded.repartition("shard_id").sortWithinPartitions("shard_id", "rank")
     .select("shard_id", *TRAINING_COLS).write.mode("overwrite").partitionBy("shard_id")
     .option("ignoreNullFields", "false").json(path))


def read_training_shards(spark: SparkSession, path: str) -> DataFrame:
    """Written blocks with their shard number."""
    return spark.read.schema("tokens array<int>, token_count int, language string, source string, url string, char_length int, "
                             "sample_id string, is_continuation boolean, chunk_index int, shard_id int").json(path)


def write_metrics(one_row: DataFrame, path: str) -> None:
    """A metrics row as JSON and, flattened one level, as CSV."""
    one_row.coalesce(1).write.mode("overwrite").json(f"{path}/json")
    flat = []
    for f in one_row.schema.fields:
        if f.dataType.typeName() == "struct":
            flat += [F.col(f"{f.name}.{s.name}").alias(f"{f.name}.{s.name}") for s in f.dataType.fields]
        elif f.dataType.typeName() in ("array", "map"):
            flat.append(F.size(f.name).alias(f.name))
        else:
            flat.append(F.col(f.name))
    one_row.select(*flat).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


REQUIRED_KEYS = ["tokens", "token_count", "language", "source"]

#: lines, or digests, under one node of a file's digest
LEAVES = 4096


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of written shards with their file and shard number."""
    file = F.col("_metadata.file_path")
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value", file.alias("file"), F.regexp_extract(file, r"/shard_id=(\d+)/", 1).try_cast("int").alias("shard_id"),
        F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def shard_list(spark: SparkSession, path: str) -> DataFrame:
    """(shard_id) of the written shards, from the names of their files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.select(F.regexp_extract("path", r"/shard_id=(\d+)/", 1).try_cast("int").alias("shard_id")).distinct()


def validate_shards(spark: SparkSession, path: str, min_tokens: int = 20) -> tuple[DataFrame, DataFrame]:
    """Re-read written shards.  Returns (per-line errors, per-shard report).
    Errors: invalid JSON, a missing required key, ``size(tokens) !=
    token_count``; ``token_count < min_tokens`` is a range warning that does
    not fail the shard."""
    keys = F.json_object_keys("value")
    obj = F.from_json("value", "tokens array<int>, token_count int")
    checks = _lines(spark, path).select("file", "shard_id", keys.alias("keys"), obj.alias("o"))
    errors = F.array_compact(F.array(
        F.when(F.col("keys").isNull(), F.lit("json_decode_error")),
        *[F.when(F.col("keys").isNotNull() & ~F.array_contains("keys", k), F.lit(f"missing_field:{k}"))
          for k in REQUIRED_KEYS],
        F.when(F.col("keys").isNotNull() & (F.coalesce(F.size("o.tokens"), F.lit(0))
                                            != F.coalesce(F.col("o.token_count"), F.lit(0))),
               F.lit("token_count_mismatch")),
    ))
    per_line = checks.select("file", "shard_id", errors.alias("errors"),
                             (F.coalesce(F.col("o.token_count"), F.lit(0)) < min_tokens).alias("range_warning"))
    report = per_line.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.size("errors")).alias("errors"),
        F.count_if("range_warning").alias("token_range_warnings"),
    ).withColumn("valid", F.col("errors") == 0)
    return per_line, report


def validation_status(report: DataFrame) -> DataFrame:
    """One row: shards, valid ones, and ``passed`` or ``failed``."""
    n, ok = F.count(F.lit(1)), F.count_if("valid")
    return report.agg(n.alias("total_shards"), ok.alias("valid_shards"),
                      F.when(n == ok, "passed").otherwise("failed").alias("status"))


def audit_sample(spark: SparkSession, path: str, n_shards: int, total: int = 200, seed: int = 42) -> DataFrame:
    """A seeded sample of ``total // n_shards`` lines, one at least, of each
    shard, with a PII re-check of ``text``: blocks carry none, shards of
    documents do.  The first lines of a shard in hash order are kept in each task
    before the shuffle (a limit under the window), so a shard of any size sends
    a sample's rows only."""
    per_shard = max(1, total // max(1, n_shards))
    text = F.get_json_object("value", "$.text")
    lines = _lines(spark, path).select("shard_id", "value", F.md5(F.concat(F.lit(f"{int(seed)}:"), F.coalesce(text, "value"))).alias("h"))
    order = Window.partitionBy("shard_id").orderBy("h", "value")
    return (lines.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_shard)
            .withColumn("text", text)
            .select("shard_id", F.col("r").alias("sample"), F.get_json_object("value", "$.sample_id").alias("sample_id"),
                    F.coalesce((F.col("text") != "") & has_unredacted_pii(F.col("text")), F.lit(False)).alias("pii_found")))


def audit_report(index: DataFrame, audit: DataFrame) -> DataFrame:
    """A row for every shard of the index: audited lines, and those with PII."""
    found = audit.groupBy("shard_id").agg(F.count(F.lit(1)).alias("audited"), F.count_if("pii_found").alias("with_pii"))
    return index.select("shard_id").join(found, "shard_id", "left").na.fill(0, ["audited", "with_pii"])


def file_digests(lines: DataFrame) -> DataFrame:
    """(shard_id, file, digest): SHA-256 over a tree of each file's lines.  The
    leaves are the lines' digests; a node is the digest of up to ``LEAVES`` of its
    children's hexadecimal digests one after the other; the root has no brother.
    Order and repeats count, files are read in splits, and a group holds
    ``LEAVES`` digests at most.

    ``lines`` are those of ``_lines``: rows of a split follow each other in one
    partition, so a line's number is its place in its split, and the lines of the
    splits before it."""
    leaves = lines.select("shard_id", "file", "block", "at", F.sha2("value", 256).alias("digest"))
    splits = leaves.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    splits = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nodes = leaves.join(splits, ["file", "block"]).select(
        "shard_id", "file", (F.col("at") - F.col("first") + F.col("before")).alias("no"), "digest")
    most = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    height = 0
    while True:
        children = F.array_sort(F.collect_list(F.struct("no", "digest")))
        grouped = nodes.groupBy("shard_id", "file", F.floor(F.col("no") / LEAVES).alias("no")).agg(children.alias("c"))
        joined = F.sha2(F.array_join(F.transform("c", lambda x: x["digest"]), ""), 256)
        # a single node above the leaves is a root already
        root = (F.size("c") == 1) & (F.col("no") == 0) & F.lit(height > 0)
        nodes = grouped.select("shard_id", "file", "no", F.when(root, F.col("c")[0]["digest"]).otherwise(joined).alias("digest"))
        height += 1
        most = -(-most // LEAVES)
        if most <= 1:
            return nodes.drop("no")


def dataset_index(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard: rows, tokens, bytes and digest (of its file; of several
    files, of their digests in order of their names)."""
    lines = _lines(spark, path)
    counted = lines.groupBy("shard_id", "file").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.from_json("value", "token_count long")["token_count"], F.lit(0))).alias("t"),
        F.max("file_size").alias("b"))
    files = counted.join(file_digests(lines).drop("shard_id"), "file")
    digests = F.transform(F.array_sort(F.collect_list(F.struct("file", "digest"))), lambda x: x["digest"])  # a file each
    return files.groupBy("shard_id").agg(
        F.sum("n").alias("num_rows"), F.sum("t").alias("num_tokens"), F.sum("b").alias("bytes"), digests.alias("d")).select(
        "shard_id", "num_rows", "num_tokens", "bytes",
        F.when(F.size("d") == 1, F.col("d")[0]).otherwise(F.sha2(F.array_join("d", ""), 256)).alias("digest"))


def index_totals(index: DataFrame, report: DataFrame) -> DataFrame:
    """One row over the index and the validation report."""
    totals = index.agg(F.count(F.lit(1)).alias("total_shards"), F.coalesce(F.sum("num_rows"), F.lit(0)).alias("total_rows"),
                       F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("total_tokens"))
    return totals.withColumn("status", F.lit(validation_status(report).first()["status"]))
