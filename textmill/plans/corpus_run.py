"""The corpus run: load -> language -> clean -> safety -> dedup -> tokenise
-> perplexity -> report -> export, as DataFrame transforms.

Each stage annotates the rows that the one before kept and is written once, as a
Parquet table below the shared checkpoint folder: this cuts lineage and plan,
survives lost executors, and later readers take only the columns they need.
The stage's figures (rows, reasons, averages ...) are observed in the same write,
above all its shuffles, where Spark counts every task once.  Kept rows are a
filter on the stage's table, so dropped rows cost no second pass.  ``release``
deletes the stage tables when the results have been read.

Input is the driver's ``documents`` table, any DataFrame of
(original_index, text, url[, language, source]) or a JSONL path; with ``out``
the sinks that ``ExportConfig`` names are written below it and made visible by one
manifest (``sources.manifest``)."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import (CleanConfig, DedupConfig, ExportConfig, PerplexityConfig, SafetyConfig, TokenConfig,
                      TrainingConfig)
from ..operators import cleaning, dedup, language, perplexity, safety, tokens, training
from ..session import ensure_checkpoint_dir, remove_scratch, scratch_path
from ..sources import jsonl, sinks, tables
from ..sources.manifest import Export
from . import report_run


@dataclass
class RunResult:
    tables: dict = field(default_factory=dict)      # DataFrames by name
    throughput: list = field(default_factory=list)  # (stage, rows in, rows out, seconds, rows per second)
    figures: dict = field(default_factory=dict)     # observed scalars by stage
    summaries: dict = field(default_factory=dict)
    exported: dict = field(default_factory=dict)    # folder by sink
    scratch: list = field(default_factory=list)     # stage tables below the checkpoint folder
    seconds: float = 0.0

    def release(self, spark: SparkSession) -> None:
        """Delete the stage tables; tables that read them can no longer be read."""
        while self.scratch:
            remove_scratch(spark, self.scratch.pop())

    def throughput_df(self, spark: SparkSession) -> DataFrame:
        final = self.figures["tokenize"]["kept_samples"] if "tokenize" in self.figures else 0
        return report_run.throughput(spark, self.throughput, final, self.seconds)


@contextmanager
def whole_stage_codegen(spark: SparkSession, enabled: bool):
    """Scope the whole-stage codegen setting to one materialisation.  The
    safety projections are dominated by regular expressions and interpreted
    array lambdas; compiling their very large generated code costs more
    than it saves (measured: about 2x on the stage), so that stage runs with
    expression-level code generation only."""
    key = "spark.sql.codegen.wholeStage"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "true" if enabled else "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


class _Stages:
    """Writes the stages of one run and records what they observed."""

    def __init__(self, spark: SparkSession, res: RunResult) -> None:
        self.spark, self.res = spark, res

    def write(self, name: str, build, rows_in: int | None, metrics: dict[str, Column], out: str = "kept_samples",
              source: DataFrame | None = None, codegen: bool = True) -> tuple[DataFrame, dict]:
        """The table of ``build()`` and its observed ``metrics``; rows out are the
        metric ``out``.  With ``source``, ``build`` takes it and rows in are
        counted as they are read."""
        start = time.time()
        seen, read = Observation(f"{name}: rows out"), None
        if source is not None:
            read = Observation(f"{name}: rows in")
            df = build(source.observe(read, F.count(F.lit(1)).alias("rows")))
        else:
            df = build()
        path = scratch_path(self.spark, f"stage-{name}")
        self.res.scratch.append(path)
        with whole_stage_codegen(self.spark, codegen):
            df.observe(seen, *[c.alias(k) for k, c in metrics.items()]).write.parquet(path)
        figures = dict(seen.get)
        if read is not None:
            rows_in = read.get["rows"]
        self.res.figures[name] = figures
        self.record(name, rows_in, figures[out], time.time() - start)
        return self.spark.read.schema(df.schema).parquet(path), figures

    def record(self, name: str, rows_in: int, rows_out: int, seconds: float) -> None:
        self.res.throughput.append((name, int(rows_in), int(rows_out), seconds, rows_out / seconds if seconds > 0 else 0.0))


def run(spark: SparkSession, sf_dir: str | None = None, target_language: str = "en", detect_language: bool = True,
        clean_cfg: CleanConfig = CleanConfig(), safety_cfg: SafetyConfig = SafetyConfig(),
        dedup_cfg: DedupConfig = DedupConfig(), token_cfg: TokenConfig = TokenConfig(),
        ppl_cfg: PerplexityConfig = PerplexityConfig(), train_cfg: TrainingConfig = TrainingConfig(),
        export_cfg: ExportConfig = ExportConfig(), input_partitions: int | None = None,
        docs: DataFrame | None = None, jsonl_path: str | None = None, out: str | None = None,
        export_id: str | None = None, blocklist: DataFrame | None = None, scorer: perplexity.Scorer | None = None, scorer_name: str = "bigram",
        with_report: bool = True) -> RunResult:
    res = RunResult()
    ensure_checkpoint_dir(spark)
    stages, begun = _Stages(spark, res), time.time()

    if jsonl_path:
        docs = jsonl.load_jsonl(spark, jsonl_path)
    docs = tables.documents(spark, sf_dir) if docs is None else docs
    detect_language = detect_language and "language" in docs.columns  # the model learns from labels
    if input_partitions:  # the caller's choice, for inputs of fewer row groups than cores
        docs = docs.repartition(input_partitions, "original_index")

    # load + language identification; rows out are those of the target language
    profile = None
    if detect_language:
        start = time.time()
        learns = docs.where(language.learning_rows(F.col("original_index")))
        profile = language.train_profile(learns)
        stages.record("language_model", profile.documents, len(profile.languages), time.time() - start)

    def load(rows: DataFrame) -> DataFrame:
        if profile is not None:
            return language.detect(rows.withColumnRenamed("language", "label"), profile)
        # unlabelled input: all of it is taken as the target language
        return rows if "language" in rows.columns else rows.withColumn("language", F.lit(target_language))

    wanted = F.col("language") == target_language
    loaded, _ = stages.write("load_language", load, None, {
        "total_samples": F.count(F.lit(1)), "kept_samples": F.count_if(wanted)}, source=docs)
    if "language" in docs.columns:
        res.tables["language_distribution"] = language.distribution(loaded)
    n = res.figures["load_language"]["kept_samples"]

    cleaned, seen = stages.write("clean", lambda: cleaning.annotate(language.keep_target(loaded, target_language), clean_cfg), n, cleaning.metric_columns())
    res.tables["clean_drops"] = report_run.counts_of(spark, seen, "reason", "drop_reason")

    safe, seen = stages.write("safety", lambda: safety.annotate(cleaning.kept(cleaned), safety_cfg, blocklist=blocklist),
                              seen["kept_samples"], safety.metric_columns(entities=safety_cfg.pii_entities), codegen=False)
    res.tables["safety_metrics"] = report_run.one_row(spark, {k: v for k, v in seen.items() if "__" not in k})
    res.tables["prefilter_tags"] = report_run.counts_of(spark, seen, "tag", "tag")
    res.tables["flagged_tokens"] = safety.flagged_token_top(safe)
    res.tables["pii_type_counts"] = report_run.counts_of(spark, seen, "pii", "pii_type")

    # what later stages do not read is not written again; without the safety stage the report reads its columns
    safe_rows = safety.kept(safe).drop(*["prefilter", "toxicity"] * safety_cfg.enabled)
    unique, seen = stages.write("dedup", lambda: dedup.deduplicate(safe_rows, dedup_cfg).drop("canonical_text"),
                                seen["kept_samples"], dedup.metric_columns())
    res.tables["dedup_metrics"] = report_run.one_row(spark, seen)

    tokenised, seen = stages.write("tokenize", lambda: tokens.annotate(unique.where(~F.col("is_duplicate")), token_cfg),
                                   seen["kept_samples"], tokens.metric_columns())
    res.tables["token_metrics"] = report_run.one_row(spark, {k: v for k, v in seen.items() if "__" not in k})
    final = tokens.kept(tokenised)
    res.tables["final"] = final
    n_final = seen["kept_samples"]

    scores = None
    if ppl_cfg.enabled:
        scores, _ = stages.write("perplexity", lambda: perplexity.score_sample(
            final, perplexity.sample(final, ppl_cfg), ppl_cfg, scorer), n_final, {"kept_samples": F.count(F.lit(1))})
        res.tables["perplexity_stats"] = perplexity.stats(scores, scorer_name)
    else:
        res.tables["perplexity_stats"] = perplexity.disabled(spark)

    if export_cfg.clean or export_cfg.tokenized or export_cfg.training:
        start = time.time()
        rows = _export(spark, out, export_id, export_cfg, train_cfg, cleaning.kept(cleaned), final, n_final, res)
        stages.record("export", n_final, rows, time.time() - start)
    res.seconds = time.time() - begun
    if with_report:
        fig = res.figures
        res.tables |= {f"report_{k}": v for k, v in report_run.build(
            final, res.tables.get("language_distribution"), target_language, fig["clean"],
            fig["safety"] if safety_cfg.enabled else None, res.tables["flagged_tokens"], fig["dedup"], fig["tokenize"], scores,
            res.throughput, res.seconds).items()}
    return res


def _export(spark: SparkSession, out: str | None, export_id: str | None, flags: ExportConfig, cfg: TrainingConfig,
            clean: DataFrame, final: DataFrame, n_final: int, res: RunResult) -> int:
    """The sinks that the flags name; rows of the training blocks, else rows in.
    Tokenised and training sinks need a row with tokens.  Without ``out`` the
    training blocks are placed but not written."""
    export = Export(spark, out, export_id) if out else None
    if export and flags.clean:
        export.sink("clean", lambda p: sinks.write_clean_shards(clean, p, cfg.shard_size, "gzip" if flags.compress else None))
    if export and flags.tokenized and n_final:
        export.sink("tokenized", lambda p: sinks.write_tokenized_shards(final, p, cfg.shard_size))
    n = n_final
    if flags.training and n_final:
        n = _training(spark, export, cfg, final, res)
    if export:
        for name in ("safety_metrics", "dedup_metrics"):
            export.sink(f"metrics_{name}", lambda p, name=name: sinks.write_metrics(res.tables[name], p))
        export.commit()
        res.exported = {k: p for k, (p, _) in export.done.items()}
    return n


def _training(spark: SparkSession, export: Export | None, cfg: TrainingConfig, final: DataFrame, res: RunResult) -> int:
    """The training chain: checks, blocks, shards; with an export also the shards'
    validation, audit, index, full meta and mixture."""
    validated = training.validate_preconditions(final.drop("drop_reason"), cfg)
    checked = training.consistency_pass(validated, cfg)
    res.tables["consistency_report"] = training.consistency_report(checked)
    res.tables["consistency_drops"] = training.consistency_drop_counts(checked)
    res.tables["consistency_pii"] = training.consistency_pii_counts(checked)
    consistent = checked.where(F.col("consistency_reason").isNull())
    blocks, res.summaries["chunking"] = training.pack_blocks(consistent, cfg)
    sharded = training.shuffle_and_shard(blocks, cfg)
    if export is None:
        path = scratch_path(spark, "stage-blocks")
        res.scratch.append(path)
        sharded.write.parquet(path)
        sharded = spark.read.schema(sharded.schema).parquet(path)
        res.tables["blocks"], res.tables["shard_meta"] = sharded, training.shard_meta(sharded)
        return sharded.count()
    path = export.sink("training", lambda p: sinks.write_training_shards(sharded, p))
    index = sinks.dataset_index(spark, path)
    index_path = export.sink("index", lambda p: index.write.parquet(p))
    index = spark.read.schema(index.schema).parquet(index_path)
    _, report = sinks.validate_shards(spark, path, cfg.min_tokens)
    report_path = export.sink("validation", lambda p: report.write.parquet(p))
    report = spark.read.schema(report.schema).parquet(report_path)
    n_shards = index.count()  # a row a shard
    audit = sinks.audit_report(index, sinks.audit_sample(spark, path, n_shards, seed=cfg.shuffle_seed))
    audit_path = export.sink("audit", lambda p: audit.write.parquet(p))
    meta = training.describe_shards(training.shard_meta(sinks.read_training_shards(spark, path)), cfg, res.tables["dedup_metrics"],
                                    res.tables["consistency_pii"], res.tables["consistency_drops"])
    meta_path = export.sink("shard_meta", lambda p: meta.write.parquet(p))
    meta = spark.read.schema(meta.schema).parquet(meta_path)
    export.sink("mixture", lambda p: training.mixture(meta).write.json(p))
    res.tables |= {"index": index, "validation": report, "index_totals": sinks.index_totals(index, report),
                   "audit": spark.read.schema(audit.schema).parquet(audit_path), "shard_meta": meta,
                   "sharding_summary": training.sharding_summary(meta)}
    return index.agg(F.sum("num_rows")).first()[0] or 0
