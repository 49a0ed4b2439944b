"""Shards on disk: validation of broken ones, and the run from JSONL to the index."""

import hashlib
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from textmill.config import DedupConfig, ExportConfig, PerplexityConfig, TokenConfig, TrainingConfig
from textmill.plans import corpus_run
from textmill.session import remove_scratch, scratch_path
from textmill.sources import sinks, tables
from textmill.sources.manifest import Export, manifest, visible

GOOD = {"tokens": [1] * 25, "token_count": 25, "language": "en", "source": "web", "sample_id": "b", "text": "mail a@b.COM"}


def test_broken_shards(spark):
    path = scratch_path(spark, "shards")
    short = GOOD | {"tokens": [1], "token_count": 1}
    lines = {0: [GOOD, short], 1: [GOOD, "{broken"], 2: [{k: v for k, v in GOOD.items() if k != "language"}],
             3: [GOOD | {"token_count": 24}]}
    for shard, rows in lines.items():
        os.makedirs(f"{path}/shard_id={shard}")
        with open(f"{path}/shard_id={shard}/part-0.json", "w") as f:
            f.write("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    errors, report = sinks.validate_shards(spark, path)
    got = {r.shard_id: (r.lines, r.errors, r.token_range_warnings, r.valid) for r in report.collect()}
    assert got[0] == (2, 0, 1, True) and not any(got[i][3] for i in (1, 2, 3))
    found = {r.shard_id: r.errors for r in errors.where(F.size("errors") > 0).collect()}
    assert found == {1: ["json_decode_error"], 2: ["missing_field:language"], 3: ["token_count_mismatch"]}
    assert sinks.validation_status(report).first().status == "failed"
    assert sinks.validation_status(report.where("shard_id = 0")).first().status == "passed"
    index = sinks.dataset_index(spark, path)
    rows = {r.shard_id: r for r in index.collect()}
    assert rows[0].num_rows == 2 and rows[0].num_tokens == 26 and rows[0].bytes == os.path.getsize(f"{path}/shard_id=0/part-0.json")
    assert len({r.digest for r in rows.values()}) == 4
    audit = {r.shard_id: (r.sample, r.pii_found) for r in sinks.audit_sample(spark, path, 4, total=4).collect()}
    assert set(audit) == {0, 1, 2, 3} and all(audit[i] == (1, True) for i in (0, 2, 3))


def _digest_by_hand(lines):
    nodes = [hashlib.sha256(x).hexdigest() for x in lines]
    while True:
        nodes = [hashlib.sha256("".join(nodes[i: i + sinks.LEAVES]).encode()).hexdigest() for i in range(0, len(nodes), sinks.LEAVES)]
        if len(nodes) == 1:
            return nodes[0]


def test_digests(spark, monkeypatch):
    """The tree of lines, whatever the splits; order, repeats and changes count."""
    monkeypatch.setattr(sinks, "LEAVES", 3)
    lines = [json.dumps(GOOD | {"sample_id": f"b{i}"}).encode() for i in range(40)]
    shards = {0: lines, 1: lines[:20] + [lines[21], lines[20]] + lines[22:], 2: lines[:5] + [lines[4]] * 2 + lines[5:],
              3: lines[:39] + [lines[39].replace(b"b39", b"b93")], 4: lines[:1], 5: lines[:3], 6: lines[:4]}
    path = scratch_path(spark, "digests")
    for shard, rows in shards.items():
        os.makedirs(f"{path}/shard_id={shard}")
        with open(f"{path}/shard_id={shard}/part-0.json", "wb") as f:
            f.write(b"\n".join(rows) + b"\n")
    want = {k: _digest_by_hand(v) for k, v in shards.items()}
    assert len(set(want.values())) == 7
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "300", "1000"):  # splits inside lines too
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = {r.shard_id: r for r in sinks.dataset_index(spark, path).collect()}
            assert {k: r.digest for k, r in rows.items()} == want
            assert {k: r.num_rows for k, r in rows.items()} == {k: len(v) for k, v in shards.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_audit_of_many_shards(spark):
    """A row for each of 1,000 shards, though 200 lines are fewer; planted PII is found."""
    path = scratch_path(spark, "audit")
    df = spark.range(4000).select(
        (F.col("id") % 1000).cast("int").alias("shard_id"),
        F.when(F.col("id") % 1000 < 10, F.lit("write to a.b@c.DE")).otherwise(F.concat(F.lit("clean text "), F.col("id"))).alias("text"))
    df.repartition(4).write.partitionBy("shard_id").json(path)
    index = spark.range(1001).select(F.col("id").cast("int").alias("shard_id"))
    sample = sinks.audit_sample(spark, path, 1000)
    assert "WindowGroupLimit" in sample._jdf.queryExecution().executedPlan().toString()  # k rows a task and shard are shuffled
    rows = {r.shard_id: (r.audited, r.with_pii) for r in sinks.audit_report(index, sample).collect()}
    assert len(rows) == 1001 and rows.pop(1000) == (0, 0)
    assert all(rows[i] == (1, int(i < 10)) for i in range(1000))
    more = sinks.audit_report(index, sinks.audit_sample(spark, path, 66)).collect()
    assert {r.audited for r in more if r.shard_id < 1000} == {3}


def test_export_flags(spark):
    docs = tables.documents(spark, SF_SMALL)
    light = {"detect_language": False, "dedup_cfg": DedupConfig(method="hash"), "token_cfg": TokenConfig(encoding="word_hash"),
             "ppl_cfg": PerplexityConfig(enabled=False), "with_report": False,
             "train_cfg": TrainingConfig(block_size=256, shard_size=20, vocab_size=1 << 28)}
    none = ExportConfig(clean=False, tokenized=False, training=False)
    for flag, sinks_of in (("clean", {"clean"}), ("tokenized", {"tokenized"}),
                           ("training", {"training", "index", "validation", "audit", "shard_meta", "mixture"})):
        out = scratch_path(spark, "flags")
        res = corpus_run.run(spark, docs=docs, out=out, export_cfg=replace(none, **{flag: True}), **light)
        assert set(visible(spark, out)) == sinks_of | {"metrics_safety_metrics", "metrics_dedup_metrics"} == set(res.exported)
    out = scratch_path(spark, "flags")
    res = corpus_run.run(spark, docs=docs, out=out, export_cfg=none, **light)
    assert visible(spark, out) == {} and "export" not in {s[0] for s in res.throughput}
    res = corpus_run.run(spark, docs=docs.where("false"), out=out, **light)  # no row with tokens: neither of the two last sinks
    assert set(visible(spark, out)) == {"clean", "metrics_safety_metrics", "metrics_dedup_metrics"}


def test_a_killed_export_leaves_nothing_visible(spark):
    out = scratch_path(spark, "killed")
    wrote = []

    def sink(name, dies=False):
        def write(path):
            spark.range(5).write.parquet(path)
            wrote.append(name)
            if dies:
                raise KeyboardInterrupt
            return 5
        return name, write

    first = Export(spark, out, "one")
    first.sink(*sink("clean"))
    with pytest.raises(KeyboardInterrupt):
        first.sink(*sink("training", dies=True))
    assert visible(spark, out) == {}
    again = Export(spark, out, "one")  # goes on after the complete sink
    assert again.sink(*sink("clean")) == first.done["clean"][0]
    again.sink(*sink("training"))
    assert visible(spark, out) == {} and wrote == ["clean", "training", "training"]
    again.commit()
    assert visible(spark, out) == {k: p for k, (p, _) in again.done.items()} and set(again.done) == {"clean", "training"}
    other = Export(spark, out, "two")  # sinks of its own, invisible until it is complete
    assert other.sink(*sink("clean")) != first.done["clean"][0]
    assert set(visible(spark, out)) == {"clean", "training"}
    other.commit()
    assert set(visible(spark, out)) == {"clean"} and manifest(spark, out).count() == 3


def test_jsonl_to_index(spark):
    src, out = scratch_path(spark, "jsonl-in"), scratch_path(spark, "run")
    tables.documents(spark, SF_SMALL).repartition(3).select("text", F.lit("http://www.a.com/x").alias("url")).write.json(src)
    res = corpus_run.run(spark, jsonl_path=src, out=out, train_cfg=TrainingConfig(block_size=256, shard_size=20))
    rows = {s: (i, o) for s, i, o, _, _ in res.throughput}
    got = visible(spark, out)
    assert got == res.exported
    drops = sum(r.n for r in res.tables["clean_drops"].collect())
    safe, dup = res.tables["safety_metrics"].first(), res.tables["dedup_metrics"].first()
    assert rows["load_language"][0] == rows["load_language"][1] == rows["clean"][1] + drops > 0
    assert rows["clean"][1] == rows["safety"][1] + safe.toxic_dropped + safe.pii_dropped
    assert rows["safety"][1] == rows["dedup"][1] + dup.duplicates_removed
    totals = res.tables["index_totals"].first()
    assert totals.status == "passed" and totals.total_rows == rows["export"][1] > 0
    listed = {r.shard for r in spark.read.json(got["mixture"]).collect()}
    assert listed and all(os.path.isdir(f"{got['training']}/{x}".replace("file:", "")) for x in listed)
    assert spark.read.json(got["clean"]).count() == rows["clean"][1]
    assert spark.read.parquet(got["tokenized"]).count() == rows["tokenize"][1]
    assert res.tables["audit"].count() == totals.total_shards and set(res.tables["shard_meta"].columns) >= {"pii_summary", "drop_reasons"}
    paths = [p.replace("file:", "") for p in res.scratch]
    assert all(os.path.isdir(p) for p in paths)
    res.release(spark)
    assert not res.scratch and not any(os.path.exists(p) for p in paths)
    with pytest.raises(ValueError):
        remove_scratch(spark, out + "/../..")
