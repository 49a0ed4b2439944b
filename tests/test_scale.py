"""What a query computes once, sends and holds as its input grows."""

import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.config import CleanConfig, DedupConfig, TrainingConfig
from textmill.functions import text as TX
from textmill.operators import cleaning, dedup, report, tokens, training


def _filters(df) -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Filter" in line]


def _texts(n: int, words: int = 60) -> list[str]:
    rng = random.Random(5)
    out = [" ".join(rng.choices(["a", "be", "sea", "dee", "ease", "eff", "gee"], k=words)) for _ in range(n)]
    for i in range(0, n - 1, 5):  # one word at the end, and one in the middle, differ
        out[i + 1] = out[i] + " end"
        out[i + 2] = " ".join(out[i].split(" ")[:30] + ["mid"] + out[i].split(" ")[31:])
    return out + out[:3]


def _sets(texts: list[str]) -> list[set]:
    words = [t.split(" ") for t in texts]
    return [{" ".join(w[i:i + 3]) for i in range(len(w) - 2)} for w in words]


def test_cleaned_and_fingerprinted_once(spark):
    df = spark.createDataFrame([(0, "one  two <b>"), (1, None)], "original_index long, text string")
    kept = cleaning.kept(cleaning.annotate(df, CleanConfig(min_chars=1)))
    assert not any("regexp_replace" in x for x in _filters(kept))
    hashed = dedup.fingerprint(df).filter(F.col("content_hash").isNotNull())
    assert not any("regexp_replace" in x or "sha2" in x for x in _filters(hashed))


def test_consistency_checked_once(spark):
    df = spark.createDataFrame([(0, "w " * 40, [1] * 40, 40, "en", "s", 80)],
                               "original_index long, text string, tokens array<int>, token_count int, language string, source string, char_length int")
    checked = training.consistency_pass(training.validate_preconditions(df), TrainingConfig())
    assert not any("RLIKE" in x for x in _filters(training.consistency_drop_counts(checked)))


def test_histogram_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(30).mapInArrow(count, "id long")
    assert report.histogram(df, "id", 3).orderBy("bin").select("n").collect() == [(10,), (10,), (10,)]
    assert seen.value == 30


@pytest.mark.parametrize("text", ["", " ", "a b", "  a \t b\n\n c ", "a b   c\u0085", "\ta", "a  ", "a 　b"])
def test_whitespace_runs(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(TX.collapse_whitespace(F.col("t"))).first()[0] == " ".join(text.split())


class _Bytes:
    """One id a character; refuses batches."""

    def encode_to_numpy(self, text, disallowed_special):
        assert disallowed_special == ()
        return np.array([ord(c) for c in text], dtype=np.uint32)


def test_encoded_one_text_at_a_time():
    got = tokens.encode_batch(pa.array(["no", None, "ab", "", "c"])[1:], _Bytes())
    assert got.type == pa.list_(pa.int32()) and got.to_pylist() == [None, [97, 98], [], [99]]
    assert tokens.encode_batch(pa.array([], pa.string()), _Bytes()).to_pylist() == []


def test_jsonl_parts_follow_the_partitions(spark, tmp_path):
    from textmill.plans import registry
    from textmill.sources import jsonl
    spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        path = registry._docs_as_jsonl(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(f.endswith(".json") for f in os.listdir(path.removeprefix("file:"))) == 9
    assert {(r.original_index, r.text) for r in jsonl.load_jsonl(spark, path).collect()} == {(i, f"t{i}") for i in range(200)}


def test_prefixes_share_a_key_in_any_order():
    rng = np.random.default_rng(2)
    counters = rng.integers(0, 3, dedup.COUNTERS)
    for _ in range(300):
        common, extra = rng.integers(0, 1 << 62, 30), rng.integers(0, 1 << 62, 4)
        a, b = np.concatenate([common, extra[:2]]), np.concatenate([common, extra[2:]])
        assert set(dedup.prefix_of(a, counters, 30 / 34).tolist()) & set(dedup.prefix_of(b, counters, 30 / 34).tolist())
    assert not len(dedup.prefix_of(np.zeros(0, dtype=np.int64), counters, 0.9))


def test_counters_count_every_shingle(spark):
    sets = [["a b c", "b c d"], ["a b c"], [], None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "original_index long, shingles array<string>").repartition(3)
    counters = dedup.shingle_counters(df)
    assert len(counters) == dedup.COUNTERS and counters.sum() == 3 and counters.max() == 2


def test_near_pairs_without_a_shuffle_of_shingles(spark):
    texts, cfg = _texts(40), DedupConfig(verify="exact", threshold=0.9)
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")
    fp = dedup.fingerprint(df)
    sets = _sets(texts)
    first = [i for i, s in enumerate(sets) if s not in sets[:i]]
    want = {(i, j) for i, j in itertools.combinations(first, 2) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) > 0.9}
    assert want and {tuple(r) for r in dedup.near_pairs(fp, cfg).collect()} == want
    narrow, whole = dedup._marked_reps(fp, cfg)
    assert "shingles" not in narrow.columns and "canonical_text" not in narrow.columns
    assert whole.select("original_index", "shingles", "_copy").count() == len(texts)


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a\n", "a b ", "　a b", "a b", "x\u0085\n"])
def test_stripped_at_both_ends(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    stripped = df.select(TX.strip_ws(F.col("t")).alias("s"))
    assert stripped.first()[0] == text.strip()
    assert df.select(TX.strip_ws(F.lit(None).cast("string"))).first()[0] is None


def test_safety_filter_runs_without_generated_code(spark, tmp_path, monkeypatch):
    from textmill.plans import registry
    from textmill import session
    spark.createDataFrame([(0, "call 555-123-4567 now", "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, real = [], session.reliable_checkpoint
    monkeypatch.setattr(session, "reliable_checkpoint", lambda df: seen.append(spark.conf.get("spark.sql.codegen.wholeStage")) or real(df))
    assert registry.q_safety_filter(spark, str(tmp_path)).count() == 1
    assert seen == ["false"] and spark.conf.get("spark.sql.codegen.wholeStage", "true") == "true"
