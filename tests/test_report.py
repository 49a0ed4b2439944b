"""Report tables with any input absent, blocklist tables of any size, scorers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textmill.config import PerplexityConfig, SafetyConfig
from textmill.operators import blocklist, cleaning, dedup, perplexity, report, safety, tokens
from textmill.plans import report_run

CLEAN = {"total_samples": 10, "kept_samples": 8, "dropped_samples": 2, "reason__too_short": 2, "reason__too_long": 0, "reason__empty_text": 0}
SAFE = {"total_samples": 8, "kept_samples": 5, "toxic_dropped": 1, "pii_dropped": 2, "empty_texts": 0, "tag__safe": 3, "tag__unknown": 5,
        "tag__suspect": 0, "pii__SSN": 1, "pii__EMAIL_ADDRESS": 2, "pii__IP_ADDRESS": 0}
DEDUP = {"total_samples": 5, "kept_samples": 4, "duplicates_removed": 1, "duplicate_rate": 0.2}
TOKENS = {"total_samples": 4, "kept_samples": 3, "dropped_samples": 1, "avg_token_length": 4.0, "median_token_length": 4,
          "reason__too_few_tokens": 1, "reason__too_many_tokens": 0}
STAGES = [("load", 12, 10, 2.0, 5.0), ("clean", 10, 8, 1.0, 8.0), ("tokenize", 4, 3, 1.0, 3.0)]


@pytest.fixture(scope="module")
def kept(spark):
    return spark.createDataFrame([(1, "abc", 3, 30, None), (2, "de", 5, 50, None), (3, "f", 10, 10, None)],
                                 "original_index long, text string, token_count int, char_length int, drop_reason string").cache()


@pytest.fixture(scope="module")
def full(spark, kept):
    return {"languages": spark.createDataFrame([("en", 10), ("de", 4)], "language string, n long"), "clean": CLEAN, "safety": SAFE,
            "flagged": spark.createDataFrame([("hate", 2)], "token string, n long"), "dedup": DEDUP, "tokens": TOKENS,
            "scores": spark.createDataFrame([(1, 2.0), (2, None), (3, 6.0)], "original_index long, perplexity double"),
            "stages": STAGES, "seconds": 4.0}


def rows(tables, name):
    return [tuple(r) for r in tables[name].collect()]


def test_all_tables(kept, full):
    t = report_run.build(kept, **full)
    assert t["statistics"].first().asDict() == {
        "total_samples": 3, "duplicate_rate": 0.2, "pii_detection_rate": 0.25, "toxicity_rate": 0.125, "avg_token_length": 6.0,
        "median_token_length": 5.0, "min_token_length": 3.0, "max_token_length": 10.0, "avg_char_length": 30.0, "median_char_length": 30.0}
    assert dict(rows(t, "drop_reason_counts")) == {"cleaning_too_short": 2, "safety_toxic": 1, "safety_contains_pii": 2,
                                                   "tokenization_too_few_tokens": 1, "deduplication_duplicate": 1}
    assert rows(t, "pii_type_counts") == [("EMAIL_ADDRESS", 2), ("SSN", 1)]  # sorted bars
    assert rows(t, "prefilter_tags") == [("unknown", 5), ("safe", 3)]
    assert rows(t, "throughput")[3:] == [("total", "run", 12, 3, 4.0, 0.75), ("average", "run", None, 3, 4.0, 0.75),
                                         ("peak", "clean", 10, 8, 1.0, 8.0)]
    summary = {m: v for _, m, v in rows(t, "summary")}
    assert summary["retention_rate"] == 3 / 14 and summary["samples_after_language_filter"] == 10 and summary["peak_rows_per_sec"] == 8.0
    assert t["token_histogram"].agg(F.sum("n")).first()[0] == 3 and t["perplexity_stats"].first().samples_evaluated == 2
    assert t["kept_drop_reasons"].count() == 0 and t["language_top"].count() == 2
    box = t["token_boxplot"].first()
    assert (box.q1, box.median, box.q3, box.min, box.max) == (4.0, 5.0, 7.5, 3.0, 10.0)


GONE = {"languages": {"language_distribution", "language_top"}, "clean": {"cleaning_drop_reasons"}, "safety": {"pii_type_counts", "prefilter_tags"},
        "flagged": {"toxic_removals"}, "dedup": set(), "tokens": set(), "scores": {"perplexity_histogram"}, "stages": {"throughput"}}


@pytest.mark.parametrize("absent", sorted(GONE))
def test_each_input_absent(kept, full, absent):
    every = set(report_run.build(kept, **full))
    t = report_run.build(kept, **(full | {absent: None}))
    assert every - set(t) == GONE[absent]
    summary = {m for _, m, _ in rows(t, "summary")}
    assert ("retention_rate" in summary) == (absent != "languages") and ("peak_rows_per_sec" in summary) == (absent != "stages")
    assert ("duplicate_rate" in summary) == (absent != "dedup") and "final_samples" in summary
    stats = t["statistics"].first()
    assert stats.duplicate_rate == (0.0 if absent == "dedup" else 0.2) and stats.toxicity_rate == (0.0 if absent == "safety" else 0.125)
    if absent == "scores":
        assert t["perplexity_stats"].first().error == "disabled"
    reasons = dict(rows(t, "drop_reason_counts"))
    assert ("cleaning_too_short" in reasons) == (absent != "clean") and ("safety_toxic" in reasons) == (absent != "safety")


def test_only_kept_rows(spark):
    """Rates and PII types fall back to the kept rows; a column that is missing gives no table."""
    text = spark.createDataFrame([("I hate you!!! ??? kill",), ("mail a.b@EXAMPLE.COM now",), ("fine words",)], "text string")
    rows_ = safety.annotate(text.withColumn("original_index", F.monotonically_increasing_id()), SafetyConfig(enabled=False))
    t = report_run.build(rows_.withColumn("drop_reason", F.when(F.col("text") == "fine words", "too_short")))
    stats = t["statistics"].first()
    assert stats.toxicity_rate == 1 / 3 and stats.pii_detection_rate == 1 / 3 and "avg_token_length" not in stats
    assert stats.avg_char_length == (22 + 24 + 10) / 3  # of the text, without a length column
    assert rows(t, "pii_type_counts") == [("EMAIL_ADDRESS", 1)] and rows(t, "kept_drop_reasons") == [("too_short", 1)]
    assert rows(t, "drop_reason_counts") == [("cleaning_too_short", 1)] and "token_histogram" not in t and "char_histogram" not in t
    empty = report_run.build(rows_.limit(0))
    assert empty["statistics"].first().total_samples == 0 and "char_histogram" not in empty


def test_observed_columns_equal_the_tables(spark):
    """The aggregates that a run observes are those of the metric functions."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["x" * 100, "", None, "short", "some words " * 20, "some words " * 20])],
                                 "original_index long, text string")
    clean = cleaning.annotate(docs)
    seen = clean.agg(*[v.alias(k) for k, v in cleaning.metric_columns().items()]).first().asDict()
    assert {k[8:]: n for k, n in seen.items() if k.startswith("reason__") and n} == {r.drop_reason: r.n for r in cleaning.drop_counts(clean).collect()}
    tok = tokens.annotate(cleaning.kept(clean), tokens.TokenConfig(encoding=tokens.WORD_HASH))
    seen = tok.agg(*[v.alias(k) for k, v in tokens.metric_columns().items()]).first().asDict()
    assert {k[8:]: n for k, n in seen.items() if k.startswith("reason__") and n} == {r.drop_reason: r.n for r in tokens.drop_counts(tok).collect()}
    dup = dedup.annotate_exact(cleaning.kept(clean))
    assert dedup.metrics(dup).first().asDict() == {"total_samples": 3, "kept_samples": 2, "duplicates_removed": 1, "duplicate_rate": 1 / 3}
    h = report.histogram(docs.select(F.col("original_index").alias("x")), "x", 5, upper_limit=2)
    assert [(r.bin, r.n) for r in h.orderBy("bin").collect()] == [(0, 1), (1, 1)]


def test_blocklist_table(spark):
    rng = random.Random(4)
    listed = {f"bad{a}{b}": round(rng.uniform(0.1, 2.0), 2) for a in "abcdefghij" for b in "klmnopqrst"} | {"Zero": 0.0}
    texts = [" ".join(rng.choice([*listed, *["fine", "plain"] * 80]) for _ in range(40)) for _ in range(40)] + ["", None]
    docs = spark.createDataFrame([(0 if i < 3 else i, t) for i, t in enumerate(texts)], "original_index long, text string")
    want = safety.annotate(docs, SafetyConfig(blocklist=listed)).select("text", "toxicity.score", "toxicity.flagged_tokens")
    table = spark.createDataFrame([*listed.items(), ("", 9.0), (None, 1.0)], "word string, weight double")
    got = safety.annotate(docs, SafetyConfig(), blocklist=table).select("text", "toxicity.score", "toxicity.flagged_tokens")
    key = lambda df: sorted((str(r.text), r.score, tuple(r.flagged_tokens)) for r in df.collect())
    assert key(got) == key(want) and any(r[2] for r in key(want))

    words_of = docs.select("original_index", "text", F.split("text", " ").alias("w"))
    small = blocklist.add_found(words_of, "w", table, "found")
    large = blocklist.add_found(words_of, "w", table, "found", broadcast_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert set(large.columns) == set(small.columns)


def test_a_large_blocklist_does_not_grow_the_plan(spark):
    docs = spark.createDataFrame([(1, "a line of some length with wordabcde in it"), (2, "another line of some length, with nothing listed")], "original_index long, text string")
    sizes = []
    for n in (10, 100_000):
        table = spark.range(n).select(F.concat(F.lit("word"), F.translate(F.lpad(F.col("id").cast("string"), 5, "0"), "0123456789", "abcdefghij"))
                                      .alias("word"))
        out = safety.annotate(docs, SafetyConfig(), blocklist=table.union(spark.createDataFrame([("wordabcde",)], "word string")))
        assert {r.original_index: r.toxicity.flagged_tokens for r in out.collect()}[1] == ["wordabcde"]
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[1] - sizes[0]) < 200


def test_scorers(spark):
    def load():
        """A model that fails on one text and honours the length."""
        def model(texts, most):
            if any("poison" in t for t in texts):
                raise ValueError("no")
            return [None if len(t.split()) < 2 else float("inf") if "inf" in t else float(len(t.split()[:most])) for t in texts]
        return model

    rows_ = [(1, "one two three"), (2, " "), (3, None), (4, "single"), (5, "poison here"), (6, "inf inf"), (7, "a b c d e")]
    docs = spark.createDataFrame(rows_, "original_index long, text string").repartition(2)
    toy = perplexity.batch_scorer("toy", load)
    got = {r[0]: r[1] for r in perplexity.score_sample(docs, docs, PerplexityConfig(), toy).collect()}
    assert got == {1: 3.0, 2: None, 3: None, 4: None, 5: None, 6: None, 7: 5.0}
    got = {r[0]: r[1] for r in perplexity.score_sample(docs, docs, PerplexityConfig(max_length=2), toy).collect()}
    assert got[7] == 2.0
    bigram = {r[0]: r[1] for r in perplexity.score_sample(docs, docs, PerplexityConfig()).collect()}
    assert bigram[3] is None and bigram[4] is None and math.isfinite(bigram[7])
    stats = perplexity.stats(perplexity.score_sample(docs, docs, PerplexityConfig(), toy), "toy").first()
    assert (stats.model_name, stats.samples_evaluated, stats.mean_perplexity) == ("toy", 2, 4.0)


def test_a_sample_is_the_first_in_hash_order(spark):
    docs = spark.range(500).select(F.col("id").alias("original_index"), F.when(F.col("id") % 7 > 0, F.lit("text here")).otherwise(" ").alias("text"))
    for key in ("xxhash64", "md5"):
        small = [r[0] for r in perplexity.sample(docs, PerplexityConfig(sample_size=40), key).collect()]
        more = [r[0] for r in perplexity.sample(docs, PerplexityConfig(sample_size=1000), key).collect()]
        assert len(set(small)) == 40 and set(small) < set(more) and len(more) == sum(i % 7 > 0 for i in range(500))
