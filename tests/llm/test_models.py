"""Trained operators: held-out accuracy, gradients, edge rows; nearest neighbours."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from textmill.llm import ann_tree, crf_lang, samples, toxicity
from textmill.llm.words import ALNUM, split_words

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, score string, c0 long"


def docs_of(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_language_of_held_out_documents(spark):
    docs = docs_of(spark)
    rows = E.queries()["op8_language_id"](spark, SF).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_language_labels_words_of_mixed_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = crf_lang.train(docs, F.lit(True), per_language=60)
    by = {}
    for r in docs.orderBy("doc_id").collect():
        if 600 < len(r.text) < 4000 and r.text.count(" ") > 80:
            by.setdefault(r.lang, r.text)
    parts = [" ".join(by[x].split()[:60]) for x in ("fr", "de", "en")]
    rows = [(1, " ".join(parts), None, None, "own", 1), (2, None, "x", None, "own", 1), (3, "", None, None, "own", 1),
            (4, "12 345 !", None, None, "own", 1), (None, parts[0], None, None, "own", 1), (6, parts[1] * 2000, None, None, "own", 1)]
    got = crf_lang.predict(spark.createDataFrame(rows, DOCS), model, word_labels=True)
    assert got.columns == ["doc_id", "text", "lang", "source", "c0", "lang_pred", "score", "word_labels"]
    got = {r.doc_id: r for r in got.collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "fr" and got[6].lang_pred == "de"
    n = [len(split_words(*_buffer(p), ALNUM)) for p in parts]
    labels = got[1].word_labels
    assert len(labels) == sum(n)
    own = ["fr"] * n[0] + ["de"] * n[1] + ["en"] * n[2]
    assert sum(a == b for a, b in zip(labels, own)) > 0.9 * len(own)


def _buffer(text):
    raw = text.encode()
    return np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(0)
    length = np.array([1, 2, 4, 5])
    emission = rng.normal(size=(4, crf_lang.CHAIN, 3)).astype(np.float64)
    move = rng.normal(size=(3, 3))
    gamma, pairs = crf_lang.forward_backward(emission, length, move)
    want_pairs = np.zeros((3, 3))
    for c, n in enumerate(length):
        weight, marginal, total = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for code in range(3**n):
            y = [code // 3**i % 3 for i in range(n)]
            w = np.exp(sum(emission[c, t, y[t]] for t in range(n)) + sum(move[a, b] for a, b in zip(y, y[1:])))
            weight += w
            marginal[np.arange(n), y] += w
            for a, b in zip(y, y[1:]):
                total[a, b] += w
        assert np.allclose(gamma[c, :n], marginal / weight) and not gamma[c, n:].any()
        want_pairs += total / weight
    assert np.allclose(pairs, want_pairs)


def test_language_without_anything_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    assert crf_lang.train(empty, F.lit(True)) is None
    rows = spark.createDataFrame([(1, "text", None, None, None, 1), (None, None, None, None, None, None)], DOCS)
    assert crf_lang.train(rows, F.lit(True)) is None
    assert [(r.lang_pred, r.score) for r in crf_lang.predict(rows, None).collect()] == [("und", 0.0)] * 2
    model = crf_lang.fit(["only one language", "still one"], ["xx", "xx"])
    assert crf_lang.predict(empty, model).count() == 0
    assert {r.lang_pred for r in crf_lang.predict(rows, model).collect()} == {"xx", "und"}


def test_one_long_text_does_not_end_the_language_sample(spark):
    words = {"en": "the house and water of", "fr": "maison avec des rivieres", "xx": "qwz jvk zzt"}
    rows = [(i, f"{words[x]} " * 4, x, None, None, i) for i, x in enumerate(["en", "fr"] * 20 + ["xx"])]
    docs = spark.createDataFrame(rows, DOCS)
    (first,) = docs.orderBy(F.xxhash64("doc_id", F.lit(5))).limit(1).collect()
    long = docs.withColumn("text", F.when(F.col("doc_id") == first.doc_id, F.repeat("text", 300)).otherwise(F.col("text")))
    model = crf_lang.train(long, F.lit(True), sample_bytes=12_000)
    assert model is not None and model.labels == ["en", "fr", "xx"]
    assert all(r.lang_pred == r.lang for r in crf_lang.predict(docs, model).collect())


def test_more_languages_than_256_are_learned(spark, monkeypatch):
    monkeypatch.setattr(crf_lang, "WEIGHTS", 1 << 19)  # fewer weights a language, not fewer languages
    rng = np.random.default_rng(4)
    own = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(270)]
    rows = [(i * 2 + j, f"{w} {w}s {w}en", f"l{i:03}", None, None, None) for i, w in enumerate(own) for j in range(1 if i == 7 else 2)]
    docs = spark.createDataFrame(rows, DOCS)
    model = crf_lang.train(docs, F.lit(True))
    assert len(model.labels) == 270 and crf_lang.buckets_for(270) == len(model.weights) - 1 == 1024
    got = crf_lang.predict(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) > 0.95 * len(got)
    assert {r.lang_pred for r in got if r.lang == "l007"} == {"l007"}  # the rarest


def test_toxicity_of_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = E.queries()["op3_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.85
    assert np.mean([p for _, y, p in held if not y]) < 0.1


def test_toxicity_edge_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(None, 1, None), (7, 0, None), (8, None, None)],
                                   "doc_id long, toxic int, text string")
    rows = [(i, f"plain word{i} here " + ("vile" if i % 2 else "fine"), "en", "s", "own", i) for i in range(60)]
    edge = [(100, None, None, None, None, None), (101, "", "en", "s", "own", 1), (None, "vile words", "en", "s", "own", 1),
            (102, "so vile", "en", "s", "own", 1), (103, "so fine " * 40_000, "en", "s", "own", 1), (0, rows[0][1], "en", "s", "own", 0)]
    docs = spark.createDataFrame(rows + edge, DOCS)
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "c0", "score"] and got.count() == 66
    by = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert by[(100, None)] == by[(101, "")] < 0.5 < by[(102, "so vile")] and by[(None, "vile words")] > 0.5
    assert by[(103, "so fine " * 40_000)] < 0.5
    # long texts are pooled block by block: one vile word far inside counts as in a short text
    texts = ["fine " * 250_000 + "vile " + "fine " * 10, "fine " * 10 + "vile " + "fine " * 10, "fine " * 20]
    far = {len(r.text): r.score for r in toxicity.score(
        spark.createDataFrame([(1, t, "", "", "", 1) for t in texts], DOCS), model).collect()}
    one, two, none = (far[len(t)] for t in texts)
    assert one == pytest.approx(two) and two > none
    assert toxicity.train(docs, labels.where("toxic = 1"), F.lit(True)) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.train(docs.limit(0), labels.limit(0), F.lit(True)) is None
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_one_long_text_does_not_end_its_class(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"plain word{i} here " + ("vile" if i % 2 else "fine"), "en", "s", "own", i) for i in range(60)], DOCS)
    (first,) = docs.where("doc_id % 2 = 1").orderBy(F.xxhash64("doc_id")).limit(1).collect()  # the first of its class
    long = docs.withColumn("text", F.when(F.col("doc_id") == first.doc_id, F.repeat(F.lit("vile plain "), 2000)).otherwise(F.col("text")))
    model = toxicity.train(long, labels, F.lit(True), sample_bytes=8000)
    assert model is not None
    by = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((by[i] >= 0.5) == (i % 2 == 1) for i in range(60))


def test_long_texts_are_held_to_spread_windows(spark):
    assert samples.fair_length([5, 100, 7, 300], 72) == 30 and samples.fair_length([5, 6], 11) == 6
    assert samples.fair_length([9, 9], 1) == 1 and samples.fair_length([], 5) == samples.fair_length([0], 5) == 1
    text = "".join(chr(0x100 + i) for i in range(1000))
    rows = spark.createDataFrame([(text, 1000), (text, 80), (text, 1), ("", 1)], "t string, most int")
    whole, some, least, none = [r.t for r in rows.select(samples.held_to(F.col("t"), F.col("most")).alias("t")).collect()]
    assert whole == text and none == "" and some.startswith(text[:9] + "\n") and some.endswith("\n" + text[-9:])
    assert len(some) == 79 and all(x in text for x in some.split("\n")) and len(least.split("\n")) == 8


def test_toxicity_does_not_read_the_language_column(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    texts = [r.text for r in docs.collect()]
    model = toxicity.fit(texts, np.arange(200) % 3 == 0, ["a" if i % 2 else "b" for i in range(200)], np.arange(200) % 5 == 0, epochs=1)
    one = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    two = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id")), model).collect()}
    assert one == two


def brute(ids, x, own, q, k):
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    return [(int(ids[i]), d[i]) for i in np.lexsort((ids, d)) if ids[i] != own][:k]


def test_nearest_reaches_the_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = collections.defaultdict(list)
    for r in E.queries()["op2_nearest"](spark, SF).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [int(i) for i in sorted(ids) if i % 100 == 0]
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, *_ in found] == list(range(1, 11)) and [s for *_, s in found] == sorted(s for *_, s in found)
        for _, i, s in found:
            assert s == pytest.approx(np.sqrt(((x[ids == i][0] - x[ids == q][0]) ** 2).sum()), abs=1e-12)
        hit += len({i for _, i, _ in found} & {i for i, _ in brute(ids, x, q, x[ids == q][0], 10)})
    assert hit >= 0.9 * 10 * len(got)


def test_nearest_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0], "own"), (1, [1.0, 0.0], "own"), (2, [1.0, 0.0], "own"), (3, [0.0, 2.0], "own"), (4, None, "own"),
            (5, [0.0, 0.0], "own"), (6, [1.0, None], "own"), (7, [nan, 1.0], "own"), (8, [inf, 1.0], "own"), (9, [1.0], "own"),
            (None, [1.0, 1.0], "own"), (200, [0.0, 0.0], "own"), (300, None, "own"), (2, [1.0, 0.0], "own"), (100, [1.0, 0.0], "own"),
            (10, [], "own")]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf string")
    got = [tuple(r) for r in ann_tree.nearest(v, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 0.0), (100, 3, 2, 0.0)]
    more = ann_tree.nearest(v, F.col("vec_id") % 100 == 0, k=10).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 6)) for r in more] == [(1, 0), (2, 0), (2, 0), (3, round(5**0.5, 6))]
    assert ann_tree.nearest(v.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert ann_tree.nearest(v.where("vec_id > 3"), F.col("vec_id") % 100 == 0).count() == 0


def test_hot_vector_and_blocks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF_BLOCK", 50)
    monkeypatch.setattr(ann_tree, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann_tree.nearest(v, F.col("vec_id") % 100 == 0, k=5, recall=1.0).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    ids, x = np.arange(900), np.array([r[1] for r in rows])
    for q, found in got.items():
        if q % 3 == 0:
            assert [i for _, i in sorted(found)] == [i for i, _ in brute(ids, x, q, x[q], 5)]
    assert len(got) == 9


def test_small_leaves_still_give_k_rows(spark):
    rng = np.random.default_rng(6)
    # most rows in large groups of copies, so that one visit is calibrated; a few far ones alone in their leaves
    rows = [(i, [float(i % 4), 0.0, 0.0]) for i in range(1, 2000)] + [(3000 + i, (50 * rng.normal(size=3)).tolist()) for i in range(8)]
    rows += [(3000, rows[-8][1]), (3000, [1.0, 2.0, 3.0])]  # rows of a query's own id do not count
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_tree.nearest(v, F.col("vec_id") >= 3000, k=10).groupBy("query_id").agg(F.max("rank").alias("n")).collect()
    assert sorted(r.query_id for r in got) == [3000 + i for i in range(8)]
    assert all(r.n >= 10 for r in got)
