"""The pipeline's stages against plain versions, and their edge rows."""

import collections
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from test_repeats import ALNUM, contamination_by_hand, covered, groups_by_hand
from textmill.llm import toxicity

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return collections.Counter(map(str, df.collect()))


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), toxicity.fold(F.col("doc_id"), 5) != 0)
    one = cp.drop_toxic(spark, docs, SF).cache()
    left = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    assert {r.doc_id for r in one.collect()} == left and one.columns == columns

    two = cp.drop_near_duplicates(spark, one, SF).cache()
    pairs = [(r.doc_id, r.text) for r in one.collect()]
    assert {r.doc_id for r in two.collect()} == {i for i, _, c in groups_by_hand(pairs, 5) if i == c} and two.columns == columns

    three = cp.cut_repeats(spark, two, SF).cache()
    rows = two.collect()
    want = {}
    for r, (w, gone) in zip(rows, covered([r.text for r in rows], cp.REPEAT_WORDS)):
        want[r.doc_id] = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else r.text
    assert {r.doc_id: r.text for r in three.collect()} == want and three.columns == columns
    before = {r.doc_id: r for r in rows}
    assert all(r.n_chars == (len(r.text) if r.text != before[r.doc_id].text else before[r.doc_id].n_chars) for r in three.collect())

    four = cp.drop_contaminated(spark, three, SF).cache()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(ALNUM.findall(t.lower())[:1]) for _, t in bench}
    clean = set()
    for r in three.collect():
        words = ALNUM.findall(r.text.lower())
        if not any((w,) in grams for w in words):
            clean.add(r.doc_id)
            continue
        n, hit, _ = contamination_by_hand(r.text, bench)
        if not (hit and 20 * len(hit) >= n):
            clean.add(r.doc_id)
    assert {r.doc_id for r in four.collect()} == clean and four.columns == columns

    five = cp.pack_sequences(spark, four, SF).collect()
    t = Tokenizer.from_file(BYTE)
    got = collections.defaultdict(dict)
    for r in five:
        got[r.doc_id][r.start] = np.frombuffer(r.ids, dtype="<u4").tolist()
    for r in four.collect():
        assert sum((got[r.doc_id][s] for s in sorted(got[r.doc_id])), []) == [*t.encode(r.text, add_special_tokens=False).ids, 1]

    assert rows_of(cp.run(spark, SF).select("doc_id", "start", "length", "doc_tokens")) == collections.Counter(
        map(str, spark.createDataFrame(five).select("doc_id", "start", "length", "doc_tokens").collect()))


def test_stages_take_odd_rows(spark):
    extra = ["n_words", "n_removed", "spans", "items", "score", "k1", "c0"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    own = ("own",) * len(extra)
    rows = [(1, None, None, None, None, *own), (2, "", "en", "s", 0, *own), (None, "a few words", "en", "s", 11, *own),
            (3, "kept words here", "en", None, 15, *own), (3, "kept words here", "en", None, 15, *own), (4, "long " * 20_000, "en", "s", None, *own)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {r.k1 for r in out.collect()} == {"own"} and {r.n_removed for r in out.collect()} == {"own"}
    assert cp.drop_near_duplicates(spark, docs, SF).count() == 5
    texts = {r.doc_id: r.text for r in cp.cut_repeats(spark, docs, SF).collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == "kept words here" and texts[4] == ""
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {r.doc_id for r in cp.pack_sequences(spark, docs, SF).collect()} == {1, 2, 3, 4, None}
    assert re.match("toxicity", cp.STAGES[0][0])
