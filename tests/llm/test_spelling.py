"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import spelling

ROWS = "doc_id long, text string, word string, n string"


def vocabulary_by_hand(rows, least=3, drop=97):
    count = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= least}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def variants_by_hand(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], counts.get(form[w]), root)
    return out


def got_variants(df, **kw):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df, **kw).collect()}


def made_words(seed, n):
    rng = random.Random(seed)
    letters, words = "aabcdeéÿÀ", set()
    while len(words) < n:
        w = [rng.choice(letters) for _ in range(rng.randint(1, 8))]
        words.add("".join(w))
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(letters)
            words.add("".join(w) + rng.choice(["", "a"]))
    return {w: rng.choice([1, 2, 3, 5, 12, 40, 500]) for w in sorted(words)}


def test_letter_runs_and_checksums():
    texts = ["L'Été, naïve×÷x! ÀÿĀb ©¿Ã", "", "ABC¿defĀé", "x" * 50]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    w = spelling.letter_runs(data, offs)
    got = [w.word(i).decode() for i in range(len(w))]
    want = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for t in texts for x in re.findall("[A-Za-zÀ-ÿ]+", t)]
    assert got == want
    ids = [f"{i}:".encode() for i in (7, 123456, 8, -1)]
    assert spelling._crcs(w, ids).tolist() == [zlib.crc32(ids[r] + x.encode()) for r, x in zip(w.row, want)]


@pytest.mark.parametrize("drop", [97, 2, 0])
def test_vocabulary(spark, drop):
    rng = random.Random(drop)
    words = ["Apples", "apple", "éclair", "ÉCLAIR", "naïve", "hello", "worlds", "tiny", "o'neills"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + rng.choice([".", "Ā", ""])) for i in range(40)]
    rows += [(None, "hello hello"), (None, None), (1, ""), (2, "hello"), (2, "hello"), (3, "longword" * 3000 + " " + "longword" * 3000)]
    docs = spark.createDataFrame([(i, t, "own", "own") for i, t in rows], ROWS)
    got = {r.word: r.n for r in spelling.vocabulary(docs, drop_every=drop, min_count=2).collect()}
    assert got == vocabulary_by_hand(rows, 2, drop)
    assert spelling.vocabulary(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed,filter_bytes", [(1, 1 << 20), (2, 512), (3, 8)])
def test_variants_equal_brute_force(spark, seed, filter_bytes):
    """Also with passes of few lengths, and with filters so full that most edits pass."""
    counts = made_words(seed, 500)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert len(spelling.passes(collections.Counter(map(len, counts)), filter_bytes)) == {1 << 20: 1, 512: 4, 8: 9}[filter_bytes]
    assert got_variants(df, filter_bytes=filter_bytes) == variants_by_hand(counts)


def test_long_chains_ties_and_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PROBES", 5000)  # long words in parts
    chain = {"a" * (5 + i): 3 << i for i in range(30)}
    ties = {"tease": 3, "least": 50, "feast": 100, "beast": 100, "yeast": 100}
    long = {"b" * 700: 5, "b" * 350 + "c" + "b" * 349: 20, "b" * 699: 9, "d" * 699: 4}
    counts = chain | ties | long
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = got_variants(df)
    assert got == variants_by_hand(counts)
    assert got["aaaaa"][4] == "a" * 34 and got["least"][2] == "beast"
    assert got_variants(df.limit(0)) == {}
    assert got_variants(spark.createDataFrame([("alone", 3)], "word string, n long")) == {"alone": (3, 0, None, None, "alone")}


def test_words_of_one_name_stay_apart(spark, monkeypatch):
    """Equal names cost work and change nothing: all names of a length are made equal."""
    def all_equal(batches):
        for b in batches:
            length = [len(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(length, pa.int32()), pa.array(length, pa.int64())],
                                             names=["word", "n", "length", "name"])

    def probe(filters, blocks, first):
        def run(batches):
            for b in batches:
                name = [x for x in b.column(1).to_pylist() for _ in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array([x - i % 2 for i, x in enumerate(name)], pa.int64())],
                                                 names=["source", "edit"])
        return run

    monkeypatch.setattr(spelling, "_named", all_equal)
    monkeypatch.setattr(spelling, "_probe", probe)
    counts = made_words(4, 60)
    assert got_variants(spark.createDataFrame(list(counts.items()), "word string, n long")) == variants_by_hand(counts)
