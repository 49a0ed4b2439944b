"""Substring dedup, decontamination and near duplicates against brute force."""

import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textmill.llm import components, decontaminate, near_dup, recompress

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, spans string, k1 string, name string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", "own", "own", "own") for i, t in rows], DOCS)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def covered(texts, window):
    words = [BLANK.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[p: p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if count[tuple(w[p: p + window])] > 1:
                gone[p: p + window] = [True] * window
        out.append((w, gone))
    return out


def corpus(seed):
    """Texts that share passages, repeat words and copy each other with edits."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "the", "the", "the"]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    texts = [None, "", "   ", "one"]
    for _ in range(60):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 20))]
        if rng.random() < 0.2:
            w += [rng.choice(words)] * rng.randint(1, 40)
        texts.append(rng.choice([" ", "  ", "\n"]).join(w))
    for t in texts[10:20]:
        w = t.split()
        if w:
            w[rng.randrange(len(w))] = "edit"
        texts += [t, " ".join(w)]
    return texts


@pytest.mark.parametrize("seed,window", [(1, 8), (2, 12), (3, 35)])
def test_repeats_equal_brute_force(spark, seed, window):
    texts = corpus(seed) + ["lang " * 5000 + "x"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    got = recompress.remove_repeats(frame(spark, rows), window=window)
    assert got.columns == ["doc_id", "text", "spans", "k1", "name", "n_words", "n_removed"]
    want = collections.Counter()
    for (i, t), (w, gone) in zip(rows, covered(texts, window)):
        kept = t if not any(gone) else " ".join(x for x, g in zip(w, gone) if not g)
        want[(i, kept, len(w), sum(gone))] += 1
    assert collections.Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in got.collect()) == want
    joined = recompress.remove_repeats(frame(spark, rows), window=window, keep_layout=False).collect()
    assert collections.Counter(r.text for r in joined) == collections.Counter(
        None if t is None else " ".join(x for x, g in zip(w, gone) if not g) for t, (w, gone) in zip(texts, covered(texts, window)))


def test_repeats_of_nothing(spark):
    assert recompress.remove_repeats(frame(spark, [])).count() == 0
    assert [r.text for r in recompress.remove_repeats(frame(spark, [(1, None), (2, None)])).collect()] == [None, None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=5, max_size=60), st.integers(0, 30), st.integers(1, 5))
def test_equal_contexts_have_equal_symbols(middle, shift, rounds):
    """A symbol depends on its context alone: the same words elsewhere give it."""
    from textmill.llm.words import NOT_SPACE, split_words

    def symbols(words):
        data = " ".join(words).encode()
        s = recompress.parse(split_words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), NOT_SPACE), rounds)
        return set(zip(s.name.tolist(), s.lo.tolist(), s.hi.tolist()))

    before = ["x", "a", "b"] * 10
    one = symbols(["q"] + middle + ["q"])
    two = symbols(before[:shift] + ["y"] + middle + ["z", "a"])
    inside = {(n, a, b) for n, a, b in one if a >= 1 and b <= 1 + len(middle)}
    assert {(n, a + shift, b + shift) for n, a, b in inside} <= two


BENCH = [(1, "the quick brown fox jumps over the lazy dog and then runs far away home"), (2, "short item"), (3, None), (4, "!!!"),
         (5, "the quick brown fox jumps over the lazy dog and then runs far"), (None, "no id here"), (10, "short item")]


def contamination_by_hand(text, bench, window=13):
    words, hit, items = ALNUM.findall(low(text)), set(), set()
    for i, t in bench:
        w = ALNUM.findall(low(t))
        n = min(window, len(w))
        for p in range(len(w) - n + 1) if n else ():
            for q in range(len(words) - n + 1):
                if words[q: q + n] == w[p: p + n]:
                    hit.update(range(q, q + n))
                    items |= {str(i)} if i is not None else set()
    return len(words), sorted(hit), sorted(items)


@pytest.mark.parametrize("block_windows", [1_000_000, 2])
def test_contamination_equals_brute_force(spark, block_windows):
    texts = [None, "", "...", "Short, ITEM!", "a " * 30 + BENCH[0][1].upper() + " b" * 300, "short item short item",
             "the quick brown fox jumps over the lazy dog and then runs close", "x no id here y", "word " * 50_000 + "short item"]
    rows = [(i if i else None, t) for i, t in enumerate(texts)] + [(4, texts[4])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in BENCH], "item_id long, text string, doc_id string")
    marked = decontaminate.contamination(frame(spark, rows), bench, block_windows=block_windows)
    assert marked.columns == ["doc_id", "text", "k1", "name", "n_words", "spans", "items"]
    got = collections.Counter()
    for r in marked.select("*", decontaminate.hit_words().alias("n_hit")).collect():
        hit = [w for s in r.spans for w in range(s.first, s.end)]
        assert r.n_hit == len(hit)
        got[(r.doc_id, r.n_words, str(hit), str(r["items"]))] += 1
    want = collections.Counter((i, n, str(h), str(x)) for i, t in rows for n, h, x in [contamination_by_hand(t, BENCH)])
    assert got == want
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(marked).collect()}
    assert cut[3] == "!" and cut[7] == "x  y" and cut[6] == texts[6] and cut[1] == ""


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(frame(spark, []), none).count() == 0
    (r,) = decontaminate.contamination(frame(spark, [(1, "a b")]), none).collect()
    assert (r.n_words, r.spans, r["items"]) == (2, [], [])


def shingles(text, k):
    w = BLANK.findall(low(text))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups_by_hand(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if find(y) == find(x) and rows[y][0] is not None]
        out.append((i, len(sets[x]), (min(ids) if ids else None) if sets[x] else i))
    return out


def near_corpus(seed):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    rows = [(1000, None), (1001, ""), (1002, " \t "), (1003, "one"), (1004, "ONE"), (1005, "two words"), (None, "two  words"),
            (1006, "long " * 30_000), (1007, "long " * 29_000)]
    for base in range(8):
        w = [rng.choice(words) for _ in range(rng.randint(10, 120))]
        for c in range(rng.randint(1, 12)):
            v = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                v[rng.randrange(len(v))] = rng.choice(words)
            rows.append((base * 100 + c, " ".join(v)))
            if rng.random() < 0.3:
                w = v  # a chain of versions
    rows += [rows[12], (rows[13][0] + 5000, rows[13][1].upper())]
    return rows


@pytest.mark.parametrize("seed,k", [(1, 2), (2, 2), (3, 5)])
def test_near_duplicates_equal_brute_force(spark, seed, k):
    rows = near_corpus(seed)
    got = near_dup.near_duplicates(frame(spark, rows), shingle=k).collect()
    want = groups_by_hand(rows, k)
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == collections.Counter(
        (i, n, c, i == c) for i, n, c in want)
    kept = near_dup.keep_one(frame(spark, rows), shingle=k)
    assert kept.columns == ["doc_id", "text", "n_words", "spans", "k1", "name"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        [str(c) for c in {c for _, n, c in want if n}] + [str(i) for i, n, _ in want if not n])


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dup.keep_one(frame(spark, [])).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = x[:2000], x[1000:]
    assert (near_dup.merge(near_dup.registers(a), near_dup.registers(b)) == near_dup.registers(x)).all()
    errors = []
    for common in (200, 900, 1600, 1990):
        a, b = x[:2000], x[2000 - common: 4000 - common]
        ra, rb = near_dup.registers(a), near_dup.registers(b)
        larger, equal = (ra > rb).sum(), (ra == rb).sum()
        j, e = near_dup.similarity(*(np.array([float(v)]) for v in (larger, 300 - larger - equal, equal, len(a), len(b))))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs(j[0] - true) / e[0])
    assert max(errors) < 4


@pytest.mark.parametrize("related,close,block", [(0.4, 0.75, 256), (0.4, 0.75, 3), (0.9, 2.0, 4), (0.0, 0.0, 2)])
def test_links_that_no_leader_shows(spark, monkeypatch, related, close, block):
    """Many versions at mixed distances; families and residual members alone, in small blocks."""
    monkeypatch.setattr(near_dup, "RELATED", related)
    monkeypatch.setattr(near_dup, "CLOSE", close)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        v = list(base)
        for k in rng.sample(range(120), rng.randint(0, 9)):
            v[k] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(v)))
    got = near_dup.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, c) for i, _, c in groups_by_hand(rows, 2))


def test_across_finds_links_that_the_stars_miss(spark, monkeypatch):
    """a - b - c where only the middle is alike to both, whatever leads a bucket."""
    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(base[12:] + [f"x{i}" for i in range(4)])), (3, " ".join(base[20:] + [f"x{i}" for i in range(16)]))]
    got = near_dup.near_duplicates(frame(spark, rows), shingle=2, m=300, band=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, c) for i, _, c in groups_by_hand(rows, 2))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (1002, 1000), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000, 1002: 1000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
