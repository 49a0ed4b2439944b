"""Runs of words against brute force, extensions against plain comparison."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textmill.llm import period_runs
from textmill.llm.period_runs import Grammar, runs
from textmill.llm.words import NOT_SPACE, slices, split_words


def by_hand(words, shortest=12):
    """Maximal stretches of every period, the smallest period of each."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            start = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            if x > start and x + q - start >= max(shortest, 2 * q):
                found.setdefault((start, x + q - start), q)
            x += x == start
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_hand(words, found):
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    return " ".join(w for x, w in enumerate(words) if x not in gone)


def got_runs(texts, shortest=12):
    out = [[] for _ in texts]
    for lo, _, data, offs in slices(pa.array(texts, pa.string())):
        for row, *run in zip(*(x.tolist() for x in runs(split_words(data, offs, NOT_SPACE), shortest))):
            out[lo + row].append(tuple(run))
    return out


def periodic(rng, letters):
    words = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 60)]
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [periodic(rng, [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 40]))]) for _ in range(60)]
    for shortest in (12, 4, 30):
        assert got_runs([" ".join(t) for t in texts], shortest) == [by_hand(t, shortest) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=5))
def test_runs_of_two_words(texts):
    assert got_runs([" ".join(t) for t in texts]) == [by_hand(list(t)) for t in texts]


def test_small_grid_blocks_and_many_candidates(monkeypatch):
    """Texts whose candidates come in many blocks, and more than are held."""
    texts = ["a " * 300, "a b " * 150, "x " + "a b c " * 70 + "y", "one two three", ""]
    want = [by_hand(t.split()) for t in texts]
    for grid in (1, 7, 500):
        monkeypatch.setattr(period_runs, "GRID", grid)
        assert got_runs(texts) == want


@pytest.mark.parametrize("seed", range(5))
def test_grammar_extensions(seed):
    rng = np.random.default_rng(seed)
    unit = rng.integers(0, 3, 30)
    s = np.concatenate([np.tile(unit, 6), rng.integers(0, 2, 200), np.zeros(100, int), np.tile([0, 1], 80)])
    name = np.concatenate([[3], s, [4]]).astype(np.int32)
    g = Grammar(name)
    i, j = rng.integers(1, len(s), (2, 400))
    i, j = np.minimum(i, j), np.maximum(i, j) + 1
    for a, b, ahead, back in zip(i.tolist(), j.tolist(), g.ahead_of(i, j).tolist(), g.before(i, j).tolist()):
        want = 0
        while b + want < len(name) and name[a + want] == name[b + want]:
            want += 1
        assert ahead == want
        want = 0
        while name[a - want - 1] == name[b - want - 1]:
            want += 1
        assert back == want


def test_a_jump_passes_many_words():
    """Extensions over a million equal or alternating words take few steps."""
    for unit in (["a"], ["a", "b", "c"]):
        n = 999_999
        assert got_runs([" ".join(unit * (n // len(unit)))]) == [[(0, n, len(unit))]]


def test_rows_of_all_kinds(spark):
    schema = "doc_id long, text string, runs string, n_words string, name string"
    rows = [(1, None), (2, ""), (None, "a " * 20), (3, "b c " * 10), (3, "b c " * 10), (4, " \n x  y\tz "),
            (5, "long " * 50_000 + "end"), (6, "l1 l2 l3 " * 3 + "l1 l2 " + "t " * 12)]
    docs = spark.createDataFrame([(i, t, "own", "own", "own") for i, t in rows], schema)
    out = period_runs.mark_runs(docs)
    assert out.columns == ["doc_id", "text", "name", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.text, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.name) for r in out.collect()), key=str)
    want = []
    for i, t in rows:
        w = (t or "").split()
        found = [(0, 50_000, 1)] if i == 5 else by_hand(w)
        want.append((i, t, len(w), found, None if t is None else "long end" if i == 5 else collapsed_by_hand(w, found), "own"))
    assert got == sorted(want, key=str)
    assert period_runs.mark_runs(docs.limit(0)).count() == 0
    best = {r.doc_id: r.b for r in out.select("doc_id", period_runs.longest().alias("b")).collect()}
    assert best[1] is None and tuple(best[3]) == (0, 20, 2) and tuple(best[6]) == (11, 12, 1)


def test_ties_of_the_longest(spark):
    one = spark.sql("SELECT array(named_struct('start', 5L, 'length', 12L, 'period', 1L), "
                    "named_struct('start', 2L, 'length', 12L, 'period', 4L), named_struct('start', 2L, 'length', 12L, 'period', 3L)) AS runs")
    assert tuple(one.select(period_runs.longest().alias("b")).first().b) == (2, 12, 3)
