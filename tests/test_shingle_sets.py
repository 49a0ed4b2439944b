"""Near duplicates in exact mode: keys of similar sets, blocks, and what is left out."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from textmill.config import DedupConfig
from textmill.operators import dedup
from textmill.operators import shingle_sets as SS


def _grams(text: str) -> frozenset:
    words = text.split(" ")
    return frozenset(tuple(words[i:i + 3]) for i in range(len(words) - 2) if all(words[i:i + 3]))


def _jaccard(a, b) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def _family(rng, words: int, members: int, changes: int) -> list[str]:
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(members):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(text))
    return out


def _keys(texts, threshold):
    names, keys = SS.names_and_keys(pa.array(texts), threshold)
    return names.to_pylist(), [set(x or ()) for x in keys.to_pylist()]


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "a b c a b c a b", "a  b c d", " a b c", "a b c ", "é ü ö é ü", "a\nb c d e"])
def test_names_follow_the_set(text):
    one, two, row = SS.named_sets(pa.array([text, "p q r s", text]))
    assert np.bincount(row, minlength=3).tolist() == [len(_grams(text)), 2, len(_grams(text))]
    assert one[row == 0].tolist() == one[row == 2].tolist() and two[row == 0].tolist() == two[row == 2].tolist()


def test_names_of_sets_and_not_of_texts(monkeypatch):
    texts = ["a b c a b c a", "b c a b c a b", "a b", "", None, "a b c d"]
    names, keys = SS.names_and_keys(pa.array(texts), 0.9)
    assert names[0] == names[1] and names[2] == names[3] == names[4] and len(set(names.to_pylist())) == 3
    monkeypatch.setattr(SS, "SLICE_BYTES", 1)
    again = SS.names_and_keys(pa.array(texts), 0.9)
    assert again[0].equals(names) and again[1].equals(keys)
    assert SS.names_and_keys(pa.array(texts), None)[1].null_count == 6
    assert len(SS.names_and_keys(pa.array([], pa.string()), 0.9)[0]) == 0


@pytest.mark.parametrize("threshold", [0.85, 0.9, 0.95])
def test_similar_sets_share_a_key(threshold):
    rng, found = random.Random(7), 0
    texts = [t for words in [*range(10, 200), 400, 1500] for t in _family(rng, words, 4, max(1, words // 60))]
    sets, (_, keys) = [_grams(t) for t in texts], _keys(texts, threshold)
    for start in range(0, len(texts), 4):
        for i, j in itertools.combinations(range(start, start + 4), 2):
            if sets[i] != sets[j] and _jaccard(sets[i], sets[j]) >= threshold:
                found += 1
                assert keys[i] & keys[j], (texts[i], texts[j])
    assert found > 20


def test_rows_with_an_empty_part_share_their_prefix():
    """All equal parts of two sets may be empty: that pair is found by a prefix."""
    parts = SS.levels(0.9, 64)[1]
    level = np.searchsorted(SS.levels(0.9, 64)[0], 12, side="right") - 1
    assert parts[level] == 2
    low = np.arange(1, 13, dtype=np.uint64)  # all in the first of two parts
    other = np.sort(np.concatenate([low[1:], np.array([99], dtype=np.uint64)]))
    one, row = np.concatenate([low, other]), np.repeat(np.array([0, 1], dtype=np.uint16), 12)
    keys, of = SS.shared_keys(one, one, row, 2, 0.85)
    assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_a_common_passage_makes_no_candidates(spark):
    """Any number of texts with a rare passage in common: no pair of them meets."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(100)) + " " + passage for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")
    assert dedup._exact(dedup.fingerprint(df), DedupConfig(verify="exact"))[1].count() == 0


@pytest.mark.parametrize("blocks", [1, 2])
def test_similar_rows_are_those_of_all_pairs(blocks, monkeypatch):
    rng = random.Random(blocks)
    texts = _family(rng, 80, 20, 3) + _family(rng, 90, 10, 2) + ["", "a b", "a b c"]
    sets = [_grams(t) for t in texts]
    block = np.array([i % blocks for i in range(len(texts))])
    want = {(i, j) for i, j in itertools.permutations(range(len(texts)), 2)
            if _jaccard(sets[i], sets[j]) > 0.9 and (blocks == 1 or block[i] != block[j])}
    for cells in (SS._CELLS, 64):
        monkeypatch.setattr(SS, "_CELLS", cells)
        a, b = SS.similar_rows(SS.member_names(pa.array(texts)), block, 0.9)
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def _expected(texts, threshold):
    """Pairs, dropped rows and leaders by the sequential rule, over all pairs."""
    sets = [_grams(t) for t in texts]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    rows = sorted(first.values())
    pairs = {(i, j) for i, j in itertools.combinations(rows, 2) if _jaccard(sets[i], sets[j]) > threshold}
    kept, led = [], {}
    for j in rows:
        near = [i for i in kept if (i, j) in pairs]
        if near:
            led[j] = min(near)
        else:
            kept.append(j)
    copies = {i: led.get(first[s], first[s]) for i, s in enumerate(sets) if first[s] != i}
    return pairs, led | copies


def _mixed_families(threshold):
    rng = random.Random(11)
    texts = [t for n in (100, 101, 300, 400) for t in _family(rng, n, 12, 4)] + ["a b", "c", "a b c d e"] * 2
    rng.shuffle(texts)
    return texts, *_expected(texts, threshold)


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")


@pytest.mark.parametrize("rows,threshold", [(3, 0.9), (5, 0.8)])
def test_pairs_in_blocks(spark, monkeypatch, rows, threshold):
    monkeypatch.setattr(dedup, "BLOCK_ROWS", rows)
    texts, pairs, _ = _mixed_families(threshold)
    found = [tuple(r) for r in dedup.near_pairs(dedup.fingerprint(_frame(spark, texts)), DedupConfig(verify="exact", threshold=threshold)).collect()]
    assert set(found) == pairs and len(found) == len(pairs) > 30


def test_leaders_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_ROWS", 4)
    texts, _, led = _mixed_families(0.9)
    assert {r.original_index: r.leader for r in dedup.leaders(_frame(spark, texts), DedupConfig(verify="exact")).collect()} == led


@pytest.mark.parametrize("per_row", [1024, -1])
def test_listed_pairs_and_leaders_alone_drop_the_same(spark, monkeypatch, per_row):
    monkeypatch.setattr(dedup, "BLOCK_PAIRS_PER_ROW", per_row)
    texts, _, led = _mixed_families(0.9)
    flags = {r.original_index: r.is_duplicate for r in dedup.annotate_near(_frame(spark, texts), DedupConfig(verify="exact")).collect()}
    assert flags == {i: i in led for i in range(len(texts))}


def test_a_family_of_many_keys_is_one_bucket(spark):
    """Members of a family share other keys pair by pair; they are sent once."""
    texts = _family(random.Random(5), 300, 40, 6)
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")
    _, buckets, sets = dedup._exact(dedup.fingerprint(df), DedupConfig(verify="exact"))
    assert buckets.select("key").distinct().count() == 1 and buckets.count() == sets.count() == len(set(texts))


def test_rows_of_one_index_are_compared_each(spark):
    """Every two rows of a pair of indices are listed, as rows joined to a pair are."""
    near = _family(random.Random(2), 200, 30, 1)
    a, b = list(dict.fromkeys(near))[:2]
    df = spark.createDataFrame([(1, a), (1, a), (2, b), (2, b), (3, "c d e f"), (None, b)], "original_index long, text string")
    fp = dedup.fingerprint(df)
    assert [tuple(r) for r in dedup.near_pairs(fp, DedupConfig(verify="exact")).collect()] == [(1, 2)] * 4
