"""Greedy dedup rounds equal the sequential rule; packing equals list
concatenation and slicing; prefix sums are partition-count independent."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.config import DedupConfig, TrainingConfig
from textmill.operators import dedup, ordering, training


def _sequential(n, edges):
    nb = {}
    for i, j in edges:
        nb.setdefault(j, set()).add(i)
    kept, dropped = set(), set()
    for v in range(n):
        if nb.get(v, set()) & kept:
            dropped.add(v)
        else:
            kept.add(v)
    return dropped


def test_greedy_matches_sequential(spark):
    rnd = random.Random(7)
    for _ in range(6):
        n = rnd.randint(5, 30)
        edges = sorted({tuple(sorted(rnd.sample(range(n), 2))) for _ in range(rnd.randint(0, 40))})
        e = spark.createDataFrame(edges or [], "i long, j long")
        got = {r[0] for r in dedup.greedy_dropped(e).collect()}
        assert got == _sequential(n, edges)


def test_chain_keeps_both_ends(spark):
    e = spark.createDataFrame([(0, 1), (1, 2)], "i long, j long")
    assert {r[0] for r in dedup.greedy_dropped(e).collect()} == {1}


def test_long_chain(spark):
    n = 60
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "i long, j long")
    assert {r[0] for r in dedup.greedy_dropped(e).collect()} == set(range(1, n + 1, 2))


@pytest.mark.parametrize("shape", ["line", "ladder"])
def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch, shape):
    n, rounds = 10_000, []
    edges = [(i, i + 1) for i in range(n - 1)]
    if shape == "ladder":  # each row is like the two before it
        edges += [(i, i + 2) for i in range(0, n - 2, 7)]
    real = dedup.reliable_checkpoint
    monkeypatch.setattr(dedup, "reliable_checkpoint", lambda df: rounds.append(1) or real(df))
    e = spark.createDataFrame(edges, "i long, j long")
    got = {r[0] for r in dedup.greedy_dropped(e).collect()}
    assert got == _sequential(n, edges)
    if shape == "line":
        assert len(rounds) - 1 <= 20


def test_a_long_chain_among_copies_and_stars(spark, monkeypatch):
    """Leaders first, then the chain that they would follow row by row."""
    n = 600
    edges = [(i, i + 1) for i in range(n)] + [(0, 1000 + i) for i in range(300)] + [(1000 + i, 2000 + i) for i in range(300)]
    pairs = spark.createDataFrame(edges, "lead long, original_index long")
    buckets = pairs.select(F.xxhash64("lead", "original_index").alias("key"), F.explode(F.array("lead", "original_index")).alias("original_index"))
    calls = []

    def similar(found):
        calls.append(1)
        return found.join(pairs, ["lead", "original_index"], "left_semi")
    got = {r[0] for r in dedup.leader_rounds(buckets, similar).collect()}
    assert got == _sequential(2300, edges) and len(calls) == dedup.LEADER_ROUNDS + 1
    monkeypatch.setattr(dedup, "PAIRS_PER_ROW", -1)  # leaders alone give the same
    short = [e for e in edges if max(e) <= 30 or min(e) >= 1000]
    few = spark.createDataFrame(short, "lead long, original_index long")
    buckets = few.select(F.xxhash64("lead", "original_index").alias("key"), F.explode(F.array("lead", "original_index")).alias("original_index"))
    assert {r[0] for r in dedup.leader_rounds(buckets, similar).collect()} == _sequential(2300, short)


def test_lsh_parameters():
    assert dedup.lsh_parameters(0.9, 128) == (5, 25)
    assert dedup.lsh_parameters(0.5, 128) == (25, 5)
    bands, rows = dedup.lsh_parameters(0.8, 128, recall=0.95)
    s = np.linspace(0.8, 1, 2001)
    assert bands * rows <= 128 and (1 - (1 - s ** rows) ** bands).mean() >= 0.95
    assert dedup.lsh_parameters(0.1, 4, recall=0.99) == (4, 1)  # the best there is
    for bad in ((0, 128, None), (1.0, 128, None), (0.5, 0, None), (0.5, 128, 1.0)):
        with pytest.raises(ValueError):
            dedup.lsh_parameters(*bad)


def test_searched_bands_find_what_exact_mode_finds(spark):
    """Recall against exact mode, for the shipped pair and a searched one."""
    rnd = random.Random(5)
    texts = []
    for g in range(120):
        w = [f"w{rnd.randrange(4000)}" for _ in range(120)]
        texts.append(" ".join(w))
        for _ in range(2):
            v = list(w)
            for _ in range(rnd.randint(1, 3)):
                v[rnd.randrange(120)] = f"x{rnd.randrange(4000)}"
            texts.append(" ".join(v))
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")

    def pairs(cfg):
        fp = dedup.fingerprint(df)
        reps = dedup._reps(fp, cfg)
        cands = dedup.prefix_candidates(reps, 0.8) if cfg.verify == "exact" else dedup.minhash_candidates(reps, cfg)
        return {(r.i, r.j) for r in cands.collect()}, {(r.i, r.j) for r in dedup._similar(cands, reps, cfg).collect()}

    true = pairs(DedupConfig(verify="exact", threshold=0.8))[1]
    found = pairs(DedupConfig(threshold=0.8, bands=None, recall=0.95))[0]
    shipped = pairs(DedupConfig(threshold=0.8))[0]
    assert len(true) > 200 and len(true & found) >= 0.9 * len(true) > len(true & shipped)


def test_one_template_lists_no_pairs_of_members(spark):
    """Members are compared with kept leaders only: n rows of one bucket."""
    seen = []

    def similar(pairs):
        seen.append(pairs.count())
        return pairs.where("original_index % 3 = lead % 3")
    buckets = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("original_index"))
    gone = {r[0] for r in dedup.leader_rounds(buckets, similar).collect()}
    assert gone == set(range(3, 20_000)) and sum(seen) <= 3 * 20_000 and len(seen) == 3


def test_near_duplicates_follow_the_sequential_rule(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        w = [rnd.choice(words) for _ in range(60)]
        for _ in range(rnd.randint(1, 5)):
            v = list(w)
            for _ in range(rnd.randint(0, 2)):
                v[rnd.randrange(60)] = rnd.choice(words)
            texts.append(" ".join(v))
    rnd.shuffle(texts)
    sets = [{tuple(t.split()[i:i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    edges = [(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) > 0.8 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")
    out = dedup.annotate_near(df, DedupConfig(verify="exact", threshold=0.8))
    assert {r["original_index"] for r in out.collect() if r["is_duplicate"]} == _sequential(len(texts), edges) and edges


def _pack_py(docs, B, eos):
    stream = []
    for t in docs:
        stream += t + [eos]
    stream = stream[:-1] if stream else stream
    out = []
    for i in range(0, len(stream), B):
        blk = stream[i:i + B]
        if len(blk) < B and len(blk) < B // 2:
            break
        out.append(blk)
    return out


def test_packing_cases(spark):
    B, eos = 8, 99
    cases = [[[1]], [[1, 2, 3]], [[1] * 7], [[1] * 3, [2] * 3], [[1] * 30], [[5] * 3, [6] * 20, [7]],
             [[1, 2], [3, 4], [5, 6], [7, 8]], [[1] * 2, [2] * 1]]
    cfg = TrainingConfig(block_size=B, eos_token=eos)
    for docs in cases:
        df = spark.createDataFrame([(i, d, "en", "web") for i, d in enumerate(docs)],
                                   "original_index long, tokens array<int>, language string, source string")
        blocks, summary = training.pack_blocks(df, cfg)
        got = [list(r["tokens"]) for r in blocks.orderBy("block_index").collect()]
        assert got == _pack_py(docs, B, eos), docs


def test_prefix_sum_of_any_keys(spark):
    """Sparse keys, any partition count."""
    df = spark.range(200).select((F.col("id") * F.col("id") * 1_000_003).alias("k"), (F.col("id") % 7).alias("v")).repartition(5)
    before, ref = spark.conf.get("spark.sql.shuffle.partitions"), None
    for parts in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out = ordering.exclusive_prefix_sum(df, ["k"], F.col("v"), "ps")
        vals = [r["ps"] for r in out.orderBy("k").collect()]
        ref = ref or vals
        assert vals == ref
    spark.conf.set("spark.sql.shuffle.partitions", before)
    expect, acc = [], 0
    for i in range(200):
        expect.append(acc)
        acc += i % 7
    assert ref == expect
