"""Best-two-fit packing against a plain version, whole texts and odd rows."""

import collections

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textmill.llm import two_fit
from textmill.llm.two_fit import RANKS, patterns, places

PATH = public_tokenizers.path("word_bpe_49k.json")


def filled_one_by_one(sizes, capacity):
    """The rule with a list of pieces, one sequence after the other."""
    left, out = sorted(sizes), []
    while left:
        own, room = [], capacity
        while fits := [x for x in left if x <= room]:
            left.remove(fits[-1])
            own.append(fits[-1])
            room -= fits[-1]
        if room and len(own) > 1:
            pairs = [(left[i] + left[j], left[i], left[j]) for i in range(len(left)) for j in range(i)
                     if own[-1] < left[i] + left[j] <= room + own[-1]]
            if pairs:
                _, a, b = max(pairs)
                left.append(own.pop())
                left.remove(a)
                left.remove(b)
                left.sort()
                own += [a, b]
        out.append(sorted(own))
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.one_of(
    st.integers(1, c), st.sampled_from([1, c // 2, c // 3 + 1, c // 4 + 1])), max_size=50))))
def test_patterns_equal_the_rule(case):
    capacity, sizes = case
    counts = np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, dtype=int)
    want = filled_one_by_one(sizes, capacity)
    assert [sorted(s for s, n in p for _ in range(n)) for p, times in patterns(counts) for _ in range(times)] == want
    table, sequences = places(counts), collections.defaultdict(list)
    for size in set(sizes):
        for rank in range(counts[size]):
            first, n, sequence, offset = table[np.searchsorted(table[:, 0], size * RANKS + rank, side="right") - 1].tolist()
            k = size * RANKS + rank - first
            sequences[sequence + k // n].append((offset + k % n * size, size))
    assert [sorted(s for _, s in sequences[i]) for i in range(len(want))] == want
    for pieces in sequences.values():
        ends = np.cumsum([s for _, s in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= capacity


def test_the_two_replace_the_smallest():
    # 6 + 3 leaves 1; without the 3 there is room for 2 + 2
    assert next(patterns(np.bincount([6, 3, 2, 2], minlength=11)))[0] == [(6, 1), (2, 2)]
    # one 2 alone is no pair
    assert next(patterns(np.bincount([6, 3, 2], minlength=11)))[0] == [(6, 1), (3, 1)]


def test_many_pieces_need_few_patterns():
    sizes = np.clip(np.random.default_rng(1).lognormal(5.5, 1.2, 1_000_000).astype(int), 1, 4096)
    made = list(patterns(np.bincount(sizes, minlength=4097)))
    assert len(made) < 10_000 and sum(times for _, times in made) <= -(-sizes.sum() // 4096) * 1.001


def checked(rows, pieces, length):
    t = Tokenizer.from_file(PATH)
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length <= length and r.start == r.piece * length
        got[r.doc_id].append((r.piece, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = collections.defaultdict(list)
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[i] += [(p, ids[p * length: (p + 1) * length]) for p in range(-(-len(ids) // length))]
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    sizes = [len(ids) for x in want.values() for _, ids in x]
    assert len(sequences) == len(filled_one_by_one(sizes, length))


def test_whole_texts_and_odd_rows(spark):
    rows = [(3, "It's THE end, isn't it?"), (1, None), (2, ""), (None, "no id"), (None, "no id"), (2, "twice"), (2, "twice"),
            (5, "long " * 150 + "é"), (4, "   \t spaced  out\n\n"), *[(100 + i, "a word " * (i % 17)) for i in range(60)]]
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], "doc_id long, text string, ids string, length long").repartition(5)
    checked(rows, two_fit.pack(docs, PATH, length=64).collect(), 64)
    checked(rows, two_fit.pack(docs, PATH).collect(), 4096)
    assert two_fit.pack(docs.limit(0), PATH).count() == 0


def test_query_of_the_table(spark):
    from textmill.llm.queries import op11_two_fit

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    pieces = two_fit.pack(spark.read.parquet(f"{sf}/documents.parquet"), PATH).collect()
    checked(rows, pieces, two_fit.LENGTH)
    got = op11_two_fit(spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() == len(pieces)
