"""Token files and packing: exact round trips and edge rows."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm import packing, token_arrow
from textmill.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PLAIN, OURS = {}, {}
SCHEMA = "doc_id long, text string, ids string, length long"
ROWS = [(3, "It's THE end, isn't it?", "x", 1), (1, None, None, None), (2, "", "x", 2), (None, "no id", "x", 3),
        (2, "twice", "x", 4), (2, "twice", "x", 4), (5, "long " * 9000 + "é", "x", 5), (4, "   \t spaced  out\n\n", "x", 6)]


def plain(path):
    if path not in PLAIN:
        PLAIN[path], OURS[path] = Tokenizer.from_file(path), Encoder(path)
        PLAIN[path].encode_special_tokens = True
    return PLAIN[path]


def ids_of(path, text):
    return [*plain(path).encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZé3'ts.,!<|> \t\n\x0b\x1c\x85  ́ßİ中Σ​-", max_size=30), min_size=1, max_size=4),
       st.sampled_from([WORD, BYTE]))
def test_cut_pieces_encode_like_whole_texts(texts, path):
    want = [ids_of(path, t) for t in texts]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, ends = OURS[path].encode(data, offs)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>", " ", "\n", "  ", "see", "É", "x's", "<", "!"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=9).map("".join), min_size=1, max_size=4), st.sampled_from([WORD, BYTE]))
def test_added_tokens_in_a_text_are_the_tokenizers_ids(texts, path):
    untouched = Tokenizer.from_file(path)
    texts = [*texts, "see <|endoftext|> here"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    plain(path)
    ids, ends = OURS[path].encode(data, offs, None)
    got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[-1] == ([862, 49407, 763] if path == WORD else [3826, 220, 50256, 994])


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr("textmill.llm.tokens.KEPT_PIECES", 5)
    e = Encoder(BYTE)
    for t in ["one two three", "four five six seven", "one eight nine ten two", "one"]:
        raw = t.encode()
        assert e.encode(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))[0].tolist() == ids_of(BYTE, t)


def test_token_files_round_trip(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    manifest = token_arrow.write_tokens(docs, WORD, length=64, batch=4)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_arrow.read_documents(manifest).collect()))
    start, keys = 0, []
    for s, doc_id, n, c in got:
        assert s == start
        start += n
        keys.append(-1 if doc_id is None else doc_id)
        assert (n, c) in {(len(ids_of(WORD, t)), crc(ids_of(WORD, t))) for i, t, *_ in ROWS if i == doc_id}
    assert keys == sorted(keys) and len(got) == len(ROWS)
    # sequences: equal lengths, masks, views of the mapped file
    every = []
    for m in sorted(manifest.collect(), key=lambda m: m.part):
        f = token_arrow.SequenceFile(m.path)
        assert len(f) == m.sequences and f.length == 64
        flat = []
        for i in range(len(f)):
            ids = f.ids(i)
            assert len(ids) == 64 and not ids.flags.owndata
            mask = np.array(f.mask(i).to_pylist())
            flat += ids[mask].tolist()
            assert mask.all() or i == len(f) - 1
        assert len(flat) == m.tokens
        every += flat
    assert len(every) == start


def test_token_files_of_nothing(spark):
    manifest = token_arrow.write_tokens(spark.createDataFrame([], SCHEMA), WORD)
    assert manifest.count() == 0 and token_arrow.read_documents(manifest).count() == 0


def test_tree_is_first_fit():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 50, rng.integers(0, 60)).tolist()
        bins, want = [], []
        for s in sizes:
            i = next((i for i, b in enumerate(bins) if b + s <= 50), len(bins))
            bins[i:i + 1] = [(bins[i] if i < len(bins) else 0) + s]
            want.append(i)
        assert packing.first_fit(sizes, 50) == want
    with pytest.raises(ValueError):
        packing.first_fit([51], 50)


def test_packing_places_each_id_once(spark):
    rows = packing.pack(spark.createDataFrame(ROWS, SCHEMA), BYTE, length=256).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        assert len(r.ids) == 4 * r.length
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    for i in {r[0] for r in ROWS} - {2}:
        (text,) = [t for d, t, *_ in ROWS if d == i]
        pieces = sorted(by_doc[i])
        assert np.frombuffer(b"".join(p[2] for p in pieces), dtype="<u4").tolist() == ids_of(BYTE, text)
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
        assert {p[3] for p in pieces} == {len(ids_of(BYTE, text))}
    assert sorted(p[2] for p in by_doc[2]) == sorted(np.array(ids_of(BYTE, t), "<u4").tobytes() for t in ("", "twice", "twice"))


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), BYTE).count() == 0


def test_queries_equal_plain_encoding(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    start = 0
    rows = {r.doc_id: r for r in E.queries()["op1_token_arrow"](spark, SF_SMALL).collect()}
    assert len(rows) == len(docs)
    for i in sorted(docs):
        ids = ids_of(WORD, docs[i])
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    pieces = E.queries()["op6_packing"](spark, SF_SMALL).collect()
    used = {}
    for r in pieces:
        ids = ids_of(BYTE, docs[r.doc_id])
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start: r.start + r.length])
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(r.length for r in pieces) == sum(len(ids_of(BYTE, t)) for t in docs.values())
    assert sum(used.values()) > 0.95 * 2048 * len(used)


def test_sequence_file_index_error(tmp_path):
    w = token_arrow.SequenceWriter(pa.OSFile(str(tmp_path / "x"), "wb"), np.dtype("<u4"), 8, 2)
    w.add(np.arange(37, dtype=np.uint32))
    w.close()
    f = token_arrow.SequenceFile(str(tmp_path / "x"))
    assert len(f) == 5 and f.ids(4).tolist() == [32, 33, 34, 35, 36, 0, 0, 0]
    with pytest.raises(IndexError):
        f.ids(5)


def test_groups_stay_bounded_without_ids(spark):
    """30,000 rows of one null id, all of one text, still spread over their groups."""
    docs = spark.range(30_000, numPartitions=6).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a few words").alias("text"))
    pieces = packing.pack(docs, BYTE)
    sizes = [r.n for r in pieces.groupBy((F.col("sequence_id") / (1 << 32)).cast("long").alias("g")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 30_000 and len(sizes) >= 7 and max(sizes) < 1.3 * packing.GROUP_PIECES


def test_pieces_that_go_are_learned_again():
    """Thinned between batches, the ids stay those of whole texts."""
    e, rng = Encoder(BYTE), np.random.default_rng(3)
    for _ in range(6):
        texts = [" ".join(f"w{rng.integers(60)}" for _ in range(rng.integers(0, 30))) for _ in range(20)] + ["the same words", ""]
        for lo in (0, 11):
            raw = [t.encode() for t in texts[lo: lo + 11]]
            data, offs = np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
            ids, ends = e.encode(data, offs)
            assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [ids_of(BYTE, t) for t in texts[lo: lo + 11]]
        before = len(e.names)
        e.thin()
        assert 0 < len(e.names) < before
