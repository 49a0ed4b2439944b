import hashlib
import io

import pytest

from textmill.llm import shard_bytes, warc

PAGES = "page_id long, url string, html string, refers long, payload string"


def test_records_frame_and_verify():
    made = [warc.record_bytes(1, "http://a/b c\r\nX: y", b"<html>" * 10, None), warc.record_bytes(None, None, b"", None),
            warc.record_bytes(3, "u", b"x" * 300_000, 1), warc.record_bytes(4, "é", bytes(range(256)) * 2000, None)]
    for chunk in (1, 7, 65536):
        got = [warc.parse(*r) for r in warc.read_records(io.BytesIO(b"".join(made if chunk > 1 else made[:2])), chunk)]
        assert [r["payload_bytes"] for r in got] == [60, 0, 300_000, 512_000][: len(got)] and len(got) in (2, 4)
        assert got[0]["url"] == "http://a/b%20c%0D%0AX:%20y" and got[1]["page_id"] is None
    assert got[2]["record_type"] == "revisit" and got[2]["refers_to"] == 1 and got[2]["payload"] is None
    assert got[2]["payload_digest"] == warc.sha1_base32(b"x" * 300_000)
    assert got[3]["payload"] == bytes(range(256)) * 2000


def test_faults_are_found():
    import zlib

    good = warc.record_bytes(1, "u", b"payload", None)
    plain = zlib.decompress(good, 31)

    def again(raw):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(raw) + c.flush()

    for bad in (good[:-9], again(plain.replace(b"payload", b"pay1oad")), again(plain[:-1]), again(plain + b"x"),
                again(plain.replace(b"WARC/1.1", b"nope/1.1")), again(plain.replace(b"Content-Length", b"Content-Width")),
                good + b"rubbish"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad), 16))


def test_pages_round_trip(spark):
    rows = [(5, "http://x/5", "same", 1, "p"), (3, None, "same", 1, "p"), (3, None, "same", 1, "p"), (7, "u", None, None, None),
            (8, "u", "", 1, ""), (None, "n", "same", 1, "p"), (9, "u", "é" * 500_000, 1, "p"), (10, "u", "alone", 1, "p")]
    manifest = warc.write_warc(spark.createDataFrame(rows, PAGES), file_bytes=200)
    got = sorted(((r.page_id or 99, r.record_type, r.refers_to, r.payload_bytes, r.payload) for r in warc.read_warc(manifest).collect()),
                 key=str)
    assert got == sorted([(5, "revisit", 3, 4, None), (3, "response", None, 4, b"same"), (3, "response", None, 4, b"same"),
                          (7, "response", None, 0, b""), (8, "revisit", 7, 0, None), (99, "revisit", 3, 4, None),
                          (9, "response", None, 1_000_000, "é".encode() * 500_000), (10, "response", None, 5, b"alone")], key=str)
    assert manifest.agg({"records": "sum"}).first()[0] == 8 and manifest.count() > 2
    few = warc.read_warc(warc.write_warc(spark.createDataFrame(rows, PAGES), min_bytes=5), with_payload=False)
    assert few.where("record_type = 'revisit'").count() == 0


def test_no_pages(spark):
    manifest = warc.write_warc(spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and warc.read_warc(manifest).count() == 0


DOCS = "doc_id long, text string, size long, shard int, range int, key long"


def shards_by_hand(rows, shards):
    import zlib

    order = sorted(((i is not None, i or 0), zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t, *_ in rows)
    total, upto, out, slots = sum(r[2] for r in order), 0, [], {}
    for (has, i), crc, size in order:
        upto += size
        s = min(shards - 1, (2 * upto - size) * shards // (2 * total))
        out.append((i if has else None, size, crc, s, slots.setdefault(s, 0)))
        slots[s] += 1
    return sorted(out, key=str)


def test_shards_are_contiguous_and_balanced(spark):
    rows = [(i * 37 % 1000, "x" * (i * i % 300) + "é", 1, 1, 1, 1) for i in range(1000)]
    rows += [(None, None, 1, 1, 1, 1), (None, "", 1, 1, 1, 1), (5, "tie", 1, 1, 1, 1), (5, "tie", 1, 1, 1, 1)]
    got = [tuple(r) for r in shard_bytes.shard_by_bytes(spark.createDataFrame(rows, DOCS), 7).collect()]
    assert sorted(got, key=str) == shards_by_hand(rows, 7)
    bytes_of = [sum(r[1] for r in got if r[3] == s) for s in range(7)]
    assert max(bytes_of) - min(bytes_of) <= 2 * max(r[1] for r in got)
    starts = [min(r[0] or -1 for r in got if r[3] == s) for s in range(7)]
    assert starts == sorted(starts)


def test_shards_of_little(spark):
    assert shard_bytes.shard_by_bytes(spark.createDataFrame([], DOCS), 4).count() == 0
    one = shard_bytes.shard_by_bytes(spark.createDataFrame([(1, "z" * 1_000_000, 1, 1, 1, 1)], DOCS), 4).collect()
    assert [(r.shard, r.slot, r.size) for r in one] == [(2, 0, 1_000_008)]
    empty = shard_bytes.shard_by_bytes(spark.createDataFrame([(i, None, 1, 1, 1, 1) for i in range(3)], DOCS), 3, overhead=0)
    assert sorted(r.slot for r in empty.collect()) == [0, 1, 2]


def test_digest_form():
    assert warc.sha1_base32(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and len(hashlib.sha1(b"").digest()) == 20
