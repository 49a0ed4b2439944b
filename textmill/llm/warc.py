"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: each page becomes a ``response`` record (an HTTP response whose body
is the payload) or, if an equal payload has a response of a smaller id, a
``revisit`` record that names it and carries no body.  Each task writes its
partition to files of its own, rolled at ``file_bytes``; the manifest lists the
files of successful attempts only.

Reading is sequential: compressed chunks go through one incremental zlib
object per gzip member, the record is framed by its header's Content-Length,
and block and payload digests are verified.  A task holds one record at a
time.  The archives can be read without any other table.

Defined results: null payload counts as empty; null or odd urls are
percent-encoded or left out; rows of equal id and payload that share the
smallest id are all responses (a repeated row has no smaller one to refer to);
rows without id sort last and are written without a page id; an empty table
gives no file and no record; extra columns are ignored.  A digest or framing
fault raises ``WarcError``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import (attempt_name, open_output, open_stream, partitions, prepare, shared_folder,
                                written)

FILE_BYTES = 256 << 20
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no fetch time


class WarcError(ValueError):
    pass


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _uri(url: str | None) -> str | None:
    if not url:
        return None
    return re.sub(rb"[\x00-\x20\x7f-\xff]", lambda m: b"%%%02X" % m[0][0], url.encode("utf-8")).decode("ascii")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode("ascii")
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if (uri := _uri(url)) is not None:
        head.append(f"WARC-Target-URI: {uri}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n") + c.flush()


def read_records(stream, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of a file of gzip members, in order."""
    left = b""
    while True:
        left = left or stream.read(chunk)
        if not left:
            return
        member, plain, head, need, body_at = zlib.decompressobj(31), bytearray(), None, None, 0
        while True:
            try:
                plain += member.decompress(left)
            except zlib.error as e:
                raise WarcError(f"broken gzip member: {e}") from e
            left = member.unused_data
            if head is None and (end := plain.find(b"\r\n\r\n")) >= 0:
                head, body_at = _header(bytes(plain[:end])), end + 4
                need = body_at + int(head["content-length"]) + 4
            if need is not None and len(plain) > need:
                raise WarcError("a member holds more than its record")
            if member.eof:
                break
            left = stream.read(chunk)
            if not left:
                raise WarcError("the file ends inside a record")
        if need is None or len(plain) != need or plain[-4:] != b"\r\n\r\n":
            raise WarcError("Content-Length does not frame the record")
        block = bytes(plain[body_at: need - 4])
        if head.get("warc-block-digest", "").removeprefix("sha1:") != sha1_base32(block):
            raise WarcError("block digest differs")
        yield head, block


def _header(raw: bytes) -> dict[str, str]:
    first, *lines = raw.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise WarcError(f"not a WARC record: {first[:40]!r}")
    out = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not out.get("content-length", "").isdigit():
        raise WarcError("no Content-Length")
    return out


def parse(head: dict[str, str], block: bytes) -> dict:
    """One record's row; a response's payload digest is verified."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
    if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise WarcError("payload digest or length differs")
    number = lambda k: int(head[k]) if k in head else None
    return {"page_id": number("x-page-id"), "url": head.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": length, "payload_digest": digest, "refers_to": number("x-refers-to-page-id"),
            "payload": payload if kind == "response" else None}


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, n, size, files = None, None, 0, 0, []
        for batch in batches:
            cols = [batch.column(i) for i in range(4)]
            for r in range(batch.num_rows):
                if out is None:
                    uri, n, size = attempt_name(folder, "pages", ".warc.gz"), 0, 0
                    out = open_output(uri)
                page, url, html, refers = (c[r].as_py() for c in cols)
                made = record_bytes(page, url, (html or "").encode("utf-8"), refers)
                out.write(made)
                n, size = n + 1, size + len(made)
                if size >= file_bytes:
                    out.close()
                    files.append((uri, n, size))
                    out = None
        if out is not None:
            out.close()
            files.append((uri, n, size))
        if files:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in files], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                names=["path", "records", "bytes"])
    return run


def write_warc(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row; the manifest (path, records, bytes)."""
    spark = pages.sparkSession
    prepare(spark)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).alias("html"), F.sha1(payload).alias("sha"), F.length(payload).alias("n"))
    # one narrow row per repeated payload; combined map-side, so a hot payload is one row per task
    firsts = (rows.where(F.col("n") >= min_bytes).groupBy("sha", "n")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").select(F.col("sha").alias("s"), F.col("n").alias("m"), "first"))
    marked = rows.join(firsts, (F.col("sha") == F.col("s")) & (F.col("n") == F.col("m")), "left").select(
        "page_id", "url", "html",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers"))
    return written(marked.mapInArrow(_write(shared_folder(spark, "warc"), file_bytes),
                                     "path string, records long, bytes long"), "warc-manifest")


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_stream(uri) as stream:
                    for head, block in read_records(stream):
                        rows.append(parse(head, block))
                        held += len(block) * with_payload + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds],
                                                             names=[k for k, _ in kinds])
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds],
                                                 names=[k for k, _ in kinds])
    return run


def read_warc(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the files that ``manifest.path`` names, a file per task."""
    spark = manifest.sparkSession
    prepare(spark)
    schema = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to long" + ", payload binary" * with_payload)
    files = manifest.select("path").repartition(partitions(spark), "path")
    return files.mapInArrow(_read(with_payload), schema)
