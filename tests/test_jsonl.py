"""JSONL scan: blank and broken lines, non-object lines, missing / null /
empty text, extra keys; the dense index counts valid rows in file order."""

import os

from textmill.session import scratch_path
from textmill.sources import jsonl

LINES = [
    '{"text": "first", "url": "http://a.example.com/x"}',
    "",
    "   ",
    "{not json",
    "[1, 2, 3]",
    '{"url": "no text here"}',
    '{"text": null}',
    '{"text": ""}',
    '  {"text": "second", "extra": 1}  ',
    '{"text": "third"}',
]


def test_jsonl_edges(spark):
    path = scratch_path(spark, "jsonl-test")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.jsonl"), "w", encoding="utf-8") as f:
        f.write("\n".join(LINES) + "\n")
    rows = sorted((r["original_index"], r["text"], r["url"]) for r in jsonl.load_jsonl(spark, path).collect())
    assert rows == [(0, "first", "http://a.example.com/x"), (1, "second", None), (2, "third", None)]
    counts = {r["status"]: r["n"] for r in jsonl.load_counts(spark, path).collect()}
    assert counts == {"ok": 3, "corrupt": 2, "no_text": 3}


def test_texts_that_are_no_strings(spark):
    """Truthy values take an index but give no document; falsy ones do neither."""
    lines = ['{"text": "a"}', '{"text": 5}', '{"text": ["a"]}', '{"text": {"k": 1}}', '{"text": true}', '{"text": 0}', '{"text": []}',
             '{"text": false}', '{"text": {}}', '{"text": 0.0}', '{"text": "5"}', '{"text": "false"}', '{"text": "0"}']
    path = scratch_path(spark, "jsonl-test")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.jsonl"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    rows = sorted((r["original_index"], r["text"]) for r in jsonl.load_jsonl(spark, path).collect())
    assert rows == [(0, "a"), (5, "5"), (6, "false"), (7, "0")]
    counts = {r["status"]: r["n"] for r in jsonl.load_counts(spark, path).collect()}
    assert counts == {"ok": 4, "not_string": 4, "no_text": 5}
