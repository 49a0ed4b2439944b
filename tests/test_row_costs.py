"""Values whose cost a row must grow with its text and not faster, and the look-aheads that spare rules."""

import hashlib
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import patterns as P
from textmill.functions import pii as PII
from textmill.functions import safety as S
from textmill.functions import text as TX
from textmill.operators import tokens

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_many_matches_in_one_text(spark):
    """A running aggregate that copies its spans for each match takes over a minute here."""
    n = 32_000
    df = spark.createDataFrame([("NOUN a " * n,), ("",), ("none",), ("ABCD",), (None,)], "t string").coalesce(1)
    start = time.time()
    found = [r[0] for r in df.select(S.match_spans(F.col("t"), P.ALL_CAPS_J, "x")).collect()]
    assert time.time() - start < 20
    assert [tuple(s) for s in found[0]] == [(7 * i, 7 * i + 4, "x") for i in range(n)]
    assert [x and [tuple(s) for s in x] for x in found[1:]] == [[], [], [(0, 4, "x")], None]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100])
def test_running_sums(spark, n):
    numbers = [(i * 7919) % 13 for i in range(n)]
    df = spark.createDataFrame([(numbers,)], "x array<int>")
    assert df.select(S.running_sums(F.col("x"))).first()[0] == [sum(numbers[:i + 1]) for i in range(n)]


def test_words_are_hashed_once_a_batch(monkeypatch):
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda w: calls.append(w) or md5(w))
    ids = tokens.word_hash_batch(pa.array([" b a b ", None, "", "a", " "])).to_pylist()
    one = {w: int(md5(w.encode()).hexdigest()[:7], 16) for w in "ab"}
    assert ids == [[one["b"], one["a"], one["b"]], None, [], [one["a"]], []]
    assert sorted(calls) == [b"a", b"b"]


def test_word_hash_splits_like_the_class(spark):
    """Against the words that Java's class gives, at every character of the first plane."""
    df = (spark.range(1, 0x10000).where("id < 55296 OR id > 57343")
          .select(F.concat(F.lit("a"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32"), F.lit("b ")).alias("t")))
    words = F.filter(F.split("t", r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"), lambda w: w != "")
    plain = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int"))
    assert df.select("t", plain.alias("p"), tokens.word_hash_tokens(F.col("t")).alias("h")).where("NOT p <=> h").count() == 0


def test_look_aheads_change_no_match(spark):
    """Rules with and without what spares them, with every character of the first plane."""
    ch = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    df = spark.range(1, 0x10000).where("id < 55296 OR id > 57343").select(ch.alias("c"))
    bare = "(?iu)(?:" + "|".join(P._j(t) for t in P.PROFANITY_TERMS_PY) + ")"
    for before, after in (("", "hit"), ("", "uck"), ("s", "it"), ("d", "ck"), ("di", "k"), ("s", "lut"), ("b", "tch"), ("motherf", "er"), ("", "damn")):
        t = F.concat(F.lit(before), "c", F.lit(after))
        assert df.where(t.rlike(P.PROFANITY_J) != t.rlike(bare)).count() == 0, (before, after)
    run = rf"(?:[{P.S}&&[^ ]]{P.S}*+| {P.S}++)"
    for t in (F.concat(F.lit("a"), "c", F.lit("b")), F.concat(F.lit(" "), "c", "c", F.lit("b ")), F.concat(F.col("c"), F.lit(" a "))):
        assert df.where(TX.collapse_whitespace(t) != F.trim(F.regexp_replace(t, run, " "))).count() == 0
        share = F.length(F.regexp_replace(t, r"[^\x00-\x7F]", "")) / F.length(t)
        assert df.where(TX.ascii_ratio(t) != share).count() == 0


@pytest.mark.parametrize("text", ["", "call (555) 123-4567 now", "call +1.555.123.4567", "1-(555) 123 4567", "123-45-6789", "4111 1111-1111 1111",
                                  "4 1 1 1 1 1 1 1 1 1 1 1 1 ", "in 2024 and 1999 and 10.0.0.1", "12345678", "١٢٣-٤٥-٦٧٨٩", "a1b2c3d4e5f6g7h8i9j0", None])
def test_numbers_are_counted_where_digits_are(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    names = tuple(P.PII_ENTITIES)

    def plain(name):
        n = F.regexp_count("t", F.lit(P.PII_J[name]))
        need = P.PII_REQUIRED.get(name)
        return (F.when(F.col("t").contains(need), n).otherwise(F.lit(0)) if need else n).cast("int")

    got = df.select(PII.pii_counts(F.col("t"), names), F.array(*[plain(x) for x in names])).first()
    assert got[0] == got[1]


def test_spaces_are_those_of_the_class():
    assert [c for c in map(chr, range(0x10000)) if c.isspace()] == sorted(set(SPACES) | {c for c in map(chr, range(0x2000, 0x200b))})
