"""Cleaning edge rows the fixtures never reach (FIXTURES §3)."""

import random
import unicodedata
from html.parser import HTMLParser

from textmill.config import CleanConfig
from textmill.operators import cleaning

CASES = [
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("I <3 you", "I <3 you"),
    ('<a title="x>y">link</a> text', "link text"),
    ("fish &amp chips", "fish & chips"),
    ("&#65;BC &#x42;", "ABC B"),
    ("&amp;lt;", "&lt;"),
    ("hello <b>world</b>", "hello world"),
    ('hello <div class="x', "hello"),
    ("<script>var a='<p>';</script>text", "text"),
    ("<!-- c -->x<style>p{}</style>", "x"),
    ("a\rb a\x0cb a\x85b", "ab ab ab"),
    ("a­b a​b", "ab ab"),
    ("a b c", "a b c"),
    ("  many   \n\t spaces  ", "many spaces"),
    # quotes delimit only after '='; a stray '<letter' is text
    ("<a title=it's>hello world rest of page", "hello world rest of page"),
    ("<p>x</p><a href=/o'neil>hello</a> don't <b>drop</b> me", "x hello don't drop me"),
    ("a <b and then the rest of the text", "a <b and then the rest of the text"),
    ("<a title = 'x>y' alt=\">\">in</a> out", "in out"),
    ("text <img src='a", "text"),
    ("text <img alt=x src", "text"),
    ("text <br", "text"),
    ("<p " + "x" * 200_000 + ">kept", "kept"),
    ("<p " + "a='b' " * 10_000 + ">kept", "kept"),
    ("<script " + "x" * 50_000 + ">gone</script>kept", "kept"),
    ("a <" + "b" * 50_000 + " c d e", "a <" + "b" * 50_000 + " c d e"),
    # character references: the whole standard set, Windows-1252, numbers out of range
    ("caf&eacute; &rarr; &frac12;", "café → ½"),
    ("&#150;&#x93;x&#148;", "–“x”"),
    ("&#0;&#xD800;&#99999999999;&#x110000;", "\ufffd\ufffd\ufffd\ufffd"),
    ("&notit; &notin; &ampere &unknown; &;&", "¬it; ∉ &ere &unknown; &;&"),
    ("&#0000000065;&NotEqualTilde;", "A≂̸"),
]


def test_edge_rows(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "original_index long, text string")
    out = cleaning.annotate(df, CleanConfig(min_chars=0)).select("original_index", "text", "drop_reason").collect()
    got = {r["original_index"]: r["text"] for r in out}
    assert [got[i] for i in range(len(CASES))] == [e for _, e in CASES]


def test_length_bounds_inclusive(spark):
    df = spark.createDataFrame([(0, "x" * 5), (1, "x" * 4), (2, "x" * 10), (3, "x" * 11), (4, "")],
                               "original_index long, text string")
    out = cleaning.annotate(df, CleanConfig(min_chars=5, max_chars=10))
    got = {r[0]: r[1] for r in out.select("original_index", "drop_reason").collect()}
    assert got == {0: None, 1: "too_short", 2: None, 3: "too_long", 4: "empty_text"}


class _Nodes(HTMLParser):
    """Text nodes of a page: what lies between tags, comments and declarations."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.text, self.raw = [], "", None

    def flush(self):
        if self.text:
            self.nodes.append(self.text)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in ("script", "style", "template"):
            self.raw = tag

    def handle_endtag(self, tag):
        self.flush()
        if tag == self.raw:
            self.raw = None

    def handle_data(self, data):
        if self.raw is None:
            self.text += data

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


PARTS = ["<p>", "</p>", "<br/>", "<!-- c <b> -->", "<!DOCTYPE html>", "<a href='x>y'>", "</a>", "<script>var a = '<p>';</script>",
         "<style>p {}</style>", "<template>t</template>", " ", "\n", "\t  ", "word", "two words", "&amp;", "&lt;b&gt;", "é", "1 < 2", "a > b",
         '<img alt="a > b" src=x>', "<B CLASS=big>"]


def test_text_nodes_without_whitespace_normalisation(spark):
    """The text is its nodes joined by one space, as a parser splits them."""
    rng = random.Random(11)
    pages = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    pages += ["<p></p>x<p></p>", "<br>" * 50_000 + "x" + "<!-- a -->" * 20_000, "a<b>c</b>d", "  a  <i> </i>b "]
    want = []
    for page in pages:
        parser = _Nodes()
        parser.feed(page)
        parser.close()
        parser.flush()
        want.append("".join(c for c in " ".join(parser.nodes) if unicodedata.category(c)[0] != "C" or c in "\n\t"))
    df = spark.createDataFrame(list(enumerate(pages)), "original_index long, text string")
    cfg = CleanConfig(min_chars=0, normalize_whitespace=False)
    got = {r[0]: r[1] for r in cleaning.annotate(df, cfg).select("original_index", "text").collect()}
    assert [got[i] for i in range(len(pages))] == want
