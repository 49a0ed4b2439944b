"""Column -> Column text functions: HTML to text, control characters,
whitespace, canonical form.  All are built-in expressions (JVM side, inside
whole-stage codegen); nothing here runs Python per row.
"""

from __future__ import annotations

import functools
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

# ---------------------------------------------------------------------------
# HTML to text (the cleaner's markup removal).  One expression reads the page
# from left to right: each match is a run of adjacent tags, comments,
# declarations and raw bodies, so what lies between two matches is one text node,
# and replacing each match by a space joins the text nodes with a space.
# ---------------------------------------------------------------------------

# A tag runs to the first '>' outside a quoted value, and a value is quoted only
# right after '='.  All loops are possessive: Java runs them without recursion,
# so a tag, or a run of them, of any length is safe.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_COMMENT = r"!--[\s\S]*?(?:-->|\z)"
_DECL = r"[!?][^>]*+(?:>|\z)"
# Bodies of script, style and template contribute no text; an unclosed one
# runs to the end of the page.
_RAW_BODY = "|".join(rf"{name}(?:[\s/]{_ATTRS})?+>[\s\S]*?(?:</{name}\s*+>|\z)" for name in ("script", "style", "template"))
_TAG = r"/?[a-z]" + _ATTRS + ">"
# A tag cut off by the end of the page is a name, attributes with values and at
# most one more name; any other remaining '<letter' is text.
_UNFINISHED_TAG = (
    r"""/?[a-z][^\s<>"'=/]*+"""
    r"""(?:[\s/]++[^\s<>"'=/]++\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s"'<>]++|\z))*+"""
    r"""(?:[\s/]++[^\s<>"'=/]++)?+[\s/]*+\z"""
)
MARKUP = f"(?i)(?:<(?:{_COMMENT}|{_RAW_BODY}|{_DECL}|{_TAG}|{_UNFINISHED_TAG}))++"

# Character references: names of up to 32 characters, numbers of any length.
ENTITY_NAME = r"^([A-Za-z][A-Za-z0-9]{0,31})(;?)"
ENTITY_DEC = r"^#([0-9]++);?+"
ENTITY_HEX = r"^#[xX]([0-9a-fA-F]++);?+"
_NAMES_SEMI = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
_NAMES_BARE = {n: c for n, c in html5.items() if not n.endswith(";")}
_BARE_PREFIX = "^(" + "|".join(sorted(_NAMES_BARE, key=lambda n: (-len(n), n))) + ")"
# 128-159 are read as Windows-1252 where it has a character
_C1 = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


def _code_point_to_string(n: Column) -> Column:
    """Unicode code point -> one-character string (UTF-32 decode)."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


@functools.cache
def _by_first_letter(names: tuple[tuple[str, str], ...]) -> str:
    """JSON of names by their first letter: {letter: {name: characters}}."""
    out: dict[str, dict[str, str]] = {}
    for name, chars in names:
        out.setdefault(name[0], {})[name] = chars
    return json.dumps(out)


def _looked_up(names: dict[str, str], name: Column) -> Column:
    """The characters of a name, null for others.  The table is one literal,
    parsed once when the plan is optimised; a look-up reads the names of one
    letter."""
    table = F.from_json(F.lit(_by_first_letter(tuple(names.items()))), "map<string,map<string,string>>")
    return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)


def _numeric_reference(n: Column) -> Column:
    """The character of a number: 0, surrogates and numbers beyond Unicode are
    U+FFFD, 128-159 are Windows-1252."""
    bad = n.isNull() | (n == 0) | (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF))
    return (F.when(bad, F.lit("\ufffd")).when(n.between(128, 159), F.substr(F.lit(_C1), n - 127, F.lit(1)))
            .otherwise(_code_point_to_string(n)))


def decode_entities(c: Column) -> Column:
    """Decode character references once: all names of the HTML standard
    (those of the old set also without ';', longest first), decimal and
    hexadecimal numbers.  The text is split on '&' and each piece after the
    first is decoded at its head, so a decoded '&' is never re-read."""
    def piece(p: Column) -> Column:
        dec, hx = F.regexp_extract(p, ENTITY_DEC, 1), F.regexp_extract(p, ENTITY_HEX, 1)
        name, end = F.regexp_extract(p, ENTITY_NAME, 1), F.regexp_extract(p, ENTITY_NAME, 2)
        full = F.when(end == ";", _looked_up(_NAMES_SEMI, F.when(name != "", name)))
        short = F.regexp_extract(p, _BARE_PREFIX, 1)
        # more than 7 significant digits are beyond Unicode in any case
        dec_n = F.ltrim(dec, F.lit("0"))
        hex_n = F.ltrim(hx, F.lit("0"))
        dec_n = F.when(F.length(dec_n) <= 7, F.coalesce(dec_n.try_cast("int"), F.lit(0)))
        hex_n = F.when(F.length(hex_n) <= 6, F.coalesce(F.conv(hex_n, 16, 10).try_cast("int"), F.lit(0)))
        return (
            F.when(dec != "", F.concat(_numeric_reference(dec_n), F.regexp_replace(p, ENTITY_DEC, "")))
            .when(hx != "", F.concat(_numeric_reference(hex_n), F.regexp_replace(p, ENTITY_HEX, "")))
            .when(full.isNotNull(), F.concat(full, p.substr(F.length(name) + 2, F.length(p))))
            .when(short != "", F.concat(_looked_up(_NAMES_BARE, F.when(short != "", short)), p.substr(F.length(short) + 1, F.length(p))))
            .otherwise(F.concat(F.lit("&"), p))
        )

    parts = F.split(c, "&", -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(piece(p))), ""
    )


def strip_html(c: Column, at_ends: bool = True) -> Column:
    """Markup to text: text nodes joined by one space.  Markup at the ends of the
    page gives a space too, unless ``at_ends`` is False (then the text is exactly
    its joined nodes).  Rows without '<' or '&' bypass the expressions."""
    out = c
    if not at_ends:
        out = F.regexp_replace(F.regexp_replace(out, r"\A" + MARKUP, ""), MARKUP + r"\z", "")
    out = F.regexp_replace(out, MARKUP, " ")
    out = F.when(out.contains("&"), decode_entities(out)).otherwise(out)
    return F.when(c.rlike("[<&]"), out).otherwise(c)


CONTROL_CHARS = r"[\p{C}&&[^\n\t]]"
# a run of whitespace that is not one space already; most characters fail the look-ahead
_MAYBE_SPACE = r"(?=[\x09-\x0d\x1c-\x20\x85-\uffff])"
WHITESPACE_RUN = rf"{_MAYBE_SPACE}(?: {_MAYBE_SPACE}{P.S}++|[{P.S}&&[^ ]]{P.S}*+)"


def remove_control_chars(c: Column) -> Column:
    """Drop Unicode category C* except newline and tab (removed, not replaced)."""
    return F.regexp_replace(c, CONTROL_CHARS, "")


def collapse_whitespace(c: Column) -> Column:
    """Python ``re.sub(r'\\s+', ' ', t).strip()``."""
    return F.trim(F.regexp_replace(c, WHITESPACE_RUN, " "))


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace on both ends); texts that neither
    begin nor end with it skip the search."""
    at_end = F.substring(c, 1, 1).rlike(P.S) | F.substring(c, -1, 1).rlike(P.S)
    return F.when(at_end, F.regexp_replace(c, f"^{P.S}+|{P.S}+$", "")).otherwise(c)


def clean_text(c: Column, remove_html: bool = True, normalize_whitespace: bool = True,
               lowercase: bool = False) -> Column:
    out = strip_html(c, at_ends=normalize_whitespace) if remove_html else c
    out = remove_control_chars(out)
    if normalize_whitespace:
        out = collapse_whitespace(out)
    if lowercase:
        out = F.lower(out)
    return out


def canonical_text(c: Column, squeeze_punct: bool = False) -> Column:
    """Dedup canonical form: strip, lower-case, collapse whitespace.

    The reference's punctuation squeeze is written with a doubled backslash
    and never fires; ``squeeze_punct=True`` applies the documented intent."""
    out = collapse_whitespace(F.lower(c))
    if squeeze_punct:
        out = F.regexp_replace(out, r"([!?,.])\1+", "$1")
    return F.when(c.isNull() | (c == ""), F.lit(None)).otherwise(out)


def content_hash(canonical: Column) -> Column:
    """SHA-256 hex of the UTF-8 canonical text."""
    return F.sha2(canonical, 256)


def computed_once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used: it
    is the one element of a transformed array."""
    return F.transform(F.array(value), use)[0]


def ascii_ratio(c: Column) -> Column:
    """Share of ASCII characters; a text of as many bytes as characters has no others."""
    n = F.length(c)
    ascii_n = F.when(F.octet_length(c) == n, n).otherwise(F.length(F.regexp_replace(c, r"[^\x00-\x7F]", "")))
    return F.when(n > 0, ascii_n / n).otherwise(F.lit(0.0))


def count_class(c: Column, java_class: str) -> Column:
    """Number of code points of ``c`` inside a Java character class."""
    return F.length(c) - F.length(F.regexp_replace(c, java_class, ""))
