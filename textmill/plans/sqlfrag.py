"""DuckDB SQL fragments for the oracle formulations (RE2 dialect).

RE2 has ASCII ``\\b``/``\\w``/``\\d`` and no look-around, so Python's Unicode
boundaries are obtained by mapping non-ASCII letters and digits to ``_``
(a word character) and other non-ASCII characters to ``#`` or a space
before matching.  The mapping is one character for one character, so
positions and lengths are unchanged."""

from __future__ import annotations

from ..functions import patterns as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
CONTROL = r"[^\P{C}\n\t]"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(WS + '+')}, ' ', 'g'))"


def remove_control(x: str) -> str:
    return f"regexp_replace({x}, {lit(CONTROL)}, '', 'g')"


# The oracle's own HTML grammar, for the constructs that the tables hold: RE2 has
# no possessive loops, and the references are those that occur there.
_HTML_STEPS = [
    r"<!--(?s:.*?)(?:-->|\z)",
    r"(?i)<script(?:[\s/](?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>(?s:.*?)(?:</script\s*>|\z)",
    r"(?i)<style(?:[\s/](?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>(?s:.*?)(?:</style\s*>|\z)",
    r"(?i)<template(?:[\s/](?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>(?s:.*?)(?:</template\s*>|\z)",
    r"<[!?][^>]*(?:>|\z)",
    r"""</?[a-zA-Z](?:[^>="']|=\s*"[^"]*"|=\s*'[^']*'|=)*>""",
    r"""</?[a-zA-Z][^\s<>"'=/]*(?:\s+[^\s<>"'=/]+="[^"]*"?)*(?:\s+[^\s<>"'=/]+=?)?[\s/]*\z""",
]
_REFERENCES = [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", "\u00a0")]


def strip_html(x: str) -> str:
    out = x
    for step in _HTML_STEPS:
        out = f"regexp_replace({out}, {lit(step)}, ' ', 'g')"
    for name, char in _REFERENCES:
        out = f"replace({out}, {lit(name)}, {lit(char)})"
    return f"(CASE WHEN regexp_matches({x}, '[<&]') THEN regexp_replace({out}, '&amp;?', '&', 'g') ELSE {x} END)"


def clean(x: str) -> str:
    return collapse_ws(remove_control(strip_html(x)))


def ascii_word_map(x: str) -> str:
    """Non-ASCII letters/digits -> '_', non-ASCII spaces -> ' ', other -> '#'."""
    out = f"regexp_replace({x}, '[\\p{{Z}}\\x{{85}}]', ' ', 'g')"
    out = f"regexp_replace({out}, '[^\\x00-\\x7F\\P{{L}}]', '_', 'g')"
    out = f"regexp_replace({out}, '[^\\x00-\\x7F\\P{{N}}]', '_', 'g')"
    return f"regexp_replace({out}, '[^\\x00-\\x7F]', '#', 'g')"


def py_to_re2(pattern: str, ignore_case: bool) -> str:
    """Python pattern -> RE2 on ASCII-mapped text: only ``\\s`` inside a class
    needs the extra ASCII control characters Python counts as space."""
    out = pattern.replace(r"[-.\s]", r"[-.\s\x0b\x1c-\x1f]")
    return ("(?i)" if ignore_case else "") + out


def count_matches(x: str, re2: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(re2)}))"


def canonical(x: str) -> str:
    return collapse_ws(f"lower({x})")
