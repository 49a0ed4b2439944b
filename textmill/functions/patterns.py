"""Fixed values that must equal the behaviour being reproduced.

The first block is stated in Python ``re`` syntax, exactly as the rules are
defined.  The second block holds the same rules translated to Java regex
(the dialect of Spark's ``rlike`` / ``regexp_*``): Python's Unicode ``\\w``,
``\\b`` and ``\\d`` are spelled out, since Java's defaults are ASCII.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour; do not edit)
# --------------------------------------------------------------------------

# Safety prefilter and scoring rules (Python syntax).
WORD_PATTERN_PY = r"[a-zA-Z']+"
REPEATED_CHAR_PATTERN_PY = r"(.)\1{3,}"
SAFE_SHORT_TEXT_PATTERN_PY = r"^[\w\s.,'\"-]{1,40}$"
SAFE_NUMERIC_PATTERN_PY = r"^\s*(?:[-+]?[\d.,:%\s]{1,})\s*$"
SAFE_TIMESTAMP_PATTERN_PY = (
    r"^\s*(?:\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(?::\d{2})?(?:Z|[+-]\d{2}:\d{2})?)\s*$"
)
SAFE_URL_ONLY_PATTERN_PY = r"^\s*(?:https?://|www\.)\S+\s*$"  # case-insensitive
SAFE_FORMAL_TEMPLATE_PATTERN_PY = r"^(?:dear|sincerely|regards|to whom it may concern)[\s,].{0,200}$"  # case-insensitive
SAFE_CODE_BLOCK_PATTERN_PY = r"^```[\s\S]+```$"  # multiline
SAFE_ALLOWLIST_PHRASES = [
    "thank you",
    "please advise",
    "see attached",
    "looking forward to hearing from you",
]
PROFANITY_TERMS_PY = [
    r"\b(?:fuck|shit|bitch|bastard|asshole|cunt|slut|dick|prick|whore)\b",
    r"\b(?:damn|dumbass|jackass|motherf+er|f+ck|s+hit)\b",
]
OBFUSCATED_PROFANITY_PATTERN_PY = r"\b[f5]\W{0,2}u\W{0,2}c\W{0,2}k\b"  # case-insensitive
REPEATED_PUNCT_PATTERN_PY = r"[!?]{3,}"
ALL_CAPS_WORD_PATTERN_PY = r"\b[A-Z]{4,}\b"
ZERO_WIDTH_PATTERN_PY = r"[\u200b-\u200d\u2060\uFEFF]"
REPEATED_SYMBOL_PATTERN_PY = r"([^\w\s])\1{2,}"
RULE_VERSION = "v1"

# Prefilter pattern order, label and severity weight.
PREFILTER_RULES = [
    ("profanity", 3),
    ("obfuscated_profanity", 3),
    ("repeated_punctuation", 2),
    ("all_caps", 1),
]
# Reasons that count as safe.
SAFE_REASONS = [
    "short_neutral",
    "numeric_like",
    "timestamp_like",
    "url_only",
    "formal_template",
    "code_block",
    "allowlist_phrase",
    "non_english_like",
]

# Built-in blocklist weights.
DEFAULT_BLOCKLIST = {
    "abuse": 0.8,
    "attack": 0.9,
    "bomb": 1.2,
    "bully": 0.9,
    "death": 0.7,
    "destroy": 0.9,
    "harass": 1.0,
    "hate": 1.1,
    "killer": 1.4,
    "kill": 1.5,
    "murder": 1.7,
    "rape": 2.0,
    "shoot": 1.3,
    "suicide": 1.6,
    "terror": 1.3,
    "threat": 1.2,
    "violence": 1.1,
}

# Blocklist of the shipped configuration (each weight 1.0).
CONFIG_BLOCKLIST = ["hate", "kill", "murder", "suicide", "bomb", "terror", "rape"]

# PII patterns, case-insensitive, in entity order (Python syntax).
PII_PATTERNS_PY = {
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z]{2,}\b",
    "PHONE_NUMBER": r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "CREDIT_CARD": r"\b(?:\d[ -]?){13,16}\b",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
PII_ENTITIES = ["EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD", "SSN", "IP_ADDRESS"]

# Export-time redaction labels, in replacement order.
REDACTION_LABELS = [
    ("EMAIL_ADDRESS", "[EMAIL_REDACTED]"),
    ("PHONE_NUMBER", "[PHONE_REDACTED]"),
    ("CREDIT_CARD", "[CARD_REDACTED]"),
    ("SSN", "[SSN_REDACTED]"),
]

# --------------------------------------------------------------------------
# Java translations of the rules above
# --------------------------------------------------------------------------

# Python's Unicode word class, and a word boundary on it.
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
B = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
D = r"\p{Nd}"
# Python's str whitespace (after control characters are gone it equals this).
S = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
NS = r"[^\s\p{Z}\x0b\x1c-\x1f\x85]"


def _j(py: str) -> str:
    """Translate the Python classes used by the fixed rules into Java.

    ``\\s`` and ``\\S`` are expanded differently inside and outside a
    character class, so the pattern is scanned once.
    """
    out, i, depth = [], 0, 0
    inside = {"b": None, "d": r"\p{Nd}", "w": r"\p{L}\p{N}_", "s": S[1:-1]}
    outside = {"b": B, "d": D, "w": W, "W": NW, "s": S, "S": NS}
    while i < len(py):
        ch = py[i]
        if ch == "\\" and i + 1 < len(py):
            nxt = py[i + 1]
            table = inside if depth else outside
            rep = table.get(nxt)
            out.append(rep if rep else py[i:i + 2])
            i += 2
            continue
        if ch == "[" and not depth:
            depth = 1
        elif ch == "]" and depth and out and out[-1] != "[" and out[-1] != "[^":
            depth = 0
        out.append(ch)
        i += 1
    return "".join(out)


# Each Java pattern starts with a look-ahead on the characters a match can
# start with.  It changes no match; it lets the engine reject most
# positions with one class test instead of evaluating the emulated ``\b``.
# The first two letters of the profanities; beyond ASCII, letters of equal case folding.
PROFANITY_J = r"(?=[fsbacdpwjmFSBACDPWJM\u017f][uhiaslrofcUHIASLROFC\u0080-\uffff])(?iu)(?:" + "|".join(_j(t) for t in PROFANITY_TERMS_PY) + ")"
OBFUSCATED_J = "(?iu)(?=[f5])" + _j(OBFUSCATED_PROFANITY_PATTERN_PY)
REPEATED_PUNCT_J = REPEATED_PUNCT_PATTERN_PY
ALL_CAPS_J = "(?=[A-Z])" + _j(ALL_CAPS_WORD_PATTERN_PY)
PREFILTER_J = {
    "profanity": PROFANITY_J,
    "obfuscated_profanity": OBFUSCATED_J,
    "repeated_punctuation": REPEATED_PUNCT_J,
    "all_caps": ALL_CAPS_J,
}
SAFE_SHORT_TEXT_J = _j(SAFE_SHORT_TEXT_PATTERN_PY)
SAFE_NUMERIC_J = _j(SAFE_NUMERIC_PATTERN_PY)
SAFE_TIMESTAMP_J = _j(SAFE_TIMESTAMP_PATTERN_PY)
SAFE_URL_ONLY_J = "(?iu)" + _j(SAFE_URL_ONLY_PATTERN_PY)
# Python's ``.`` does not match a newline; Java's ``(?d)`` makes only '\n' a
# line terminator, which is the same, also for ``$`` before a final '\n'.
SAFE_FORMAL_TEMPLATE_J = "(?iud)" + _j(SAFE_FORMAL_TEMPLATE_PATTERN_PY)
# re.MULTILINE + match(): anchored at the start, ``$`` before any '\n' or at end.
SAFE_CODE_BLOCK_J = r"(?md)\A```[\s\S]+```$"
WORD_J = WORD_PATTERN_PY
ZERO_WIDTH_J = r"[\x{200b}-\x{200d}\x{2060}\x{feff}]"
REPEATED_SYMBOL_J = _j(REPEATED_SYMBOL_PATTERN_PY)
REPEATED_CHAR_J = r"(?d)(.)\1{3,}"

_PII_FIRST = {
    "EMAIL_ADDRESS": r"(?=[A-Za-z0-9._%+-])",
    "PHONE_NUMBER": r"(?=[+(\p{Nd}])",
    "CREDIT_CARD": r"(?=\p{Nd})",
    "SSN": r"(?=\p{Nd})",
    "IP_ADDRESS": r"(?=\p{Nd})",
}
# A literal every match contains: texts without it skip the pattern.
PII_REQUIRED = {"EMAIL_ADDRESS": "@", "SSN": "-", "IP_ADDRESS": "."}
# Nine digits with at most two other characters between them are in every match of these.
PII_NUMBERS = ("PHONE_NUMBER", "CREDIT_CARD", "SSN")
PII_NUMBERS_J = r"(?:\p{Nd}\P{Nd}{0,2}+){8}\p{Nd}"
PII_J = {name: "(?iu)" + _PII_FIRST[name] + _j(p) for name, p in PII_PATTERNS_PY.items()}
# Export-time checks are case-sensitive.
PII_CASED_J = {name: _PII_FIRST[name] + _j(p) for name, p in PII_PATTERNS_PY.items()}
