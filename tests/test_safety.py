"""Safety rules on golden rows (expected values worked out by hand from the rule
descriptions) and as properties of the fixture rows."""

import pytest

from textmill.config import SafetyConfig
from textmill.operators import safety
from textmill.sources import tables
from conftest import SF_SMALL

# text -> drop reason, tag, severity, score, scored characters, windows, flagged words, PII types
GOLDEN = [
    ("", None, "safe", None, 0.0, 0, None, [], []),
    ("   ", None, "safe", None, 0.0, 0, None, [], []),
    ("hello there friend", None, "safe", 0, 0.0, 0, None, [], []),
    # upper-case share 0.5 + punctuation run 0.3
    ("THIS IS SHOUTING AND VERY LOUD TEXT HERE!!!", None, "suspect", 2, 0.8, 43, 1, [], []),
    # short and neutral-looking: profanity is lowered to 1, the obfuscation rule adds 0.6
    ("fuck", None, "unknown", 1, 0.6, 4, 1, [], []),
    ("what the f*u*c*k man", None, "suspect", 3, 0.6, 20, 1, [], []),
    ("12,345.67", None, "safe", 0, 0.0, 0, None, [], []),
    ("2024-01-02T10:20:30Z", None, "safe", 0, 0.0, 0, None, [], []),
    ("https://example.com/x", None, "safe", 0, 0.0, 0, None, [], []),
    ("Dear Sir, " + "x" * 50, None, "safe", 0, 0.0, 0, None, [], []),
    ("```code\nblock```", None, "safe", 0, 0.0, 0, None, [], []),
    # one allow-listed phrase skips the score, whatever follows
    ("thank you " + "kill hate murder " * 40, None, "safe", 0, 0.0, 0, None, [], []),
    ("Привет как дела у тебя сегодня", None, "unknown", 1, 0.0, 30, 1, [], []),
    # long texts: two windows, 768 characters; the run of one letter adds 0.4
    ("x" * 400 + " SHIT " + "y" * 400, None, "suspect", 3, 0.4, 768, 2, [], []),
    ("word " * 100 + "DAMN" + " word" * 800, None, "suspect", 3, 0.0, 768, 2, [], []),
    ("a" * 5000, None, "unknown", 0, 0.4, 768, 2, [], []),
    # hate 1.1 + kill 1.5 + punctuation 0.3
    ("I hate you!!! ??? kill", "toxic", "suspect", 2, 2.9, 22, 1, ["hate", "kill"], []),
    ("a​b", None, "unknown", 0, 0.0, 3, 1, [], []),
    ("mail me at a.b@EXAMPLE.COM or 555-123-4567", "contains_pii", "unknown", 1, 0.0, 42, 1, [], ["EMAIL_ADDRESS", "PHONE_NUMBER"]),
    # two hits are the budget: the address behind them is not reported
    ("card 4111 1111 1111 1111 and ssn 123-45-6789 ip 10.0.0.1", "contains_pii", "unknown", 0, 0.4, 56, 1, [], ["CREDIT_CARD", "SSN"]),
    # a number beyond the scanned 10,000 characters
    ("x" * 9995 + " 555-123-4567", None, "unknown", 0, 0.4, 768, 2, [], []),
]

# a run of one always fires (0.4), listed words weigh 1.0, no budget: one hit ends the scan
OTHER = {"blocklist": ["hate", "kill"], "max_repeated_chars": 1, "pii_max_matches": 0}
GOLDEN_OTHER = [
    ("hello there friend", None, "safe", 0, 0.0, 0, None, [], []),
    ("THIS IS SHOUTING AND VERY LOUD TEXT HERE!!!", None, "suspect", 2, 1.2, 43, 1, [], []),
    ("fuck", None, "unknown", 1, 1.0, 4, 1, [], []),
    ("I hate you!!! ??? kill", "toxic", "suspect", 2, 2.7, 22, 1, ["hate", "kill"], []),
    ("mail me at a.b@EXAMPLE.COM or 555-123-4567", "contains_pii", "unknown", 1, 0.4, 42, 1, [], ["EMAIL_ADDRESS"]),
]


def _text(length, marks):
    """Plain words of the length with marks at places."""
    t = list(("lorem ipsum " * (length // 12 + 1))[: length - 1] + "s")
    for at, mark in marks:
        t[at - 1: at + len(mark) + 1] = [" ", *mark, " "]
    return "".join(t)


# length, marks, severity, windows, stitched characters (head, tail, match and slide windows under the budget)
WINDOWS = [
    (200, [(10, "fuck")], 3, 1, 200),
    (400, [], 0, 1, 400),
    (400, [(10, "fuck")], 3, 2, 545),
    (400, [(380, "!!!!")], 2, 2, 739),
    (1000, [], 0, 2, 768),
    (5000, [(3000, "!!!")], 2, 2, 768),
    (5000, [(10, "fuck"), (2000, "shit"), (4900, "fuck")], 3, 2, 768),
]


def _annotated(spark, texts, cfg):
    df = spark.createDataFrame(list(enumerate(texts)), "original_index long, text string")
    rows = safety.annotate(df, cfg).select(
        "original_index", "drop_reason", "prefilter.tag", "prefilter.metadata.severity", "toxicity.score", "toxicity.char_span",
        "toxicity.signals.window_count", "toxicity.flagged_tokens", "pii.pii_types").collect()
    return [tuple(list(x) if isinstance(x, list) else x for x in r[1:]) for r in sorted(rows, key=lambda r: r[0])]


@pytest.mark.parametrize("cfg,golden", [(SafetyConfig(), GOLDEN), (SafetyConfig.from_overrides(**OTHER), GOLDEN_OTHER)])
def test_golden_rows(spark, cfg, golden):
    assert _annotated(spark, [g[0] for g in golden], cfg) == [g[1:] for g in golden]


def test_windows(spark):
    got = _annotated(spark, [_text(n, marks) for n, marks, *_ in WINDOWS], SafetyConfig())
    assert [(r[2], r[5], r[4]) for r in got] == [w[2:] for w in WINDOWS]


def test_disabled(spark):
    df = spark.createDataFrame([(0, "I hate you, kill kill 555-123-4567")], "original_index long, text string")
    assert safety.annotate(df, SafetyConfig(enabled=False)).first()["drop_reason"] is None


def test_properties_of_fixture_rows(spark):
    cfg = SafetyConfig()
    rows = safety.annotate(tables.documents(spark, SF_SMALL).select("original_index", "text"), cfg).collect()
    assert len(rows) >= 200
    for r in rows:
        toxic = r["toxicity"]["score"] >= cfg.toxicity_threshold
        assert (r["drop_reason"] == "toxic") == toxic
        assert (r["drop_reason"] == "contains_pii") == (not toxic and bool(r["pii"]["pii_types"]))
        assert len(r["pii"]["pii_types"]) <= cfg.pii_max_matches and not (toxic and r["pii"]["pii_types"])
        assert r["toxicity"]["char_span"] <= min(cfg.toxicity_char_cap, max(len(r["text"]) * 2, 1))
        if r["prefilter"]["tag"] == "safe":
            assert r["toxicity"]["score"] == 0


def test_config_values():
    assert SafetyConfig.from_overrides(blocklist={"Kill": "2", "": 3, "x": "no"}).blocklist == {"kill": 2.0, "x": 1.0}
    assert SafetyConfig.from_overrides(blocklist=["A", "", "b"]).blocklist == {"a": 1.0, "b": 1.0}
    assert SafetyConfig.from_overrides(pii_entities=["ssn", "nope"]).pii_entities == ("SSN",)
    assert SafetyConfig.from_overrides(SafetyConfig(toxicity_threshold=9.0), toxicity_char_cap=None).toxicity_threshold == 9.0
    with pytest.raises(TypeError):
        SafetyConfig.from_overrides(blocklist="kill")
