"""Safety rules as built-in Column expressions: prefilter, window
selection, rule-based toxicity score.

Everything is JVM side.  Per-row sequential logic of the rules (span
positions, window registration with de-duplication, budgeted selection) is
written with higher-order array functions (``aggregate``, ``filter``,
``transform``, ``array_sort``) over arrays of at most a dozen entries.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SafetyConfig
from . import patterns as P
from . import text as TX

SPAN_T = "array<struct<start:int,end:int,label:string>>"


# ---------------------------------------------------------------------------
# D1 match spans
# ---------------------------------------------------------------------------

def match_spans(text: Column, pattern: str, label: str) -> Column:
    """All matches of ``pattern`` with code-point positions, left to right.

    ``split`` gives the pieces between matches and ``regexp_extract_all``
    the matches; the running sums of their lengths give each end."""
    lengths = F.filter(F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0),
                                  lambda p, m: F.struct(F.length(p).alias("lp"), F.length(m).alias("lm"))),
                       lambda x: x["lm"].isNotNull())  # the last piece has no match

    def spans(found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda x: x["lp"] + x["lm"]))
        return F.zip_with(ends, found, lambda e, x: F.struct(
            (e - x["lm"]).alias("start"), e.alias("end"), F.lit(label).alias("label")))

    return TX.computed_once(lengths, spans)


def running_sums(numbers: Column) -> Column:
    """The inclusive running sums of an array of whole numbers.

    A running ``aggregate`` would copy its array for every element.  Here each
    pass adds to every element what stands a distance before it, and doubles
    the distance: passes grow with the logarithm of the size."""
    def sums(xs: Column) -> Column:
        distances = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(xs))) - 1),
                                lambda j: F.pow(F.lit(2), j).cast("int"))
        return F.aggregate(distances, xs, lambda acc, d: F.transform(
            acc, lambda x, i: x + F.coalesce(F.get(acc, i - d), F.lit(0))))

    return TX.computed_once(numbers, sums)


# ---------------------------------------------------------------------------
# D1-D5 prefilter
# ---------------------------------------------------------------------------

def add_prefilter(df: DataFrame, text_col: str = "text", cfg: SafetyConfig = SafetyConfig(),
                  out: str = "prefilter") -> DataFrame:
    """Adds ``out`` = struct<tag, reasons, metadata<length, ascii_ratio,
    severity, safe_reasons, suspect_spans>, suspect_spans>.

    Intermediate values are projected into their own columns first: each is
    used several times, and a separate projection keeps Catalyst from
    inlining (and so re-running) the regular expressions at every use."""
    text = F.col(text_col)
    length = F.length(text).cast("int")
    if not cfg.prefilter_enabled:
        return df.withColumn(out, F.struct(
            F.lit("unknown").alias("tag"),
            F.array().cast("array<string>").alias("reasons"),
            _metadata(length, None, None, F.array().cast("array<string>"), None),
            F.array().cast(SPAN_T).alias("suspect_spans"),
        ))
    rules = [label for label, _ in P.PREFILTER_RULES]
    stage0 = df.withColumn("_pf_stripped", TX.strip_ws(text))
    blank = F.col("_pf_stripped").isNull() | (F.col("_pf_stripped") == "")
    # positions are only computed for texts that match at all
    stage1 = stage0.select("*", *[F.when(~blank & text.rlike(P.PREFILTER_J[r]), match_spans(text, P.PREFILTER_J[r], r))
                                  .when(~blank, F.array().cast(SPAN_T)).alias(f"_pf_{r}")
                                  for r in rules],
                           F.when(~blank, TX.ascii_ratio(text)).alias("_pf_ar"), blank.alias("_pf_blank"))
    ar = F.col("_pf_ar")
    stripped = F.col("_pf_stripped")
    sev0 = F.greatest(*[F.when(F.size(f"_pf_{r}") > 0, F.lit(w)).otherwise(F.lit(0))
                        for r, (_, w) in zip(rules, P.PREFILTER_RULES)])
    allow = TX.computed_once(F.lower(text), lambda lower: functools.reduce(
        operator.or_, [lower.contains(phrase) for phrase in P.SAFE_ALLOWLIST_PHRASES]))
    stage2 = stage1.select(
        "*",
        sev0.alias("_pf_sev0"),
        (ar < F.lit(cfg.prefilter_non_english_ascii_ratio)).alias("_pf_non_en"),
        ((F.length(stripped) <= cfg.prefilter_safe_char_limit) & stripped.rlike(P.SAFE_SHORT_TEXT_J)
         & (ar >= F.lit(cfg.prefilter_safe_ascii_ratio))).alias("_pf_short"),
        stripped.rlike(P.SAFE_NUMERIC_J).alias("_pf_numeric"),
        stripped.rlike(P.SAFE_TIMESTAMP_J).alias("_pf_timestamp"),
        stripped.rlike(P.SAFE_URL_ONLY_J).alias("_pf_url"),
        stripped.rlike(P.SAFE_FORMAL_TEMPLATE_J).alias("_pf_formal"),
        stripped.rlike(P.SAFE_CODE_BLOCK_J).alias("_pf_code"),
        allow.alias("_pf_allow"),
        F.concat(*[F.col(f"_pf_{r}") for r in rules]).alias("_pf_spans"),
    )
    sev1 = F.when(F.col("_pf_non_en"), F.greatest(F.col("_pf_sev0"), F.lit(1))).otherwise(F.col("_pf_sev0"))
    flags = [("suspect_pattern", F.col("_pf_sev0") > 0), ("non_english_like", F.col("_pf_non_en")),
             ("short_neutral", F.col("_pf_short")), ("numeric_like", F.col("_pf_numeric")),
             ("timestamp_like", F.col("_pf_timestamp")), ("url_only", F.col("_pf_url")),
             ("formal_template", F.col("_pf_formal")), ("code_block", F.col("_pf_code")),
             ("allowlist_phrase", F.col("_pf_allow"))]
    stage3 = stage2.select(
        "*",
        F.when(F.col("_pf_short"), F.least(sev1, F.lit(1))).otherwise(sev1).cast("int").alias("_pf_sev"),
        F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags])).alias("_pf_reasons"),
    )
    sev = F.col("_pf_sev")
    reasons = F.col("_pf_reasons")
    # At severity 0 no 'suspect_pattern' can be present, so every reason is safe.
    tag = (F.when(sev >= 2, F.lit("suspect")).when(sev == 1, F.lit("unknown"))
           .when(F.size(reasons) > 0, F.lit("safe")).otherwise(F.lit("unknown")))
    full = F.struct(
        tag.alias("tag"), reasons.alias("reasons"),
        _metadata(length, F.bround(ar, 3), sev, F.filter(reasons, lambda r: r != "suspect_pattern"),
                  F.size("_pf_spans").cast("int")),
        F.col("_pf_spans").alias("suspect_spans"),
    )
    empty = F.struct(
        F.lit("safe").alias("tag"), F.array(F.lit("empty")).alias("reasons"),
        _metadata(length, None, None, F.lit(None).cast("array<string>"), None),
        F.array().cast(SPAN_T).alias("suspect_spans"),
    )
    temp = [c for c in stage3.columns if c.startswith("_pf_")]
    return stage3.withColumn(out, F.when(F.col("_pf_blank"), empty).otherwise(full)).drop(*temp)


def _metadata(length, ratio, severity, safe_reasons, n_spans) -> Column:
    def opt(c, t):
        return (c if c is not None else F.lit(None)).cast(t)
    return F.struct(
        length.alias("length"),
        opt(ratio, "double").alias("ascii_ratio"),
        opt(severity, "int").alias("severity"),
        safe_reasons.cast("array<string>").alias("safe_reasons"),
        opt(n_spans, "int").alias("suspect_spans"),
    ).alias("metadata")


# ---------------------------------------------------------------------------
# D6-D7 windows
# ---------------------------------------------------------------------------

WIN_T = "array<struct<prio:int,s:int,e:int>>"
SEL_T = "array<struct<s:int,e:int>>"


def _budgeted(windows: Column, budget: int, limit: int | Column) -> Column:
    """Take windows in order while budget and count last; the window that
    overflows the budget is cut to it and ends the selection."""
    init = F.struct(F.lit(budget).alias("budget"),
                    (F.lit(limit) if isinstance(limit, int) else limit).cast("int").alias("rl"),
                    F.lit(False).alias("done"), F.array().cast(SEL_T).alias("out"))

    def step(acc, w):
        stop = acc["done"] | (acc["budget"] <= 0) | (acc["rl"] <= 0)
        n = w["e"] - w["s"]
        cut = n > acc["budget"]
        piece = F.struct(w["s"].alias("s"), F.when(cut, w["s"] + acc["budget"]).otherwise(w["e"]).alias("e"))
        return F.struct(
            F.when(stop | cut, acc["budget"]).otherwise(acc["budget"] - n).alias("budget"),
            F.when(stop | cut, acc["rl"]).otherwise(acc["rl"] - 1).alias("rl"),
            (stop | cut).alias("done"),
            F.when(stop, acc["out"]).otherwise(F.concat(acc["out"], F.array(piece))).alias("out"),
        )

    return F.aggregate(windows, init, step, lambda acc: acc["out"])


def select_windows(length: Column, severity: Column, spans: Column, cfg: SafetyConfig) -> Column:
    """Selected windows ``array<struct<s,e>>`` (0-based, end exclusive), in
    stitching order: head and tail (priority 2), one window around each of
    the first suspect spans (0), sliding windows for severity >= 3 (1), a
    middle window (3); de-duplicated by (start, end), at most
    ``toxicity_suspect_windows`` registered, sorted by (priority, start),
    then cut to the character budget and the window limit."""
    wc = max(128, int(cfg.toxicity_window_chars or 256))
    budget = max(wc, int(cfg.toxicity_char_cap or wc))
    max_windows = math.ceil(budget / wc)
    cap_n = cfg.toxicity_suspect_windows
    lim3 = min(cfg.toxicity_suspect_windows, max_windows)
    lim2 = min(max(2, cfg.toxicity_max_windows), max_windows)
    lim1 = min(cfg.toxicity_max_windows, max_windows)
    limit = F.when(severity >= 3, F.lit(lim3)).when(severity == 2, F.lit(lim2)).otherwise(F.lit(lim1))
    stride = max(64, int(wc * (1 - min(max(cfg.toxicity_window_stride, 0.1), 0.9))))
    L = length

    def cand(kind: int, prio: int, start: Column, end: Column, cursor: Column | None = None) -> Column:
        s = F.greatest(F.lit(0), start)
        e = F.least(L, F.greatest(s + 1, end))
        e = F.when(e - s > wc, s + wc).otherwise(e)
        return F.struct(F.lit(kind).alias("kind"), F.lit(prio).alias("prio"), s.cast("int").alias("s"),
                        e.cast("int").alias("e"), (cursor if cursor is not None else F.lit(0)).cast("int").alias("cursor"))

    head = F.array(cand(0, 2, F.lit(0), F.lit(wc)), cand(0, 2, L - wc, L))
    match = F.transform(F.slice(spans, 1, cap_n), lambda sp: cand(
        0, 0,
        F.greatest(F.lit(0), F.floor((sp["start"] + sp["end"]) / 2).cast("int") - (wc // 2) - cfg.toxicity_window_padding),
        F.greatest(F.lit(0), F.floor((sp["start"] + sp["end"]) / 2).cast("int") - (wc // 2) - cfg.toxicity_window_padding) + wc))
    n_slides = F.least(F.lit(cap_n + 8), F.ceil(L / F.lit(stride)).cast("int"))
    slides = F.transform(F.sequence(F.lit(0), F.greatest(n_slides, F.lit(1)) - 1),
                         lambda j: cand(1, 1, j * stride, j * stride + wc, j * stride))
    mid = F.greatest(F.lit(0), F.floor(L / 2).cast("int") - (wc // 2))
    middle = F.array(cand(2, 3, mid, mid + wc))
    cands = F.concat(head, match, slides, middle)

    def register(acc, x):
        n = F.size(acc)
        fresh = ~F.exists(acc, lambda a: (a["s"] == x["s"]) & (a["e"] == x["e"]))
        gate = (F.when(x["kind"] == 1, (severity >= 3) & (n < limit) & (x["cursor"] < L))
                .when(x["kind"] == 2, n < limit).otherwise(F.lit(True)))
        row = F.struct(x["prio"].alias("prio"), x["s"].alias("s"), x["e"].alias("e"))
        return F.when((n < cap_n) & fresh & gate, F.concat(acc, F.array(row))).otherwise(acc)

    registered = F.aggregate(cands, F.array().cast(WIN_T), register)
    ordered = F.transform(F.array_sort(registered), lambda w: F.struct(w["s"].alias("s"), w["e"].alias("e")))
    return _budgeted(ordered, budget, limit)


def stitch(text: Column, windows: Column, cfg: SafetyConfig) -> Column:
    """Window texts joined by '\\n' under the character cap, cut to the cap."""
    cap = int(cfg.toxicity_char_cap)
    parts = _budgeted(windows, cap, 1 << 30) if cap > 0 else windows
    joined = F.array_join(F.transform(parts, lambda w: F.substring(text, w["s"] + 1, w["e"] - w["s"])), "\n")
    fallback = F.substring(text, 1, cap) if cap > 0 else text
    out = F.when(F.size(parts) > 0, joined).otherwise(fallback)
    return F.substring(out, 1, cap) if cap > 0 else out


# ---------------------------------------------------------------------------
# D8-D15 score
# ---------------------------------------------------------------------------

def normalize_for_scoring(t: Column) -> Column:
    out = F.regexp_replace(t, P.ZERO_WIDTH_J, "")
    out = F.regexp_replace(out, P.REPEATED_SYMBOL_J, "$1$1")
    return TX.collapse_whitespace(out)


def _blocklist_map(cfg: SafetyConfig) -> Column | None:
    items = []
    for k, w in cfg.blocklist.items():
        if w:  # a zero weight never scores
            items += [F.lit(str(k)), F.lit(float(w))]
    return F.create_map(*items) if items else None


SIGNALS_T = ("struct<rule_version:string,blocklist_hits:int,uppercase_ratio:double,symbol_ratio:double,"
             "uppercase_penalty_applied:boolean,symbol_penalty_applied:boolean,repeated_sequence:boolean,"
             "repeated_punctuation:int,obfuscated_matches:int,obfuscated_examples:array<string>,"
             "window_count:int,processing_mode:string,prefilter_tag:string,skip_reason:string,"
             "safe_reasons:array<string>>")
TOX_T = f"struct<is_toxic:boolean,score:double,flagged_tokens:array<string>,signals:{SIGNALS_T},char_span:int>"


def _signals(**kv) -> Column:
    names = ["rule_version", "blocklist_hits", "uppercase_ratio", "symbol_ratio", "uppercase_penalty_applied",
             "symbol_penalty_applied", "repeated_sequence", "repeated_punctuation", "obfuscated_matches",
             "obfuscated_examples", "window_count", "processing_mode", "prefilter_tag", "skip_reason",
             "safe_reasons"]
    return F.struct(*[(kv.get(n) if kv.get(n) is not None else F.lit(None)).alias(n) for n in names]) \
        .cast(SIGNALS_T)


def empty_toxicity(prefilter_tag: Column | None = None, skip_reason: str | None = None,
                   safe_reasons: Column | None = None) -> Column:
    return F.struct(
        F.lit(False).alias("is_toxic"), F.lit(0.0).alias("score"),
        F.array().cast("array<string>").alias("flagged_tokens"),
        _signals(rule_version=F.lit(P.RULE_VERSION), processing_mode=F.lit("rule_based"),
                 prefilter_tag=prefilter_tag,
                 skip_reason=F.lit(skip_reason) if skip_reason else None, safe_reasons=safe_reasons).alias("signals"),
        F.lit(0).alias("char_span"),
    ).cast(TOX_T)


def add_toxicity(df: DataFrame, text_col: str, pf_col: str, cfg: SafetyConfig = SafetyConfig(),
                 out: str = "toxicity", active: Column | None = None, find=None) -> DataFrame:
    """Adds ``out`` = rule score of the stitched windows for rows where
    ``active`` holds (null elsewhere).  Stitched text, normalised text and
    the counts are staged in separate projections (see add_prefilter).

    ``find(df, words, out)`` adds the listed ones of a word array with their
    weights (a blocklist table); without it the configuration's map is used."""
    text = F.col(text_col)
    pf = F.col(pf_col)
    on = active if active is not None else F.lit(True)
    severity = F.coalesce(pf["metadata"]["severity"], F.lit(0))
    s0 = df.withColumn("_tx_len", F.length(text))
    s1 = s0.withColumn("_tx_win", F.when(on, select_windows(F.col("_tx_len"), severity, pf["suspect_spans"], cfg)))
    s2 = s1.withColumn("_tx_t", F.when(on, stitch(text, F.col("_tx_win"), cfg)))
    t = F.col("_tx_t")
    normalized = normalize_for_scoring(t)
    s3 = s2.withColumn("_tx_low", F.lower(normalized))
    lowered = F.col("_tx_low")
    bmap = _blocklist_map(cfg) if find is None else None
    tokens = F.regexp_extract_all(lowered, F.lit(P.WORD_J), 0)
    if find is not None:
        s3 = find(s3.withColumn("_tx_words", F.when(on, tokens)), "_tx_words", "_tx_found")
        hits = F.transform("_tx_found", lambda x: x["word"])
    elif bmap is not None:
        hits = F.filter(tokens, lambda x: x.isin(*[str(k) for k, w in cfg.blocklist.items() if w]))
    else:
        hits = F.array().cast("array<string>")
    n = F.length(t)
    letters = TX.count_class(t, r"\p{L}")
    upper = TX.count_class(t, r"\p{IsUppercase}")
    symbols = TX.count_class(t, r"[^\p{L}\p{N}\s\p{Z}\x0b\x1c-\x1f\x85]")
    k = int(cfg.max_repeated_chars)
    repeated = F.lit(True) if k <= 1 else t.rlike(r"(?s)(.)\1{%d,}" % (k - 1))
    if k > 4:  # up to 4, the first has all matches of the fixed rule
        repeated = repeated | t.rlike(P.REPEATED_CHAR_J)
    s4 = s3.select(
        "*",
        hits.alias("_tx_hits"),
        F.when(letters > 0, upper / letters).otherwise(F.lit(0.0)).alias("_tx_ur"),
        (symbols / F.greatest(F.lit(1), n)).alias("_tx_sr"),
        repeated.alias("_tx_rep"),
        F.regexp_count(t, F.lit(P.REPEATED_PUNCT_J)).alias("_tx_punct"),
        F.regexp_extract_all(lowered, F.lit(P.OBFUSCATED_J), 0).alias("_tx_obf"),
        n.alias("_tx_n"),
    )
    hits = F.col("_tx_hits")
    if find is not None:
        score = F.aggregate("_tx_found", F.lit(0.0), lambda acc, x: acc + x["weight"])
    else:
        score = (F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + F.element_at(bmap, x))
                 if bmap is not None else F.lit(0.0))
    up_on = (F.col("_tx_n") >= cfg.min_chars_for_uppercase_check) & (F.col("_tx_ur") > cfg.uppercase_ratio_limit)
    sym_on = F.col("_tx_sr") > cfg.symbol_ratio_limit
    punct_on = F.col("_tx_punct") > 0
    obf_on = F.size("_tx_obf") > 0
    s5 = s4.select("*", score.alias("_tx_bl"), up_on.alias("_tx_up_on"), sym_on.alias("_tx_sym_on"),
                   punct_on.alias("_tx_punct_on"), obf_on.alias("_tx_obf_on"))
    total = F.col("_tx_bl")
    for c, pen in (("_tx_up_on", cfg.uppercase_penalty), ("_tx_sym_on", cfg.symbol_penalty),
                   ("_tx_rep", cfg.repeat_penalty), ("_tx_punct_on", cfg.repeated_punct_penalty),
                   ("_tx_obf_on", cfg.obfuscated_profanity_penalty)):
        total = total + F.when(F.col(c), F.lit(float(pen))).otherwise(F.lit(0.0))
    s6 = s5.withColumn("_tx_total", total)
    signals = _signals(
        rule_version=F.lit(P.RULE_VERSION),
        blocklist_hits=F.size(hits),
        uppercase_ratio=F.bround("_tx_ur", 3),
        symbol_ratio=F.bround("_tx_sr", 3),
        uppercase_penalty_applied=F.when(F.col("_tx_up_on"), F.lit(True)),
        symbol_penalty_applied=F.when(F.col("_tx_sym_on"), F.lit(True)),
        repeated_sequence=F.when(F.col("_tx_rep"), F.lit(True)),
        repeated_punctuation=F.when(F.col("_tx_punct_on"), F.col("_tx_punct")),
        obfuscated_matches=F.when(F.col("_tx_obf_on"), F.size("_tx_obf")),
        obfuscated_examples=F.when(F.col("_tx_obf_on"), F.slice("_tx_obf", 1, 3)),
        window_count=F.size("_tx_win"),
        processing_mode=F.lit("rule_based"),
        prefilter_tag=pf["tag"],
    )
    result = F.struct(
        (F.col("_tx_total") >= F.lit(float(cfg.toxicity_threshold))).alias("is_toxic"),
        F.bround("_tx_total", 3).alias("score"),
        hits.alias("flagged_tokens"),
        signals.alias("signals"),
        F.col("_tx_n").cast("int").alias("char_span"),
    ).cast(TOX_T)
    temp = [c for c in s6.columns if c.startswith("_tx_")]
    return s6.withColumn(out, F.when(on, result)).drop(*temp)
