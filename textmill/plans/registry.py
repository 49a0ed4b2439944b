"""Registered queries (Spark) and their oracle formulations (DuckDB SQL).

Every query reads the given tables in full.  Keys follow the operator
inventory; each Spark callable takes ``(spark, sf_dir)``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import CleanConfig
from ..functions import patterns as P
from ..functions import pii as PII
from ..functions.url import source_from_url
from ..operators import cleaning, dedup
from ..operators.staging import once
from ..sources import tables
from . import sqlfrag as S

QUERIES: dict = {}
ORACLE: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


CLEAN = CleanConfig()


# --------------------------------------------------------------------------- B3-B5

@register("lang_distribution", """
SELECT lang AS language, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang
""")
def q_lang_distribution(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import language
    return language.distribution(tables.documents(spark, sf))


@register("lang_top5", """
SELECT lang AS language, CAST(count(*) AS BIGINT) AS n FROM documents
GROUP BY lang ORDER BY n DESC, language LIMIT 5
""")
def q_lang_top5(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import language
    return language.top_k(language.distribution(tables.documents(spark, sf)), 5)


@register("lang_share", """
SELECT language, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share
FROM (SELECT lang AS language, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang)
""")
def q_lang_share(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import language
    return language.shares(language.distribution(tables.documents(spark, sf)))


# --------------------------------------------------------------------------- C1-C6

def _clean_sql(table: str, idx: str, col: str) -> str:
    c = S.clean(col)
    return f"""
SELECT {idx} AS original_index,
       CASE WHEN {col} IS NULL OR {col} = '' THEN 'empty_text'
            WHEN length(c) < {CLEAN.min_chars} THEN 'too_short'
            WHEN length(c) > {CLEAN.max_chars} THEN 'too_long' END AS drop_reason,
       CASE WHEN length(c) BETWEEN {CLEAN.min_chars} AND {CLEAN.max_chars} THEN CAST(length(c) AS INTEGER) END AS char_length,
       CASE WHEN length(c) BETWEEN {CLEAN.min_chars} AND {CLEAN.max_chars} THEN c END AS text
FROM (SELECT {idx}, {col}, {c} AS c FROM {table})
"""


def _clean_cols(df: DataFrame) -> DataFrame:
    return df.select("original_index", "drop_reason", "char_length", "text")


@register("clean_text", _clean_sql("documents", "doc_id", "text"))
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_cols(cleaning.annotate(tables.documents(spark, sf), CLEAN))


@register("clean_html", _clean_sql("pages", "page_id", "html"))
def q_clean_html(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_cols(cleaning.annotate(tables.pages(spark, sf), CLEAN))


@register("clean_drops", f"""
SELECT drop_reason, CAST(count(*) AS BIGINT) AS n FROM ({_clean_sql("documents", "doc_id", "text")})
WHERE drop_reason IS NOT NULL GROUP BY drop_reason
""")
def q_clean_drops(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_counts(cleaning.annotate(tables.documents(spark, sf), CLEAN))


# --------------------------------------------------------------------------- D16, I7

def _pii_sql() -> str:
    m = S.ascii_word_map("substr(text, 1, 10000)")
    ks, parts, counts = [], [], []
    left = "2"
    for name in P.PII_ENTITIES:
        n = S.count_matches("m", S.py_to_re2(P.PII_PATTERNS_PY[name], True))
        k = f"least({n}, {left})"
        ks.append(f"{k} AS k_{name}")
        left = f"({left} - k_{name})"
        parts.append(f"list_transform(range(k_{name}), lambda x: {S.lit(name)})")
        counts.append(f"k_{name}")
    # lateral column aliases let each k refer to the earlier ones
    return f"""
SELECT doc_id AS original_index,
       ({' + '.join(counts)}) > 0 AS has_pii,
       CAST(flatten([{', '.join(parts)}]) AS VARCHAR[]) AS pii_types,
       CAST({' + '.join(counts)} AS INTEGER) AS pii_count
FROM (SELECT doc_id, {', '.join(ks)} FROM (SELECT doc_id, {m} AS m FROM documents))
"""


@register("pii_detect", _pii_sql())
def q_pii_detect(spark: SparkSession, sf: str) -> DataFrame:
    d = tables.documents(spark, sf)
    return d.select("original_index", PII.detect_pii(F.col("text")).alias("p")).select(
        "original_index", "p.has_pii", "p.pii_types", "p.pii_count")


def _redact_sql() -> str:
    x = S.ascii_word_map("text")
    for name, label in P.REDACTION_LABELS:
        x = f"regexp_replace({x}, {S.lit(S.py_to_re2(P.PII_PATTERNS_PY[name], False))}, {S.lit(label)}, 'g')"
    cols = ", ".join(
        f"CAST(len(regexp_extract_all(r, {S.lit(S.lit(label)[1:-1].replace('[', chr(92) + '[').replace(']', chr(92) + ']'))})) AS INTEGER) AS n_{name.split('_')[0].lower()}"
        for name, label in P.REDACTION_LABELS)
    return f"SELECT doc_id AS original_index, {cols}, CAST(length(r) AS INTEGER) AS redacted_length FROM (SELECT doc_id, {x} AS r FROM documents)"


@register("redact", _redact_sql())
def q_redact(spark: SparkSession, sf: str) -> DataFrame:
    d = tables.documents(spark, sf).withColumn("r", PII.redact_pii(F.col("text")))
    cols = [F.regexp_count("r", F.lit(label.replace("[", r"\[").replace("]", r"\]"))).cast("int")
            .alias(f"n_{name.split('_')[0].lower()}") for name, label in P.REDACTION_LABELS]
    return d.select("original_index", *cols, F.length("r").cast("int").alias("redacted_length"))


# --------------------------------------------------------------------------- E1-E4

@register("dedup_exact", f"""
SELECT original_index, content_hash, original_index <> min(original_index) OVER (PARTITION BY content_hash) AS is_duplicate
FROM (SELECT doc_id AS original_index, sha256({S.canonical('text')}) AS content_hash
      FROM documents WHERE text IS NOT NULL AND text <> '')
""")
def q_dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.annotate_exact(tables.documents(spark, sf)).select(
        "original_index", "content_hash", "is_duplicate")


# --------------------------------------------------------------------------- I1

@register("source_from_url", r"""
SELECT page_id, url,
  CASE WHEN url IS NULL OR url = '' OR dom = '' THEN 'web'
       WHEN len(parts) > 2 THEN parts[-2]
       WHEN len(parts) = 2 THEN d ELSE 'web' END AS source
FROM (SELECT page_id, url, dom, d, string_split(d, '.') AS parts FROM (
  SELECT page_id, url, dom, replace(dom, 'www.', '') AS d FROM (
    SELECT page_id, url,
      CASE WHEN regexp_extract(rest, '^//([^/?#]*)', 1) <> '' THEN regexp_extract(rest, '^//([^/?#]*)', 1)
           WHEN starts_with(rest, '//') THEN regexp_extract(rest, '^//[^/?#]*([^?#]*)', 1)
           ELSE regexp_extract(rest, '^([^?#]*)', 1) END AS dom
    FROM (SELECT page_id, url, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:', '') AS rest FROM pages))))
""")
def q_source_from_url(spark: SparkSession, sf: str) -> DataFrame:
    p = tables.table(spark, sf, "pages")
    return p.select("page_id", "url", source_from_url(F.col("url")).alias("source"))


# --------------------------------------------------------------------------- D1-D21

def _prefilter_sql() -> str:
    m = "m"
    prof = "(?i)" + "|".join(P.PROFANITY_TERMS_PY)
    obf = "(?i)" + P.OBFUSCATED_PROFANITY_PATTERN_PY
    caps = P.ALL_CAPS_WORD_PATTERN_PY
    punct = P.REPEATED_PUNCT_PATTERN_PY
    n = {k: S.count_matches(m, v) for k, v in (("prof", prof), ("obf", obf), ("punct", punct), ("caps", caps))}
    ws = S.WS
    allow = " OR ".join(f"contains(lower(text), {S.lit(p)})" for p in P.SAFE_ALLOWLIST_PHRASES)
    return f"""
WITH base AS (
  SELECT doc_id, text, {S.ascii_word_map('text')} AS m,
         regexp_replace(text, {S.lit('^' + ws + '+|' + ws + '+$')}, '', 'g') AS stripped,
         CAST(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS ar
  FROM documents),
f AS (
  SELECT doc_id, text, stripped, ar, {S.ascii_word_map('stripped')} AS ms,
         {n['prof']} AS n_prof, {n['obf']} AS n_obf, {n['punct']} AS n_punct, {n['caps']} AS n_caps
  FROM base),
g AS (
  SELECT *, greatest(CASE WHEN n_prof > 0 THEN 3 ELSE 0 END, CASE WHEN n_obf > 0 THEN 3 ELSE 0 END,
                     CASE WHEN n_punct > 0 THEN 2 ELSE 0 END, CASE WHEN n_caps > 0 THEN 1 ELSE 0 END) AS sev0,
         ar < 0.35 AS non_en,
         length(stripped) <= 20 AND regexp_full_match(ms, {S.lit(S.py_to_re2(P.SAFE_SHORT_TEXT_PATTERN_PY[1:-1], False))}) AND ar >= 0.75 AS short,
         regexp_matches(ms, {S.lit(P.SAFE_NUMERIC_PATTERN_PY)}) AS numeric,
         regexp_matches(ms, {S.lit(P.SAFE_TIMESTAMP_PATTERN_PY)}) AS ts,
         regexp_matches(ms, {S.lit('(?i)' + P.SAFE_URL_ONLY_PATTERN_PY)}) AS url,
         regexp_matches(ms, {S.lit('(?i)' + P.SAFE_FORMAL_TEMPLATE_PATTERN_PY)}) AS formal,
         regexp_matches(ms, {S.lit('(?m)' + chr(92) + 'A```[' + chr(92) + 's' + chr(92) + 'S]+```$')}) AS code,
         ({allow}) AS allow
  FROM f),
h AS (
  SELECT *, CASE WHEN short THEN least(CASE WHEN non_en THEN greatest(sev0, 1) ELSE sev0 END, 1)
                 ELSE CASE WHEN non_en THEN greatest(sev0, 1) ELSE sev0 END END AS sev,
         list_filter(['suspect_pattern', 'non_english_like', 'short_neutral', 'numeric_like', 'timestamp_like',
                      'url_only', 'formal_template', 'code_block', 'allowlist_phrase'],
                     lambda r, i: [sev0 > 0, non_en, short, numeric, ts, url, formal, code, allow][i]) AS reasons
  FROM g)
SELECT doc_id AS original_index,
       CASE WHEN text IS NULL OR stripped = '' THEN 'safe' WHEN sev >= 2 THEN 'suspect' WHEN sev = 1 THEN 'unknown'
            WHEN len(reasons) > 0 THEN 'safe' ELSE 'unknown' END AS tag,
       CASE WHEN text IS NULL OR stripped = '' THEN NULL ELSE CAST(sev AS INTEGER) END AS severity,
       CASE WHEN text IS NULL OR stripped = '' THEN ['empty'] ELSE reasons END AS reasons,
       CAST(CASE WHEN text IS NULL OR stripped = '' THEN 0 ELSE n_prof + n_obf + n_punct + n_caps END AS INTEGER) AS n_spans
FROM h
"""


@register("prefilter", _prefilter_sql())
def q_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions import safety as SF
    d = SF.add_prefilter(tables.documents(spark, sf))
    return d.select("original_index", "prefilter.tag", F.col("prefilter.metadata.severity").alias("severity"),
                    "prefilter.reasons", F.size("prefilter.suspect_spans").cast("int").alias("n_spans"))


def _safety_annotated(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import safety
    return safety.annotate(tables.documents(spark, sf))


@register("toxicity_score")
def q_toxicity_score(spark: SparkSession, sf: str) -> DataFrame:
    return _safety_annotated(spark, sf).select(
        "original_index", "toxicity.is_toxic", "toxicity.score", "toxicity.flagged_tokens", "toxicity.char_span",
        F.col("toxicity.signals.window_count").alias("window_count"))


@register("safety_filter")
def q_safety_filter(spark: SparkSession, sf: str) -> DataFrame:
    from ..session import reliable_checkpoint
    from .corpus_run import whole_stage_codegen
    with whole_stage_codegen(spark, False):  # as in the run: the rules' generated code is slower than none
        return reliable_checkpoint(_safety_annotated(spark, sf).select(
            "original_index", "drop_reason", "pii.pii_types", "prefilter.tag", "toxicity.score"))


@register("safety_metrics")
def q_safety_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import safety
    return safety.metrics(_safety_annotated(spark, sf))


@register("flagged_tokens")
def q_flagged_tokens(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import safety
    return safety.flagged_token_top(_safety_annotated(spark, sf), 20)


@register("pii_type_counts")
def q_pii_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import safety
    return safety.pii_type_counts(_safety_annotated(spark, sf))


# --------------------------------------------------------------------------- E5-E9

def _shingle_sql() -> str:
    canon = S.canonical("text")
    return f"""
SELECT doc_id, w, len(w) AS nw FROM (
  SELECT doc_id, CASE WHEN c = '' THEN [] ELSE string_split(c, ' ') END AS w
  FROM (SELECT doc_id, {canon} AS c FROM documents WHERE text IS NOT NULL AND text <> '')
  WHERE c <> '')
"""


_SH = f"""
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(nw - 1, 1)),
           lambda i: array_to_string(w[i:i + 2], ' ')))) AS sh
  FROM ({_shingle_sql()})),
sets2 AS (SELECT doc_id, CASE WHEN len(sh) > 0 AND len(sh[1]) > 0 THEN sh ELSE [] END AS sh FROM sets),
keyed AS (SELECT doc_id, sh, md5(array_to_string(sh, chr(1))) AS k FROM sets2),
reps AS (SELECT doc_id, sh, k, doc_id <> min(doc_id) OVER (PARTITION BY k) AS copy FROM keyed),
r AS (SELECT doc_id, sh FROM reps WHERE NOT copy),
tok AS (SELECT doc_id, unnest(sh) AS t, len(sh) AS n FROM r),
pairs AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS inter, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM tok a JOIN tok b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
edges AS (SELECT i, j FROM pairs WHERE CAST(inter AS DOUBLE) / (na + nb - inter) > 0.9)
"""


@register("shingles", f"""
WITH {_SH.strip()}
SELECT doc_id AS original_index, CAST(len(sh) AS INTEGER) AS n_shingles FROM sets2
""")
def q_shingles(spark: SparkSession, sf: str) -> DataFrame:
    fp = dedup.fingerprint(tables.documents(spark, sf)).filter(F.col("content_hash").isNotNull())
    return dedup.add_shingles(fp).select("original_index", F.size("shingles").cast("int").alias("n_shingles"))


_EXACT = None


def _exact_cfg():
    from ..config import DedupConfig
    return DedupConfig(verify="exact")


@register("near_dup_pairs", f"""
WITH {_SH.strip()}
SELECT i, j FROM edges
""")
def q_near_dup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _exact_cfg()
    fp = dedup.fingerprint(tables.documents(spark, sf)).filter(F.col("content_hash").isNotNull())
    return dedup.near_pairs(fp, cfg)


@register("dedup_greedy", f"""
WITH RECURSIVE {_SH.strip()},
nodes AS (SELECT v, row_number() OVER (ORDER BY v) AS rn FROM (SELECT i AS v FROM edges UNION SELECT j FROM edges)),
walk(rn, kept) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT n.rn,
         CASE WHEN len(list_filter(w.kept, lambda x: list_contains(n.nb, x))) > 0 THEN w.kept
              ELSE list_append(w.kept, n.v) END
  FROM walk w JOIN (SELECT nodes.v, nodes.rn, coalesce((SELECT list(e.i) FROM edges e WHERE e.j = nodes.v), []) AS nb FROM nodes) n
    ON n.rn = w.rn + 1),
final AS (SELECT kept FROM walk ORDER BY rn DESC LIMIT 1)
SELECT doc_id AS original_index,
       copy OR (doc_id IN (SELECT v FROM nodes) AND NOT list_contains((SELECT kept FROM final), doc_id)) AS is_duplicate
FROM reps
""")
def q_dedup_greedy(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.annotate_near(tables.documents(spark, sf), _exact_cfg()).select("original_index", "is_duplicate")


@register("dedup_leaders", f"""
WITH RECURSIVE {_SH.strip()},
nodes AS (SELECT v, row_number() OVER (ORDER BY v) AS rn FROM (SELECT i AS v FROM edges UNION SELECT j FROM edges)),
walk(rn, kept) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT n.rn,
         CASE WHEN len(list_filter(w.kept, lambda x: list_contains(n.nb, x))) > 0 THEN w.kept
              ELSE list_append(w.kept, n.v) END
  FROM walk w JOIN (SELECT nodes.v, nodes.rn, coalesce((SELECT list(e.i) FROM edges e WHERE e.j = nodes.v), []) AS nb FROM nodes) n
    ON n.rn = w.rn + 1),
final AS (SELECT kept FROM walk ORDER BY rn DESC LIMIT 1),
gone AS (SELECT v FROM nodes WHERE NOT list_contains((SELECT kept FROM final), v)),
led AS (SELECT j AS doc_id, min(i) AS leader FROM edges WHERE j IN (SELECT v FROM gone) AND i NOT IN (SELECT v FROM gone) GROUP BY j),
firsts AS (SELECT k, min(doc_id) AS first FROM reps GROUP BY k)
SELECT doc_id AS original_index, leader FROM led
UNION ALL SELECT reps.doc_id, coalesce(led.leader, first) FROM reps JOIN firsts USING (k) LEFT JOIN led ON led.doc_id = first WHERE copy
""")
def q_dedup_leaders(spark: SparkSession, sf: str) -> DataFrame:
    """Members with their leaders: no pairs of members are listed."""
    return dedup.leaders(tables.documents(spark, sf), _exact_cfg())


@register("dedup_minhash")
def q_dedup_minhash(spark: SparkSession, sf: str) -> DataFrame:
    from ..config import DedupConfig
    return dedup.annotate_near(tables.documents(spark, sf), DedupConfig()).select(
        "original_index", "content_hash", "is_duplicate")


# --------------------------------------------------------------------------- F1-F4

def _tokenized(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import tokens
    return tokens.annotate(tables.documents(spark, sf))


@register("tokenize")
def q_tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return _tokenized(spark, sf).select("original_index", "drop_reason", "encoded_count", "token_count")


@register("token_metrics")
def q_token_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import tokens
    return tokens.metrics(_tokenized(spark, sf))


# --------------------------------------------------------------------------- I2-I6, J1-J9

def _training_cfg():
    from ..config import TrainingConfig
    return TrainingConfig(vocab_size=1 << 28, shard_size=50, shuffle_key="md5", eos_token=50256)


def _hashed_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned documents with word-hash tokens (SQL-reproducible)."""
    from ..operators import tokens
    d = cleaning.kept(cleaning.annotate(tables.documents(spark, sf), CLEAN))
    return once(d, "tokens", tokens.word_hash_tokens(F.col("text"))).withColumn("token_count", F.size("tokens").cast("int"))


_SQL_WORDS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"
_SQL_DOCS = f"""
cl AS ({_clean_sql("documents", "doc_id", "text")}),
hd AS (SELECT original_index, text, char_length,
         list_transform(list_filter(string_split_regex(text, {S.lit(_SQL_WORDS)}), lambda w: w <> ''),
                        lambda w: CAST(('0x' || substr(md5(w), 1, 7)) AS INTEGER)) AS tokens
       FROM cl WHERE drop_reason IS NULL)
"""


@register("preconditions", f"""
WITH {_SQL_DOCS.strip()}
SELECT original_index,
       NOT (len(tokens) = 0 OR char_length < 80 OR len(tokens) < 20) AS valid,
       CASE WHEN len(tokens) = 0 THEN 'empty_tokens'
            WHEN char_length < 80 THEN 'too_few_chars_' || CAST(char_length AS VARCHAR)
            WHEN len(tokens) < 20 THEN 'too_few_tokens_' || CAST(len(tokens) AS VARCHAR) END AS drop_reason
FROM hd
""")
def q_preconditions(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    v = training.validate_preconditions(_hashed_docs(spark, sf), _training_cfg())
    return v.select("original_index", "valid", "drop_reason")


def _unredacted_sql(x: str) -> str:
    m = S.ascii_word_map(x)
    return " OR ".join(f"regexp_matches({m}, {S.lit(P.PII_PATTERNS_PY[n])})"
                       for n in ("EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD"))


_SMALL_VOCAB = (1 << 28) - (1 << 16)  # some word ids lie beyond


@register("consistency", f"""
WITH {_SQL_DOCS.strip()}
SELECT original_index,
       CASE WHEN len(tokens) = 0 THEN 'empty_sequence'
            WHEN len(list_filter(tokens, lambda t: t < 0 OR t > {_SMALL_VOCAB - 1})) > 0 THEN 'out_of_vocab'
            WHEN ({_unredacted_sql('text')}) THEN 'unredacted_pii' END AS consistency_reason
FROM hd WHERE NOT (len(tokens) = 0 OR char_length < 80 OR len(tokens) < 20)
""")
def q_consistency(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = replace(_training_cfg(), vocab_size=_SMALL_VOCAB)
    v = training.validate_preconditions(_hashed_docs(spark, sf), cfg)
    return training.consistency_pass(v, cfg).select("original_index", "consistency_reason")


_SQL_BLOCKS = f"""
d AS (SELECT original_index, tokens, len(tokens) AS n FROM hd WHERE len(tokens) > 0),
s AS (SELECT original_index, list_append(tokens, 50256) AS st,
        coalesce(sum(n + 1) OVER (ORDER BY original_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d),
tot AS (SELECT coalesce(sum(n + 1), 0) - 1 AS total FROM d),
nb AS (SELECT total // 2048 + CASE WHEN total % 2048 > 0 AND total % 2048 >= 1024 THEN 1 ELSE 0 END AS nblocks FROM tot),
flat AS (SELECT start + generate_subscripts(st, 1) - 1 AS pos, unnest(st) AS tok FROM s),
blocks AS (SELECT pos // 2048 AS block_index, list(tok ORDER BY pos) AS tokens
           FROM flat, tot, nb WHERE pos < total AND pos // 2048 < nblocks GROUP BY pos // 2048)
"""


@register("pack_blocks", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()}
SELECT CAST(block_index AS BIGINT) AS block_index, CAST(len(tokens) AS INTEGER) AS token_count, tokens,
       printf('block_%08d', block_index) AS sample_id, block_index > 0 AS is_continuation
FROM blocks
""")
def q_pack_blocks(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), _training_cfg())
    return blocks.select("block_index", "token_count", "tokens", "sample_id", "is_continuation")


@register("shard_meta", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()},
ranked AS (SELECT block_index, len(tokens) AS token_count,
             row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42:' || CAST(block_index AS VARCHAR)), 1, 15)) AS BIGINT), block_index) - 1 AS rk
           FROM blocks)
SELECT CAST(rk // 50 AS INTEGER) AS shard_id, CAST(count(*) AS BIGINT) AS num_samples,
       CAST(sum(token_count) AS BIGINT) AS num_tokens, avg(token_count) AS avg_tokens,
       CAST(min(token_count) AS INTEGER) AS min_tokens, CAST(max(token_count) AS INTEGER) AS max_tokens,
       printf('shard_id=%d', CAST(rk // 50 AS INTEGER)) AS filename
FROM ranked GROUP BY rk // 50
""")
def q_shard_meta(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = _training_cfg()
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), cfg)
    return training.shard_meta(training.shuffle_and_shard(blocks, cfg))


@register("mixture", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()},
sh AS (SELECT DISTINCT CAST((row_number() OVER (ORDER BY block_index) - 1) // 50 AS INTEGER) AS shard_id FROM blocks)
SELECT 'web' AS name, printf('shard_id=%d', shard_id) AS shard, 1.0 AS weight, 'unknown' AS license FROM sh
""")
def q_mixture(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = _training_cfg()
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), cfg)
    return training.mixture(training.shard_meta(training.shuffle_and_shard(blocks, cfg)))


# --------------------------------------------------------------------------- G1-G4

_PPL_WORDS = r"[^\p{L}\p{N}']+"
_PPL_SQL = f"""
nb AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND trim(text) <> ''),
s AS (SELECT doc_id, text FROM nb ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 1000),
ws AS (SELECT doc_id, list_filter(string_split_regex(lower(text), {S.lit(_PPL_WORDS)}), lambda w: w <> '') AS w FROM s),
pairs AS (SELECT doc_id, unnest(w[1:len(w) - 1]) AS prev, unnest(w[2:len(w)]) AS cur FROM ws WHERE len(w) >= 2),
cw AS (SELECT list_filter(string_split_regex(lower(text), {S.lit(_PPL_WORDS)}), lambda w: w <> '') AS w
       FROM documents WHERE text IS NOT NULL),
cp AS (SELECT unnest(w[1:len(w) - 1]) AS prev, unnest(w[2:len(w)]) AS cur FROM cw WHERE len(w) >= 2),
big AS (SELECT prev, cur, count(*) AS c2 FROM cp GROUP BY prev, cur),
uni AS (SELECT prev, count(*) AS c1 FROM (SELECT unnest(w) AS prev FROM cw) GROUP BY prev),
v AS (SELECT count(DISTINCT x) AS v FROM (SELECT unnest(w) AS x FROM cw)),
scores AS (
  SELECT s.doc_id, exp(-avg(CASE WHEN pairs.prev IS NOT NULL THEN ln(coalesce(big.c2, 0) + 1.0) - ln(coalesce(uni.c1, 0) + 1.0 * v.v) END)) AS perplexity
  FROM s LEFT JOIN pairs ON pairs.doc_id = s.doc_id
         LEFT JOIN big ON big.prev = pairs.prev AND big.cur = pairs.cur
         LEFT JOIN uni ON uni.prev = pairs.prev, v
  GROUP BY s.doc_id)
"""


def _ppl_scores(spark: SparkSession, sf: str) -> DataFrame:
    from ..config import PerplexityConfig
    from ..operators import perplexity
    cfg = PerplexityConfig()
    docs = tables.documents(spark, sf)
    return perplexity.score_sample(docs, perplexity.sample(docs, cfg, key="md5"), cfg)


@register("perplexity_sample", f"""
WITH {_PPL_SQL.strip()}
SELECT doc_id AS original_index, round(perplexity, 6) AS perplexity FROM scores
""")
def q_perplexity_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _ppl_scores(spark, sf).select("original_index", F.round("perplexity", 6).alias("perplexity"))


@register("perplexity_stats", f"""
WITH {_PPL_SQL.strip()}
SELECT CAST(count(perplexity) AS BIGINT) AS samples_evaluated, round(avg(perplexity), 4) AS mean_perplexity,
       round(quantile_cont(perplexity, 0.5), 4) AS median_perplexity, round(stddev_pop(perplexity), 4) AS std_perplexity,
       round(min(perplexity), 4) AS min_perplexity, round(max(perplexity), 4) AS max_perplexity,
       round(quantile_cont(perplexity, 0.25), 4) AS p25_perplexity, round(quantile_cont(perplexity, 0.75), 4) AS p75_perplexity
FROM scores
""")
def q_perplexity_stats(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import perplexity
    st = perplexity.stats(_ppl_scores(spark, sf))
    cols = ["mean_perplexity", "median_perplexity", "std_perplexity", "min_perplexity", "max_perplexity",
            "p25_perplexity", "p75_perplexity"]
    return st.select("samples_evaluated", *[F.round(c, 4).alias(c) for c in cols])


# --------------------------------------------------------------------------- H1-H14

_KEPT_SQL = f"WITH cl AS ({_clean_sql('documents', 'doc_id', 'text')}) "


def _kept_clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.kept(cleaning.annotate(tables.documents(spark, sf), CLEAN))


@register("corpus_stats", _KEPT_SQL + """
SELECT avg(char_length) AS avg_chars, quantile_cont(char_length, 0.5) AS median_chars,
       CAST(min(char_length) AS INTEGER) AS min_chars, CAST(max(char_length) AS INTEGER) AS max_chars,
       CAST(count(char_length) AS BIGINT) AS n_chars
FROM cl WHERE drop_reason IS NULL
""")
def q_corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    return report.length_stats(_kept_clean(spark, sf), "char_length", "chars")


@register("char_histogram", _KEPT_SQL + """
, k AS (SELECT char_length AS x FROM cl WHERE drop_reason IS NULL),
mm AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM k),
w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM mm),
c AS (SELECT CAST(CASE WHEN CAST(x AS DOUBLE) >= hi THEN 49 ELSE floor((CAST(x AS DOUBLE) - lo) / width) END AS INTEGER) AS bin,
             count(*) AS n FROM k, w GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT b.bin, lo + b.bin * width AS lower, lo + (b.bin + 1) * width AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN w LEFT JOIN c ON c.bin = b.bin
""")
def q_char_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    return report.histogram(_kept_clean(spark, sf), "char_length", 50)


@register("boxplot", _KEPT_SQL + """
, k AS (SELECT CAST(char_length AS DOUBLE) AS x FROM cl WHERE drop_reason IS NULL),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM k)
SELECT q1, med AS median, q3,
       min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_low,
       max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_high,
       avg(x) AS avg, min(x) AS min, max(x) AS max
FROM k, q GROUP BY q1, med, q3
""")
def q_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    return report.boxplot(_kept_clean(spark, sf), "char_length")


@register("token_histogram", f"""
WITH {_SQL_DOCS.strip()}
, k AS (SELECT len(tokens) AS x FROM hd),
mm AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM k),
w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM mm),
c AS (SELECT CAST(CASE WHEN CAST(x AS DOUBLE) >= hi THEN 49 ELSE floor((CAST(x AS DOUBLE) - lo) / width) END AS INTEGER) AS bin,
             count(*) AS n FROM k, w GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT b.bin, lo + b.bin * width AS lower, lo + (b.bin + 1) * width AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN w LEFT JOIN c ON c.bin = b.bin
""")
def q_token_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    return report.histogram(_hashed_docs(spark, sf), "token_count", 50)


@register("drop_summary")
def q_drop_summary(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report, safety, tokens
    from ..session import ensure_checkpoint_dir
    from .corpus_run import whole_stage_codegen
    ensure_checkpoint_dir(spark)
    # each stage is materialised once (as in the run): its metrics and its
    # kept rows both read it, and a filter on a derived column would
    # otherwise re-derive the whole rule set
    from ..session import reliable_checkpoint
    ann = reliable_checkpoint(cleaning.annotate(tables.documents(spark, sf), CLEAN))
    with whole_stage_codegen(spark, False):
        saf = reliable_checkpoint(safety.annotate(cleaning.kept(ann)))
    tok = reliable_checkpoint(tokens.annotate(safety.kept(saf)))
    dd = dedup.annotate_exact(tokens.kept(tok))
    return report.drop_summary(cleaning.drop_counts(ann), safety.metrics(saf), tokens.drop_counts(tok), dedup.metrics(dd))


# --------------------------------------------------------------------------- A1-A6, J10-J12

def _docs_as_jsonl(spark: SparkSession, sf: str) -> str:
    """documents written as JSONL (text, url) in doc_id order to a fresh
    folder under the shared checkpoint folder."""
    from ..session import scratch_path
    path = scratch_path(spark, "jsonl")
    d = tables.table(spark, sf, "documents").select("doc_id", "text", F.lit(None).cast("string").alias("url"))
    # parts grow in number with the input: the reader's splits, the session's partitions at least
    parts = max(d.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    d.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").select("text", "url") \
        .write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


@register("load_jsonl", """
SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS original_index, text, CAST(NULL AS VARCHAR) AS url
FROM documents WHERE text IS NOT NULL AND text <> ''
""")
def q_load_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources import jsonl
    return jsonl.load_jsonl(spark, _docs_as_jsonl(spark, sf))


_SHARDED_SQL = f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()},
r AS (SELECT len(tokens) AS tc, CAST((row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42:' || CAST(block_index AS VARCHAR)), 1, 15)) AS BIGINT),
        block_index) - 1) // 50 AS INTEGER) AS shard_id FROM blocks)
"""


def _training_shards(spark: SparkSession, sf: str) -> str:
    """Training shards of the documents, written below the shared folder."""
    from ..operators import training
    from ..session import scratch_path
    from ..sources import sinks
    cfg = _training_cfg()
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), cfg)
    path = scratch_path(spark, "training")
    sinks.write_training_shards(training.shuffle_and_shard(blocks, cfg), path)
    return path


@register("validate_shards", _SHARDED_SQL + """
SELECT shard_id, CAST(count(*) AS BIGINT) AS lines, CAST(0 AS BIGINT) AS errors, CAST(count_if(tc < 20) AS BIGINT) AS token_range_warnings,
       true AS valid FROM r GROUP BY shard_id
""")
def q_validate_shards(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources import sinks
    return sinks.validate_shards(spark, _training_shards(spark, sf), _training_cfg().min_tokens)[1]


@register("dataset_index", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()},
kept AS (SELECT doc_id, lang, source FROM hd JOIN documents ON doc_id = original_index),
mode AS (SELECT (SELECT lang FROM kept WHERE lang <> '' GROUP BY lang ORDER BY count(*) DESC, min(doc_id) LIMIT 1) AS lang,
                (SELECT source FROM kept WHERE source <> '' GROUP BY source ORDER BY count(*) DESC, min(doc_id) LIMIT 1) AS source),
r AS (SELECT block_index, len(tokens) AS tc, row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42:' || CAST(block_index AS VARCHAR)), 1, 15)) AS BIGINT),
             block_index) - 1 AS rk,
        '{{"tokens":[' || array_to_string(tokens, ',') || '],"token_count":' || len(tokens) || ',"language":"' || lang || '","source":"' || source
        || '","url":null,"char_length":' || 4 * len(tokens) || ',"sample_id":"' || printf('block_%08d', block_index) || '","is_continuation":'
        || CASE WHEN block_index > 0 THEN 'true' ELSE 'false' END || ',"chunk_index":0}}' AS line FROM blocks, mode)
SELECT CAST(rk // 50 AS INTEGER) AS shard_id, CAST(count(*) AS BIGINT) AS num_rows, CAST(sum(tc) AS BIGINT) AS num_tokens,
       CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, sha256(string_agg(sha256(line), '' ORDER BY rk)) AS digest
FROM r GROUP BY rk // 50
""")
def q_dataset_index(spark: SparkSession, sf: str) -> DataFrame:
    """With the digest of each file's lines, language and source of the blocks included."""
    from ..sources import sinks
    return sinks.dataset_index(spark, _training_shards(spark, sf))


@register("index_totals", _SHARDED_SQL + """
SELECT CAST(count(DISTINCT shard_id) AS BIGINT) AS total_shards, CAST(count(*) AS BIGINT) AS total_rows,
       CAST(sum(tc) AS BIGINT) AS total_tokens, 'passed' AS status FROM r
""")
def q_index_totals(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources import sinks
    path = _training_shards(spark, sf)
    return sinks.index_totals(sinks.dataset_index(spark, path), sinks.validate_shards(spark, path, 20)[1])


@register("audit_sample", f"""
WITH cl AS ({_clean_sql('documents', 'doc_id', 'text')}),
k AS (SELECT text, CAST((row_number() OVER (ORDER BY original_index) - 1) // 100 AS INTEGER) AS shard_id FROM cl WHERE drop_reason IS NULL),
n AS (SELECT greatest(1, 200 // count(DISTINCT shard_id)) AS each FROM k),
s AS (SELECT shard_id, text <> '' AND ({_unredacted_sql('text')}) AS pii, row_number() OVER (PARTITION BY shard_id ORDER BY md5('42:' || text)) AS r FROM k)
SELECT shard_id, CAST(count(*) AS BIGINT) AS audited, CAST(count_if(pii) AS BIGINT) AS with_pii FROM s, n WHERE r <= each GROUP BY shard_id
""")
def q_audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every clean shard, which carry text."""
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, "clean")
    sinks.write_clean_shards(_kept_clean(spark, sf), path, shard_size=100)
    shards = sinks.shard_list(spark, path)
    return sinks.audit_report(shards, sinks.audit_sample(spark, path, shards.count()))


@register("shard_meta_full", _SHARDED_SQL + f"""
, h AS (SELECT sha256({S.canonical('text')}) AS k, doc_id FROM documents WHERE text IS NOT NULL AND text <> ''),
f AS (SELECT doc_id <> min(doc_id) OVER (PARTITION BY k) AS dup FROM h),
dr AS (SELECT count_if(dup) / count(*) AS rate FROM f)
SELECT shard_id, CAST(count(*) AS BIGINT) AS num_samples, CAST(sum(tc) AS BIGINT) AS num_tokens, avg(tc) AS avg_tokens,
       printf('shard_id=%d', shard_id) AS filename, 'byte_bpe_50k' AS tokenizer, 42 AS shuffle_seed, '1.0' AS pipeline_version,
       any_value(rate) AS duplicate_rate FROM r, dr GROUP BY shard_id
""")
def q_shard_meta_full(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = _training_cfg()
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), cfg)
    meta = training.shard_meta(training.shuffle_and_shard(blocks, cfg))
    return training.describe_shards(meta, cfg, dedup.metrics(dedup.annotate_exact(tables.documents(spark, sf)))).select(
        "shard_id", "num_samples", "num_tokens", "avg_tokens", "filename", "tokenizer", "shuffle_seed", "pipeline_version",
        "duplicate_rate")


# --------------------------------------------------------------------------- B1

@register("lang_detect", r"""
WITH d AS (SELECT doc_id, lang, text, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 7) AS BIGINT) % 5 <> 0 AS learns,
  list_transform(regexp_extract_all(hex(encode(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))), '..'),
                 lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
g AS (SELECT doc_id, lang, learns, unnest(list_transform(range(1, len(b) - 1), lambda i: (b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) % 4093)) AS k
      FROM d WHERE len(b) >= 3),
c AS (SELECT lang, k, count(*) AS c FROM g WHERE learns AND lang IS NOT NULL GROUP BY lang, k),
t AS (SELECT lang, sum(c) AS total FROM c GROUP BY lang),
p AS (SELECT lang, ln(count(*)) - ln(sum(count(*)) OVER ()) AS prior FROM d WHERE learns AND lang IS NOT NULL GROUP BY lang),
m AS (SELECT t.lang, r.k, ln(coalesce(c.c, 0) + 1.0) - ln(total + 4093.0) AS w
      FROM t CROSS JOIN (SELECT unnest(range(0, 4093)) AS k) r LEFT JOIN c ON c.lang = t.lang AND c.k = r.k),
f AS (SELECT doc_id, k, count(*) AS n FROM g GROUP BY doc_id, k),
s AS (SELECT doc_id, m.lang, sum(n * w) AS score FROM f JOIN m ON m.k = f.k GROUP BY doc_id, m.lang),
e AS (SELECT d.doc_id, p.lang, coalesce(s.score, 0) + prior AS score FROM d CROSS JOIN p LEFT JOIN s ON s.doc_id = d.doc_id AND s.lang = p.lang),
best AS (SELECT doc_id, arg_max(lang, score) AS lang FROM e GROUP BY doc_id)
SELECT d.doc_id AS original_index, CASE WHEN regexp_matches(coalesce(text, ''), '\p{L}') THEN best.lang ELSE 'unknown' END AS language,
       NOT learns AS held_out
FROM d LEFT JOIN best ON best.doc_id = d.doc_id
""")
def q_lang_detect(spark: SparkSession, sf: str) -> DataFrame:
    """Learned from four fifths of the ids, predicted for all rows."""
    from ..operators import language
    docs = tables.documents(spark, sf)
    learns = language.learning_rows(F.col("original_index"))
    profile = language.train_profile(docs.where(learns))
    return language.detect(docs.withColumnRenamed("language", "label"), profile).select(
        "original_index", "language", (~learns).alias("held_out"))


# --------------------------------------------------------------------------- B6, E11, I4, J8

@register("target_share", """
SELECT avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) AS target_share FROM documents
""")
def q_target_share(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import language
    return language.target_share(tables.documents(spark, sf), "en")


@register("dedup_metrics", f"""
WITH h AS (SELECT doc_id, sha256({S.canonical('text')}) AS k FROM documents WHERE text IS NOT NULL AND text <> ''),
f AS (SELECT doc_id <> min(doc_id) OVER (PARTITION BY k) AS dup FROM h)
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count(*) - count_if(dup) AS BIGINT) AS kept_samples,
       CAST(count_if(dup) AS BIGINT) AS duplicates_removed,
       CASE WHEN count(*) > 0 THEN count_if(dup) / count(*) ELSE 0.0 END AS duplicate_rate
FROM f
""")
def q_dedup_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.metrics(dedup.annotate_exact(tables.documents(spark, sf)))


@register("precondition_report", f"""
WITH {_SQL_DOCS.strip()},
v AS (SELECT source = 'src7' AS no_source, NOT (len(tokens) = 0 OR hd.char_length < 80 OR len(tokens) < 20) AND source <> 'src7' AS valid
      FROM hd JOIN documents ON doc_id = original_index),
t AS (SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count_if(valid) AS BIGINT) AS valid_samples,
             CAST(count_if(no_source) AS BIGINT) AS no_source FROM v),
f AS (SELECT unnest(['text', 'tokens', 'token_count', 'language', 'source', 'license', 'char_length',
                     'dedupe_hash', 'pii_types', 'pii_redacted']) AS field)
SELECT total_samples, valid_samples, field, CASE WHEN field = 'source' THEN no_source ELSE 0 END AS missing,
       total_samples - CASE WHEN field = 'source' THEN no_source ELSE 0 END AS present FROM t, f
""")
def q_precondition_report(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    docs = _hashed_docs(spark, sf).withColumn("source", F.nullif("source", F.lit("src7")))  # one source counts as missing
    return training.precondition_report(training.validate_preconditions(docs, _training_cfg()))


@register("sharding_summary", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()},
r AS (SELECT (row_number() OVER (ORDER BY block_index) - 1) // 50 AS shard_id, len(tokens) AS tc FROM blocks),
m AS (SELECT shard_id, count(*) AS ns, sum(tc) AS nt FROM r GROUP BY shard_id)
SELECT CAST(count(*) AS BIGINT) AS total_shards, CAST(sum(ns) AS BIGINT) AS total_samples,
       CAST(sum(nt) AS BIGINT) AS total_tokens, sum(ns) / count(*) AS avg_samples_per_shard,
       sum(nt) / count(*) AS avg_tokens_per_shard
FROM m
""")
def q_sharding_summary(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = _training_cfg()
    blocks, _ = training.pack_blocks(_hashed_docs(spark, sf), cfg)
    return training.sharding_summary(training.shard_meta(training.shuffle_and_shard(blocks, cfg)))


# --------------------------------------------------------------------------- A3 round trip

@register("clean_shards", f"""
WITH cl AS ({_clean_sql('documents', 'doc_id', 'text')})
SELECT CAST((row_number() OVER (ORDER BY original_index) - 1) // 100 AS INTEGER) AS shard_id,
       cl.text, CAST(NULL AS VARCHAR) AS url, CAST(char_length AS BIGINT) AS char_length, lang AS language
FROM cl JOIN documents ON doc_id = original_index WHERE drop_reason IS NULL
""")
def q_clean_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Kept documents written as clean shards of 100 rows (text, url,
    char_length, language) and read back with their shard folder."""
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, "clean")
    sinks.write_clean_shards(_kept_clean(spark, sf), path, shard_size=100)
    back = spark.read.schema("text string, url string, char_length long, language string, shard_id int").json(path)
    return back.select("shard_id", "text", "url", "char_length", "language")


@register("clean_lowercase", _clean_sql("documents", "doc_id", "text").replace(f"{S.clean('text')} AS c", f"lower({S.clean('text')}) AS c"))
def q_clean_lowercase(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_cols(cleaning.annotate(tables.documents(spark, sf), replace(CLEAN, lowercase=True)))


@register("tokenized_shards", f"""
WITH {_SQL_DOCS.strip()}
SELECT CAST((row_number() OVER (ORDER BY original_index) - 1) // 100 AS INTEGER) AS shard_id, tokens, CAST(len(tokens) AS INTEGER) AS token_count,
       '{{"url":null,"char_length":' || hd.char_length || ',"language":"' || lang || '","original_index":' || original_index || '}}' AS metadata
FROM hd JOIN documents ON doc_id = original_index
""")
def q_tokenized_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Tokenised shards of 100 rows, written and read back."""
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, "tokenized")
    sinks.write_tokenized_shards(_hashed_docs(spark, sf), path, shard_size=100)
    return spark.read.schema("tokens array<int>, token_count int, metadata string, shard_id int").parquet(path)


@register("chunking_summary", f"""
WITH {_SQL_DOCS.strip()}, {_SQL_BLOCKS.strip()}
SELECT 'concatenation_fixed_blocks' AS strategy, 2048 AS block_size, 50256 AS eos_token,
       (SELECT CAST(count(*) AS BIGINT) FROM hd) AS total_input_samples, CAST(nblocks AS BIGINT) AS total_blocks,
       CAST(total AS BIGINT) AS total_tokens, total / nblocks AS avg_tokens_per_block FROM tot, nb
""")
def q_chunking_summary(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    return training.summary_table(spark, training.pack_blocks(_hashed_docs(spark, sf), _training_cfg())[1])


def _consistent(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    cfg = replace(_training_cfg(), vocab_size=_SMALL_VOCAB)
    docs = _hashed_docs(spark, sf).join(dedup.annotate_exact(tables.documents(spark, sf)).select("original_index", "is_duplicate"),
                                        "original_index")
    docs = once(docs, "pii", PII.detect_pii(F.col("text")))  # of the cleaned text
    return training.consistency_pass(training.validate_preconditions(docs.drop("drop_reason"), cfg), cfg)


_CONSISTENT_SQL = f"""
WITH {_SQL_DOCS.strip()},
h AS (SELECT doc_id, sha256({S.canonical('text')}) AS k FROM documents WHERE text IS NOT NULL AND text <> ''),
f AS (SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY k) AS dup FROM h),
pc AS (SELECT original_index AS doc_id, pii_types FROM ({_pii_sql().replace("FROM documents", "FROM (SELECT original_index AS doc_id, text FROM hd)")})),
v AS (SELECT CASE WHEN len(tokens) = 0 THEN 'empty_sequence'
                  WHEN len(list_filter(tokens, lambda t: t < 0 OR t > {_SMALL_VOCAB - 1})) > 0 THEN 'out_of_vocab'
                  WHEN ({_unredacted_sql('text')}) AND len(pii_types) = 0 THEN 'unredacted_pii' END AS reason, dup, pii_types
      FROM hd JOIN f ON f.doc_id = original_index JOIN pc ON pc.doc_id = original_index
      WHERE NOT (len(tokens) = 0 OR char_length < 80 OR len(tokens) < 20))
"""


@register("consistency_report", _CONSISTENT_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count_if(reason IS NULL) AS BIGINT) AS consistent_samples,
       CAST(count_if(reason IS NOT NULL) AS BIGINT) AS dropped_samples, CAST(count_if(reason = 'out_of_vocab') AS BIGINT) AS out_of_vocab_count,
       CAST(count_if(reason = 'empty_sequence') AS BIGINT) AS empty_sequences,
       CAST(count_if(reason IS NULL AND dup) AS BIGINT) AS total_duplicates, count_if(reason IS NULL AND dup) / count(*) AS duplicate_rate FROM v
""")
def q_consistency_report(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    return training.consistency_report(_consistent(spark, sf))


@register("consistency_counts", _CONSISTENT_SQL + """
SELECT 'reason' AS kind, reason AS name, CAST(count(*) AS BIGINT) AS n FROM v WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'pii_type', t, CAST(count(*) AS BIGINT) FROM (SELECT unnest(pii_types) AS t FROM v WHERE reason IS NULL) GROUP BY t
""")
def q_consistency_counts(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import training
    from ..session import reliable_checkpoint
    checked = reliable_checkpoint(_consistent(spark, sf).select("consistency_reason", "pii_types"))  # read twice
    return training.consistency_drop_counts(checked).select(F.lit("reason").alias("kind"), F.col("reason").alias("name"), "n").union(
        training.consistency_pii_counts(checked).select(F.lit("pii_type"), "pii_type", "n"))


# --------------------------------------------------------------------------- D6-D15 oracle

def _toxicity_sql(final: str | None = None) -> str:
    from ..config import SafetyConfig
    cfg = SafetyConfig()
    wc, budget, pad, stride, cap_n = 512, 768, cfg.toxicity_window_padding, 256, cfg.toxicity_suspect_windows
    pats = {"prof": "(?i)" + "|".join(P.PROFANITY_TERMS_PY), "obf": "(?i)" + P.OBFUSCATED_PROFANITY_PATTERN_PY,
            "punct": P.REPEATED_PUNCT_PATTERN_PY, "caps": P.ALL_CAPS_WORD_PATTERN_PY}
    ws = S.WS
    allow = " OR ".join(f"contains(lower(text), {S.lit(p)})" for p in P.SAFE_ALLOWLIST_PHRASES)
    mcols = ", ".join(f"regexp_extract_all(m, {S.lit(v)}) AS mt_{k}, regexp_split_to_array(m, {S.lit(v)}) AS pc_{k}"
                      for k, v in pats.items())

    def spans(k):
        return (f"list_transform(range(1, len(mt_{k}) + 1), lambda j: {{'s': CAST(len(array_to_string(pc_{k}[1:j], '')) "
                f"+ len(array_to_string(mt_{k}[1:j - 1], '')) AS INTEGER), 'e': CAST(len(array_to_string(pc_{k}[1:j], '')) "
                f"+ len(array_to_string(mt_{k}[1:j], '')) AS INTEGER)}})")
    weights = " ".join(f"WHEN {S.lit(k)} THEN {float(v)}" for k, v in P.DEFAULT_BLOCKLIST.items())
    bl_keys = ", ".join(S.lit(k) for k in P.DEFAULT_BLOCKLIST)
    sym_cls = r"[^\p{L}\p{N}_\s\p{Z}\x0b\x1c-\x1f\x85]"
    win_t = "STRUCT(p INTEGER, s INTEGER, e INTEGER)[]"
    sel_t = "STRUCT(s INTEGER, e INTEGER)[]"
    return f"""
WITH base AS (
  SELECT doc_id, text, CAST(length(text) AS INTEGER) AS L, {S.ascii_word_map('text')} AS m,
         regexp_replace(text, {S.lit('^' + ws + '+|' + ws + '+$')}, '', 'g') AS stripped,
         CAST(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS ar
  FROM documents),
mt AS (SELECT *, {S.ascii_word_map('stripped')} AS ms, {mcols} FROM base),
pf AS (
  SELECT *, greatest(CASE WHEN len(mt_prof) > 0 THEN 3 ELSE 0 END, CASE WHEN len(mt_obf) > 0 THEN 3 ELSE 0 END,
                     CASE WHEN len(mt_punct) > 0 THEN 2 ELSE 0 END, CASE WHEN len(mt_caps) > 0 THEN 1 ELSE 0 END) AS sev0,
         ar < 0.35 AS non_en,
         length(stripped) <= 20 AND regexp_full_match(ms, {S.lit(S.py_to_re2(P.SAFE_SHORT_TEXT_PATTERN_PY[1:-1], False))}) AND ar >= 0.75 AS short,
         regexp_matches(ms, {S.lit(P.SAFE_NUMERIC_PATTERN_PY)}) OR regexp_matches(ms, {S.lit(P.SAFE_TIMESTAMP_PATTERN_PY)})
           OR regexp_matches(ms, {S.lit('(?i)' + P.SAFE_URL_ONLY_PATTERN_PY)}) OR regexp_matches(ms, {S.lit('(?i)' + P.SAFE_FORMAL_TEMPLATE_PATTERN_PY)})
           OR regexp_matches(ms, {S.lit('(?m)' + chr(92) + 'A```[' + chr(92) + 's' + chr(92) + 'S]+```$')}) OR ({allow}) AS other_safe,
         list_concat({spans('prof')}, {spans('obf')}, {spans('punct')}, {spans('caps')})[1:{cap_n}] AS spans5
  FROM mt),
sv AS (
  SELECT *, CASE WHEN short THEN least(CASE WHEN non_en THEN greatest(sev0, 1) ELSE sev0 END, 1)
                 ELSE CASE WHEN non_en THEN greatest(sev0, 1) ELSE sev0 END END AS sev FROM pf),
tg AS (
  SELECT *, CASE WHEN text IS NULL OR stripped = '' THEN 'empty'
                 WHEN sev >= 2 THEN 'suspect' WHEN sev = 1 THEN 'unknown'
                 WHEN non_en OR short OR other_safe THEN 'safe' ELSE 'unknown' END AS tag FROM sv),
cand AS (
  SELECT *, list_concat(
     [{{'k': 0, 'p': 2, 's': 0, 'e': least(L, {wc})}}, {{'k': 0, 'p': 2, 's': greatest(0, L - {wc}), 'e': L}}],
     list_transform(spans5, lambda x: {{'k': 0, 'p': 0, 's': greatest(0, (x.s + x.e) // 2 - {wc // 2} - {pad}),
                                        'e': least(L, greatest(0, (x.s + x.e) // 2 - {wc // 2} - {pad}) + {wc})}}),
     list_transform(range(0, CAST(least({cap_n + 8}, ceil(L / {stride})) AS BIGINT)),
                    lambda j: {{'k': 1, 'p': 1, 's': CAST(j * {stride} AS INTEGER), 'e': CAST(least(L, j * {stride} + {wc}) AS INTEGER)}}),
     [{{'k': 2, 'p': 3, 's': greatest(0, L // 2 - {wc // 2}), 'e': least(L, greatest(0, L // 2 - {wc // 2}) + {wc})}}]) AS cands
  FROM tg WHERE tag IN ('suspect', 'unknown')),
reg AS (
  SELECT *, list_sort(list_reduce(cands, lambda acc, x:
      CASE WHEN len(acc) < {cap_n} AND len(list_filter(acc, lambda a: a.s = x.s AND a.e = x.e)) = 0
                AND (CASE x.k WHEN 1 THEN sev >= 3 AND len(acc) < 2 AND x.s < L WHEN 2 THEN len(acc) < 2 ELSE true END)
           THEN list_append(acc, {{'p': x.p, 's': x.s, 'e': x.e}}) ELSE acc END, []::{win_t})) AS wins
  FROM cand),
sel AS (
  SELECT *, list_reduce(wins, lambda acc, w:
      CASE WHEN acc.done OR acc.b <= 0 OR acc.rl <= 0 THEN acc
           WHEN w.e - w.s > acc.b THEN {{'b': acc.b, 'rl': acc.rl, 'done': true,
                                        'out': list_append(acc.out, {{'s': w.s, 'e': w.s + acc.b}})}}
           ELSE {{'b': acc.b - (w.e - w.s), 'rl': acc.rl - 1, 'done': false,
                 'out': list_append(acc.out, {{'s': w.s, 'e': w.e}})}} END,
      {{'b': {budget}, 'rl': 2, 'done': false, 'out': []::{sel_t}}}).out AS chosen
  FROM reg),
st AS (
  SELECT doc_id, chosen, substr(array_to_string(list_transform(chosen, lambda w: substr(text, w.s + 1, w.e - w.s)), chr(10)), 1, {budget}) AS t
  FROM sel),
nz AS (SELECT *, regexp_replace(t, '[\\x{{200b}}-\\x{{200d}}\\x{{2060}}\\x{{feff}}]', '', 'g') AS t1 FROM st),
sq AS (
  SELECT *, list_transform(range(1, length(t1) + 1), lambda i: substr(t1, i, 1)) AS ch FROM nz),
sq2 AS (
  SELECT *, lower(trim(regexp_replace(array_to_string(list_filter(ch, lambda c, i: NOT (i >= 3 AND regexp_matches(c, {S.lit(sym_cls)})
            AND c = ch[i - 1] AND c = ch[i - 2])), ''), {S.lit(ws + '+')}, ' ', 'g'))) AS low FROM sq),
sc AS (
  SELECT doc_id, chosen, t, low,
         list_filter(regexp_extract_all(low, '[a-zA-Z'']+'), lambda w: w IN ({bl_keys})) AS hits,
         length(t) - length(regexp_replace(t, '\\p{{L}}', '', 'g')) AS letters,
         length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS upper,
         length(t) - length(regexp_replace(t, {S.lit(sym_cls.replace('_', ''))}, '', 'g')) AS symbols,
         len(list_filter(range(1, length(t) - 2), lambda i: substr(t, i, 1) = substr(t, i + 1, 1)
             AND substr(t, i, 1) = substr(t, i + 2, 1) AND substr(t, i, 1) = substr(t, i + 3, 1))) > 0 AS rep,
         len(regexp_extract_all(t, '[!?]{{3,}}')) AS punct,
         len(regexp_extract_all({S.ascii_word_map('low')}, {S.lit(pats['obf'])})) AS obf
  FROM sq2),
tot AS (
  SELECT doc_id, hits, t, chosen,
    list_reduce(list_transform(hits, lambda w: CASE w {weights} END), lambda a, x: a + x, 0.0)
    + CASE WHEN length(t) >= 20 AND (CASE WHEN letters > 0 THEN CAST(upper AS DOUBLE) / letters ELSE 0.0 END) > 0.65 THEN 0.5 ELSE 0.0 END
    + CASE WHEN CAST(symbols AS DOUBLE) / greatest(1, length(t)) > 0.45 THEN 0.4 ELSE 0.0 END
    + CASE WHEN rep THEN 0.4 ELSE 0.0 END
    + CASE WHEN punct > 0 THEN 0.3 ELSE 0.0 END
    + CASE WHEN obf > 0 THEN 0.6 ELSE 0.0 END AS score
  FROM sc)
{final or _TOX_FINAL}
"""


_TOX_FINAL = """
SELECT d.doc_id AS original_index, coalesce(tot.score >= 1.5, false) AS is_toxic,
       coalesce(round(tot.score, 3), 0.0) AS score, coalesce(tot.hits, []::VARCHAR[]) AS flagged_tokens,
       CAST(coalesce(length(tot.t), 0) AS INTEGER) AS char_span, CAST(len(tot.chosen) AS INTEGER) AS window_count
FROM documents d LEFT JOIN tot ON tot.doc_id = d.doc_id
"""


def _pii_list_sql(src: str) -> str:
    """pii_types list expression over a table alias with ``text`` (budget 2)."""
    m = S.ascii_word_map(f"substr({src}.text, 1, 10000)")
    ns = [S.count_matches(m, S.py_to_re2(P.PII_PATTERNS_PY[n], True)) for n in P.PII_ENTITIES]
    parts, used = [], "0"
    for name, n in zip(P.PII_ENTITIES, ns):
        k = f"least({n}, 2 - ({used}))"
        parts.append(f"list_transform(range({k}), lambda x: {S.lit(name)})")
        used = f"({used}) + {k}"
    return f"CAST(flatten([{', '.join(parts)}]) AS VARCHAR[])"


_SAFETY_FINAL = f"""
, piis AS (SELECT d.doc_id, {_pii_list_sql('d')} AS pii_all FROM documents d),
j AS (
  SELECT d.doc_id, d.text, CASE WHEN tg.tag = 'empty' THEN 'safe' ELSE tg.tag END AS tag,
         coalesce(tot.score >= 1.5, false) AS toxic, coalesce(round(tot.score, 3), 0.0) AS score, piis.pii_all
  FROM documents d JOIN tg ON tg.doc_id = d.doc_id LEFT JOIN tot ON tot.doc_id = d.doc_id
       JOIN piis ON piis.doc_id = d.doc_id)
SELECT doc_id AS original_index,
       CASE WHEN text IS NULL OR text = '' THEN NULL
            WHEN tag = 'safe' THEN CASE WHEN len(pii_all) > 0 THEN 'contains_pii' END
            WHEN toxic THEN 'toxic'
            WHEN len(pii_all) > 0 THEN 'contains_pii' END AS drop_reason,
       CASE WHEN text IS NULL OR text = '' OR (tag <> 'safe' AND toxic) THEN []::VARCHAR[] ELSE pii_all END AS pii_types,
       tag, score
FROM j
"""

ORACLE["toxicity_score"] = _toxicity_sql()
ORACLE["safety_filter"] = _toxicity_sql("SELECT 1 AS dummy").replace("\nSELECT 1 AS dummy", _SAFETY_FINAL)


_METRICS_FINAL = f"""
, piis AS (SELECT d.doc_id, {_pii_list_sql('d')} AS pii_all FROM documents d),
j AS (
  SELECT d.doc_id, d.text, CASE WHEN tg.tag = 'empty' THEN 'safe' ELSE tg.tag END AS tag,
         coalesce(tot.score >= 1.5, false) AS toxic, round(tot.score, 3) AS score, length(tot.t) AS span,
         len(tot.chosen) AS nwin, piis.pii_all
  FROM documents d JOIN tg ON tg.doc_id = d.doc_id LEFT JOIN tot ON tot.doc_id = d.doc_id
       JOIN piis ON piis.doc_id = d.doc_id),
r AS (
  SELECT *, text IS NULL OR text = '' AS empty,
         NOT (text IS NULL OR text = '') AND tag <> 'safe' AS scored,
         CASE WHEN text IS NULL OR text = '' THEN NULL
              WHEN tag = 'safe' THEN CASE WHEN len(pii_all) > 0 THEN 'contains_pii' END
              WHEN toxic THEN 'toxic'
              WHEN len(pii_all) > 0 THEN 'contains_pii' END AS drop_reason
  FROM j)
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count_if(drop_reason IS NULL) AS BIGINT) AS kept_samples,
       CAST(count_if(drop_reason = 'toxic') AS BIGINT) AS toxic_dropped,
       CAST(count_if(drop_reason = 'contains_pii') AS BIGINT) AS pii_dropped,
       CAST(count_if(empty) AS BIGINT) AS empty_texts,
       coalesce(sum(CASE WHEN scored THEN span END), 0) / greatest(1, count(*) - count_if(empty)) AS avg_chars_scanned,
       round(coalesce(sum(CASE WHEN scored THEN score END), 0.0) / greatest(1, count(*) - count_if(empty)), 6) AS avg_toxicity_score,
       CASE WHEN count_if(scored) > 0 THEN sum(CASE WHEN scored THEN nwin END) / count_if(scored) ELSE 0.0 END AS avg_windows_scored
FROM r
"""

ORACLE["safety_metrics"] = _toxicity_sql("SELECT 1 AS dummy").replace("\nSELECT 1 AS dummy", _METRICS_FINAL)


def q_safety_metrics_rounded(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import safety
    m = safety.metrics(_safety_annotated(spark, sf))
    return m.withColumn("avg_toxicity_score", F.round("avg_toxicity_score", 6))


QUERIES["safety_metrics"] = q_safety_metrics_rounded

_R_CTES = _METRICS_FINAL[:_METRICS_FINAL.index("SELECT CAST(count(*) AS BIGINT) AS total_samples")]

ORACLE["pii_type_counts"] = _toxicity_sql("SELECT 1 AS dummy").replace("\nSELECT 1 AS dummy", _R_CTES + """
SELECT pii_type, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(pii_all) AS pii_type FROM r WHERE drop_reason = 'contains_pii') GROUP BY pii_type
""")

ORACLE["flagged_tokens"] = _toxicity_sql("SELECT 1 AS dummy").replace("\nSELECT 1 AS dummy", """
, ft AS (SELECT doc_id, unnest(hits) AS token, generate_subscripts(hits, 1) AS pos FROM tot)
SELECT token, CAST(count(*) AS BIGINT) AS n FROM ft GROUP BY token
ORDER BY n DESC, min(doc_id * 1000000 + pos) LIMIT 20
""")


@register("safety_rates", f"""
SELECT pii_dropped / total_samples AS pii_detection_rate, toxic_dropped / total_samples AS toxicity_rate
FROM ({ORACLE["safety_metrics"]})
""")
def q_safety_rates(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report, safety
    return report.rates(safety.metrics(_safety_annotated(spark, sf)))


@register("perplexity_histogram", f"""
WITH {_PPL_SQL.strip()}
, k AS (SELECT round(perplexity, 6) AS x FROM scores WHERE perplexity IS NOT NULL),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM k),
w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM mm),
c AS (SELECT CAST(CASE WHEN x >= hi THEN 49 ELSE floor((x - lo) / width) END AS INTEGER) AS bin, count(*) AS n FROM k, w GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT b.bin, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM b CROSS JOIN w LEFT JOIN c ON c.bin = b.bin
""")
def q_perplexity_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    scores = QUERIES["perplexity_sample"](spark, sf).persist()
    return report.histogram(scores, "perplexity", 50).select("bin", "n")


@register("summary_table", f"""
WITH m AS ({ORACLE["dedup_metrics"]})
SELECT 'retention' AS metric, CAST(kept_samples / total_samples AS VARCHAR) AS value FROM m
UNION ALL SELECT 'dedup_total_samples', CAST(total_samples AS VARCHAR) FROM m
UNION ALL SELECT 'dedup_kept_samples', CAST(kept_samples AS VARCHAR) FROM m
UNION ALL SELECT 'dedup_duplicates_removed', CAST(duplicates_removed AS VARCHAR) FROM m
UNION ALL SELECT 'dedup_duplicate_rate', CAST(duplicate_rate AS VARCHAR) FROM m
""")
def q_summary_table(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import report
    m = dedup.metrics(dedup.annotate_exact(tables.documents(spark, sf))).persist()
    r = m.first()
    return report.summary_table({"dedup": m}, r["total_samples"], r["kept_samples"])


@register("safety_disabled", _toxicity_sql("SELECT 1 AS dummy").replace("WHERE tag IN ('suspect', 'unknown')", "WHERE tag <> 'empty'")
          .replace("\nSELECT 1 AS dummy", f"""
, piis AS (SELECT d.doc_id, {_pii_list_sql('d')} AS pii_all FROM documents d)
SELECT d.doc_id AS original_index, CAST(NULL AS VARCHAR) AS drop_reason, CASE WHEN tg.tag = 'empty' THEN 'safe' ELSE tg.tag END AS tag,
       coalesce(tot.score >= 1.5, false) AS is_toxic, coalesce(round(tot.score, 3), 0.0) AS score,
       CASE WHEN d.text IS NULL OR d.text = '' THEN []::VARCHAR[] ELSE pii_all END AS pii_types
FROM documents d JOIN tg ON tg.doc_id = d.doc_id LEFT JOIN tot ON tot.doc_id = d.doc_id JOIN piis ON piis.doc_id = d.doc_id
"""))
def q_safety_disabled(spark: SparkSession, sf: str) -> DataFrame:
    """Everything is annotated, also what the prefilter would skip, and nothing is dropped."""
    from ..config import SafetyConfig
    from ..operators import safety
    return safety.annotate(tables.documents(spark, sf), SafetyConfig(enabled=False)).select(
        "original_index", "drop_reason", "prefilter.tag", "toxicity.is_toxic", "toxicity.score", "pii.pii_types")


@register("target_filter", "SELECT doc_id AS original_index, text, lang AS language FROM documents WHERE lang = 'en'")
def q_target_filter(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import language
    return language.keep_target(tables.documents(spark, sf), "en").select("original_index", "text", "language")


@register("metrics_sink", f"""
WITH m AS ({ORACLE["dedup_metrics"]})
SELECT * FROM m, (SELECT unnest(['csv', 'json']) AS kind)
""")
def q_metrics_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Stage metrics written as JSON and flat CSV and read back."""
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, "metrics")
    m = dedup.metrics(dedup.annotate_exact(tables.documents(spark, sf)))
    sinks.write_metrics(m, path)
    csv = spark.read.option("header", "true").schema(m.schema).csv(f"{path}/csv").withColumn("kind", F.lit("csv"))
    return csv.unionByName(spark.read.schema(m.schema).json(f"{path}/json").withColumn("kind", F.lit("json")))


# --------------------------------------------------------------------------- H15: the report of a run

_REPORT_SQL = f"""
WITH en AS (SELECT doc_id, text FROM documents WHERE lang = 'en'),
cl AS ({_clean_sql("en", "doc_id", "text")}),
sdocs AS (SELECT original_index AS doc_id, text, char_length FROM cl WHERE drop_reason IS NULL),
{ORACLE["safety_metrics"].strip()[len("WITH "):].replace("FROM documents", "FROM sdocs").replace("SELECT CAST(count(*) AS BIGINT) AS total_samples", ", m AS (SELECT CAST(count(*) AS BIGINT) AS total_samples", 1)}),
sk AS (SELECT r.doc_id, r.text, char_length, r.tag, r.score FROM r JOIN sdocs ON sdocs.doc_id = r.doc_id WHERE r.drop_reason IS NULL),
dd AS (SELECT *, doc_id <> min(doc_id) OVER (PARTITION BY sha256({S.canonical('text')})) AS dup FROM sk),
tk AS (SELECT doc_id, char_length, contains(text, '<|endoftext|>') AS special,
              len(list_filter(string_split_regex(text, {S.lit(_SQL_WORDS)}), lambda w: w <> '')) AS n FROM dd WHERE NOT dup),
tr AS (SELECT *, CASE WHEN special THEN 'tokenization_error' WHEN n < 20 THEN 'too_few_tokens' WHEN n > 8192 THEN 'too_many_tokens' END AS reason FROM tk),
fin AS (SELECT CAST(n AS DOUBLE) AS n, CAST(char_length AS DOUBLE) AS c FROM tr WHERE reason IS NULL),
c AS (SELECT (SELECT count(*) FROM documents) AS loaded, (SELECT count(*) FROM en) AS target,
             (SELECT count(*) FROM sdocs) AS cleaned, (SELECT count(*) FROM sk) AS safe, (SELECT count(*) FROM dd) AS before,
             (SELECT count_if(dup) FROM dd) AS dups, (SELECT count(*) FROM tk) AS uniq, (SELECT count(*) FROM fin) AS final),
lang AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
drops AS (
  SELECT 'cleaning_' || drop_reason AS item, count(*) AS value FROM cl WHERE drop_reason IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'safety_toxic', toxic_dropped FROM m WHERE toxic_dropped > 0
  UNION ALL SELECT 'safety_contains_pii', pii_dropped FROM m WHERE pii_dropped > 0
  UNION ALL SELECT 'tokenization_' || reason, count(*) FROM tr WHERE reason IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'deduplication_duplicate', dups FROM c WHERE dups > 0),
q AS (SELECT quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS med, quantile_cont(n, 0.75) AS q3, min(n) AS lo, max(n) AS hi FROM fin),
w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM q),
u AS (
  SELECT 'statistics' AS section, unnest(['total_samples', 'duplicate_rate', 'pii_detection_rate', 'toxicity_rate', 'avg_token_length',
           'median_token_length', 'min_token_length', 'max_token_length', 'avg_char_length', 'median_char_length']) AS item,
         unnest([final, dups / before, pii_dropped / total_samples, toxic_dropped / total_samples, (SELECT avg(n) FROM fin),
           (SELECT quantile_cont(n, 0.5) FROM fin), (SELECT min(n) FROM fin), (SELECT max(n) FROM fin), (SELECT avg(c) FROM fin),
           (SELECT quantile_cont(c, 0.5) FROM fin)]) AS value FROM c, m
  UNION ALL SELECT 'summary', unnest(['samples_after_deduplication', 'duplicates_removed', 'duplicate_rate', 'samples_after_cleaning',
           'samples_after_tokenization', 'avg_token_length', 'median_token_length', 'samples_after_safety', 'toxic_dropped', 'pii_dropped',
           'pii_detection_rate', 'toxicity_rate', 'samples_loaded', 'samples_after_language_filter', 'final_samples', 'retention_rate']),
         unnest([uniq, dups, dups / before, cleaned, final, (SELECT avg(n) FROM tr WHERE NOT special),
           (SELECT floor(quantile_cont(n, 0.5)) FROM tr WHERE NOT special), safe, toxic_dropped, pii_dropped, pii_dropped / total_samples,
           toxic_dropped / total_samples, loaded, target, final, final / loaded]) FROM c, m
  UNION ALL SELECT 'throughput', unnest(['load_language.in', 'load_language.out', 'clean.in', 'clean.out', 'safety.in', 'safety.out',
           'dedup.in', 'dedup.out', 'tokenize.in', 'tokenize.out']),
         unnest([loaded, target, target, cleaned, cleaned, safe, safe, uniq, uniq, final]) FROM c
  UNION ALL SELECT 'drop_reason_counts', item, value FROM drops
  UNION ALL SELECT 'cleaning_drop_reasons', substr(item, 10), value FROM drops WHERE item LIKE 'cleaning_%'
  UNION ALL SELECT 'prefilter_tags', tag, count(*) FROM r GROUP BY tag
  UNION ALL SELECT 'pii_type_counts', t, count(*) FROM (SELECT unnest(pii_all) AS t FROM r WHERE drop_reason = 'contains_pii') GROUP BY t
  UNION ALL (SELECT 'toxic_removals', token, count(*) FROM (SELECT doc_id, unnest(hits) AS token, generate_subscripts(hits, 1) AS pos FROM tot)
             GROUP BY token ORDER BY count(*) DESC, min(doc_id * 1000000 + pos) LIMIT 20)
  UNION ALL (SELECT 'language_top', lang, n FROM lang ORDER BY n DESC, lang LIMIT 5)
  UNION ALL SELECT 'token_boxplot', unnest(['q1', 'median', 'q3', 'whisker_low', 'whisker_high', 'avg', 'min', 'max']),
         unnest([q1, med, q3, (SELECT min(n) FROM fin WHERE n >= q1 - 1.5 * (q3 - q1)), (SELECT max(n) FROM fin WHERE n <= q3 + 1.5 * (q3 - q1)),
                 (SELECT avg(n) FROM fin), lo, hi]) FROM q
  UNION ALL SELECT 'token_histogram', CAST(b.bin AS VARCHAR), coalesce(k.n, 0) FROM (SELECT unnest(range(50)) AS bin) b LEFT JOIN (
         SELECT CASE WHEN n >= hi THEN 49 ELSE floor((n - lo) / width) END AS bin, count(*) AS n FROM fin, w GROUP BY 1) k ON k.bin = b.bin)
SELECT section, item, round(CAST(value AS DOUBLE), 6) AS value FROM u
"""


@register("report_run", _REPORT_SQL)
def q_report_run(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a run's report, in one: labelled languages, exact
    deduplication and word-hash tokens, which SQL can follow."""
    from ..config import DedupConfig, ExportConfig, PerplexityConfig, TokenConfig
    from . import corpus_run
    res = corpus_run.run(
        spark, sf, detect_language=False, dedup_cfg=DedupConfig(method="hash"), token_cfg=TokenConfig(encoding="word_hash"),
        ppl_cfg=PerplexityConfig(enabled=False), export_cfg=ExportConfig(clean=False, tokenized=False, training=False))

    def part(section: str, df: DataFrame, item, value) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), F.round(value.cast("double"), 6).alias("value"))

    def wide(section: str) -> DataFrame:
        row = res.tables[f"report_{section}"]
        stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in row.columns)
        return part(section, row.selectExpr(f"stack({len(row.columns)}, {stack}) AS (item, value)"), F.col("item"), F.col("value"))

    summary = res.tables["report_summary"].where(~F.col("metric").endswith("_per_sec"))
    stages = res.tables["report_throughput"].where("kind = 'stage'").selectExpr(
        "stack(2, stage || '.in', rows_in, stage || '.out', rows_out) AS (item, value)")
    parts = [wide("statistics"), wide("token_boxplot"), part("summary", summary, F.col("metric"), F.col("value")),
             part("throughput", stages, F.col("item"), F.col("value")),
             part("token_histogram", res.tables["report_token_histogram"], F.col("bin"), F.col("n"))]
    for section, key in (("drop_reason_counts", "reason"), ("cleaning_drop_reasons", "drop_reason"), ("prefilter_tags", "tag"),
                         ("pii_type_counts", "pii_type"), ("toxic_removals", "token"), ("language_top", "language")):
        parts.append(part(section, res.tables[f"report_{section}"], F.col(key), F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
