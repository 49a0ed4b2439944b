"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}')"


_BLANK = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_PAYLOAD = "encode(coalesce(html, ''))"
OP4 = f"""
WITH p AS (SELECT page_id, {_PAYLOAD} AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
             min(page_id) OVER (PARTITION BY sha1(payload)) AS first FROM p),
b AS (SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT)) AS parts FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(flatten(list_transform(parts, lambda v: list_transform([15, 10, 5, 0], lambda s:
           substr('{_UPPER}234567', CAST(((v >> s) & 31) + 1 AS BIGINT), 1)))), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

OP5 = """
WITH crc_table AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
      FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295], bytes),
             lambda acc, b: xor(acc >> 8, t[CAST((xor(acc, b) & 255) + 1 AS BIGINT)])), 4294967295) AS text_crc32
      FROM d, crc_table),
s AS (SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER () AS total FROM c),
p AS (SELECT *, CAST(least(23, (2 * upto - size) * 24 // (2 * total)) AS INT) AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM p
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_lower('text'), _BLANK)} AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                                 WHEN len(w) = 1 THEN w ELSE CAST([] AS VARCHAR[]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = r),
m AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_words(_lower('text'), _ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words(_lower('text'), _ALNUM)} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
              lambda p: array_to_string(w[p:p + least(13, len(w)) - 1], ' '))) AS g FROM b WHERE len(w) > 0),
widths AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, widths WHERE len(w) >= n),
hits AS (SELECT doc_id, p, dp.n, item_id FROM dp JOIN bw ON bw.n = dp.n AND bw.g = array_to_string(dp.w[p:p + dp.n - 1], ' ')),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

OP10 = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')", _BLANK)} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, w FROM d WHERE len(w) >= 35),
named AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS g FROM win),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS k FROM named) WHERE k > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
marked AS (SELECT doc_id, p, word, max(CASE WHEN rep.p IS NULL THEN 0 ELSE 1 END)
                  OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
           FROM words LEFT JOIN rep USING (doc_id, p)),
k AS (SELECT doc_id, count(*) AS n, sum(gone) AS r, string_agg(word, ' ' ORDER BY p) FILTER (gone = 0) AS kept
      FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(r, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8, beside ``crc_table``."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({text})), '..'),
             lambda x: CAST('0x' || x AS BIGINT))), lambda acc, b: xor(acc >> 8, t[CAST((xor(acc, b) & 255) + 1 AS BIGINT)])), 4294967295)"""


OP12 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_words("coalesce(text, '')", _BLANK)} AS w, {_crc32('CAST(doc_id AS VARCHAR)')} AS h FROM documents, crc_table),
l AS (SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS m FROM d),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: w[CAST(CASE WHEN i < a THEN i
             ELSE a + (i - a) % (1 + (n - a) // (3 + m)) END + 1 AS BIGINT)]) ELSE w END AS w FROM l),
pos AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS x FROM t),
eq AS (SELECT a.doc_id, a.x, b.x - a.x AS q, a.n FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND a.word = b.word AND b.x > a.x
       AND 2 * (b.x - a.x) <= a.n),
isl AS (SELECT doc_id, q, x - row_number() OVER (PARTITION BY doc_id, q ORDER BY x) AS g, x FROM eq),
st AS (SELECT doc_id, q, min(x) AS start, count(*) + q AS length FROM isl GROUP BY doc_id, q, g HAVING count(*) >= greatest(q, 12 - q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM st GROUP BY ALL),
agg AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
        FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS x FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY x) AS text FROM pos ANTI JOIN gone USING (doc_id, x) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN agg USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, unnest({_words(_lower('text'), '[A-Za-zÀ-ÿ]+')}) AS r FROM documents),
c AS (SELECT doc_id, r, count(*) AS k FROM r GROUP BY ALL),
h AS (SELECT r, k, {_crc32("doc_id || ':' || r")} AS h FROM c, crc_table),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, sum(k) AS n
      FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3),
d AS (SELECT word, unnest(range(1, length(word) + 1)) AS i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM v),
near AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
         UNION SELECT d.word, v.word FROM d JOIN v ON d.d = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.d = v.word),
best AS (SELECT a AS word, b AS other, n AS other_n, count(*) OVER (PARTITION BY a) AS n_near FROM near JOIN v ON v.word = b
         QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
             CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best USING (word)),
follow(word, upto) AS (SELECT word, word FROM f UNION SELECT follow.word, form FROM follow JOIN f ON f.word = upto WHERE form IS NOT NULL),
ends AS (SELECT follow.word, upto AS root FROM follow JOIN f ON f.word = upto WHERE form IS NULL)
SELECT word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f JOIN ends USING (word)
"""

SQL = {"op4_warc": OP4, "op5_sharding": OP5, "op7_near_dedup": OP7, "op9_decontamination": OP9,
       "op10_substring_dedup": OP10, "op12_period_runs": OP12, "op13_spelling": OP13}
