"""DuckDB equivalents of the numbered queries that SQL can express; each is slow and meant for small tables."""

from __future__ import annotations

from ledgerlake.llm import quality_rules as q

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, least(10, len(w)) AS n, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') for i in range(1, len(w) - least(10, len(w)) + 2)]) AS g FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM dw) dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def _gone(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g'))"


def _term(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"


_KINDS = ["blank", "symbols", *q.CLASSES, "rest"]

DIVERGENCE = rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, lang, w, len(w) AS n, length(t) AS chars, {_gone(q.BLANK)} AS blank, {_gone(q.SYMBOLS)} AS symbols, {", ".join(f"{_gone(p)} AS {c}" for c, p in q.CLASSES.items())},
  [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM t),
m2 AS (SELECT *, chars - blank - symbols - {" - ".join(q.CLASSES)} AS rest FROM m),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM m WHERE len(w) > 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM tri) WHERE k > 1) GROUP BY doc_id),
short AS (SELECT doc_id, lang, lower(word) AS word FROM (SELECT doc_id, lang, unnest(w) AS word FROM m) WHERE length(word) <= {q.COMMON_CHARS}),
top AS (SELECT lang, word, c FROM (SELECT lang, word, count(*) AS c, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS k FROM short WHERE lang IS NOT NULL GROUP BY lang, word) WHERE k <= {q.COMMON}),
ref AS (SELECT lang, sum(n) AS n, sum(chars) AS chars, {", ".join(f"sum({c}) AS {c}" for c in _KINDS)} FROM m2 WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) >= {q.MIN_REFERENCE}),
share AS (SELECT lang, word, c / n AS q FROM top JOIN ref USING (lang)),
other AS (SELECT lang, 1.0 - sum(q) AS q FROM share GROUP BY lang),
cell AS (SELECT s.doc_id, sum(p) AS p, sum(q) AS q, sum({_term("p", "q")}) AS term FROM (SELECT doc_id, lang, word, count(*) / any_value(n) AS p FROM short JOIN m USING (doc_id, lang) GROUP BY doc_id, lang, word) s JOIN share USING (lang, word) GROUP BY s.doc_id),
far AS (SELECT m2.doc_id, sqrt(greatest(0, 0.5 * ({" + ".join(_term(f"(m2.{c} / m2.chars)", f"(ref.{c} / ref.chars)") for c in _KINDS)}))) AS class_distance,
  sqrt(greatest(0, 0.5 * (coalesce(term, 0) + 1.0 - other.q - coalesce(cell.q, 0) + {_term("(1.0 - coalesce(cell.p, 0))", "other.q")}))) AS word_distance
  FROM m2 JOIN ref USING (lang) JOIN other USING (lang) LEFT JOIN cell USING (doc_id) WHERE m2.chars > 0),
base AS (SELECT m2.*, coalesce(rep.n, 0) AS again, m2.n < 50 OR 100 * coalesce(rep.n, 0) > 50 * m2.n AS base_failed FROM m2 LEFT JOIN rep USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(chars - blank AS BIGINT) AS word_chars, CAST(symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(again AS BIGINT) AS n_repeat_words, base_failed, NOT (base_failed OR coalesce(chars >= {q.MIN_CHARS} AND class_distance > {q.MAX_CLASS_DISTANCE}, false) OR coalesce(n >= {q.MIN_WORDS} AND word_distance > {q.MAX_WORD_DISTANCE}, false)) AS kept
FROM base LEFT JOIN far USING (doc_id)"""

LEXICAL_SEARCH = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT item_id, row_number() OVER () AS k, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM u),
s AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS wt FROM tf, s GROUP BY t, n),
m AS (SELECT r, doc_id, 25 + (75 * len(w) * n) // l AS m FROM d, s WHERE len(w) > 0),
score AS (SELECT k, item_id, r, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score WHERE score > 0) WHERE rank <= 10"""

VECTOR_SEARCH = """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 100 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 10"""
