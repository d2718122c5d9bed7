"""DuckDB SQL for the queries that SQL can express.

The others are tested against brute force: models (1, 7), threads (2), checksums that
DuckDB lacks (5) and byte pair merges (6, 9).
"""

from __future__ import annotations

from sluiceway.llm.line_quality import BOILERPLATE, BOILERPLATE_ELSEWHERE, SEPARATORS

_BLANK = r"'[\x20\x09-\x0D]'"
_WORD = r"'[^\x20\x09-\x0D]+'"


def _solid(text: str) -> str:
    """Characters outside blanks."""
    return f"length(regexp_replace({text}, {_BLANK}, '', 'g'))"


def _symbols(text: str) -> str:
    return f"length(regexp_replace({text}, '[^#*$%&|<>]', '', 'g'))"


def _count(text: str, one: str) -> str:
    return f"(length({text}) - length(replace({text}, '{one}', '')))"


OP3 = f"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), {_BLANK}, '', 'g')) AS digest
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY digest ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY digest) AS group_size
  FROM hashed)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, digest AS text_sha256 FROM ranked
"""

_PHRASES = "|".join(BOILERPLATE + BOILERPLATE_ELSEWHERE).replace("'", "''")
_LONE = ", ".join(f"'{one.decode()}'" for one in sorted(SEPARATORS))

OP4 = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base),
filled AS (SELECT *, {_solid('line')} AS solid FROM lines WHERE {_solid('line')} > 0),
parts AS (
  SELECT *, regexp_extract_all(line, {_WORD}) AS w, {_symbols('line')} AS symbols,
         len(regexp_extract_all(line, '[\\p{{P}}\\p{{S}}]')) AS marks,
         {_count('line', '|')} + greatest(0, {_count('line', '»')} - {_count('line', '«')}) AS bars,
         regexp_extract_all(lower(line), '{_PHRASES}') AS phrases
  FROM filled),
bars AS (
  SELECT *, bars + len(list_filter(w, lambda one: one IN ({_LONE})))
         - least(len(list_filter(w, lambda one: one = '›')), {_count('line', '‹')}) AS entries
  FROM parts),
judged AS (
  SELECT *, 100 * symbols > 10 * length(line)
         OR 100 * marks > 50 * solid
         OR 100 * {_count('line', '!')} >= 50 * len(w)
         OR (entries >= 3 AND 100 * entries >= 15 * len(w))
         OR CASE WHEN length(line) <= 100 THEN len(phrases) > 0
                 ELSE 100 * coalesce(list_sum(list_transform(phrases, lambda one: length(one))), 0) >= 20 * length(line) END AS fails
  FROM bars),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (fails) AS n_failed_lines, coalesce(sum(solid) FILTER (fails), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY doc_id),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places),
covered AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM windows WHERE n > 1),
by_word AS (SELECT doc_id, count(*) AS n_repeat_words FROM covered GROUP BY doc_id),
counted AS (
  SELECT base.doc_id, len(w) AS n_words, {_solid('text')} AS word_chars, {_symbols('text')} AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
         coalesce(lost_chars, 0) AS lost_chars
  FROM base LEFT JOIN by_line USING (doc_id) LEFT JOIN by_word USING (doc_id)),
verdict AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept FROM verdict
"""

OP8 = f"""
WITH meta AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         coalesce(len(regexp_extract_all(text, {_WORD})), 0) AS size
  FROM documents),
sizes AS (SELECT key, sum(size)::BIGINT AS source_size FROM meta GROUP BY key),
weighted AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         ([3.0::DOUBLE, 1.0, 2.0])[((row_number() OVER (ORDER BY key)) - 1) % 3 + 1] AS weight,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM sizes),
levels AS (
  SELECT *, cap / weight AS full_at,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
chosen AS (SELECT level AS set_level FROM levels WHERE level < full_at ORDER BY full_at, key LIMIT 1),
targets AS (
  SELECT key, source_size, coalesce(least(cap, (SELECT set_level FROM chosen) * weight), cap) AS target FROM levels),
ranked AS (
  SELECT meta.*, source_size, target, row_number() OVER (PARTITION BY key ORDER BY size, doc_id NULLS LAST) - 1 AS r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each
  FROM meta JOIN targets USING (key)),
taken AS (
  SELECT *, least(floor((r + 1) * each + 0.618033988749895::DOUBLE) - floor(r * each + 0.618033988749895::DOUBLE),
                  ceil(each))::BIGINT AS copies
  FROM ranked)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken
"""

OP10 = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END)) AS grams
  FROM base),
grams AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS n, count(*) AS common
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 9 * common >= 4 * n),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN links ON a = reach.doc_id),
classes AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a),
copies AS (
  SELECT doc_id, len(grams) AS n_grams,
         CASE WHEN len(grams) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY grams) END AS copy_id FROM sets)
SELECT doc_id, class_id, copy_id, coalesce(n_links, 0) AS n_links, n_grams
FROM copies JOIN classes USING (doc_id) LEFT JOIN degrees USING (doc_id)
"""

OP11 = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS grams
  FROM base),
grams AS (SELECT doc_id, len(grams) AS n, hash(unnest(grams)) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS n, count(*) AS common
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
       AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 9 * common >= 4 * n),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN both_ways ON a = reach.doc_id),
classes AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(grams) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN classes USING (doc_id)
"""

OP12 = f"""
WITH RECURSIVE known AS (
  SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic
  FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce((doc_id > min(doc_id) OVER (PARTITION BY text))::INT, 0) AS mask
  FROM texts LEFT JOIN known USING (doc_id)),
counters AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
orders(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || letter FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS letters(letter)
  WHERE NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
         (1 << (ascii(substr(filter_order, step, 1)) - 65)) AS own,
         coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i::INT, 1)) - 65))), 0)::INT
           AS before
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders WHERE length(filter_order) = 5)),
counted AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM counters CROSS JOIN steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

ORACLES: dict[str, str] = {
    "op3_exact_dedup": OP3, "op4_line_quality": OP4, "op8_source_mix": OP8, "op10_ngram_join": OP10,
    "op11_signature_join": OP11, "op12_filter_audit": OP12,
}
