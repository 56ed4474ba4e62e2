"""DuckDB SQL for the text queries that SQL can express on whole tables."""

from __future__ import annotations

from wardline.llm.ledger import POLICIES, RULES

_SPACE = r"[\x20\x09-\x0D]"

_OP11 = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM kept WHERE vec_id % 50 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM anchors a JOIN kept r ON a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

_FAILED = " + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(RULES))
_LAST = list(POLICIES.values())[-1]
_KEPT_BY = ", ".join(f"CASE WHEN failed & {m} = 0 THEN '{p}' END" for p, m in POLICIES.items())
_ONLY = " ".join(f"WHEN {1 << k} THEN '{r.name}'" for k, r in enumerate(RULES))
_OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT k, unnest(w) AS word FROM d),
by_word AS (
  SELECT k, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_letter_words
  FROM words GROUP BY k),
spots AS (SELECT k, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d),
windows AS (SELECT k, i, array_to_string(w[i:i + 7], ' ') AS g FROM spots),
twice AS (SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
covered AS (SELECT k, count(DISTINCT j) AS n_repeat_words FROM (SELECT k, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY k),
lines AS (SELECT k, line FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
by_line AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (regexp_matches(line, '(\.\.\.|…){_SPACE}*$')) AS n_ellipsis_lines
  FROM lines GROUP BY k),
measured AS (
  SELECT d.k, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS n_digits,
         coalesce(n_letter_words, 0) AS n_letter_words, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines
  FROM d LEFT JOIN by_word USING (k) LEFT JOIN covered USING (k) LEFT JOIN by_line USING (k)),
ledger AS (SELECT *, ({_FAILED})::BIGINT AS failed FROM measured),
verdicts AS (SELECT *, CASE failed & {_LAST} {_ONLY} END AS only_rule FROM ledger)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, failed & {_LAST} = 0 AS kept, failed,
       array_to_string(list_filter([{_KEPT_BY}], lambda x: x IS NOT NULL), ',') AS kept_by, only_rule,
       CASE WHEN only_rule IS NOT NULL THEN count(*) OVER (PARTITION BY only_rule) END AS only_rule_docs
FROM verdicts
"""

#: CRC-32 (reflected polynomial 0xEDB88320) of the decimal digits of c.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

_OP13 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM turns),
ids AS (SELECT c, c - c % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM turns)),
rebuilt AS (
  SELECT c, 0 AS tail, pos, role, text FROM ids JOIN own ON conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM ids JOIN own ON conv_id = c AND pos > h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY tail, pos) AS depth, role, text FROM rebuilt),
ranked AS (SELECT c, depth, text, dense_rank() OVER (ORDER BY role, text) AS r FROM placed),
prefixes AS (
  SELECT c, depth, length(text) AS chars, string_agg(r::VARCHAR, ',') OVER (PARTITION BY c ORDER BY depth) AS prefix FROM ranked
  UNION ALL SELECT c, 0, 0, '' FROM ids),
sizes AS (SELECT c, max(depth) AS d FROM prefixes GROUP BY c),
nodes AS (SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM prefixes GROUP BY depth, prefix),
member AS (SELECT p.c, p.depth, n.conv_id, n.n_convs, n.chars FROM prefixes p JOIN nodes n USING (depth, prefix)),
up AS (
  SELECT n.conv_id, n.depth, a.conv_id AS over_id, a.depth AS over_depth, n.n_convs, n.chars,
         NOT EXISTS (SELECT 1 FROM member m JOIN member x ON x.c = m.c AND x.depth = n.depth + 1 WHERE m.conv_id = n.conv_id AND m.depth = n.depth) AS leaf
  FROM nodes n JOIN member a ON a.c = n.conv_id AND a.depth <= n.depth),
below AS (
  SELECT over_id AS conv_id, over_depth AS depth, count(*) FILTER (depth = over_depth + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves,
         sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM up GROUP BY over_id, over_depth),
ends AS (
  SELECT m.conv_id, m.depth, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids FROM member m JOIN sizes s ON s.c = m.c AND s.d = m.depth GROUP BY m.conv_id, m.depth)
SELECT n.conv_id, n.depth, u.over_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b USING (conv_id, depth)
LEFT JOIN up u ON u.conv_id = n.conv_id AND u.depth = n.depth AND u.over_depth = n.depth - 1
LEFT JOIN ends e ON e.conv_id = n.conv_id AND e.depth = n.depth
"""

ORACLE_SQL: dict[str, str] = {"op11_hard_negatives": _OP11, "op12_rule_ledger": _OP12, "op13_prefix_trie": _OP13}
