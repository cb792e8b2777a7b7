"""DuckDB SQL for the registered queries that SQL can express over whole tables."""

SQL: dict[str, str] = {}

SQL["op5_rule_ledger"] = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT doc_id, text, [x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM base),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM cut WHERE len(words) >= 8)),
starts AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM starts, range(8) r(k) GROUP BY doc_id),
counts AS (
  SELECT c.doc_id, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g'))::BIGINT AS n_upper
  FROM cut c LEFT JOIN repeats r ON c.doc_id = r.doc_id),
bits AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (5 * n_symbols > n_words)::BIGINT + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::BIGINT
    + 16 * (n_words >= 20 AND (word_chars < 2 * n_words OR word_chars > 40 * n_words))::BIGINT
    + 32 * (n_words >= 20 AND 3 * n_upper > word_chars)::BIGINT AS failures
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failures & 3 <> 0 AS base_failed, failures = 0 AS kept, n_lines, n_upper, failures
FROM bits
"""

SQL["op8_line_windows"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS k
  FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT doc_id, k AS f, lead(k, 2) OVER o AS t,
    line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS w
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
later AS (
  SELECT doc_id, f, t FROM (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, f) AS n FROM w WHERE w IS NOT NULL)
  WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(f, t + 1)) AS k FROM later),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.k) FILTER (c.k IS NULL) AS text, count(c.k) AS n_removed
  FROM l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.k = c.k GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
SQL["op2_merkle"] = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS following
  FROM documents WINDOW o AS (ORDER BY doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (
  SELECT *, length(text) // 2 AS half FROM base),
texts AS (
  SELECT doc_id, length(text)::BIGINT AS n_chars, text, following,
    left(text, length(text) - half) || left(following, half) AS edited FROM edits),
every AS (
  SELECT doc_id, 'own' AS kind, text AS t FROM texts UNION ALL SELECT doc_id, 'next', following FROM texts
  UNION ALL SELECT doc_id, 'edited', edited FROM texts),
digests AS (
  SELECT doc_id, kind, [sha256(p) FOR p IN string_split(t, chr(10))] AS paragraphs,
    list_distinct([left(md5(p), 16) FOR p IN regexp_extract_all(t, '[^.!?\n]{1,120}[.!?\n]*|[.!?\n]+') IF p <> '']) AS marks
  FROM every),
trees AS (
  SELECT *, string_split(regexp_replace(array_to_string(paragraphs, ' '), '([0-3][0-9a-f]{63}|EMPTY) ', '\1|', 'g'), '|') AS sections
  FROM digests),
roots AS (
  SELECT *, sha256(array_to_string([sha256(s) FOR s IN sections], ' ')) AS root FROM trees),
pairs AS (
  SELECT a.doc_id, a.root, e.root AS edited_root, n.root AS next_root, a.paragraphs, e.paragraphs AS edited_paragraphs,
    len(a.marks) AS na, len(e.marks) AS ne, len(n.marks) AS nn,
    len(list_intersect(a.marks, e.marks)) AS ce, len(list_intersect(a.marks, n.marks)) AS cn
  FROM roots a JOIN roots e ON a.doc_id = e.doc_id AND e.kind = 'edited'
    JOIN roots n ON a.doc_id = n.doc_id AND n.kind = 'next' WHERE a.kind = 'own')
SELECT t.doc_id, n_chars, sha256(edited) AS edited_sha256, root AS fingerprint, edited_root AS edited_fingerprint,
  CASE WHEN root = edited_root THEN 1.0 WHEN na + ne = 0 THEN 0.0 ELSE 2.0 * ce / (na + ne) END::DOUBLE AS near_edited,
  CASE WHEN root = next_root THEN 1.0 WHEN na + nn = 0 THEN 0.0 ELSE 2.0 * cn / (na + nn) END::DOUBLE AS near_next,
  len([p FOR p IN list_distinct(edited_paragraphs) IF NOT list_contains(paragraphs, p)])::BIGINT AS n_changed_paragraphs
FROM texts t JOIN pairs p ON t.doc_id = p.doc_id
""".replace("EMPTY", _EMPTY)
