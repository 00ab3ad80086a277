"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, r_host, r_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT DISTINCT host, path, r_host || r_path AS rule, verdict
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
), best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""

QUALITY = r"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM (
    SELECT doc_id, p, array_to_string(list_slice(words, p, p + 7), ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM words WHERE len(words) >= 8))
), repeats AS (
  SELECT doc_id, sum(least(8, coalesce(next_p - p, 8))) AS n_repeat_words
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next_p FROM windows WHERE n > 1) GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeats USING (doc_id)
), flagged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
), metrics AS (
  SELECT doc_id, lang, source, base_failed, m.metric, m.least, m.v
  FROM (SELECT *, unnest([
      {'metric': 'symbols', 'least': 32, 'v': CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END},
      {'metric': 'dup_lines', 'least': 32, 'v': CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END},
      {'metric': 'repeat_words', 'least': 32, 'v': CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END},
      {'metric': 'word_length', 'least': 32, 'v': CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END}]) AS m FROM flagged)
), cells AS (
  SELECT lang, source, metric, least, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS cell, count(*) AS n
  FROM metrics WHERE NOT base_failed GROUP BY ALL
), fine AS (
  SELECT lang, source, metric, max(rows) AS rows, max(least) AS least, min(cell) FILTER (upto * 4 >= rows) AS q1, min(cell) FILTER (upto * 4 >= rows * 3) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY lang, source, metric) AS rows FROM cells)
  GROUP BY lang, source, metric
), merged AS (
  SELECT lang, metric, least, cell, sum(n) AS n FROM cells GROUP BY ALL
), coarse AS (
  SELECT lang, metric, max(rows) AS rows, max(least) AS least, min(cell) FILTER (upto * 4 >= rows) AS q1, min(cell) FILTER (upto * 4 >= rows * 3) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, metric ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY lang, metric) AS rows FROM merged)
  GROUP BY lang, metric
), limits AS (
  SELECT f.lang, f.source, f.metric,
    CASE WHEN f.rows >= 30 THEN f.q3 + greatest(3 * (f.q3 - f.q1), f.least) WHEN c.rows >= 30 THEN c.q3 + greatest(3 * (c.q3 - c.q1), c.least) END AS high
  FROM fine f JOIN coarse c ON f.lang IS NOT DISTINCT FROM c.lang AND f.metric = c.metric
), verdicts AS (
  SELECT doc_id, coalesce(bool_or(v > high), false) AS above
  FROM metrics m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source AND m.metric = l.metric
  GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT above AS kept
FROM flagged JOIN verdicts USING (doc_id)
"""

MIXING = r"""
WITH base AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source)
), weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][rank % 3 + 1] AS weight, source_size * 3 AS full_size FROM ranked
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(full_size) OVER o, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM weighted WINDOW o AS (ORDER BY full_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, rank,
    CASE WHEN full_size > level * weight THEN (min({'a': full_size / weight, 'b': rank, 'level': level}) FILTER (full_size > level * weight) OVER ()).level * weight
      ELSE full_size::DOUBLE END AS target
  FROM levels
), queued AS (
  SELECT b.*, t.source_size, t.rank, t.target,
    sum(size) OVER (PARTITION BY b.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS queued
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), served AS (
  SELECT doc_id, key, size, rank, (source_size * turn + queued)::DOUBLE / target AS finish
  FROM (SELECT *, unnest(range(0, least(ceil(target / source_size), 3)::BIGINT)) AS turn FROM queued WHERE size > 0 AND target > 0)
), taken AS (
  SELECT doc_id, sum(size)::BIGINT AS taken
  FROM (SELECT *, sum(size) OVER (ORDER BY finish, rank, key, size ROWS UNBOUNDED PRECEDING) AS upto FROM served)
  WHERE upto <= (SELECT sum(size) FROM base) GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM queued LEFT JOIN taken USING (doc_id)
"""


def statements() -> dict[str, str]:
    return {"op3_url_filter": URL_FILTER, "op8_quality": QUALITY, "op9_mixing": MIXING}
