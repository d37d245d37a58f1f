"""SQL twins, in DuckDB's dialect, of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"[x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _window(length: int) -> str:
    """The words of a window that begins at a row; the last one is NULL if it is cut off."""
    return "concat_ws(' ', word, " + ", ".join(f"lead(word, {k}) OVER place" for k in range(1, length)) + ")"


_QUALITY = f"""
WITH texts AS (
  SELECT doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source,
         coalesce(text, '') AS text, {_WORDS} AS words
  FROM documents
), places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM texts
), windows AS (
  SELECT doc_id, k, {_window(5)} AS win, lead(word, 4) OVER place IS NOT NULL AS whole
  FROM places WINDOW place AS (PARTITION BY doc_id ORDER BY k)
), twice AS (
  SELECT doc_id, k, whole AND count(*) OVER (PARTITION BY doc_id, win, whole) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM twice
), repeats AS (
  SELECT doc_id, count(*) FILTER (c) AS n FROM covered GROUP BY doc_id
), line_rows AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts
), line_counts AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS d FROM line_rows WHERE trim(line, {_BLANK}) <> '' GROUP BY doc_id
), base AS (
  SELECT t.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0) AS lines
  FROM texts t LEFT JOIN repeats r ON t.doc_id = r.doc_id LEFT JOIN line_counts l ON t.doc_id = l.doc_id
), measures AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols * 1000 // greatest(word_chars, 1) AS symbol_share, n_dup_lines * 1000 // greatest(lines, 1) AS dup_line_share,
         n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_share, word_chars * 10 // greatest(n_words, 1) AS word_length
  FROM base
), long AS (
  SELECT doc_id, lang, source, base_failed, u.m AS measure, u.both AS both_ends,
         (u.v >> greatest(length(bin(u.v)) - 5, 0)) << greatest(length(bin(u.v)) - 5, 0) AS bucket
  FROM (SELECT *, unnest([{{'m': 'symbol_share', 'v': symbol_share, 'both': false}}, {{'m': 'dup_line_share', 'v': dup_line_share, 'both': false}},
                          {{'m': 'repeat_share', 'v': repeat_share, 'both': false}}, {{'m': 'word_length', 'v': word_length, 'both': true}}]) AS u
        FROM measures)
), sketch AS (
  SELECT lang, source, measure, bucket, count(*) AS n FROM long WHERE NOT base_failed GROUP BY ALL
), levels AS (
  SELECT 1 AS level, lang, source, measure, bucket, n FROM sketch
  UNION ALL SELECT 2, lang, '', measure, bucket, n FROM sketch
  UNION ALL SELECT 3, '', '', measure, bucket, n FROM sketch
), merged AS (
  SELECT level, lang, source, measure, bucket, sum(n) AS n FROM levels GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (grp ORDER BY bucket) AS upto, sum(n) OVER grp AS total
  FROM merged WINDOW grp AS (PARTITION BY level, lang, source, measure)
), outer_ AS (
  SELECT level, lang, source, measure, max(total) AS n, min(bucket) FILTER (upto * 1000 >= total * 10) AS low,
         min(bucket) FILTER (upto * 1000 >= total * 990) AS high
  FROM ranked GROUP BY ALL
), languages AS (
  SELECT l.lang, l.measure, (l.low * l.n + c.low * 200) // (l.n + 200) AS low, (l.high * l.n + c.high * 200) // (l.n + 200) AS high
  FROM outer_ l JOIN outer_ c ON c.level = 3 AND c.measure = l.measure WHERE l.level = 2
), ranges AS (
  SELECT g.lang, g.source, g.measure, (g.low * g.n + l.low * 200) // (g.n + 200) AS low, (g.high * g.n + l.high * 200) // (g.n + 200) AS high
  FROM outer_ g JOIN languages l ON l.lang = g.lang AND l.measure = g.measure WHERE g.level = 1
), judged AS (
  SELECT l.doc_id, bool_and(l.bucket <= r.high AND (NOT l.both_ends OR l.bucket >= r.low)) AS inside
  FROM long l JOIN ranges r ON r.lang = l.lang AND r.source = l.source AND r.measure = l.measure
  GROUP BY l.doc_id
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM measures m LEFT JOIN judged j ON m.doc_id = j.doc_id
"""

_SUBSTRINGS = f"""
WITH places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM (SELECT doc_id, {_WORDS} AS words FROM documents)
), windows AS (
  SELECT doc_id, k, word, {_window(20)} AS win, lead(word, 19) OVER place IS NOT NULL AS whole
  FROM places WINDOW place AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k, word, whole AND row_number() OVER (PARTITION BY win, whole ORDER BY doc_id, k) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, k, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM later
)
SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON d.doc_id = c.doc_id
GROUP BY d.doc_id
"""

_LINES = rf"""
WITH every AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT doc_id, k, trim(line, {_BLANK}) AS line FROM every WHERE trim(line, {_BLANK}) <> ''
), pairs AS (
  SELECT doc_id, k, line, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS follower FROM counted
), later AS (
  SELECT doc_id, k, follower IS NOT NULL AND row_number() OVER (PARTITION BY line, follower ORDER BY doc_id, k) > 1 AS again,
         len(string_split_regex(line, '[\x20\x09-\x0D]+')) >= 8 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, k) > 1 AS alone
  FROM pairs
), covered AS (
  SELECT doc_id, k, alone OR again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY k), false) AS gone FROM later
), cleaned AS (
  SELECT e.doc_id, count(c.k) AS n_lines, count(*) FILTER (c.gone) AS n_removed,
         string_agg(e.line, chr(10) ORDER BY e.k) FILTER (NOT coalesce(c.gone, false)) AS text
  FROM every e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.k = c.k
  GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""

_PHRASES = r"""
WITH lists AS (
  SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), totals AS (
  SELECT lang, sum(len(words))::HUGEINT AS n FROM lists GROUP BY lang
), grams AS (
  SELECT lang, k AS size, unnest([array_to_string(words[i:i + k - 1], ' ') FOR i IN range(1, len(words) - k + 2)]) AS phrase
  FROM lists, (VALUES (1), (2), (3), (4), (5)) AS lengths(k) WHERE len(words) >= k
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT lang, phrase, string_split(phrase, ' ') AS words, size, f AS a FROM counts WHERE size > 1
), cuts AS (
  SELECT lang, phrase, a, unnest(range(1, size)) AS k, words FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(words[k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), places AS (
  SELECT lang, words, size, a, unnest(range(1, size)) AS i FROM candidates
), inside AS (
  SELECT lang, array_to_string(words[i:j], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(i + 1, size + 1)) AS j FROM places) WHERE j - i + 1 < size GROUP BY ALL
), kept AS (
  SELECT w.* FROM lowest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE coalesce(100 * most < 100 * w.a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {"op3_quality": _QUALITY, "op8_substrings": _SUBSTRINGS, "op10_lines": _LINES, "op12_phrases": _PHRASES}
