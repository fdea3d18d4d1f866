"""DuckDB SQL that the registered queries must agree with, where SQL can say it."""

QUALITY_RULES = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (
  SELECT doc_id, x, list_filter(regexp_split_to_array(x, '[ \t\n\x0B\f\r]+'), lambda v: v <> '') AS ws FROM t),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS win FROM starts),
twice AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
places AS (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows JOIN twice USING (doc_id, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM places GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(x, chr(10)),
    lambda v: length(translate(v, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0) AS ls FROM t),
f AS (
  SELECT doc_id, x, ws, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(translate(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(x) - length(translate(x, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    length(x) - length(translate(x, '!', '')) AS n_calls,
    length(regexp_replace(x, '\P{Lu}+', '', 'g')) AS n_capitals,
    len(string_split(x, chr(10))) AS n_lines,
    length(regexp_replace(x, '[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]+', '', 'g')) AS n_solid,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_calls > 5 * n_words
    OR 10 * n_capitals > 6 * word_chars OR (word_chars > 25 * n_words AND 2 * n_solid <= word_chars)
    OR 10 * n_dup_lines > 5 * n_lines OR 100 * n_stutters > 20 * n_words) AS kept
FROM b
"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda v: v <> '') AS ws FROM pieces),
ends AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
grams AS (
  SELECT lang, s AS size, array_to_string(ws[i - s + 1:i], ' ') AS phrase
  FROM ends, (SELECT unnest(range(1, 5)) AS s) WHERE i >= s),
f AS (SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM ends GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
    CAST(CAST(c.a AS HUGEINT) * 2000000 // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:c.size], ' ')),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
places AS (SELECT lang, a, ws, size, unnest(range(1, size)) AS i FROM cand WHERE size > 2),
inner_phrases AS (
  SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM places, (SELECT unnest(range(2, 4)) AS m) WHERE m < size AND i + m - 1 <= size),
covering AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT s.* FROM weakest s LEFT JOIN covering c USING (lang, phrase)
  WHERE c.longer IS NULL OR CAST(c.longer AS HUGEINT) * 100 < CAST(s.a AS HUGEINT) * 80)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
