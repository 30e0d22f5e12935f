"""DuckDB SQL of the operators that SQL expresses."""

QUALITY_RULES = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS word
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)
), per_text AS (
  SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r
), windows AS (
  SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS three
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), covered AS (
  SELECT r, count(DISTINCT i + shift) AS n_repeat_words
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS times FROM windows
        WHERE three IS NOT NULL), (VALUES (0), (1), (2)) AS s(shift)
  WHERE times > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), measures AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
    CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
      AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM texts LEFT JOIN per_text USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 2 * n_repeat_words > n_words AS base_failed,
    CAST((n_words < 50)::INT + 2 * (2 * n_repeat_words > n_words)::INT
      + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
      + 16 * (2 * word_chars < 5 * n_words)::INT + 32 * (word_chars > 12 * n_words)::INT
      AS BIGINT) AS failed_bits
  FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
  base_failed, failed_bits = 0 AS kept
FROM judged
"""

LINE_DEDUP = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), lines AS (
  SELECT r, doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM texts
), keyed AS (
  SELECT r, doc_id, pos, line, translate(
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT r, doc_id, pos, line, coalesce(doc_id <> keeper, false) AS gone
  FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

SOURCE_MIXING = r"""
WITH weights(source, weight) AS (VALUES {weights}),
counts AS (
  SELECT coalesce(w.source, '*') AS bucket, any_value(coalesce(w.weight, {others})) AS weight,
    count(*) AS docs
  FROM documents d LEFT JOIN weights w ON d.source = w.source GROUP BY 1
), rates AS (
  SELECT bucket, weight * (SELECT sum(docs) FROM counts)
    / ((SELECT sum(weight) FROM counts) * docs) AS rate FROM counts
), terms AS (
  SELECT bucket, rate, k, sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate / k) END)
    OVER (PARTITION BY bucket ORDER BY k) - rate AS ln_p
  FROM rates, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS u(k)
  WHERE rate > 0
), steps AS (
  SELECT bucket, k, sum(exp(ln_p)) OVER (PARTITION BY bucket ORDER BY k) AS cdf FROM terms
), drawn AS (
  SELECT doc_id, d.source, coalesce(w.source, '*') AS bucket,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)
      AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d LEFT JOIN weights w ON d.source = w.source
)
SELECT doc_id, source, k AS copy
FROM drawn JOIN steps USING (bucket) WHERE cdf <= u
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) AS piece
  FROM documents
), runs AS (
  SELECT lang, row_number() OVER () AS run, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM pieces
), words AS (
  SELECT lang, run, generate_subscripts(w, 1) AS i, unnest(w) AS one FROM runs
), following AS (
  SELECT lang, one, one || ' ' || lead(one, 1) OVER o AS two,
         one || ' ' || lead(one, 1) OVER o || ' ' || lead(one, 2) OVER o AS three
  FROM words WINDOW o AS (PARTITION BY run ORDER BY i)
), grams AS (
  SELECT lang, 1 AS size, one AS phrase FROM following
  UNION ALL SELECT lang, 2, two FROM following WHERE two IS NOT NULL
  UNION ALL SELECT lang, 3, three FROM following WHERE three IS NOT NULL
), f AS MATERIALIZED (
  SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang
), cuts AS (
  SELECT lang, phrase, size, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w
  FROM f WHERE size > 1 AND f >= 10
), lefts AS MATERIALIZED (
  SELECT c.*, l.f AS l FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
), rated AS (
  SELECT c.lang, c.phrase, c.a, c.k, c.l, r.f AS r, (1000000 * c.a * c.a) // (c.l * r.f) AS score
  FROM lefts c JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
), worst AS (
  SELECT * FROM rated
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f AS longer, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')])
         AS phrase
  FROM (SELECT lang, f, string_split(phrase, ' ') AS w FROM f WHERE size = 3 AND f >= 10)
), held AS (
  SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT w.* FROM worst w LEFT JOIN held h ON h.lang = w.lang AND h.phrase = w.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * w.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase) AS rank,
       k.phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n,
       score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
