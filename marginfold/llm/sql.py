"""The operators that SQL can express, as DuckDB queries over the same tables."""

from marginfold.llm.quality_rules import LEAST_WORDS, MOST_REPEATED_PERCENT, RULES, RiskControl

_CONTROL = RiskControl()
_TESTS = ", ".join(
    f"('{rule}', {place}, CAST({cutoff} AS DOUBLE))" for rule, values in RULES.items() for place, cutoff in enumerate(values)
)

QUALITY_RULES = (
    r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'none') AS stratum, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), trio AS (
  SELECT r, s, array_to_string(w[s + 1:s + 3], ' ') AS phrase
  FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS s FROM doc WHERE len(w) >= 3)
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([s, s + 1, s + 2]) AS p
    FROM (SELECT r, s, count(*) OVER (PARTITION BY r, phrase) AS times FROM trio) WHERE times > 1)
  GROUP BY r
), line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), counted AS (
  SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
    coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN repeated USING (r) LEFT JOIN line USING (r)
), measured AS (
  SELECT *, """
    f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,"
    r"""
    CAST(n_symbols AS DOUBLE) / CAST(greatest(n_words, 1) AS DOUBLE) AS symbols_per_word,
    CAST(n_capitals AS DOUBLE) / CAST(greatest(word_chars, 1) AS DOUBLE) AS capital_share,
    CAST(n_repeat_words AS DOUBLE) / CAST(greatest(n_words, 1) AS DOUBLE) AS repeated_share,
    CAST(n_dup_lines AS DOUBLE) / CAST(greatest(n_lines, 1) AS DOUBLE) AS repeated_line_share
  FROM counted
), test AS (
  SELECT * FROM (VALUES """
    + _TESTS
    + r""") AS x(rule, place, cutoff)
), label AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), holdout AS (
  SELECT stratum, quality, symbols_per_word, capital_share, repeated_share, repeated_line_share
  FROM measured JOIN label USING (doc_id) WHERE NOT base_failed
), value AS (
  UNPIVOT holdout ON symbols_per_word, capital_share, repeated_share, repeated_line_share INTO NAME rule VALUE v
), tested AS (
  SELECT stratum, rule, place, cutoff, count(*) FILTER (quality = 1) AS n,
    count(*) FILTER (quality = 1 AND v > cutoff) AS k, count(*) FILTER (quality = 0 AND v > cutoff) AS bad
  FROM value JOIN test USING (rule) GROUP BY ALL
), judged AS (
  SELECT *, CASE WHEN k >= n * share THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(share) + (n - i) * ln(1 - share)))) END
    > """
    f"{_CONTROL.error} / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM holdout)) AS fails"
    f" FROM (SELECT *, {_CONTROL.limit} / {len(RULES)} AS share FROM tested)"
    r"""
), certified AS (
  SELECT * FROM (SELECT *, bool_or(fails) OVER (PARTITION BY stratum, rule ORDER BY place) AS failed FROM judged)
  WHERE NOT failed
), chosen AS (
  SELECT stratum, rule, cutoff FROM certified
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad - k DESC, place) = 1
), most AS (
  SELECT stratum, max(cutoff) FILTER (rule = 'symbols_per_word') AS a, max(cutoff) FILTER (rule = 'capital_share') AS b,
    max(cutoff) FILTER (rule = 'repeated_share') AS c, max(cutoff) FILTER (rule = 'repeated_line_share') AS d
  FROM chosen GROUP BY stratum
)
SELECT doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(symbols_per_word <= a, true) AND coalesce(capital_share <= b, true)
  AND coalesce(repeated_share <= c, true) AND coalesce(repeated_line_share <= d, true) AS kept
FROM measured LEFT JOIN most USING (stratum)
"""
)

DECONTAMINATION = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, w, least(10, len(w)) AS k FROM (
    SELECT item_id,
      regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark)
  WHERE len(w) > 0
), item_window AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s + 1:s + k], ' ') AS phrase
  FROM (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM item)
), doc_window AS (
  SELECT r, k, s, array_to_string(w[s + 1:s + k], ' ') AS phrase
  FROM (
    SELECT doc.r, doc.w, lengths.k, unnest(range(0, len(doc.w) - lengths.k + 1)) AS s
    FROM doc, (SELECT DISTINCT k FROM item) lengths WHERE len(doc.w) >= lengths.k)
), hit AS (
  SELECT d.r, d.s, d.k, i.item_id FROM doc_window d JOIN item_window i USING (k, phrase)
), words_hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hit) GROUP BY r
), items_hit AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""
