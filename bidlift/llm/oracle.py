"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .secrets import BASE, RULES

OP5 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bm AS (
  SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0
), g AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS gram
  FROM (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM bm)
), lengths AS (SELECT DISTINCT m FROM g), p AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS gram
  FROM (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m)
), h AS (SELECT p.r, p.i, g.m, g.item_id FROM p JOIN g USING (gram, m)
), n_hit AS (
  SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + m)) AS k FROM h) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, coalesce(items.s, sha256('')) AS items_sha256,
       coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)
"""


def _secrets_sql() -> str:
    """Spans of every rule on every text, without an index."""
    parts = []
    for order, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        measured = 2 if rule.group2 else 0
        parts.append(
            f"""SELECT r, {order} AS k, '{rule.name}' AS kind,
       unnest(string_split_regex(text, '{pattern}')[:-2]) AS cut,
       unnest(regexp_extract_all(text, '{pattern}')) AS hit,
       unnest(regexp_extract_all(text, '{pattern}', {measured})) AS measured,
       unnest(range(len(regexp_extract_all(text, '{pattern}')))) AS i, {rule.least} AS least
FROM d WHERE regexp_matches(text, '{pattern}')"""
        )
    counts = ", ".join(f"count(*) FILTER (WHERE k = {i}) AS n_{r.name}" for i, r in enumerate(BASE))
    zeros = ", ".join(f"CAST(coalesce(s.n_{r.name}, 0) AS BIGINT) AS n_{r.name}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
p AS (
  SELECT r, k, kind, measured, least, length(hit) AS n,
         sum(length(cut) + length(hit)) OVER (PARTITION BY r, k ORDER BY i) AS e
  FROM m
), s AS (
  SELECT r, {counts},
         coalesce(string_agg(kind || ':' || CAST(e - n AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - n, k)
                  FILTER (WHERE k < {len(BASE)}), '') AS base,
         string_agg(kind || ':' || CAST(e - n AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - n, k) AS spans
  FROM p WHERE length(measured) >= least GROUP BY r
)
SELECT doc_id, {zeros}, sha256(coalesce(s.base, '')) AS base_sha256, coalesce(s.spans, '') AS spans
FROM d LEFT JOIN s USING (r)
"""


OP8 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), win AS (
  SELECT r, i, list_value(w[i], w[i + 1], w[i + 2]) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
), twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY r),
c AS (
  SELECT d.r, doc_id, lang, source, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r)
), m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CAST(floor(1000 * greatest(n_symbols - 3 * sqrt(n_symbols), 0) / greatest(word_chars, 1)) AS BIGINT) AS v1,
         CAST(floor(1000 * greatest(n_dup_lines - 3 * sqrt(n_dup_lines), 0) / greatest(n_lines, 1)) AS BIGINT) AS v2,
         CAST(floor(1000 * greatest(n_repeat_words - 3 * sqrt(n_repeat_words), 0) / greatest(n_words, 1)) AS BIGINT) AS v3,
         CAST(10 * word_chars // greatest(n_words, 1) AS BIGINT) AS v4
  FROM c
), u AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest([v1, v2, v3, v4]) AS v FROM m WHERE NOT base_failed
), sk AS (
  SELECT lang, source, m, ((v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0)) AS v, count(*) AS n
  FROM u GROUP BY ALL
), lv AS (SELECT lang, m, v, sum(n) AS ln FROM sk GROUP BY ALL),
lt AS (SELECT lang, m, sum(n) AS lt FROM sk GROUP BY ALL),
g AS (SELECT lang, source, m, sum(n) AS gt FROM sk GROUP BY ALL),
mix AS (
  SELECT lang, source, m, v, coalesce(n, 0) * lt + 20 * ln AS w, (gt + 20) * lt AS total, CASE m WHEN 1 THEN 75 ELSE 98 END AS level
  FROM g JOIN lv USING (lang, m) JOIN lt USING (lang, m) LEFT JOIN sk USING (lang, source, m, v)
), q AS (
  SELECT lang, source, m, min(v) FILTER (WHERE 100 * cum >= (100 - level) * total) AS low,
         min(v) FILTER (WHERE 100 * cum >= 50 * total) AS median, min(v) FILTER (WHERE 100 * cum >= level * total) AS high
  FROM (SELECT *, sum(w) OVER (PARTITION BY lang, source, m ORDER BY v) AS cum FROM mix) GROUP BY ALL
), t AS (
  SELECT lang, source, max(above) FILTER (WHERE m = 1) AS h1, max(above) FILTER (WHERE m = 2) AS h2, max(above) FILTER (WHERE m = 3) AS h3,
         max(above) FILTER (WHERE m = 4) AS h4, max(below) FILTER (WHERE m = 4) AS l4
  FROM (
    SELECT *, high + greatest(3 * (high - median), CAST(2 ** greatest(length(bin(high)) - 5, 0) AS BIGINT)) AS above,
           low - greatest(3 * (median - low), CAST(2 ** greatest(length(bin(low)) - 5, 0) AS BIGINT)) AS below
    FROM q
  ) GROUP BY ALL
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND v1 <= h1 AND v2 <= h2 AND v3 <= h3 AND v4 <= h4 AND v4 >= l4 AS kept
FROM m LEFT JOIN t USING (lang, source)
"""


OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS doc, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, doc, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, doc, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM s),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (SELECT key, min(doc) AS least FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT r, i, line, coalesce(doc > least, false) AS dropped FROM k LEFT JOIN f USING (key)),
o AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
  FROM m GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, kept_sha256 FROM d JOIN o USING (r)
"""


OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (SELECT doc_id, lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (
  SELECT doc_id, lang, words, w[i:i + words - 1] AS gram
  FROM (SELECT doc_id, lang, w, words, unnest(range(1, len(w) - words + 2)) AS i
        FROM p, (SELECT unnest([1, 2, 3, 4]) AS words) WHERE len(w) >= words)
), f AS (
  SELECT lang, words, gram, array_to_string(gram, ' ') AS phrase, count(*) AS f, min(doc_id) AS first_doc
  FROM g GROUP BY lang, words, gram HAVING count(*) >= 30
), cut AS (
  SELECT lang, phrase, f AS a, first_doc, gram, k, gram[1:k] AS one, gram[k + 1:words] AS two
  FROM (SELECT *, unnest(range(1, words)) AS k FROM f WHERE words >= 2)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.first_doc, c.gram, c.k, x.f AS l, y.f AS r,
         (CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.gram = c.one JOIN f y ON y.lang = c.lang AND y.gram = c.two
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, gram[s:s + size - 1] AS gram, max(f) AS longer
  FROM (SELECT lang, gram, words, f, size, unnest(range(1, words - size + 2)) AS s
        FROM f, (SELECT unnest([2, 3]) AS size) WHERE size < words)
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.gram = b.gram
  WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score, first_doc
FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op1_secret_scan": _secrets_sql(), "op5_benchmark_decontamination": OP5, "op8_adaptive_quality": OP8,
    "op12_line_bitmaps": OP12, "op13_phrase_fingerprints": OP13,
}
