"""DuckDB SQL for the operators that SQL can express, written without the operators' own steps."""

from __future__ import annotations

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
whole AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) + 2 * v.v)::HUGEINT AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
lang_p AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2))::HUGEINT // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
  FROM whole JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense JOIN lang_p USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 10
"""

#: The crc32 table is built by its rule, a feature's code by one step for each byte.
RESAMPLE = r"""
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
  FROM range(256) r(i)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM texts),
f AS (
  SELECT side, id, unnest(ws) AS feature FROM w
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w),
codes AS (
  SELECT feature, xor(list_reduce(list_transform(range(strlen(feature)), lambda i: ('0x' || substr(hex(feature), 2 * i + 1, 2))::BIGINT),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), crc_table),
n AS (SELECT side, id, bucket, count(*) AS n FROM f JOIN codes USING (feature) GROUP BY ALL),
s AS (SELECT bucket, sum(n) AS s FROM n WHERE side = 'd' GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM n WHERE side = 'b' GROUP BY bucket),
gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
         / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT id, sum(n) AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM n JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS id, doc_id FROM documents) d JOIN w USING (id) LEFT JOIN weights USING (id) WHERE w.side = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_words >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 25 * eligible // 100 THEN r END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {"op11_source_divergence": DIVERGENCE, "op12_importance_resample": RESAMPLE}
