"""The query over word shares of sources."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from wikiloom.llm.divergence import source_divergence
from wikiloom.llm.registry import query, table

OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), x AS (SELECT row, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS words FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS words FROM c GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(sums.words, 0) + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 2)) // (langs.words + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN langs USING (lang)
  LEFT JOIN c USING (lang, source, term) LEFT JOIN sums USING (lang, source)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least=10, top=10)
