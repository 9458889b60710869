"""The best phrases of every language, and the SQL they must agree with."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.collocations import collocations
from moodstream.llm.registry import query, table

LEAST, SHARE, FIRST = 10, 50, 2000

SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
c AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM c WHERE k > 1 AND f >= {LEAST}),
cuts AS (SELECT cand.*, i, x.f AS l, y.f AS r, (1000000::HUGEINT * cand.f * cand.f) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM cand) AS cand
  JOIN c AS x ON x.lang = cand.lang AND x.g = cand.g[1:i] JOIN c AS y ON y.lang = cand.lang AND y.g = cand.g[i + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
inside AS (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, f AS longer FROM cand WHERE k = 3),
open AS (SELECT * FROM best WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = best.lang AND inside.g = best.g AND 100 * longer >= {SHARE} * best.f)),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, array_to_string(g, ' ')) AS rank FROM open)
SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {FIRST}
"""


@query("op13_collocations", SQL)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first phrases."""
    return collocations(table(spark, folder, "documents"), LEAST, SHARE, FIRST)
