"""Lines shared by ten or more documents, dropped from all documents, and the SQL it must agree with."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.lines import LEAST_CHARS, LEAST_DOCS, without_common_lines
from moodstream.llm.registry import query, table

SQL = rf"""
WITH lines AS (SELECT row, doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos
  FROM (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
keyed AS (SELECT row, doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= {LEAST_CHARS} GROUP BY k HAVING count(DISTINCT row) >= {LEAST_DOCS}),
marked AS (SELECT row, doc_id, pos, line, common.k IS NOT NULL AS dropped FROM keyed LEFT JOIN common USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row
"""


@query("op12_line_dedup", SQL)
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of what is left, of every document."""
    left = without_common_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
