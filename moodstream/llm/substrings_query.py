"""Repeated byte strings of all documents, and the SQL that must agree."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.registry import query, table
from moodstream.llm.substrings import cut_repeats

LENGTH = 100

SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
w AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, {2 * LENGTH})) AS s FROM (SELECT *, unnest(range(0, n - {LENGTH} + 1)) AS pos FROM n WHERE n >= {LENGTH})),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) > 1 AS again FROM w),
b AS (SELECT doc_id, pos, h, n FROM (SELECT *, unnest(range(0, n)) AS pos FROM n)),
c AS (SELECT b.doc_id, b.pos, substr(b.h, 2 * b.pos + 1, 2) AS byte,
  coalesce(max(r.again) OVER (PARTITION BY b.doc_id ORDER BY b.pos ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW), false) AS gone
  FROM b LEFT JOIN r ON b.doc_id = r.doc_id AND b.pos = r.pos),
e AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS opens FROM c),
s AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
  coalesce(string_agg(byte, '' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM n LEFT JOIN s USING (doc_id)
"""


@query("op2_repeated_substrings", SQL)
def op2_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cut = cut_repeats(table(spark, folder, "documents"), length=LENGTH)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
