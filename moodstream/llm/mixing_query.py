"""The mix of all documents, and the SQL it must agree with."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.mixing import LEAST_BLOCK, MOST_BLOCK, SHARD, placed_by_size, taken, word_count
from moodstream.llm.registry import query, table
from moodstream.llm.shared import written

SEED = 7

# Sainte-Lague by ranking all quotients; targets by filling up one source after the other.
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
s AS (SELECT *, [3, 1, 2][1 + (i - 1) % 3] AS weight, sum(source_size) OVER () AS total,
  greatest({LEAST_BLOCK}, least({MOST_BLOCK}, coalesce(min(source_size) FILTER (source_size > 0) OVER (), 0) // 64)) AS block FROM s0),
rounds AS (
  SELECT 0 AS r, i, false AS full, 1.5 * total / sum(weight) OVER () AS level FROM s
  UNION ALL
  SELECT r + 1, i, full2, (1.5 * total - sum(CASE WHEN full2 THEN 2 * source_size ELSE 0 END) OVER ()) / sum(CASE WHEN full2 THEN 0 ELSE weight END) OVER ()
  FROM (SELECT r, i, weight, source_size, total, "full" OR level * weight >= 2 * source_size AS full2 FROM rounds JOIN s USING (i)) WHERE r <= 40),
t AS (SELECT s.*, CASE WHEN "full" THEN 2 * source_size::DOUBLE ELSE weight * level END AS target FROM rounds JOIN s USING (i) WHERE r = (SELECT max(r) FROM rounds)),
seats AS (SELECT floor(sum(target) / any_value(block) + 0.5)::BIGINT AS n FROM t),
tries AS (SELECT i, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, i) AS place FROM t, (SELECT unnest(range(0, n + 1)) AS k FROM seats)),
q AS (SELECT i, count(*) FILTER (place <= n) AS source_quota FROM tries, seats GROUP BY i),
h AS (SELECT d.*, t.i, t.source_size, t.target, t.block, q.source_quota, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS drawn,
  ceil(docs / {SHARD})::BIGINT AS shards FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN q USING (i)),
p AS (SELECT *, ('0x' || substr(drawn, 1, 8))::BIGINT % shards AS shard FROM h),
c AS (SELECT i, shard, any_value(source) AS source, sum(size) AS words, any_value(block) AS block, any_value(source_quota) AS source_quota FROM p GROUP BY i, shard),
ctries AS (SELECT i, shard, source_quota, row_number() OVER (PARTITION BY i ORDER BY words / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT *, unnest(range(0, source_quota + 1)) AS k FROM c)),
cq AS (SELECT i, shard, count(*) FILTER (place <= source_quota) AS quota FROM ctries GROUP BY i, shard),
b AS (SELECT c.i, c.shard, greatest(1, ceil(words / block))::BIGINT AS n, quota,
  ('0x' || substr(md5('{SEED}:' || coalesce(source, '') || ':' || shard), 1, 8))::BIGINT AS mark FROM c JOIN cq USING (i, shard)),
w AS (SELECT p.*, b.n, least(b.quota, 2 * b.n) AS quota, b.mark % b.n AS shift,
  coalesce(sum(size) OVER (PARTITION BY p.i, p.shard ORDER BY drawn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
  FROM p JOIN b ON p.i = b.i AND p.shard = b.shard),
e AS (SELECT *, first + size AS last, first // block AS fb, (first + size) // block AS lb FROM w)
SELECT doc_id, size, source_size, target,
  ((block * ((lb * quota + shift) // n) + (last - block * lb) * (((lb + 1) * quota + shift) // n - (lb * quota + shift) // n))
   - (block * ((fb * quota + shift) // n) + (first - block * fb) * (((fb + 1) * quota + shift) // n - (fb * quota + shift) // n)))::BIGINT AS taken
FROM e
"""


@query("op6_mix_sources", SQL)
def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    documents = table(spark, folder, "documents")
    sized = written(documents.select("doc_id", "source", word_count(documents["text"]).alias("size")), "sizes")
    return placed_by_size(sized, seed=SEED).select("doc_id", "size", "source_size", "target", taken().alias("taken"))
