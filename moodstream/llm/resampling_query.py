"""Documents drawn towards the benchmark's distribution, and the SQL they must agree with."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.registry import query, table
from moodstream.llm.resampling import BUCKETS, LONGEST, resampled

PERCENT, LEAST_WORDS, SEED = 5, 20, 42

# CRC-32 of every distinct feature bit by bit: a byte enters with the first of its eight steps.
SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS row, true AS own, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), false, NULL, text FROM benchmark),
w AS (SELECT row, own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS (SELECT row, own, feature, count(*) AS n FROM (
    SELECT row, own, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS feature
    FROM w, (SELECT unnest(range(1, {LONGEST} + 1)) AS k) WHERE len(w) >= k) GROUP BY ALL),
bytes AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM f)),
crc AS (SELECT feature, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(0, length(h) // 2),
    lambda i: [('0x' || substr(h, 2 * i + 1, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) % {BUCKETS} AS bucket FROM bytes),
b AS (SELECT row, own, bucket, n FROM f JOIN crc USING (feature)),
counts AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t FROM b GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + {BUCKETS}) / ((s + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain FROM counts, sums),
weights AS (SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM b JOIN gains USING (bucket) WHERE own GROUP BY row),
d AS (SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weights USING (row) WHERE own),
ranked AS (SELECT doc_id, n_features, weight, score, words, row_number() OVER (PARTITION BY words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
  count(*) OVER (PARTITION BY words >= {LEAST_WORDS}) AS many FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= {LEAST_WORDS} AND place <= {PERCENT} * many // 100 THEN place END AS rank FROM ranked
"""


@query("op11_importance_resampling", SQL)
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    found = resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"), PERCENT, LEAST_WORDS, seed=SEED)
    return found.select("doc_id", "n_features", "weight", "score", "rank")
