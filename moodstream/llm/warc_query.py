"""All pages written as archives and read back, and the SQL that must agree."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.registry import query, table
from moodstream.llm.warc import read_chunks, write_archives
from moodstream.streaming.folders import shared_folder

LEAST_REVISIT = 0

SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
s AS (SELECT page_id, octet_length(payload)::BIGINT AS n, sha1(payload) AS hex FROM p),
b AS (SELECT page_id, n, hex, unhex(hex)::BIT::VARCHAR AS bits FROM s),
t AS (SELECT *, array_to_string(list_transform(range(0, 32),
  lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: substr(bits, 1 + 5 * i + j, 1)::INT * (16 >> j)))::INT, 1)), '') AS digest,
  min(page_id) OVER (PARTITION BY hex, n) AS first FROM b)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {LEAST_REVISIT} AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {LEAST_REVISIT} AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM t
"""


def _id(column: str):
    return F.regexp_extract(column, r"^urn:page:(-?\d+)$", 1).try_cast("long")


@query("op8_warc_chunks", SQL)
def op8_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read back from the archives.

    Length and digest of a response are those of the bytes read; a revisit has no payload, so they come from its header.
    """
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, folder, "pages"), path, LEAST_REVISIT)
    ends = read_chunks(spark, path).filter("last")
    own = F.col("type") == "response"
    return ends.select(
        _id("record_id").alias("page_id"),
        F.when(own, F.col("bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        _id("refers_to").alias("refers_to"),
    )
