"""Byte-level BPE of all documents."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.bpe import encoded_bytes, tokenizer
from moodstream.llm.registry import query, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def digests(documents: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    tokens = tokenizer(ranks or public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return encoded_bytes(documents, tokens, "text", ["doc_id"]).select(
        "row.doc_id",
        (F.octet_length("raw") / 4).cast("long").alias("n_tokens"),
        F.sha2("raw", 256).alias("ids_sha256"),
        F.sha2("back", 256).alias("decoded_sha256"),
    )


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    return digests(table(spark, folder, "documents"))
