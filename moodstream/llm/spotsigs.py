"""SpotSigs fingerprints (Theobald, Siddharth, Paepcke 2008) of texts and of their neighbours.

A signature is a common word of the text, the anchor, with the chain of the next CHAIN words that are not common. The fingerprint is the
set of a text's signatures, 32 bits each, as hexadecimal digits in order. Where no common word is within GAP words before and behind, a word is an
anchor itself: texts in languages whose common words are not listed, code and word lists get signatures throughout, though a listed word
stands here and there. This hangs on the words around only, so an edit changes signatures near it and no others.

Sets are dealt into partitions by length such that sets of partitions that are not neighbours can't reach the Jaccard likeness `least`.
Only sets in the same or neighbouring partitions are compared, and of those only pairs whose lengths still allow `least`; other likeness is 0.

`with_next` brings each row together with the row of the next smaller key: keys are cut into ranges, a range is one sorted partition read in
order, and the first row of each range is also sent to the range before it. Texts are shuffled once.

Null and empty texts, and texts without words, have the empty fingerprint; two empty sets are alike (1), an empty and another are not (0). Rows
with equal key follow each other in the order of their texts; rows without key come last. One row is its own next. Columns not named are not
read. An empty table gives an empty result.
"""

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAIN = 2
GAP = 4

# Common words of English, French, German and Spanish.
COMMON = frozenset(
    "a an and are as at be been but by can could did do does for from had has have he her his i if in into is it its may more no not of on or our "
    "she should so than that the their them then there these they this to up was we were what when where which who will with would you your "
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me mes mon ne nos notre nous on ou par pas pour "
    "qu que qui sa se ses son sont sur ta te tes toi ton tu un une vos votre vous été être "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die dir durch ein eine einem einen einer er es für hat ich ihr im ist kein "
    "man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wird wir zu zum zur "
    "al como con del el ella ellas ellos era es esta este esto ha hay la las lo los más mi muy no nos o para pero por que se ser si sin sobre su sus "
    "también un una uno y ya yo".split()
)

_WORD = re.compile(r"\w+")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def signatures(text: str | None) -> np.ndarray:
    """Sorted distinct signatures of a text, uint32."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    common = np.fromiter((x in COMMON for x in words), bool, len(words))
    content = np.flatnonzero(~common)
    upto = np.concatenate([np.zeros(GAP + 1, np.int64), np.cumsum(common), np.full(GAP, common.sum())])
    around = upto[2 * GAP + 1 :] - upto[: len(words)]  # common words from GAP before to GAP behind
    anchors = np.flatnonzero(common | (around == 0))
    after = np.searchsorted(content, anchors, side="right")
    keep = after + CHAIN <= len(content)
    anchors, after = anchors[keep], after[keep]
    mixed = hashes[anchors] * _MIX[0]
    for link in range(CHAIN):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1] + hashes[content[after + link]] * _MIX[2]
    if not len(mixed):  # too short for a chain: the words themselves
        mixed = hashes * _MIX[2]
    return np.unique(((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32))


def spelled(own: np.ndarray) -> str:
    """The fingerprint: 8 hexadecimal digits for each signature."""
    return own.astype(">u4").tobytes().hex()


def partition_of(length: int, least: float) -> int:
    """Partition of a set by length; lengths of partitions that are not neighbours differ by more than the factor `least`."""
    return 0 if least <= 0 or length == 0 else 1 + math.floor(math.log(length) / -math.log(least))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.1) -> float:
    """Jaccard likeness of two sets, 0 where it is below `least` by the lengths alone."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if abs(partition_of(len(a), least) - partition_of(len(b), least)) > 1:
        return 0.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as much of the beginning of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_next(frame: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """Rows (range, lead, key, text), sorted in partitions; behind the rows of a range comes at least one with `lead`: the row after them."""
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = frame.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    cuts = given.select("key").dropna().approxQuantile("key", [i / parts for i in range(1, parts)], 0.1 / parts)
    cuts = np.unique(np.array(cuts or [], float))

    def number(keys: pd.Series) -> pd.Series:
        known = keys.astype("Float64")
        found = len(cuts) - np.searchsorted(cuts, known.fillna(0).to_numpy(float), side="left")
        return pd.Series(np.where(known.isna(), len(cuts) + 1, found), dtype="int32")

    numbered = given.withColumn("range", F.pandas_udf(number, "int")("key"))
    # one row per range
    tops = {x["range"]: x["top"] for x in numbered.groupBy("range").agg(F.max("key").alias("top")).collect()}
    order = sorted(tops)
    before = {own: order[at - 1] for at, own in enumerate(order)}

    def also(keys: pd.Series, ranges: pd.Series) -> pd.Series:
        known = keys.astype("object").where(keys.notna(), None)
        return pd.Series(
            [before[r] if (tops[r] is None or (k is not None and int(k) == tops[r])) else None for k, r in zip(known, ranges, strict=True)],
            dtype="Int32",
        )

    own = F.struct("range", F.lit(False).alias("lead"))
    copy = F.struct(F.col("before").alias("range"), F.lit(True).alias("lead"))
    sent = numbered.withColumn("before", F.pandas_udf(also, "int")("key", "range")).withColumn(
        "to", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy)))
    )
    rows = sent.select("to.range", "to.lead", "key", "text").repartition(parts, "range")
    return rows.sortWithinPartitions("range", "lead", F.col("key").desc_nulls_last(), "text"), ["range", "lead", "key", "text"]


def fingerprints_with_next(frame: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.1) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows, _ = with_next(frame, key, text)
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def described(last: tuple, following: str, after: np.ndarray) -> tuple:
        _, own_key, own_text, own = last
        changed = edited(own_text, following)
        other = own if changed == own_text else signatures(changed)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return own_key, len(own_text), digest, spelled(own), spelled(other), likeness(own, other, least), likeness(own, after, least)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose next is still to come
        for batch in batches:
            held = []
            for at, lead, own_key, value in zip(*batch.columns, strict=True):
                at, lead = at.as_py(), lead.as_py()
                if last is None and lead:  # further rows with the key of the one after the range
                    continue
                value = value.as_py() or ""
                own = signatures(value)
                if last is not None:
                    held.append(described(last, value, own))
                last = None if lead else (at, own_key.as_py(), value, own)
            columns = zip(*held, strict=True) if held else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names)

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(walk, schema).withColumnRenamed("key", key)
