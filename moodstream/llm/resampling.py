"""Importance resampling towards a target: features hashed by CRCs of prefixes, a seeded draw without replacement.

Features of a text are its runs of 1 to `longest` words, joined by one space, repeats counted; a feature's bucket is the CRC-32 of its
bytes modulo `buckets`. A document is normalised (A-Z lower-cased, other ASCII signs to separators, words joined by one space) and scanned once,
storing the running CRC behind every word. The CRC of a run follows from two of them: CRCs are linear over GF(2), so
crc(run) = crc(up to its end) xor shift(crc(up to its start), bytes of the run), where shift is the CRC register over so many zero bytes. Shifts are table
lookups in numpy, so no run is ever cut out or hashed by itself.

Two passes over the texts: the first counts features per bucket, added up in the task (`buckets` rows a task); the second sums the gains,
an array of `buckets` numbers, per document. Neither shuffles a text. The draw adds seeded Gumbel noise to each document's weight and takes the highest:
documents are dealt into ranges of the score, ranked within, and shifted by the ranges before, so no task sorts them all.

Memory of a task is about WORDS words at a time, also within one very long text. Null and empty texts have no features and weight 0.
Rows with equal key are separate documents with equal noise; of equal scores the smaller key comes first, a null key last. Equal rows take
ranks of their own. Columns besides key and text are not read. An empty table gives an empty result; an empty target leaves t and T at 0.
"""

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.shared import written
from moodstream.operators.ranking import numbered

BUCKETS, LONGEST = 10_000, 3
#: Words scanned at once, and bytes of a text split at once.
WORDS, BYTES = 1 << 19, 1 << 21
#: Shifts by up to so many bytes are one lookup; longer ones go by powers of two.
NEAR = 64

_WORD_BYTES = set((string.ascii_lowercase + string.digits).encode()) | set(range(128, 256))
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_NORMAL = bytes(x if x in _WORD_BYTES else 32 for x in _LOWER)


def _times(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The matrix, 32 columns over GF(2), times each value."""
    bits = (values[..., None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return np.bitwise_xor.reduce(np.where(bits == 1, matrix, np.uint32(0)), axis=-1)


def _lookups(matrix: np.ndarray) -> np.ndarray:
    """Products of the matrix with every value of each of the four bytes."""
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([_times(matrix, byte << np.uint32(8 * k)) for k in range(4)])


def _shift_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lookups of shifts by 0 to NEAR bytes, of shifts by 2 ** k bytes, and of the step back by one byte."""
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = np.array([zlib.crc32(b"\0", int(x)) ^ zlib.crc32(b"\0", 0) for x in unit], np.uint32)
    near, matrix = [_lookups(unit)], unit
    for _ in range(NEAR):
        matrix = _times(one, matrix)
        near.append(_lookups(matrix))
    powers, matrix = [], one
    for _ in range(40):
        powers.append(_lookups(matrix))
        matrix = _times(matrix, matrix)
    back = unit.copy()  # the inverse of one: columns are swept until `left` is the unit matrix
    left = one.copy()
    for k in range(32):
        pivot = next(j for j in range(k, 32) if left[j] >> np.uint32(k) & 1)
        left[[k, pivot]], back[[k, pivot]] = left[[pivot, k]], back[[pivot, k]]
        others = (left >> np.uint32(k) & 1).astype(bool)
        others[k] = False
        left[others] ^= left[k]
        back[others] ^= back[k]
    return np.stack(near).reshape(-1), np.stack(powers), _lookups(back)


_NEAR, _POWERS, _BACK = _shift_tables()
_BLANK = np.uint32(zlib.crc32(b" "))


def _looked_up(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    byte = np.uint32(255)
    return tables[0][values & byte] ^ tables[1][values >> 8 & byte] ^ tables[2][values >> 16 & byte] ^ tables[3][values >> 24]


def shifted(crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each CRC after so many zero bytes, as far as it depends on the CRC."""
    base = np.minimum(sizes, NEAR) << 10
    byte = np.uint32(255)
    out = _NEAR[base + (crcs & byte)]
    for k in (1, 2, 3):
        out ^= _NEAR[base + (k << 8) + (crcs >> np.uint32(8 * k) & byte)]
    far = np.flatnonzero(sizes > NEAR)
    if len(far):
        rest, some = sizes[far] - NEAR, out[far]
        for k in range(int(rest.max()).bit_length()):
            on = rest >> k & 1 == 1
            some[on] = _looked_up(_POWERS[k], some[on])
        out[far] = some
    return out


def _slices(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a normalised text, some MB at a time."""
    at = 0
    while len(raw) - at > BYTES:
        end = raw.find(b" ", at + BYTES)
        if end < 0:
            break
        yield raw[at:end].split()
        at = end
    yield raw[at:].split()


class _Scan:
    """Running CRCs of documents, one behind the other; `use(buckets, document)` gets the features of finished stretches."""

    def __init__(self, use, buckets: int, longest: int):
        self.use, self.buckets, self.longest = use, buckets, longest
        self.starts, self.behind, self.sizes, self.docs, self.n, self.old = [], [], [], [], 0, 0

    def add(self, doc: int, text: str | None) -> int:
        """Scan one text; its number of words."""
        crc, total, crc32 = 0, 0, zlib.crc32
        for words in _slices((text or "").encode("utf-8").translate(_NORMAL)):
            n = len(words)
            if not n:
                continue
            pieces = (b" \n".join(words) + b" ").split(b"\n")
            running = [crc := crc32(piece, crc) for piece in pieces]
            behind = np.array(running, np.uint32)
            start = np.empty(n, np.uint32)
            start[0], start[1:] = last if total else 0, behind[:-1]
            last = crc
            self.starts.append(start)
            self.behind.append(behind)
            self.sizes.append(np.fromiter(map(len, pieces), np.int64, n))
            self.docs.append(np.full(n, doc, np.int64))
            total += n
            self.n += n
            if self.n >= WORDS:
                self.flush()
        return total

    def flush(self) -> None:
        """Use all runs that end in a word added since the last time; keep the last words for runs that go on."""
        if not self.n:
            return
        start, behind = np.concatenate(self.starts), np.concatenate(self.behind)
        sizes, docs = np.concatenate(self.sizes), np.concatenate(self.docs)
        ends = _looked_up(_BACK, behind ^ _BLANK)  # the CRC up to the word, without the blank behind it
        upto = np.concatenate([[0], np.cumsum(sizes)])
        for length in range(1, self.longest + 1):
            first = np.arange(max(0, self.old - length + 1), len(sizes) - length + 1)
            first = first[docs[first] == docs[first + length - 1]]
            run = upto[first + length] - upto[first] - 1
            crcs = ends[first + length - 1] ^ shifted(start[first], run)
            self.use((crcs % np.uint32(self.buckets)).astype(np.int64), docs[first])
        self.old = min(self.longest - 1, len(sizes))
        keep = len(sizes) - self.old
        self.starts, self.behind, self.sizes, self.docs = [start[keep:]], [behind[keep:]], [sizes[keep:]], [docs[keep:]]
        self.n = self.old


def bucket_counts(frame: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): features of all texts per bucket, buckets without any left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)

        def use(found, _):
            total[:] += np.bincount(found, minlength=buckets)

        doc = 0
        scan = _Scan(use, buckets, longest)
        for batch in batches:
            for text in batch.column(0):
                scan.add(doc, text.as_py())
                doc += 1
        scan.flush()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = frame.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket from two tables of bucket counts: thousandths of the log of the smoothed ratio, rounded down."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
    both = both.join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0)
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    double = lambda x: F.col(x).cast("double")
    ratio = (double("t") + 1) * (double("all_s") + buckets) / ((double("s") + 1) * (double("all_t") + buckets))
    return both.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))  # one row of sums


def weighed(
    frame: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST
) -> DataFrame:
    """(key, n_words, n_features, weight): the gains of all features of a text, summed up."""
    kind = frame.schema[key].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows, np.int64)

            def use(found, docs, weight=weight):
                if len(docs):
                    upto = np.concatenate([[0], np.cumsum(gain[found])])
                    edge = np.flatnonzero(np.diff(docs, prepend=-1))
                    weight[docs[edge]] += upto[np.append(edge[1:], len(docs))] - upto[edge]

            scan = _Scan(use, len(gain), longest)
            n_words = np.array([scan.add(k, x.as_py()) for k, x in enumerate(batch.column(1))], np.int64)
            scan.flush()
            n = sum(np.maximum(n_words - k, 0) for k in range(longest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n), pa.array(weight)], ["key", "n_words", "n_features", "weight"]
            )

    texts = frame.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(weigh, f"key {kind}, n_words long, n_features long, weight long").withColumnRenamed("key", key)


def noise(key: str, seed: int) -> Column:
    """Seeded Gumbel noise of a key in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def drawn(weights: DataFrame, percent: int, least_words: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Adds score, and rank 1, 2, ... to the `percent` % highest scores among documents of least_words words; null to the others."""
    scored = weights.withColumn("score", F.col("weight") + noise(key, seed))
    last = F.col(key).isNull()
    dealt = scored.repartitionByRange(F.col("n_words") < least_words, F.desc("score"), last, key)
    dealt = written(dealt.withColumn("range", F.spark_partition_id()), "scores")
    able = dealt.filter(F.col("n_words") >= least_words)
    take = percent * able.count() // 100
    order = F.struct((-F.col("score")).alias("s"), last.alias("l"), F.col(key).alias("k"))
    ranked = numbered(able, order, F.col("range"), "place")
    rank = F.when(F.col("place") < take, F.col("place") + 1)
    others = dealt.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).select(others.columns).unionByName(others).drop("range")


def resampled(
    frame: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, key: str = "doc_id", text: str = "text", seed: int = 42
) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row; `target` has the same text column."""
    ratio = gains(bucket_counts(frame, text), bucket_counts(target, text))
    table = np.zeros(BUCKETS, np.int64)
    for row in ratio.collect():  # BUCKETS rows
        table[row.bucket] = row.gain
    return drawn(weighed(frame, table, key, text), percent, least_words, key, seed)
