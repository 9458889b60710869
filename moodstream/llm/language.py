"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts, in every task, the hashed 1- to 3-grams of the lower-cased code points of each labelled text
into one array per language and sends out (language, bucket, count); Spark adds these up. All given
labelled rows are counted. The model is a matrix of at most `max_languages` x BUCKETS log probabilities
(64 x 16,384 doubles are 8 MB whatever the corpus), so it may be broadcast. `learned_blocks` makes as many of them as it takes for all label values, and
`identified` weighs a text against one after the other; `learned` is the one of the labels with the most texts.

Scoring is row-local: the non-zero buckets of many texts form one sparse block (positions, counts, row starts) that
numpy weighs against the matrix and sums by row. The score is the posterior probability of the best language.

A null text, a text without a letter, and every text if nothing could be learned give `und` with score 0. Ties go to
the label first in code point order. Rows with null label or text, or with no letter, teach nothing. Long texts are
taken in pieces of PIECE code points, whole. Columns not named are not read; repeated rows count as often as they
occur; an empty table gives an empty result.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from moodstream.llm.shared import written

UNKNOWN = "und"
LONGEST, BUCKETS = 3, 1 << 14
SMOOTHING = 0.5
PIECE = 1 << 20
#: Sparse entries weighed at once, and languages counted at once in a task.
BLOCK, HELD = 1 << 18, 64

_LETTER = regex.compile(r"\p{L}")
_FACTOR, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(50)  # 64 bits less those of a bucket number


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the n-grams of a text, with a space at both ends."""
    counts = np.zeros(BUCKETS, np.int64)
    whole = f" {text.lower()} "
    for start in range(0, len(whole), PIECE):
        codes = np.frombuffer(whole[start : start + PIECE + LONGEST - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
        rolled = codes
        for n in range(1, LONGEST + 1):
            if n > 1:
                if len(codes) < n:
                    break
                rolled = rolled[:-1] * _FACTOR + codes[n - 1 :]
            own = (rolled[:PIECE] + np.uint64(n)) * _SPREAD >> _SHIFT
            counts += np.bincount(own.astype(np.int64), minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) of a frame (text, lang); bucket -1 counts texts."""

    def packed(sums: dict) -> Iterator[pa.RecordBatch]:
        for lang, (texts, counts) in sums.items():
            own = np.flatnonzero(counts)
            buckets, n = np.append(own, -1), np.append(counts[own], texts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(buckets), pa.array(n)], ["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for text, lang in zip(*(batch.column(i) for i in (0, 1)), strict=True):
                text, lang = text.as_py(), lang.as_py()
                if has_letter(text):
                    texts, counts = sums.get(lang, (0, 0))
                    sums[lang] = texts + 1, counts + bucket_counts(text)
                    if len(sums) > HELD:
                        yield from packed(sums)
                        sums = {}
        yield from packed(sums)

    known = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counted = known.filter("text is not null and lang is not null").mapInArrow(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Labels in code point order, BUCKETS x labels log probabilities, and log priors."""

    def __init__(self, labels: list[str], weights: np.ndarray, priors: np.ndarray):
        self.labels, self.weights, self.priors = labels, weights, priors

    def predictions(self, texts: list[str | None]) -> Iterator[tuple[str, float, float]]:
        """Best label of each text, in order, its log weight, and the sum of all labels' weights relative to it."""
        at, n, starts, known, size = [], [], [], [], 0
        for text in texts:
            known.append(bool(self.labels) and has_letter(text))
            if known[-1]:
                counts = bucket_counts(text)
                own = np.flatnonzero(counts)
                starts.append(size)
                at.append(own)
                n.append(counts[own])
                size += len(own)
            if size >= BLOCK:
                yield from self._scored(at, n, starts, known)
                at, n, starts, known, size = [], [], [], [], 0
        yield from self._scored(at, n, starts, known)

    def _scored(self, at, n, starts, known) -> Iterator[tuple[str, float, float]]:
        if starts:
            terms = self.weights[np.concatenate(at)] * np.concatenate(n)[:, None]
            logs = np.add.reduceat(terms, starts, axis=0) + self.priors
            best = logs.argmax(axis=1)
            most = logs.max(axis=1)
            total = np.exp(logs - most[:, None]).sum(axis=1)
        row = 0
        for k in known:
            if k:
                yield self.labels[best[row]], float(most[row]), float(total[row])
                row += 1
            else:
                yield UNKNOWN, 0.0, 0.0


def learned(counts: DataFrame, max_languages: int = 64) -> Model:
    """The model of the most frequent labels from `gram_counts`."""
    texts = counts.filter("bucket = -1").orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    return _model(counts, texts, sum(row.n for row in texts))


def learned_blocks(counts: DataFrame, in_block: int = 64) -> Iterator[Model]:
    """Models of all labels, `in_block` at a time in code point order; at least one."""
    texts = counts.filter("bucket = -1")
    every = texts.agg(F.sum("n")).first()[0] or 0
    last: str | None = None
    while True:
        rest = texts if last is None else texts.filter(F.col("lang") > last)
        rows = rest.orderBy("lang").limit(in_block).collect()
        if rows or last is None:
            yield _model(counts, rows, every)
        if len(rows) < in_block:
            return
        last = rows[-1].lang


def _model(counts: DataFrame, texts: list[Row], every: int) -> Model:
    """The model of some labels; `every`: texts of all labels."""
    texts = sorted(texts, key=lambda row: row.lang)
    labels = [row.lang for row in texts]
    grams = np.zeros((BUCKETS, len(labels)))
    for number, label in enumerate(labels):  # at most BUCKETS rows each
        own: list[Row] = counts.filter((F.col("bucket") >= 0) & (F.col("lang") == label)).collect()
        grams[[row.bucket for row in own], number] = [row.n for row in own]
    smooth = grams + SMOOTHING
    share = np.array([row.n for row in texts], float)
    return Model(labels, np.log(smooth / smooth.sum(axis=0)), np.log(share / every))


def identified(frame: DataFrame, model: Model | Iterable[Model], text: str = "text") -> DataFrame:
    """The other columns of the frame with lang_pred and score in place of the text.

    Each further model is one more pass over the texts, written in between, so that no task holds two. A column named lang_pred or score is replaced.
    """
    rest = [x for x in frame.columns if x not in (text, "lang_pred", "score")]
    out = frame.select(F.struct(*rest).alias("row"), F.col(text).cast("string").alias("text"), F.lit(None).cast(_BEST).alias("best"))
    for number, block in enumerate([model] if isinstance(model, Model) else model):
        out = _weighed(written(out, "languages") if number else out, block)
    known = F.col("best.total") > 0
    score = F.when(known, 1 / F.col("best.total")).otherwise(0.0)
    return out.select("row.*", F.col("best.lang").alias("lang_pred"), score.alias("score"))


_BEST = "struct<lang:string,log:double,total:double>"


def _weighed(frame: DataFrame, model: Model) -> DataFrame:
    """(row, text, best) with the best label among those so far and the model's."""
    held = frame.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.priors))
    kinds = pa.struct([("lang", pa.string()), ("log", pa.float64()), ("total", pa.float64())])

    def better(old: dict | None, new: tuple[str, float, float]) -> tuple[str, float, float]:
        if old is None or old["total"] == 0:
            return new
        if new[2] == 0:
            return old["lang"], old["log"], old["total"]
        first, other = ((old["lang"], old["log"], old["total"]), new) if old["log"] >= new[1] else (new, (old["lang"], old["log"], old["total"]))
        return first[0], first[1], first[2] + other[2] * math.exp(other[1] - first[1])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            found = own.predictions(batch.column(1).to_pylist())
            best = [better(old.as_py(), new) for old, new in zip(batch.column(2), found, strict=True)]
            rows = pa.array([dict(zip(("lang", "log", "total"), x, strict=True)) for x in best], kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["row", "text", "best"])

    return frame.mapInArrow(weigh, frame.schema)
