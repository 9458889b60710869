"""Quality rules by repetition coverage.

Every text is taken apart into words, [^\\x20\\x09-\\x0D]+. Rolling hashes over the word hashes give the
hashes of all windows of 3 and of 5 to 10 words in numpy; a sort of one length finds its repeated windows.
A word is covered at a length if a later occurrence of a repeated window holds it, and the characters of
covered words, each counted once, are held against all word characters. Lines equal to an earlier line are
held against all lines and characters alike.

Row-local: nothing is shuffled, and memory is a few arrays of one text's words.

Null and empty texts, and texts of white space, have no words: all counts are 0 and the base rules reject
them. Columns besides the key and the text are not read, so extra or clashing names do no harm; repeated rows
give repeated results; an empty table gives an empty result.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"
LENGTHS = (5, 6, 7, 8, 9, 10)

#: Highest share, in percent, of word characters inside repeated windows of so many words
#: (the repetition rules of the Gopher paper, Rae et al. 2021).
MOST_COVERED = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Highest share, in percent, of lines and of characters that repeat an earlier line.
MOST_LINES, MOST_LINE_CHARS = 30, 20
#: Base rules: least number of words, highest percentage of words in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _later(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of values that occurred before, and of all that occur twice or more."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return order[:0], order[:0]
    later = order[1:][same]
    return later, np.union1d(later, order[:-1][same])


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1
    edge[starts + length] -= 1
    return np.cumsum(edge[:n]) > 0


def measure(text: str | None) -> tuple[int, ...]:
    """Counts of one text in the order of COUNTS."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    raw = text.encode("utf-8")
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    distinct = set(lines)
    n_dup_lines = len(lines) - len(distinct)
    dup_line_chars = sum(map(len, lines)) - sum(map(len, distinct)) if n_dup_lines else 0
    chars = np.fromiter(map(len, words), np.int64, n)
    repeated, shares = 0, dict.fromkeys(LENGTHS, 0)
    if n > 3:
        base = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
        rolled = base
        for length in range(2, LENGTHS[-1] + 1):
            if n <= length:
                break
            rolled = rolled[:-1] * _FACTOR + base[length - 1 :]
            if length != 3 and length not in shares:
                continue
            later, every = _later(rolled)
            if not len(later):  # then no longer window repeats either
                break
            if length == 3:
                repeated = int(_covered(every, 3, n).sum())
            else:
                shares[length] = int(chars[_covered(later, length, n)].sum())
    return n, int(chars.sum()), n_symbols, n_dup_lines, repeated, len(lines), dup_line_chars, len(text), *shares.values()


COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines dup_line_chars n_text_chars".split()
    + [f"dup_chars_{n}" for n in LENGTHS]
)


def repetition_counts(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the counts of every text."""
    kind = frame.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (measure(x.as_py()) for x in batch.column(1))
            columns = np.array(list(rows), np.int64).reshape(batch.num_rows, len(COUNTS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(x)) for x in columns)], ["key", *COUNTS]
            )

    schema = f"key {kind}, " + ", ".join(f"{x} long" for x in COUNTS)
    counted = frame.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return counted.mapInArrow(count, schema).withColumnRenamed("key", key)


def judged(counts: DataFrame) -> DataFrame:
    """Counts with base_failed and kept."""
    repetitive = (100 * F.col("n_dup_lines") > MOST_LINES * F.col("n_lines")) | (
        100 * F.col("dup_line_chars") > MOST_LINE_CHARS * F.col("n_text_chars")
    )
    for length, most in MOST_COVERED.items():
        repetitive = repetitive | (100 * F.col(f"dup_chars_{length}") > most * F.col("word_chars"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return counts.withColumns({"base_failed": base_failed, "kept": ~base_failed & ~repetitive})


def keep_good(frame: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text passes all rules, with all their columns.

    The verdict is a column of a plain row-local function, so rows need no key.
    """

    @F.pandas_udf("boolean")
    def good(texts):
        import pandas as pd

        return pd.Series([passes(measure(x)) for x in texts], dtype=bool)

    return frame.filter(good(F.col(text).cast("string")))


def passes(counts: tuple[int, ...]) -> bool:
    """The verdict of `judged` for one text."""
    c = dict(zip(COUNTS, counts, strict=True))
    return not (
        c["n_words"] < LEAST_WORDS
        or 100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"]
        or 100 * c["n_dup_lines"] > MOST_LINES * c["n_lines"]
        or 100 * c["dup_line_chars"] > MOST_LINE_CHARS * c["n_text_chars"]
        or any(100 * c[f"dup_chars_{n}"] > most * c["word_chars"] for n, most in MOST_COVERED.items())
    )
