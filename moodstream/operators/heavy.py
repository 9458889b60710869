"""Frequent words by summaries that merge, without a shuffle of the rare ones.

A summary of a batch keeps at most `size` words with a lower count and one number, the slack: no word's true count is above its lower count (0 if
it isn't there) plus the slack, and the slack is at most the batch's words divided by size + 1. A task prunes as it reads (the Misra-Gries rule with weights:
subtract the count of the first word too many from all), and summaries are added: lower counts and slacks sum up. So summaries of tasks make one of a batch, and those of
batches one of any span of time, whatever the order.

What can be frequent is then known, a list of bounded length, and one more pass counts just these words exactly.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.streaming.folders import release, written

#: Words kept in a task before its summaries are given out.
HELD = 1 << 18
#: Rows that are added up by word before they come to a summary.
ADDED = 1 << 20
#: Candidates up to which they are sent to the words, not the words to them.
FEW = 1 << 20


def pruned(counts: dict[str, int], size: int) -> tuple[dict[str, int], int]:
    """At most `size` words of a summary, and what has been subtracted."""
    if len(counts) <= size:
        return counts, 0
    values = np.fromiter(counts.values(), np.int64, len(counts))
    less = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return {word: n - less for word, n in counts.items() if n > less}, less


def added(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """(by, word, n_sum) of (by, word, n), summed up by batch and word, within about so many rows at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).group_by(["by", "word"]).aggregate([("n", "sum")])
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).group_by(["by", "word"]).aggregate([("n", "sum")])


def cut_down(part: pa.Table, size: int) -> tuple[list[tuple], list[tuple]]:
    """`pruned` for all batches of (by, word, n_sum) at once: (by, word, count) of what is kept, and (by, subtracted, sum of all counts)."""
    codes = pa.concat_arrays(part["by"].chunks).dictionary_encode(null_encoding="encode")
    at, group, n = codes.dictionary.to_pylist(), codes.indices.to_numpy(), part["n_sum"].to_numpy()
    order = np.lexsort((-n, group))
    group, n = group[order], n[order]
    begins, ends = np.searchsorted(group, np.arange(len(at))), np.searchsorted(group, np.arange(len(at)), side="right")
    less = np.where(begins + size < ends, n[np.minimum(begins + size, len(n) - 1)], 0)
    kept = n > less[group]
    words = part["word"].take(pa.array(order[kept])).to_pylist()
    rows = [(at[k], word, x) for k, word, x in zip(group[kept].tolist(), words, (n - less[group])[kept].tolist(), strict=True)]
    return rows, list(zip(at, less.tolist(), np.add.reduceat(n, begins).tolist(), strict=True))


def summaries(words: DataFrame, size: int, by: str = "batch_ts", copies: str = "cnt") -> DataFrame:
    """(by, word, lower, slack, total) of (by, word, copies): rows of words with slack 0, and per batch a row without word that has the slack and the sum of copies.

    Rows of several tasks are not added up yet; `bounds` does that, also for rows of several batches.
    """
    kind = words.schema[by].dataType.simpleString()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, dict[str, int]] = {}
        slack: dict[object, int] = {}
        total: dict[object, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = []
            for at in total:
                counts, less = pruned(held.get(at, {}), size)
                rows += [(at, word, n, 0, 0) for word, n in counts.items()]
                rows.append((at, None, 0, slack.get(at, 0) + less, total[at]))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
            types = [time, pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["by", "word", "lower", "slack", "total"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)
            held.clear()
            slack.clear()
            total.clear()

        n_held, time = 0, None
        for part in added(batches, ADDED):
            time = part.schema.field("by").type
            rows, sums = cut_down(part, size)
            for at, less, n in sums:
                slack[at] = slack.get(at, 0) + less
                total[at] = total.get(at, 0) + n
            for at, word, n in rows:
                counts = held.setdefault(at, {})
                n_held += word not in counts
                counts[word] = counts.get(word, 0) + n
                if len(counts) > 2 * size:
                    before = len(counts)
                    held[at], less = pruned(counts, size)
                    slack[at] = slack.get(at, 0) + less
                    n_held -= before - len(held[at])
            if n_held > HELD:
                yield from out()
                n_held = 0
        if total:
            yield from out()

    rows = words.select(F.col(by).alias("by"), "word", F.col(copies).cast("bigint").alias("n"))
    return rows.mapInArrow(summarise, f"by {kind}, word string, lower bigint, slack bigint, total bigint").withColumnRenamed("by", by)


def bounds(parts: DataFrame, by: list[str]) -> DataFrame:
    """(by, word, lower, upper) of summaries added up; a word that is not there has at most the `slack` of its batch."""
    words = parts.filter("word is not null").groupBy(*by, "word").agg(F.sum("lower").alias("lower"))
    slacks = parts.groupBy(*by).agg(F.sum("slack").alias("slack"))
    joined = words.join(slacks, by) if by else words.withColumn("slack", slacks.select("slack").scalar())
    return joined.select(*by, "word", "lower", (F.col("lower") + F.col("slack")).alias("upper"))


def holds(batches: int, parts_of: int) -> bool:
    """Whether a task can hold the summaries of so many batches, so that `heavy_words` need not have its words dealt out by batch.

    A summary has twice its size of words before it is pruned.
    """
    return batches * 4 * parts_of <= HELD


def heavy_words(words: DataFrame, parts_of: int, by: str = "batch_ts", copies: str = "cnt") -> DataFrame:
    """(by, word, cnt): words that make up at least one of `parts_of` parts of a batch's words, with exact counts.

    Summaries of twice that many words find all of them. Only candidates are counted: at most one more a batch than a summary has words, since each makes up more than
    such a part of its batch by its lower count. The words themselves are read twice and not sent anywhere, unless there are more than FEW candidates.
    """
    parts = written(summaries(words, 2 * parts_of, by, copies), "summaries")
    totals = parts.groupBy(by).agg(F.sum("total").alias("total"))
    found = bounds(parts, [by]).join(totals, by)
    candidates = written(found.filter(F.col("upper") * parts_of >= F.col("total")).select(by, "word", "total"), "candidates")
    release(words.sparkSession)  # what the first reading has left
    if candidates.count() <= FEW:
        candidates = F.broadcast(candidates)
    exact = words.join(candidates, [by, "word"]).groupBy(by, "word").agg(F.sum(copies).alias("cnt"), F.first("total").alias("total"))
    return exact.filter(F.col("cnt") * parts_of >= F.col("total")).drop("total")
