"""Phrases of two and three words that hold together, from count streams in prefix and in suffix order.

Texts (A-Z lower-cased) are split at [.,;:!?\\x0A-\\x0D] into pieces and those into words [^\\x20\\x09]+. n-grams are counted by task in
numpy, blocks of words at a time, and the blocks' counts summed by Spark. Lengths are counted one after the other: an n-gram can only occur `least` times if
both its parts do, so the next length passes over those whose parts are not marked in a bit filter of 2 ** FILTER bits. The filter has that size whatever the
corpus; a false mark costs a row and changes nothing.

Estimation works on streams of the frequent n-grams of all lengths. In prefix order (words from the left, the shorter first) every n-gram
stands behind its first words, so one pass that carries the last shorter rows along merges each phrase with the counts of its left parts, and
each part with its most frequent extension. In suffix order (words from the right) the same pass gives the right parts. Streams are cut into ranges of about
RANGE rows by sampled bounds; a row whose extensions go on in the next ranges is copied there, at most two rows a bound, so a first word
with most of the phrases is many ranges. Nothing is looked up by hash in this part.

Then scores by exact decimal arithmetic, the drop of phrases inside longer ones, and the first rows per language, first within slices of a language.

Null language: `und`, together with a language of that name. Null and empty texts have no words. Repeated rows count again. Ties: by the phrase. A
very long text is taken some MB at a time. Columns besides text and language are not read. An empty table gives an empty result.
"""

import string
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.shared import written
from moodstream.operators.ranking import top_per_group

#: Words and distinct words counted at once, bytes of a text split at once, rows given out at once.
BLOCK, DISTINCT, BYTES, ROWS = 1 << 20, 1 << 18, 1 << 20, 1 << 15
FILTER = 26
RANGE, SAMPLED = 1 << 18, 20
_BITS = 21  # of a word's number in a block

_CUT = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # between pieces; no word holds this byte
_PLAIN = bytes.maketrans(
    string.ascii_uppercase.encode() + _CUT + b"\t", string.ascii_lowercase.encode() + b"\n" * len(_CUT) + b" "
)
_ODD, _ODDER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, zlib.crc32(lang.encode("utf-8")))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * _ODD + second) * _ODDER


def _place(hashes: np.ndarray) -> np.ndarray:
    """Bit of the filter."""
    return ((hashes * _ODD) >> np.uint64(64 - FILTER)).astype(np.int64)


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _place(hashes)
    return (marks[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class _Block:
    """Words of one language that wait to be counted."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)
        self.numbers[_MARK]
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.n += len(words)


def _counted(lang: str, block: _Block, n: int, marks: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of a block's n-grams; for n = 1 also a row without phrase, the number of all words."""
    ids, words = np.concatenate(block.parts), list(block.numbers)
    names = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
    if n == 1:
        found = np.bincount(ids, minlength=len(words))
        keys, counts = np.arange(1, len(words)), found[1:]
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([int(counts.sum())])], ["lang", "phrase", "n"])
    else:
        hashes = np.fromiter((_word_hash(lang, x) for x in words), np.uint64, len(words))
        if n == 2:
            known = _marked(marks, hashes)
            known[0] = False
            good = known[ids[:-1]] & known[ids[1:]]
            key = ids[:-1] << _BITS | ids[1:]
        else:
            pairs = (ids[:-1] != 0) & (ids[1:] != 0)
            at = np.flatnonzero(pairs)
            pairs[at] = _marked(marks, _pair_hash(hashes[ids[at]], hashes[ids[at + 1]]))
            good = pairs[:-1] & pairs[1:]
            key = (ids[:-2] << _BITS | ids[1:-1]) << _BITS | ids[2:]
        keys, counts = np.unique(key[good], return_counts=True)
    for first in range(0, len(keys), ROWS):
        part = keys[first : first + ROWS]
        numbers = [part >> (_BITS * k) & ((1 << _BITS) - 1) for k in reversed(range(n))]
        phrase = pc.binary_join_element_wise(*(names.take(pa.array(x)) for x in numbers), " ")
        rows = [pa.array([lang] * len(part), pa.string()), phrase, pa.array(counts[first : first + ROWS].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(rows, ["lang", "phrase", "n"])


def _slices(text: str) -> Iterator[list[bytes]]:
    """Words of a text and marks between its pieces, some MB at a time, and a mark at the end."""
    raw, at = text.encode("utf-8").translate(_PLAIN), 0
    while at < len(raw):
        end = raw.find(b" ", at + BYTES) if len(raw) - at > BYTES else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].replace(b"\n", b" \xff ").split()
        at = end
    yield [_MARK]


def phrase_counts(frame: DataFrame, n: int, marks: np.ndarray | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, n) of all n-grams inside pieces whose parts are marked; for n = 1 of all words, and of no phrase: all words together."""

    def count_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Block] = defaultdict(_Block)

        def out(going_on: str | None = None) -> Iterator[pa.RecordBatch]:
            """Count all blocks; of the text being read keep the words with which an n-gram may go on."""
            tail: list[bytes] = []
            for name, block in blocks.items():
                if name == going_on and n > 1:
                    words, last = list(block.numbers), np.concatenate(block.parts[-n:])[1 - n :]
                    tail = [words[x] for x in last]
                yield from _counted(name, block, n, marks)
            blocks.clear()
            if tail:
                blocks[going_on].add(tail)

        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1), strict=True):
                value, name = value.as_py(), name.as_py()
                if not value:
                    continue
                name = "und" if name is None else name
                for words in _slices(value):
                    blocks[name].add(words)
                    if sum(b.n for b in blocks.values()) >= BLOCK or len(blocks[name].numbers) >= DISTINCT:
                        yield from out(name)
        yield from out()

    read = frame.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return read.mapInArrow(count_, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def marks_of(frequent: DataFrame, n: int) -> np.ndarray:
    """The filter of (lang, phrase) rows of n words: 2 ** FILTER bits."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x.as_py(), y.as_py().encode("utf-8").split(b" ")) for x, y in zip(batch.column(0), batch.column(1), strict=True)]
            columns = [np.fromiter((_word_hash(x, y[k]) for x, y in rows), np.uint64, len(rows)) for k in range(n)]
            at = _place(columns[0] if n == 1 else _pair_hash(*columns))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["at", "bit"])

    bits = frequent.select("lang", "phrase").mapInArrow(places, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits"))
    marks = np.zeros(1 << (FILTER - 6), np.int64)
    rows = bits.toArrow()  # at most as many rows as the filter has numbers
    marks[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return marks.view(np.uint64)


def _key(lang: str, phrase: str, reverse: bool) -> tuple[bytes, ...]:
    words = phrase.encode("utf-8").split(b" ")
    return (lang.encode("utf-8"), *(reversed(words) if reverse else words))


def _bounds(stream: DataFrame, ranges: int, rows: int, reverse: bool) -> list[tuple[bytes, ...]]:
    """Keys between ranges, from a sample of about SAMPLED rows a range, a million at most, chosen by checksum."""
    wanted = min(SAMPLED * ranges, 1_000_000)
    some = stream.filter(F.crc32(F.concat_ws(" ", "lang", "phrase")) % max(1, rows // wanted) == 0).select("lang", "phrase")
    keys = sorted({_key(x, y, reverse) for x, y in some.toLocalIterator()})
    return [keys[len(keys) * k // ranges] for k in range(1, ranges)] if keys else []


def _merged(stream: DataFrame, bounds: list[tuple[bytes, ...]], reverse: bool, names: tuple[str, str, str]) -> DataFrame:
    """The stream in prefix (or suffix) order, each row with the counts of its first (last) one and two words and of its most frequent extension."""
    from bisect import bisect_left, bisect_right

    columns = stream.columns

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                key = _key(lang, phrase, reverse)
                first = bisect_right(bounds, key)
                ranges.append((first, bisect_left(bounds, (*key, b"\xff")) if len(key) < 4 else first))
            low, high = np.array(ranges, np.int64).reshape(-1, 2).T
            row = np.repeat(np.arange(len(low)), high - low + 1)
            place = np.arange(len(row)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[row]
            part = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(place)], [*columns, "range"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        words, n = rows["words"].to_numpy(), rows["n"].to_numpy()
        here = np.arange(len(n))
        last = {k: np.maximum.accumulate(np.where(words == k, here, 0)) for k in (1, 2)}
        longer = np.zeros(len(n), np.int64)
        three = np.flatnonzero(words == 3)
        np.maximum.at(longer, last[2][three], n[three])
        out = rows.drop_columns(["range"])
        for name, values in zip(names, (n[last[1]], n[last[2]], longer), strict=True):
            out = out.append_column(name, pa.array(values))
        yield from out.to_batches(max_chunksize=ROWS)

    own = "lang string, phrase string, words int, n long" + "".join(f", {x} long" for x in columns[4:])
    by = F.split("phrase", " ")
    spread = stream.mapInArrow(dealt, own + ", range long")
    ordered = spread.repartitionById(len(bounds) + 1, F.col("range").cast("int"))
    ordered = ordered.sortWithinPartitions("lang", F.reverse(by) if reverse else by)
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    schema = pa.schema([(x, kinds[kind]) for x, kind in ordered.dtypes])
    return ordered.mapInArrow(merged, own + "".join(f", {x} long" for x in names))


def _ranges(rows: int) -> int:
    return max(1, -(-rows // RANGE))


def scored(frequent: DataFrame, rows: int, share: int = 50, ranges: int | None = None) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all phrases of (lang, phrase, words, n) that are not inside a longer one with `share` % of their count."""
    ranges = ranges or _ranges(rows)
    left = _merged(frequent, _bounds(frequent, ranges, rows, False), False, ("first", "first_two", "to_right"))
    both = _merged(left, _bounds(frequent, ranges, rows, True), True, ("last", "last_two", "to_left"))
    counts = {x: F.max(x).alias(x) for x in ("n", "first", "first_two", "last", "last_two")}
    longer = F.greatest(F.max("to_right"), F.max("to_left")).alias("longer")
    phrases = both.filter("words > 1").groupBy("lang", "phrase", "words").agg(*counts.values(), longer)  # copies of a row become one
    phrases = phrases.filter(F.lit(100) * F.col("longer") < F.lit(share) * F.col("n"))
    cut = lambda l, r: f"struct(cast(1000000 as decimal(38,0)) * n * n div (cast({l} as decimal(38,0)) * {r}) as score, {l} as l, {r} as r)"
    cuts = phrases.withColumns({"one": F.expr(cut("first", "if(words = 2, last, last_two)")), "two": F.expr(cut("first_two", "last"))})
    best = F.when((F.col("words") == 3) & (F.col("two.score") < F.col("one.score")), F.col("two")).otherwise(F.col("one"))
    return cuts.select("lang", "phrase", F.col("n").alias("a"), best.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    frame: DataFrame, least: int = 10, share: int = 50, first: int = 2000, text: str = "text", lang: str = "lang", ranges: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `first` best phrases of every language."""
    words = written(phrase_counts(frame, 1, None, text, lang), "words")
    totals = words.filter("phrase is null").select("lang", F.col("n").alias("total"))
    enough = lambda counts, k: counts.filter(F.col("phrase").isNotNull() & (F.col("n") >= least)).select(
        "lang", "phrase", F.lit(k).cast("int").alias("words"), "n"
    )
    one = enough(words, 1)
    two = written(enough(phrase_counts(frame, 2, marks_of(one, 1), text, lang), 2), "pairs")
    three = enough(phrase_counts(frame, 3, marks_of(two, 2), text, lang), 3)
    frequent = written(one.unionByName(two).unionByName(three), "frequent")
    rows = frequent.count()
    found = scored(frequent, rows, share, ranges)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = 8 * (ranges or _ranges(rows))
    some = top_per_group(found.withColumn("slice", F.crc32("phrase") % slices), ["lang", "slice"], order, first).drop("slice")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = some.withColumn("rank", rank).filter(F.col("rank") <= first).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
