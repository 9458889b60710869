"""Byte-level BPE with Spark's higher-order functions.

1. Texts are cut by the tokenizer's pattern, once. A cut that is a token is its id. Any other gets a number within its block, some MB of texts of one
   task, and the block's distinct words are kept beside it. So a text becomes an array of ids and numbers. Both go to one table, bucketed by block.
2. The distinct words of all blocks are folded, each once: the bytes of a word are an array (of hexadecimal strings), and higher-order functions merge the neighbours
   of lowest rank, leftmost first, until no pair has a rank. Ranks are a constant map in the expression, spread over small maps by checksum so that a lookup
   compares about one key. Words of over SHORT bytes are folded as one string whose rounds replace all pairs of the lowest rank at once, which is linear in a
   round and gives the same result if every token is made of tokens of lower rank; ranks of which that is not true are folded the first way only.
   For that the words are dealt and sorted once; the first row of a word is folded and the others take its ids.
3. Ids go back to their blocks, packed by task and block, and take the place of the numbers. Texts stay where their bucket is; a word travels
   once for each block it occurs in, so a frequent word is as many rows as there are blocks and never one for each occurrence.

Decoding turns ids into the bytes of their tokens and concatenates these pieces.

Nothing is collected, and only the vocabulary is held whole: in the plan for folding, and as a dictionary in each task that cuts. A text of over LONG
characters is cut piece by piece; its ids are one array. A word of very many bytes without a cut is the slow case: rounds times its length.

Null and empty texts: no ids. Columns not named are kept but not read; if one has the name asked for, the ids get that name with `_` behind it. Repeated rows
give equal rows; an empty table an empty result. Ties can't arise: ranks are distinct, and equal pairs merge from the left.
"""

import base64
import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from moodstream.llm.shared import new_folder

SHORT = 48
#: Characters of texts in a block and of a text that is cut piece by piece, words in a row, words whose ids are packed at once, and bytes of ids or numbers that leave a task at once.
BLOCK, LONG, WORDS, PACKED, SENT = 32 << 20, 1 << 22, 1 << 12, 1 << 16, 1 << 22
#: Characters of texts for a task that folds words. Each task gets a copy of the ranks, some 100,000 objects, so fewer tasks cost less.
FOLDED = 16 << 20
#: Rows of texts that go to a task that cuts at once: a batch is held by the JVM, on its way and in Python.
ROWS = 1 << 9
#: Numbers of words in a block begin here; ids are less.
OWN = 1 << 31
#: Most buckets that Spark allows by default.
MOST_BUCKETS = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines `base64 rank`; read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _table(entries: dict[str, object], kind: str) -> tuple[Column, int]:
    """A constant array of small maps, and its length."""
    width = max(1, len(entries))
    slots: list[dict[str, object]] = [{} for _ in range(width)]
    for key, value in entries.items():
        slots[zlib.crc32(key.encode("utf-8")) % width][key] = value
    return F.from_json(F.lit(json.dumps(slots, ensure_ascii=False, separators=(",", ":"))), f"array<map<string,{kind}>>"), width


def _found(table: tuple[Column, int], key: Column) -> Column:
    slots, width = table
    return F.try_element_at(F.get(slots, (F.crc32(key) % width).cast("int")), key)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value evaluated, and a constant written into the plan, once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Tokenizer:
    """Expressions for one vocabulary and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ranks = pattern, ranks
        self.nested = all(len(t) == 1 or any(max(ranks.get(t[:k], n), ranks.get(t[k:], n)) < n for k in range(1, len(t))) for t, n in ranks.items())
        self.by_bytes = _table({k.hex(): v for k, v in ranks.items()}, "int")
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        constant = lambda rows: F.from_json(F.lit(json.dumps(rows)), "array<string>")
        self.pieces = constant([x.hex() for x in self.bytes_of])
        self.little_endian = constant([i.to_bytes(4, "little").hex() for i in range(len(self.bytes_of))])

    def _fold_short(self, ranks: tuple[Column, int], digits: Column) -> Column:
        """Ids of up to SHORT bytes. parts and the ranks of their pairs are kept side by side; a merge asks for two new ranks only."""
        n = (F.length(digits) / 2).cast("int")
        bytes_ = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, 2 * i - 1, F.lit(2)))
        one = lambda a, b: F.array(_found(ranks, F.concat(a, b)))
        none = F.array().cast("array<int>")

        def step(state: Column, _) -> Column:
            parts, pairs, least = state["parts"], state["pairs"], state["least"]

            def merged(k: Column) -> Column:
                new = F.concat(F.get(parts, k - 1), F.get(parts, k))
                rest = F.concat(
                    F.when(k > 1, F.concat(F.slice(pairs, F.lit(1), F.greatest(k - 2, F.lit(0))), one(F.get(parts, k - 2), new))).otherwise(none),
                    F.when(k + 1 < F.size(parts), F.concat(one(new, F.get(parts, k + 1)), F.slice(pairs, k + 2, F.size(pairs)))).otherwise(none),
                )
                left = F.concat(F.slice(parts, F.lit(1), k - 1), F.array(new), F.slice(parts, k + 2, F.size(parts)))
                return _let(rest, lambda r: F.struct(left.alias("parts"), r.alias("pairs"), F.array_min(r).alias("least")))

            return F.when(least.isNull(), state).otherwise(_let(F.array_position(pairs, least).cast("int"), merged))

        def folded(parts: Column) -> Column:
            pairs = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts)), lambda a, b: _found(ranks, F.concat(a, b)))
            start = _let(pairs, lambda r: F.struct(parts.alias("parts"), r.alias("pairs"), F.array_min(r).alias("least")))
            return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: F.transform(s["parts"], lambda x: _found(ranks, x)))

        return _let(bytes_, folded)

    def _fold_long(self, ranks: tuple[Column, int], digits: Column) -> Column:
        split = lambda s: F.regexp_extract_all(s, F.lit("[0-9a-f]+"), F.lit(0))

        def step(state: Column, _) -> Column:
            def by_rank(least: Column) -> Column:
                old = F.concat(F.lit("("), least["a"], F.lit(")("), least["b"], F.lit(")"))
                new = F.concat(F.lit("("), least["a"], least["b"], F.lit(")"))
                more = F.struct(F.replace(state["text"], old, new).alias("text"), F.lit(False).alias("done"))
                return F.when(least.isNull(), F.struct(state["text"].alias("text"), F.lit(True).alias("done"))).otherwise(more)

            pair = lambda a, b: F.struct(_found(ranks, F.concat(a, b)).alias("rank"), a.alias("a"), b.alias("b"))
            pairs = _let(
                split(state["text"]),
                lambda p: F.array_min(F.filter(F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), pair), lambda x: x["rank"].isNotNull())),
            )
            return F.when(state["done"], state).otherwise(_let(pairs, by_rank))

        start = F.struct(F.regexp_replace(digits, "(..)", "($1)").alias("text"), F.lit(False).alias("done"))
        text = F.aggregate(F.sequence(F.lit(1), (F.length(digits) / 2).cast("int")), start, step, lambda s: s["text"])
        return F.transform(split(text), lambda x: _found(ranks, x))

    def ids_of(self, ranks: tuple[Column, int], word: Column) -> Column:
        """Ids of one non-empty word: its own if it is a token, else by folding merges over its bytes."""
        return _let(
            F.lower(F.hex(word)),
            lambda digits: F.coalesce(
                F.nullif(F.array(_found(ranks, digits)), F.array(F.lit(None).cast("int"))),
                F.when(F.length(digits) <= 2 * SHORT, self._fold_short(ranks, digits)).otherwise(
                    (self._fold_long if self.nested else self._fold_short)(ranks, digits)
                ),
            ),
        )

    def folded(self, word: Column) -> Column:
        """Ids of one word."""
        return _let(self.by_bytes[0], lambda slots: self.ids_of((slots, self.by_bytes[1]), word))

    def as_bytes(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit numbers."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.little_endian, i)), ""))

    def decoded(self, ids: Column) -> Column:
        """The bytes of the tokens, in a row."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i)), ""))


@cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file."""
    return Tokenizer(read_ranks(path), pattern)


class _Block(dict):
    """Ids of cuts; a cut that is no token gets the next number."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.name, self.words, self.size = int.from_bytes(os.urandom(8), "little", signed=True), [], 0

    def __missing__(self, word: str) -> int:
        number = self[word] = OWN + len(self.words)
        self.words.append(word)
        return number


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most, for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, min(before, rows) if before > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _cut(frame: DataFrame, tokens: Tokenizer, text: str, keep: list[str]) -> tuple[DataFrame, int]:
    """(block, row, places, first, words) in buckets by block: a row of the frame with its ids and numbers, or words of a block; and the tasks to fold the words in."""
    pattern, known = tokens.pattern, {}
    for token, rank in tokens.ranks.items():
        try:
            known[token.decode()] = rank
        except UnicodeDecodeError:  # no cut of a text
            continue
    row = F.struct(*(F.col(f"`{x}`") for x in keep)).alias("row")
    given = frame.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    row_type = given.schema["row"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, block, kind = regex.compile(pattern), _Block(known), None
        names = ["block", "row", "places", "first", "words"]

        def rows(own: pa.Array, places: list[bytes]) -> pa.RecordBatch:
            n = len(own)
            columns = [pa.array([block.name] * n, pa.int64()), own, pa.array(places, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names)

        def words() -> pa.RecordBatch:
            first = range(0, len(block.words), WORDS)
            n = len(first)
            parts = pa.array([block.words[x : x + WORDS] for x in first], pa.list_(pa.string()))
            columns = [pa.array([block.name] * n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, pa.binary()), pa.array(first, pa.int32()), parts]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch.column(0).type
            start, places, held = 0, [], 0
            for i, value in enumerate(batch.column(1)):
                own = value.as_py() or ""
                found = cuts.findall(own) if len(own) < LONG else (x[0] for x in cuts.finditer(own))
                places.append(np.fromiter(map(block.__getitem__, found), "<u4").tobytes())
                block.size += len(own)
                held += len(places[-1])
                if block.size >= BLOCK or held >= SENT:
                    yield rows(batch.column(0).slice(start, i + 1 - start), places)
                    start, places, held = i + 1, [], 0
                if block.size >= BLOCK:
                    yield words()
                    block = _Block(known)
            yield rows(batch.column(0).slice(start), places)
        if block.words:
            yield words()

    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("row", row_type),
            StructField("places", BinaryType()),
            StructField("first", IntegerType()),
            StructField("words", ArrayType(StringType())),
        ]
    )
    spark = frame.sparkSession
    size = frame.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, 8 * size // BLOCK))
    folding = max(frame.sparkSession.sparkContext.defaultParallelism, size // FOLDED)
    coded = given.mapInArrow(cut, schema)
    name = f"bpe_{uuid.uuid4().hex}"
    with _batches_of(spark, ROWS):
        coded.write.bucketBy(buckets, "block").option("path", new_folder(spark, "bpe")).option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the table is an external one
    return stored, folding


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(within, answers) of (block, place, ids): places, numbers of ids and ids of many words of a block, compressed."""
    coder, held, size = zstandard.ZstdCompressor(level=3), [], 0

    def packed() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        block, place = (table[x].to_numpy() for x in ("block", "place"))
        lists = table["ids"].combine_chunks()
        sizes, values = np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy()
        order = np.lexsort([place, block])
        starts = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1]))
        n = sizes[order]
        ends = np.cumsum(n)
        values = values[np.repeat((np.cumsum(sizes) - sizes)[order] - ends + n, n) + np.arange(n.sum())]
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            steps = np.diff(place[order[a:b]], prepend=0)
            parts = np.array([b - a]), steps, n[a:b], values[ends[a] - n[a] : ends[b - 1]]
            # bytes of equal weight side by side
            out.append(coder.compress(b"".join(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in parts)))
        return pa.RecordBatch.from_arrays([pa.array(block[order[starts]]), pa.array(out, pa.binary())], ["within", "answers"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PACKED:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()


def _unpacked(answers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, numbers of ids, ids) of all answers of a block."""
    decoder, found = zstandard.ZstdDecompressor(), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))]

    def numbers(raw: bytes) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()

    for answer in answers:
        raw = decoder.decompress(answer)
        n = 4 * int(numbers(raw[:4])[0])
        found.append((np.cumsum(numbers(raw[4 : 4 + n]), dtype=np.int64), numbers(raw[4 + n : 4 + 2 * n]).astype(np.int64), numbers(raw[4 + 2 * n :])))
    return tuple(np.concatenate([x[i] for x in found]) for i in range(3))


def _encoded(frame: DataFrame, tokens: Tokenizer, text: str, keep: list[str], digest: bool) -> DataFrame:
    """(row, ids) or, for digests, (row, raw, back): ids as little-endian unsigned 32-bit numbers, and the bytes they decode to."""
    stored, tasks = _cut(frame, tokens, text, keep)
    texts = stored.filter(F.col("words").isNull()).select("block", "row", "places")
    own = stored.filter(F.col("words").isNotNull()).select("block", "first", F.posexplode("words").alias("at", "word"))
    dealt = own.select("block", (F.col("first") + F.col("at")).alias("place"), "word").repartition(tasks, "word")
    rows = Window.partitionBy("word").orderBy("block")
    once = dealt.withColumn("nth", F.row_number().over(rows)).withColumn("ids", F.when(F.col("nth") == 1, tokens.folded(F.col("word"))))
    of_all = F.first("ids", ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    answers = once.select("block", "place", of_all.alias("ids")).mapInArrow(_packed, "within long, answers binary")
    pieces = tokens.bytes_of if digest else None

    def filled(left: pa.Table, right: pa.Table) -> pa.Table:
        place, sizes, values = _unpacked([x.as_py() for x in right["answers"]])
        order = np.argsort(place)
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        out, back, size, parts = [], [], 0, []

        def part() -> pa.Table:
            row = left["row"].slice(sum(map(len, parts)), len(out))
            if digest:
                return pa.table({"row": row, "raw": pa.array(out, pa.binary()), "back": pa.array(back, pa.binary())})
            return pa.table({"row": row, "ids": pa.array(out, pa.list_(pa.int32()))})

        for value in left["places"]:
            places = np.frombuffer(value.as_buffer(), "<u4")
            word = np.flatnonzero(places >= OWN)
            number = (places[word] - OWN).astype(np.int64)
            n = np.ones(len(places), np.int64)
            n[word] = sizes[number]
            ends = np.cumsum(n)
            ids = np.repeat(places, n)
            length = n[word]
            inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            ids[np.repeat(ends[word] - length, length) + inside] = values[np.repeat(starts[number], length) + inside]
            out.append(ids.astype("<u4").tobytes() if digest else ids.astype(np.int32))
            if digest:
                back.append(b"".join(map(pieces.__getitem__, ids.tolist())))
            size += ids.nbytes
            if size >= SENT:  # a block in one batch would be held whole three times, in Python, on its way and in the JVM
                parts.append(part())
                out, back, size = [], [], 0
        return pa.concat_tables([*parts, part()])

    fields = [StructField("raw", BinaryType()), StructField("back", BinaryType())] if digest else [StructField("ids", ArrayType(IntegerType()))]
    schema = StructType([StructField("row", stored.schema["row"].dataType), *fields])
    return texts.groupBy("block").cogroup(answers.groupBy("within")).applyInArrow(filled, schema)


def with_ids(frame: DataFrame, tokens: Tokenizer, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds the ids, array<int>, as column `to`."""
    while to.lower() in map(str.lower, frame.columns):
        to += "_"
    return _encoded(frame, tokens, text, frame.columns, False).select("row.*", F.col("ids").alias(to))


def encoded_bytes(frame: DataFrame, tokens: Tokenizer, text: str, keep: list[str]) -> DataFrame:
    """The columns `keep`, in a struct `row`, with `raw`, the ids as little-endian unsigned 32-bit numbers, and `back`, the bytes they decode to."""
    return _encoded(frame, tokens, text, keep, True)
