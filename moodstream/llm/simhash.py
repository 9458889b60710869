"""SimHash fingerprints and exact linking of those within a few bits of each other.

Fingerprint: A-Z are lower-cased, words are [^\\x20\\x09-\\x0D]+, every run of `shingle` words (repeats included, joined by a
space; a shorter text as one run) is hashed with XXH64, seed 42, and a bit is set if it is set in over half of the
hashes. No word: 0.

Linking compares distinct fingerprints only. They are dealt into classes by the population counts of their two
halves, and classes into tiles of about TILE. Counts of fingerprints within r bits differ by r at most, summed
over the halves, so other tile pairs are skipped. A remaining pair of tiles is compared by exclusive-or and
bit count in numpy, again skipping the parts whose counts of the four quarters differ by more. A pair of
tiles gives out a spanning forest of its links, never all pairs, so a group of n near copies costs n rows a pair. The
work is exact and, by nature of the method, quadratic in distinct fingerprints: about 8 % of their pairs are compared.

Components come from alternating star contractions, each written to the shared folder. The smallest key of
a component is its id.

Null and empty texts have fingerprint 0 and are linked like any other. A null key never names a component unless
all its keys are null. Equal rows are linked by equal fingerprints. Columns not named are not read; an empty table gives an
empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.shared import written

SEED = 42
TILE = 1 << 15
#: Pairs compared and hashes counted at once.
BLOCK, HASHES = 1 << 20, 1 << 13

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1).tolist()
    ends = ends[shingle - 1 :].tolist() or [len(joined)]
    bits, n = np.zeros(64, np.int64), len(ends)
    for first in range(0, n, HASHES):
        spans = zip(starts[first : min(first + HASHES, n)], ends[first : first + HASHES], strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64)
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(frame: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(key, fp) of every row; fp is a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), own], ["key", "fp"])

    kind = frame.schema[key].dataType.simpleString()
    given = frame.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(of, f"key {kind}, fp long").withColumnRenamed("key", key)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) with the components of the links a[i] - b[i]."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    order = np.argsort(j, kind="stable")
    by_i = np.argsort(i, kind="stable")
    label = np.arange(len(nodes))
    groups = []
    for own, other, sort in ((i, j, by_i), (j, i, order)):
        starts = np.flatnonzero(np.diff(own[sort], prepend=-1))
        groups.append((own[sort][starts], other[sort], starts))
    while True:
        before = label.copy()
        for own, other, starts in groups:
            label[own] = np.minimum(label[own], np.minimum.reduceat(label[other], starts))
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values ordered by the population counts of their quarters; the counts of each part; where parts start."""
    quarters = np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int64)
    codes = quarters @ np.array([1 << 15, 1 << 10, 1 << 5, 1])
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    return values[order], quarters[order][starts], np.append(starts, len(values))


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within `radius` bits between two tiles of uint64."""
    a, a_counts, a_starts = _parts(a)
    b, b_counts, b_starts = _parts(b)
    found: list[np.ndarray] = [np.zeros((2, 0), np.uint64)]
    held = 0
    for k, counts in enumerate(a_counts):
        near = np.flatnonzero(np.abs(b_counts - counts).sum(axis=1) <= radius)
        if not len(near):
            continue
        right = np.concatenate([b[b_starts[x] : b_starts[x + 1]] for x in near])
        step = max(1, BLOCK // len(right))
        for first in range(a_starts[k], a_starts[k + 1], step):
            left = a[first : min(first + step, a_starts[k + 1])]
            i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right) <= radius)
            u, v = left[i], right[j]
            other = u != v
            if other.any():
                u, v = u[other], v[other]
                found.append(np.stack(forest(u, v) if len(u) > len(left) + len(right) else (u, v)))
                held += found[-1].shape[1]
        if held > 4 * (len(a) + len(b)):
            found = [np.stack(forest(*np.concatenate(found, axis=1)))]
            held = found[0].shape[1]
    return forest(*np.concatenate(found, axis=1)) if held else (found[0][0], found[0][1])


def links(distinct: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(u, v): links whose components are those of all pairs of distinct `fp` within `radius` bits."""
    halves = F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF))
    dealt = distinct.select("fp", (halves[0] * 33 + halves[1]).cast("int").alias("class"))
    # at most 33 x 33 classes
    chunks = {row["class"]: -(-row["n"] // tile) for row in dealt.groupBy("class").agg(F.count("*").alias("n")).collect()}
    if not chunks:
        return distinct.sparkSession.createDataFrame([], "u long, v long")
    near = lambda x, y: abs(x // 33 - y // 33) + abs(x % 33 - y % 33) <= radius
    rows = [(x, chunks[x], [(y, chunks[y]) for y in sorted(chunks) if y >= x and near(x, y)]) for x in sorted(chunks)]
    classes = F.broadcast(
        distinct.sparkSession.createDataFrame(rows, "class int, chunks long, others array<struct<class:int,chunks:long>>")
    )
    tiles = (
        dealt.join(classes.drop("others"), "class")
        .groupBy("class", F.pmod(F.xxhash64("fp"), "chunks").cast("int").alias("chunk"))
        .agg(F.collect_list("fp").alias("values"))
    )
    tiles = written(tiles, "simhash-tiles")
    pairs = (
        tiles.join(classes.drop("chunks"), "class")
        .select("class", "chunk", F.col("values").alias("left"), F.explode("others").alias("other"))
        .select("class", "chunk", "left", "other.class", F.explode(F.sequence(F.lit(0), F.col("other.chunks") - 1)).alias("to"))
        .toDF("class", "chunk", "left", "other", "to")
        .filter("other > class or to >= chunk")
    )
    right = tiles.select(F.col("class").alias("other"), F.col("chunk").cast("long").alias("to"), F.col("values").alias("right"))
    both = pairs.join(right, ["other", "to"]).select("left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                u, v = tile_links(*(np.array(x.values, np.int64).view(np.uint64) for x in (left, right)), radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (u, v)], ["u", "v"])

    return both.mapInArrow(compare, "u long, v long")


def stars(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of all linked nodes that are not the smallest of their component."""
    edges = written(edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.toDF("node", "root")
        before = state
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.join(least, "hi").filter("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        edges = written(
            small.select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*").filter("hi <> lo").distinct(),
            "stars",
        )
    raise RuntimeError(f"components not closed after {most_rounds} rounds")


def components(prints: DataFrame, key: str = "doc_id", radius: int = 4, tile: int = TILE) -> DataFrame:
    """(key, fp, component_id) from (key, fp)."""
    distinct = written(prints.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    roots = stars(links(distinct.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(key, "fp", "component_id")


def one_of_each(frame: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The row of the smallest key of every component, all columns.

    Rows without a key can't be named by a component and stay. Of rows with equal key, one stays.
    """
    from pyspark.sql import Window

    prints = written(fingerprints(frame, key, text, shingle), "simhash")
    kept = components(prints, key, radius).select("component_id").distinct().withColumnRenamed("component_id", key)
    number = "__row_of_key"
    first = frame.join(kept, key, "left_semi").withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(text)))
    return first.filter(F.col(number) == 1).drop(number).unionByName(frame.filter(F.col(key).isNull()))
