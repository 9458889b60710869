"""Removal of repeated byte strings from all documents, exactly.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document with a smaller key, or earlier in the same one.

1. Windows. A window is `length` bytes of a document. Its key is the smallest hash among its runs of RUN bytes, so equal windows have equal keys, and
   neighbouring windows mostly share one: a stretch of windows with one key is a piece. Pieces travel as (key, document, place) only. A window whose
   key occurs in no other piece has no equal, so its piece is left out, unless the piece goes on behind its smallest run: then it holds that run again.
2. Shards. The bytes of the pieces that stay are dealt to shards by key, packed and compressed by task and shard; equal pieces of a task share their bytes. In the
   shard, block after block, the bytes of equal pieces are held once: the earliest stands for them, and the windows of the others are repeats.
3. Each shard is then one text in the order of documents. `suffixes.repeats` sorts its suffixes by external induction, and windows that agree in `length`
   bytes, except the first, are repeats. Its queues go to disk beyond MEMORY; different pieces, text and
   ranks of a shard are held in memory.
4. Repeats come back as spans by document, and each document is cut.

The pieces of a key that MANY pieces or more have are cut into up to (length - RUN) / STEP parts by the place of the smallest run in the window, and
the parts go to different shards: equal windows agree in that place. Texts travel twice, compressed, by document; nothing is collected.

Null and empty texts have no bytes. Rows that are equal in key and text are one document and get equal results. Rows with equal key and different
texts are told apart by a hash of the text, the smaller first; rows without key come last. Columns not named are not read. An empty table
gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.shared import written
from moodstream.llm.suffixes import repeats

RUN = 32
MANY, STEP = 4096, 8
#: Zstandard level of what travels.
LEVEL = 3
#: Bytes of pieces that a task packs at once.
BLOCK = 1 << 23
#: Bytes of documents for a shard (its pieces have about as many), and memory for sorting one before it uses disk.
SHARD, MEMORY = 4 << 20, 96 << 20
#: Windows of a piece at most; longer stretches of one key are several pieces.
LONGEST = 1 << 16
#: Flag beside the number of windows, and what is in front of both.
OWN, PLACE = 1 << 17, 18
#: Key of rows without one: behind all others.
LAST = (1 << 63) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
#: 48 bits tell enough: at 10^13 pieces one in 30 meets a stranger, which costs its bytes' way and changes nothing. Zeros travel free.
_KEPT = np.uint64(0xFFFFFFFFFFFF0000)


def run_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every run of RUN bytes."""
    hashes, width, factor = data.astype(np.uint64) + np.uint64(1), 1, _ODD
    with np.errstate(over="ignore"):
        while width < RUN:
            hashes = hashes[:-width] * factor + hashes[width:]
            factor, width = factor * factor, 2 * width
        hashes ^= hashes >> np.uint64(31)
        hashes *= _SPREAD
        return (hashes ^ (hashes >> np.uint64(29))) & _KEPT


def window_keys(hashes: np.ndarray, length: int) -> np.ndarray:
    """The key of every window: the smallest hash among its runs."""
    least, width, wanted = hashes, 1, length - RUN + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def pieces(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, number of windows + OWN if it may repeat itself) of the pieces of a text."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    step = 1 << 20
    for start in range(0, len(data) - length + 1, step):
        hashes = run_hashes(np.frombuffer(data[start : start + step + length - 1], np.uint8))
        keys = window_keys(hashes, length)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(first, len(keys)))
        while n.max(initial=0) > LONGEST:
            over = np.flatnonzero(n > LONGEST)
            first = np.sort(np.append(first, first[over] + LONGEST))
            n = np.diff(np.append(first, len(keys)))
        leaves = hashes[: len(keys)] == keys
        leaves[first + n - 1] = False
        found.append((keys[first].view(np.int64), first + start, n + OWN * (np.add.reduceat(leaves, first, dtype=np.int64) > 0)))
    return tuple(np.concatenate([x[i] for x in found]) for i in range(3))


def parts(piece: bytes, key: int, n: int) -> list[tuple[int, int, int]]:
    """(key, first window, windows) of the parts of a piece in which the smallest run has about the same place."""
    at = np.flatnonzero(run_hashes(np.frombuffer(piece, np.uint8)).view(np.int64) == key)
    windows = np.arange(n)
    place = (at[np.searchsorted(at, windows)] - windows) // STEP
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return [(key ^ (int(place[a]) + 1), int(a), int(b - a)) for a, b in zip(first, np.append(first[1:], n), strict=True)]


def _documents(frame: DataFrame, key: str, text: str) -> DataFrame:
    """(id, mark, packed): key, hash of the text, and its compressed bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            data = [(x.as_py() or "").encode() for x in batch.column(1)]
            marks = np.array([xxhash.xxh3_64_intdigest(x) for x in data], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks), pa.array([coder.compress(x) for x in data], pa.binary())], ["id", "mark", "packed"]
            )

    given = frame.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(pack, "id long, mark long, packed binary")


def _all_pieces(frame: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(key, id, mark, place): place is the first window, shifted by PLACE, with the number of windows and OWN."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0

            def packed() -> pa.RecordBatch:
                columns = (np.concatenate([x[i] for x in held]) if held else np.zeros(0, np.int64) for i in range(4))
                return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "id", "mark", "place"])

            for own, value in zip(*batch.columns, strict=True):
                data = (value.as_py() or "").encode()
                keys, first, n = pieces(data, length)
                mark = np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64)
                held.append((keys, np.full(len(keys), own.as_py()), np.full(len(keys), mark), first << PLACE | n))
                size += len(keys)
                if size > 1 << 19:
                    yield packed()
                    held, size = [], 0
            yield packed()

    given = frame.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(cut, "key long, id long, mark long, place long")


def _met_again(found: DataFrame) -> DataFrame:
    """Pieces whose key another piece has too, or that may repeat themselves; `many`: how many have the key, up to MANY."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, before = None, 0  # rows of the last key, which may go on, and how many went before them
        for batch in batches:
            own = np.stack([x.to_numpy(zero_copy_only=False) for x in batch.columns])
            own = own if rest is None else np.concatenate([rest, own], axis=1)
            if not own.shape[1]:
                continue
            starts = np.flatnonzero(np.append(True, own[0, 1:] != own[0, :-1]))
            size = np.diff(np.append(starts, own.shape[1]))
            size[0] += before
            whole, before = starts[-1], before if len(starts) == 1 else 0
            if own.shape[1] - whole > MANY:  # enough to know that it is split
                before, whole = before + own.shape[1] - 1 - whole, own.shape[1] - 1
            yield chosen(own[:, :whole], np.repeat(size, np.diff(np.append(starts, own.shape[1])))[:whole])
            rest = own[:, whole:]
        if rest is not None:
            yield chosen(rest, np.full(rest.shape[1], rest.shape[1] + before))

    def chosen(rows: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        keep = (size > 1) | ((rows[3] & OWN) > 0)
        columns = [pa.array(x[keep]) for x in rows]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.minimum(size[keep], MANY))], ["key", "id", "mark", "place", "many"])

    dealt = found.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(pick, "key long, id long, mark long, place long, many long")


def _cut_out(documents: DataFrame, wanted: DataFrame, length: int, shards: int) -> DataFrame:
    """(shard, block): the pieces of a task for one shard as compressed columns: bytes, sizes, key, id, mark and first window."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_set(F.struct("key", "place", "many")).alias("own"))
    both = documents.dropDuplicates(["id", "mark"]).join(lists, ["id", "mark"]).select("id", "mark", "packed", "own")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        held, size = [], 0
        for batch in batches:
            for own_id, mark, data, own in zip(*batch.columns, strict=True):
                data = decoder.decompress(data.as_py())
                own_id, mark = own_id.as_py(), mark.as_py()
                columns = (own.values.field(x).to_numpy().tolist() for x in ("key", "place", "many"))
                for key, place, many in zip(*columns, strict=True):
                    first, n = place >> PLACE, place & (OWN - 1)
                    piece = data[first : first + n + length - 1]
                    for key_of, start, windows in parts(piece, key, n) if many >= MANY else ((key, 0, n),):
                        held.append((piece[start : start + windows + length - 1], key_of, own_id, mark, first + start))
                    size += len(piece)
                if size > BLOCK:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        coder = zstandard.ZstdCompressor(level=LEVEL)
        numbers = np.array([x[1:] for x in rows], np.int64).T
        shard = ((numbers[0].view(np.uint64) * _SPREAD) >> np.uint64(20)) % np.uint64(shards)
        order = np.lexsort([numbers[3], numbers[1], shard])
        starts = np.flatnonzero(np.diff(shard[order].astype(np.int64), prepend=-1))
        blocks = []
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            own = order[a:b]
            once: dict[bytes, int] = {}  # equal pieces of a task share their bytes
            which = np.fromiter((once.setdefault(rows[i][0], len(once)) for i in own.tolist()), np.int64, len(own))
            head = np.array([len(own), len(once)], np.int64).tobytes() + np.fromiter(map(len, once), np.int64, len(once)).tobytes()
            blocks.append(coder.compress(head + which.tobytes() + numbers[:, own].tobytes() + b"".join(once)))
        return pa.RecordBatch.from_arrays([pa.array(shard[order[starts]].astype(np.int32)), pa.array(blocks, pa.binary())], ["shard", "block"])

    return both.mapInArrow(cut, "shard int, block binary")


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of different pieces, their sizes, which of them each piece is, (key, id, mark, first) of each piece) of a block."""
    n, m = np.frombuffer(block, np.int64, 2).tolist()
    sizes = np.frombuffer(block, np.int64, m, 16)
    which = np.frombuffer(block, np.int64, n, 16 + 8 * m)
    numbers = np.frombuffer(block, np.int64, 4 * n, 16 + 8 * (m + n)).reshape(4, n)
    return np.frombuffer(block, np.uint8, offset=16 + 8 * m + 40 * n), sizes, which, numbers


def _joined(data: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of n bytes from the given starts as one text of symbols, each with a 0 behind it; where they start in it."""
    to = np.cumsum(n + 1) - n - 1
    text = np.zeros(int((n + 1).sum()), np.uint16)
    for a in range(0, len(n), 1 << 12):  # indices of a part at a time
        own = slice(a, a + (1 << 12))
        inside = np.arange(n[own].sum()) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        text[np.repeat(to[own], n[own]) + inside] = data[np.repeat(starts[own], n[own]) + inside].astype(np.uint16) + 1
    return text, to


def _different(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As `unpacked`, of all blocks together, with the bytes of equal pieces held once. Blocks are taken out of the list."""
    seen: dict[bytes, int] = {}
    data, sizes, which, numbers = [], [], [], []
    decoder = zstandard.ZstdDecompressor()
    while blocks:
        own, n, kind, rest = unpacked(decoder.decompress(blocks.pop()))
        ends, view = np.cumsum(n).tolist(), memoryview(own)
        place = np.empty(len(n), np.int64)
        new = np.zeros(len(n), bool)
        for i, (end, length) in enumerate(zip(ends, n.tolist(), strict=True)):
            digest = xxhash.xxh3_128_digest(view[end - length : end]) + length.to_bytes(8, "little")
            new[i] = digest not in seen
            place[i] = seen.setdefault(digest, len(seen))
        data.append(own if new.all() else own[np.repeat(new, n)])
        sizes.append(n[new])
        which.append(place[kind])
        numbers.append(rest.copy())
    return np.concatenate(data), np.concatenate(sizes), np.concatenate(which), np.concatenate(numbers, axis=1)


def spans_of_shard(blocks: list[bytes], length: int) -> np.ndarray:
    """(id, mark, first, n) of the runs of windows of a shard, given as compressed blocks, that are repeats.

    Equal pieces are joined first: the windows of all but the earliest are repeats, and the earliest stands for them in the text that is sorted.
    """
    data, sizes, which, numbers = _different(blocks)
    order = np.lexsort([numbers[3], numbers[2], numbers[1], which])
    same = np.append(False, which[order][1:] == which[order][:-1])
    later = order[same]
    found = [np.stack([*numbers[1:, later], sizes[which[later]] - length + 1])]
    once = order[~same]
    once = once[np.lexsort([numbers[3, once], numbers[2, once], numbers[1, once]])]
    text, to = _joined(data, (np.cumsum(sizes) - sizes)[which[once]], sizes[which[once]])
    del data
    again = repeats(text, length, MEMORY)
    edge = np.diff(again.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(to, begin, side="right") - 1
    own = once[row]
    found.append(np.stack([*numbers[1:3, own], numbers[3, own] + begin - to[row], end - begin]))
    return np.concatenate(found, axis=1)


def _spans_of_shards(cut: DataFrame, length: int, shards: int) -> DataFrame:
    """(id, mark, first, n): runs of windows that are repeats."""
    names = ["id", "mark", "first", "n"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for number, block in zip(*batch.columns, strict=True):
                if number.as_py() != shard and held:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans_of_shard(held, length)], names)
                    held = []
                shard = number.as_py()
                held.append(block.as_py())
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans_of_shard(held, length)], names)

    dealt = cut.repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(search, "id long, mark long, first long, n long")


def cut_repeats(frame: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): bytes before, bytes and runs removed, and what is left, for every row."""
    if length < RUN:
        raise ValueError(f"length {length} is less than {RUN}")
    size = frame.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    shards = max(1, round(size / SHARD))
    documents = _documents(frame, key, text)
    cut = _cut_out(documents, _met_again(_all_pieces(frame, key, text, length)), length, shards)
    spans = written(_spans_of_shards(cut, length, shards), "repeats")
    lists = spans.groupBy("id", "mark").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    both = documents.join(lists, ["id", "mark"], "left").select("id", "packed", "spans")
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept"]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for own, data, spans in zip(*batch.columns, strict=True):
                data = decoder.decompress(data.as_py())
                gone, runs, kept = 0, 0, data
                if spans.is_valid:
                    firsts, n = (spans.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, firsts, 1)
                    np.subtract.at(edge, firsts + n + length - 1, 1)
                    out = np.cumsum(edge[:-1]) > 0
                    gone, runs = int(out.sum()), int((np.diff(out.astype(np.int8), prepend=0) == 1).sum())
                    kept = np.frombuffer(data, np.uint8)[~out].tobytes()
                rows.append((None if own.as_py() == LAST else own.as_py(), len(data), gone, runs, kept))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if k == 4 else pa.int64()) for k, x in enumerate(columns)], names)

    return both.mapInArrow(remove, "key long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("key", key)
