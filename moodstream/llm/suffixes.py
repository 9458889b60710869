"""Suffix order and common prefixes of a long text by external induced sorting.

The scheme is that of Bingmann, Fischer and Osipov (2013), to the depth that is asked for. A suffix is S-type if it is smaller than the one behind it, else
L-type; an S-type suffix behind an L-type one is a star suffix.

1. Stars are named by the text up to the next star, and the names, a text of a third of the length, are ordered by recursion over spans of names that
   double, until names are unique or cover `depth` symbols. Sorting is external: sorted runs on disk, merged range by range.
2. L-type suffixes are induced from smaller to larger: each suffix taken from a priority queue puts the one before it in, if that is L-type. S-type
   suffixes follow from larger to smaller.

A queue entry is a tuple of position and common prefix. Its priority is its first symbol, then its arrival, so the queue is one FIFO per symbol; entries beyond the
memory budget go to disk. The common prefix of two neighbours in a FIFO is one more than the smallest between their origins, which is kept per
symbol while origins pass by, so prefixes are carried through the induction instead of compared. Only the one pair per symbol where L-type suffixes
end and S-type ones begin is compared in the text.

Work is done on whole batches of tuples in numpy. Scratch files are private to the task and gone at its end; a task that is started again starts afresh.
"""

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples handled at once.
BATCH = 1 << 18
_NONE = np.zeros(0, np.uint32), np.zeros(0, np.uint8)


class Scratch:
    """A file for what exceeds the memory budget, and arrays that live in files beyond it."""

    def __init__(self, budget: int):
        self.budget, self.held, self.queues = budget, 0, []
        self.folder = tempfile.TemporaryDirectory(prefix="suffixes-")
        self.file = os.open(f"{self.folder.name}/queues", os.O_RDWR | os.O_CREAT)
        self.end = self.spilled = self.arrays = 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        os.close(self.file)
        self.folder.cleanup()

    def array(self, n: int, kind) -> np.ndarray:
        """An array of zeros, in a file if it is larger than a part of the budget."""
        if n * np.dtype(kind).itemsize <= self.budget // 8:
            return np.zeros(n, kind)
        self.arrays += 1
        return np.memmap(f"{self.folder.name}/array-{self.arrays}", kind, "w+", shape=(max(1, n),))[:n]

    def note(self, size: int) -> None:
        self.held += size
        if self.held > self.budget:
            for queue in self.queues:
                queue.spill()
            self.held = 0
            self.spilled += 1

    def put(self, data: np.ndarray) -> int:
        at, self.end = self.end, self.end + data.nbytes
        os.pwrite(self.file, data.tobytes(), at)
        return at


class Fifo:
    """The entries of one first symbol in order of arrival."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.parts = scratch, []
        scratch.queues.append(self)

    def push(self, at: np.ndarray, common: np.ndarray) -> None:
        self.parts.append((at, common))
        self.scratch.note(at.nbytes + common.nbytes)

    def spill(self) -> None:
        loose = [x for x in self.parts if isinstance(x[0], np.ndarray)]
        if loose:
            kept = [x for x in self.parts if not isinstance(x[0], np.ndarray)]
            at, common = (np.concatenate([x[i] for x in loose]) for i in (0, 1))
            self.parts = [*kept, (self.scratch.put(at), self.scratch.put(common), len(at))]

    def read(self, part) -> tuple[np.ndarray, np.ndarray]:
        if len(part) == 2:
            return part
        at, common, n = part
        fetch = lambda where, kind: np.frombuffer(os.pread(self.scratch.file, n * np.dtype(kind).itemsize, where), kind)
        return fetch(at, np.uint32), fetch(common, np.uint8)

    def batches(self, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries in pieces of at most BATCH, kept."""
        for part in self.parts[::-1] if backwards else self.parts:
            at, common = self.read(part)
            starts = range(0, len(at), BATCH)
            for start in reversed(starts) if backwards else starts:
                yield at[start : start + BATCH], common[start : start + BATCH]

    def taken(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is in the queue now, taken out; what is pushed meanwhile stays for the next call."""
        parts, self.parts = self.parts, []
        held = []
        size = 0
        for part in parts:
            at, common = self.read(part)
            if len(at) > BATCH // 4:
                if held:
                    yield tuple(np.concatenate([x[i] for x in held]) for i in (0, 1))
                    held, size = [], 0
                for start in range(0, len(at), BATCH):
                    yield at[start : start + BATCH], common[start : start + BATCH]
            else:
                held.append((at, common))
                size += len(at)
                if size > BATCH:
                    yield tuple(np.concatenate([x[i] for x in held]) for i in (0, 1))
                    held, size = [], 0
        if held:
            yield tuple(np.concatenate([x[i] for x in held]) for i in (0, 1))


def smaller_than_next(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Whether each suffix is S-type; the last is."""
    out = scratch.array(len(text), bool)
    behind, symbol = True, -1
    for end in range(len(text), 0, -BATCH):
        start = max(0, end - BATCH)
        own = text[start:end].astype(np.int64)
        step = np.append(np.diff(own), symbol - own[-1] if end < len(text) else 1)
        n = len(own)
        near = np.minimum.accumulate(np.where(step != 0, np.arange(n), n)[::-1])[::-1]
        out[start:end] = np.append(step > 0, behind)[near]
        behind, symbol = bool(out[start]), int(own[0])
    return out


def external_order(keys: list[np.ndarray], scratch: Scratch) -> np.ndarray:
    """Places of the rows in the order of keys[0], then keys[1]; sorted runs in files, merged range by range, beyond the budget."""
    n = len(keys[0])
    if len(keys) == 2 and n and keys[0].max() < 1 << 31 and -1 <= keys[1].min() and keys[1].max() < 1 << 31:
        keys = [keys[0] << 32 | (keys[1] + 1)]  # one key sorts faster than two
    elif len(keys) == 2 and n and keys[0].max() == keys[0].min():
        keys = keys[1:]
    order_of = lambda own: np.argsort(own[0]) if len(own) == 1 else np.lexsort(own[::-1])
    most = max(BATCH, scratch.budget // (64 * len(keys)))
    if n <= most:
        return order_of(keys)
    runs = [(start, min(n, start + most)) for start in range(0, n, most)]
    order = scratch.array(n, np.int64)
    firsts = scratch.array(n, keys[0].dtype)
    for start, end in runs:
        own = order_of([k[start:end] for k in keys])
        order[start:end] = own + start
        firsts[start:end] = keys[0][start:end][own]
    # ranges of the first key small enough for memory; equal first keys stay together
    picked = np.sort(np.concatenate([firsts[a:b : max(1, most // 64)] for a, b in runs]))
    cuts = np.unique(picked[:: max(1, len(picked) // (2 * len(runs)))])
    out, filled = scratch.array(n, np.int64), 0
    edges = [a + np.searchsorted(firsts[a:b], cuts[1:]) for a, b in runs]
    for number in range(len(cuts)):
        parts = []
        for (a, b), edge in zip(runs, edges, strict=True):
            parts.append(order[edge[number - 1] if number else a : edge[number] if number < len(cuts) - 1 else b])
        rows = np.concatenate(parts)
        rows = rows[order_of([k[rows] for k in keys])]
        out[filled : filled + len(rows)] = rows
        filled += len(rows)
    return out


def _refined(rank: np.ndarray, rows: np.ndarray, key: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Split the groups of equal rank among `rows` by a further key; a rank is the number of smaller ones. Gives the rows still tied."""
    old = rank[rows]
    order = external_order([old, key], scratch)
    a, k = old[order], key[order]
    place = np.arange(len(rows))
    group = np.maximum.accumulate(np.where(np.append(True, a[1:] != a[:-1]), place, 0))
    same = np.append(False, (a[1:] == a[:-1]) & (k[1:] == k[:-1]))
    first = np.maximum.accumulate(np.where(same, 0, place))
    ordered = rows[order]
    rank[ordered] = a + first - group
    return np.sort(ordered[same | np.append(same[1:], False)])


def star_order(text: np.ndarray, small: np.ndarray, stars: np.ndarray, depth: int, scratch: Scratch) -> np.ndarray:
    """Stars in the order of their suffixes, to `depth` symbols at least."""
    m, n = len(stars), len(text)
    lengths = np.append(stars[1:].astype(np.int64) - stars[:-1] + 1, 1)

    def packed(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        key = np.zeros(len(at), np.int64)
        for j in range(6):
            place = np.minimum(at.astype(np.int64) + j, n - 1)
            symbol = text[place].astype(np.int64) * 2 + small[place]
            key = key << 10 | np.where(j < left, symbol, 0)
        return key

    rank = scratch.array(m, np.int64)
    rows, done, tied = np.arange(m), 0, []
    while len(rows) and done < depth:  # names
        rows = _refined(rank, rows, packed(stars[rows].astype(np.int64) + done, lengths[rows] - done), scratch)
        done += 6
        tied.append(rows[lengths[rows] <= done])
        rows = rows[lengths[rows] > done]

    def level(span: int, rows: np.ndarray) -> None:  # recursion over spans of names
        behind = np.minimum(rows + span, m - 1)
        rows = rows[stars[behind].astype(np.int64) - stars[rows] < depth]
        rows = rows[rows + span < m] if len(rows) else rows
        if len(rows):
            whole = np.append(rank, -1)
            level(2 * span, _refined(rank, rows, whole[rows + span], scratch))

    level(1, np.sort(np.concatenate([*tied, rows])))
    return stars[external_order([rank], scratch)]


def sixes(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The six symbols from each position as one number; behind the end comes a symbol of its own."""
    n = len(text)
    out = scratch.array(n + 1, np.int64)
    for start in range(0, n + 1, BATCH):
        own = np.full(min(BATCH, n + 1 - start) + 5, 1 << 9, np.int64)
        there = text[start : start + len(own)]
        own[: len(there)] = there
        for j in range(6):
            part = out[start : start + len(own) - 5]
            part[:] = part << 10 | own[j : j + len(part)]
    return out


def common_prefix(six: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of suffix pairs, at most `depth`, from the numbers of `sixes`."""
    out = np.zeros(len(a), np.int64)
    rows = np.arange(len(a))
    a, b = a.astype(np.int64), b.astype(np.int64)
    n = len(six) - 1
    for done in range(0, depth, 6):
        if not len(rows):
            break
        differ = six[np.minimum(a[rows] + done, n)] ^ six[np.minimum(b[rows] + done, n)]
        # the highest differing symbol, by the place of the highest bit
        out[rows] = done + 6 - -(-np.frexp(differ.astype(float))[1] // 10)
        rows = rows[differ == 0]
    ends = n - np.maximum(a, b)  # behind the end all differs
    return np.minimum(np.minimum(out, ends), depth)


def _minima(common: np.ndarray) -> list[np.ndarray]:
    """Sparse table for minima of ranges."""
    table, width = [common], 1
    while 2 * width <= len(common):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


def _least(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum over each a..b, both included; a <= b."""
    level = np.frexp((b - a + 1).astype(float))[1] - 1
    out = np.empty(len(a), np.uint8)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][a[own]], table[k][b[own] - (1 << int(k)) + 1])
    return out


class Induction:
    """One pass: queues by symbol, and per symbol the smallest common prefix since its last entry."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int, scratch: Scratch):
        self.text, self.depth = text, depth
        self.queues = [Fifo(scratch) for _ in range(symbols)]
        self.since = np.zeros(symbols, np.uint8)  # 0 before the first entry

    def feed(self, at: np.ndarray, common: np.ndarray, wanted) -> None:
        """Origins in order, common: prefix with the origin before. Puts in the suffix before each if `wanted` says so."""
        if not len(at):
            return
        before = at.astype(np.int64) - 1
        ok = before >= 0
        symbol = self.text[np.maximum(before, 0)]
        ok &= wanted(np.maximum(before, 0), symbol, at)
        j = np.flatnonzero(ok)
        table = _minima(common)
        if len(j):
            target = symbol[j]
            order = np.argsort(target, kind="stable")
            j, target = j[order], target[order]
            fresh = np.append(True, target[1:] != target[:-1])
            start = np.where(fresh, 0, np.append(0, j[:-1] + 1))
            least = _least(table, start, j)
            least[fresh] = np.minimum(least[fresh], self.since[target[fresh]])
            # the first entry of all for a symbol has nothing before it
            entered = np.minimum(least.astype(np.int64) + 1, self.depth).astype(np.uint8)
            begins = np.flatnonzero(fresh)
            seen = self.seen[target[begins]]
            entered[begins[~seen]] = 0
            self.seen[target[begins]] = True
            places = before[j].astype(np.uint32)
            ends = np.append(begins[1:], len(j))
            self.since = np.minimum(self.since, table[0].min())
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                self.queues[target[a]].push(places[a:b], entered[a:b])
            last = j[ends - 1]
            inside = last + 1 < len(at)
            rest = np.full(len(last), self.depth, np.uint8)
            rest[inside] = _least(table, last[inside] + 1, np.full(inside.sum(), len(at) - 1))
            self.since[target[begins]] = rest
        else:
            self.since = np.minimum(self.since, table[0].min())

    @property
    def seen(self) -> np.ndarray:
        if not hasattr(self, "_seen"):
            self._seen = np.zeros(len(self.queues), bool)
        return self._seen


def sorted_suffixes(text: np.ndarray, depth: int, memory: int = 1 << 28) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefixes with the one before, at most `depth`) of all suffixes in order, in batches.

    text: uint16 symbols; the last is 0. Suffixes that agree in `depth` symbols come in any order. Positions are below 2^32, depth below 256.
    """
    with Scratch(memory) as scratch:
        symbols = int(text.max()) + 1
        small = smaller_than_next(text, scratch)
        stars = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.uint32)
        ordered = star_order(text, small, stars, depth, scratch)
        six = sixes(text, scratch)
        star_symbols = text[ordered]
        edges = np.searchsorted(star_symbols, np.arange(symbols + 1))

        # L-type suffixes, from the smallest symbol
        rising = Induction(text, symbols, depth, scratch)
        large = [Fifo(scratch) for _ in range(symbols)]
        for symbol in range(symbols):
            queue, kept, last = rising.queues[symbol], large[symbol], None
            while queue.parts:
                for at, common in queue.taken():
                    kept.push(at, common)
                    last = at[-1:]
                    rising.feed(at, common, lambda q, s, p: (s >= text[p]) & ~small[q])
            for start in range(edges[symbol], edges[symbol + 1], BATCH):
                at = ordered[start : min(start + BATCH, edges[symbol + 1])]
                previous = np.concatenate([ordered[start - 1 : start] if start > edges[symbol] else (last if last is not None else at[:1]), at[:-1]])
                common = common_prefix(six, previous, at, depth).astype(np.uint8)
                if start == edges[symbol] and last is None:
                    common[0] = 0
                rising.feed(at, common, lambda q, s, p: ~small[q])

        # S-type suffixes, from the largest symbol; common is here with the one behind
        falling = Induction(text, symbols, depth, scratch)
        smalls = [Fifo(scratch) for _ in range(symbols)]
        joints = np.zeros(symbols, np.uint8)
        end = np.array([len(text) - 1], np.uint32)
        for symbol in range(symbols - 1, -1, -1):
            queue, kept, last = falling.queues[symbol], smalls[symbol], None
            while queue.parts:
                for at, common in queue.taken():
                    kept.push(at, common)
                    last = at[-1:]
                    falling.feed(at, common, lambda q, s, p: (s <= text[p]) & small[q])
            if symbol == 0:  # the last suffix of the text has none behind it that could put it in
                common = common_prefix(six, last, end, depth).astype(np.uint8) if last is not None else np.zeros(1, np.uint8)
                kept.push(end, common)
                falling.feed(end, common, lambda q, s, p: (s <= text[p]) & small[q])
                last = end
            behind = 0
            for number, (at, common) in enumerate(large[symbol].batches(backwards=True)):
                if number == 0 and last is not None:
                    behind = int(common_prefix(six, at[-1:], last, depth)[0])
                    joints[symbol] = behind
                shifted = np.append(np.uint8(behind), common[:0:-1]).astype(np.uint8)
                behind = int(common[0])
                falling.feed(at[::-1], shifted, lambda q, s, p: (s < text[p]) & small[q])

        for symbol in range(symbols):
            yield from large[symbol].batches()
            before = int(joints[symbol])
            for at, common in smalls[symbol].batches(backwards=True):
                yield at[::-1], np.append(np.uint8(before), common[:0:-1]).astype(np.uint8)
                before = int(common[0])


def repeats(text: np.ndarray, depth: int, memory: int = 1 << 28) -> np.ndarray:
    """Whether the `depth` symbols from each position also begin at an earlier one; symbol 0 ends a piece and is part of no repeat."""
    out = np.zeros(len(text), bool)
    first = None  # smallest position of the open group
    for at, common in sorted_suffixes(text, depth, memory):
        at = at.astype(np.int64)
        starts = np.flatnonzero(common < depth)
        if first is not None and (not len(starts) or starts[0] > 0):
            end = starts[0] if len(starts) else len(at)
            least = min(first, int(at[:end].min()))
            out[at[:end]] = True
            out[first] = True
            out[least] = False
            first = least
            if not len(starts):
                continue
        least = np.minimum.reduceat(at, starts)
        group = np.searchsorted(starts, np.arange(len(at)), side="right") - 1
        inside = group >= 0
        out[at[inside]] = at[inside] != least[group[inside]]
        first = int(least[-1])
    zero = np.flatnonzero(text == 0)
    spans = np.minimum(zero, len(text))
    for back in range(min(depth, len(text))):  # positions too close to the end of their piece
        place = spans - back
        out[place[place >= 0]] = False
    return out
