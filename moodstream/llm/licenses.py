"""Licence notices found by conditional compression.

Candidate blocks are the stretches around words that licence texts use, as far to both sides as the longest template reaches. A block is compressed by
zstandard alone and with each template as raw dictionary; templates are ranked by the bytes that the dictionary saves. All of them are
confirmed by wording, in that order: the words of template and block are aligned, and a template is found if its telling words are all there in
order and at most MOST_DIFFERENT percent of its words, or one word, differ. The rank decides between templates that cover the same words equally well;
it rules out none. A template whose telling words are not all in the block can't be confirmed, so it is not compressed with. What a
confirmed notice covers is cut out and the rest is searched again, so a block may hold several. The differing words come with the result, an exact
wording has none.

Row-local: nothing is shuffled. Null and empty texts have no notice. Texts are searched whole, whatever their length. Columns not named are not
read. Repeated rows give repeated results. An empty table gives an empty result.
"""

import difflib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.license_texts import TEMPLATES

MOST_DIFFERENT = 10

_HINT = re.compile(r"(?i)licen[sc]|\bspdx|\bcc[ -]?by\b|\bcc0\b|permission (?:is (?:hereby )?granted|to use)|redistribution|do what the fuck|\bwarrant(?:y|ies)\b|public domain|creative commons")
_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+")
LONGEST = max(len(text) for _, _, text in TEMPLATES)


def wording(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) in lower case; version numbers are words."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


@cache
def _prepared() -> list[tuple[str, list[str], list[str], object]]:
    out = []
    for name, telling, text in TEMPLATES:
        dictionary = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=False)
        out.append((name, [w for w, _, _ in wording(telling)], [w for w, _, _ in wording(text)], coder))
    return out


def ranked(block: str, words: set[str]) -> list[tuple[int, float]]:
    """(template, part of the size saved) of the templates whose telling words are there, most bytes first, then the shorter template."""
    possible = [i for i, (_, telling, _, _) in enumerate(_prepared()) if words.issuperset(telling)]
    if not possible:
        return []
    data = block.encode()
    alone = len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
    saved = {i: alone - len(_prepared()[i][3].compress(data)) for i in possible}
    return [(i, saved[i] / alone) for i in sorted(possible, key=lambda i: (-saved[i], len(TEMPLATES[i][2]), i))]


def compared(number: int, words: list[tuple[str, int, int]], at: int) -> tuple[bool, int, int, list[str]] | None:
    """Whether a template covers word `at`, its first and last place in the words, and the differences; None if it is not confirmed.

    The template is laid on the words wherever its rarest telling word stands. A place that covers word `at` is taken first, then the one with
    the fewest differences, then the first.
    """
    _, telling, template, _ = _prepared()[number]
    own = [w for w, _, _ in words]
    most = max(1, len(template) * MOST_DIFFERENT // 100)
    pairs = [([i for i, w in enumerate(own) if w == x], [i for i, w in enumerate(template) if w == x]) for x in dict.fromkeys(telling)]
    places = min(pairs, key=lambda x: len(x[0]) * len(x[1]))
    best = None
    for start in sorted({max(0, i - j - most) for i in places[0] for j in places[1]}):
        found = _laid_on(telling, template, own[start : start + len(template) + 3 * most], most)
        if found:
            first, last, differences = start + found[0], start + found[1], found[2]
            covers = first <= at < last
            if best is None or (covers, -len(differences)) > (best[0], -len(best[3])):
                best = covers, first, last, differences
    return best


def _laid_on(telling: list[str], template: list[str], own: list[str], most: int) -> tuple[int, int, list[str]] | None:
    """First and last place of a template in a stretch of words about as long, and the differences; None if over `most` differ."""
    there = set(own)
    if sum(w not in there for w in template) > most:
        return None
    blocks = [x for x in difflib.SequenceMatcher(None, template, own, autojunk=False).get_matching_blocks() if x.size]
    if not blocks:
        return None
    first, last = blocks[0].b, blocks[-1].b + blocks[-1].size
    found = iter(own[first:last])
    if not all(w in found for w in telling):
        return None
    differences = []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, template, own[first:last], autojunk=False).get_opcodes():
        if kind != "equal":
            differences += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in own[first:last][c:d]]
    return (first, last, differences) if len(differences) <= most else None


def notices(text: str | None) -> Iterator[tuple[int, int, str, float, list[str]]]:
    """(start, end, licence, part of the size saved, wording differences) of each notice in a text, in order."""
    reach, last, blocks = LONGEST + LONGEST // 4, -1, []
    for hint in _HINT.finditer(text or ""):
        start, end = max(0, hint.start() - reach), hint.end() + reach
        if start <= last:
            blocks[-1][1] = end
        else:
            blocks.append([start, end])
        last = end
    for start, end in blocks:
        yield from _in_block(text, start, min(end, len(text)))


def _in_block(text: str, start: int, end: int) -> Iterator[tuple[int, int, str, float, list[str]]]:
    """Notices of a block. Each hint is searched with its surroundings, up to the notices found before; `since` is where untried hints begin."""
    todo, out = [(start, end, start)], []
    while todo:
        a, b, since = todo.pop()
        hint = _HINT.search(text, since, b)
        if not hint:
            continue
        low, high = max(a, hint.start() - LONGEST), min(b, hint.end() + LONGEST + LONGEST // 4)
        words = wording(text[low:high])
        at = next((i for i, (_, _, stop) in enumerate(words) if low + stop > hint.start()), len(words))
        best = None
        for number, part in ranked(text[low:high], {w for w, _, _ in words}):
            found = compared(number, words, at)
            if found:
                covers, first, last, differences = found
                order = covers, last - first, -len(differences)
                if best is None or order > best[0]:
                    best = order, number, first, last, differences, part
        if best is None:
            todo.append((a, b, hint.end()))
            continue
        (covers, *_), number, first, last, differences, part = best
        begin, stop = low + words[first][1], low + words[last - 1][2]
        if not covers and _HINT.search(text, begin, stop):  # left to its own hint, whose surroundings hold all of it
            todo.append((a, b, hint.end()))
            continue
        out.append((begin, stop, TEMPLATES[number][0], part, differences))
        todo += [(a, begin, min(since, begin)), (stop, b, max(stop, hint.end()))]
    yield from sorted(out, key=lambda x: x[:2])


def license_notices(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, license, saved, n_differences, differences): one row per notice, places in code points from 0."""
    names = ["key", "start", "length", "license", "saved", "n_differences", "differences"]
    kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.string()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for place, value in enumerate(batch.column(1)):
                for start, end, name, part, differences in notices(value.as_py()):
                    at.append(place)
                    rows.append((start, end - start, name, part, len(differences), " ".join(differences)))
            columns = [pa.array([x[i] for x in rows], kinds[i + 1]) for i in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names)

    given = frame.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = frame.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, license string, saved double, n_differences long, differences string"
    return given.mapInArrow(scan, schema).withColumnRenamed("key", key)
