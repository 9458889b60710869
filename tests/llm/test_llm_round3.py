"""Importance resampling, line dedup and collocations against plain versions and edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from moodstream.llm import collocations as phrases
from moodstream.llm import lines, resampling
from moodstream.llm.catalogue import QUERIES

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = FEATURE_WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def plain_resampling(documents, benchmark):
    """{place in the list: (n_features, weight, score, rank)} of (doc_id, text) rows."""
    own = [features(text) for _, text in documents]
    s = Counter(x for _, found in own for x in found)
    t = Counter(x for text in benchmark for x in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1.0) * (all_s + 10_000) / ((s[k] + 1.0) * (all_t + 10_000)))) for k in range(10_000)]
    out = []
    for (key, _), (_, found) in zip(documents, own, strict=True):
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in found)
        out.append([len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [k for k, (n, _) in enumerate(own) if n >= 20]
    able.sort(key=lambda k: (-out[k][2], documents[k][0] is None, documents[k][0] or 0))
    for place, k in enumerate(able[: 5 * len(able) // 100]):
        out[k][3] = place + 1
    return out


def test_resampling_equals_brute_force(spark, data):
    documents = [(x.doc_id, x.text) for x in spark.read.parquet(f"{data}/documents.parquet").collect()]
    benchmark = [x.text for x in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    wanted = {key: tuple(row) for (key, _), row in zip(documents, plain_resampling(documents, benchmark), strict=True)}
    got = QUERIES["op11_importance_resampling"](spark, data).collect()
    assert {x.doc_id: tuple(x)[1:] for x in got} == wanted
    able = sum(features(text)[0] >= 20 for _, text in documents)
    assert sorted(x.rank for x in got if x.rank) == list(range(1, able * 5 // 100 + 1))


def test_resampling_of_edge_rows_and_an_empty_target(spark, edge, nothing, rows):
    found = resampling.resampled(edge, edge.limit(0), percent=50, least_words=3).collect()
    wanted = plain_resampling([(x[0], x[1]) for x in rows], [])
    assert sorted((str(x.doc_id), x.n_features, x.weight, x.score) for x in found) == sorted(
        (str(x[0]), *w[:3]) for x, w in zip(rows, wanted, strict=True)
    )
    able = [x for x in found if x.n_words >= 3]
    assert sorted(x.rank for x in found if x.rank) == list(range(1, len(able) // 2 + 1))
    by_rank = [x.score for x in sorted((x for x in found if x.rank), key=lambda x: x.rank)]
    assert by_rank == sorted(by_rank, reverse=True) and min(by_rank) >= max(x.score for x in able if not x.rank)
    assert resampling.resampled(nothing, edge).collect() == []


@pytest.mark.parametrize("words, size", [(1 << 19, 1 << 21), (5, 40), (1, 7)])
def test_crcs_of_prefixes_give_the_crc_of_every_run(monkeypatch, words, size):
    monkeypatch.setattr(resampling, "WORDS", words)
    monkeypatch.setattr(resampling, "BYTES", size)
    random.seed(words)
    letters = ["a", "Z", "7", "é", "日", "-", " ", "\n", "🙂", "\x00", "_"]
    texts = ["".join(random.choices(letters, k=random.choice([0, 1, 5, 60, 400]))) for _ in range(60)]
    texts += [None, "x" * 5000 + " " + "é" * 70 + " y", "one", " "]
    found = Counter()
    scan = resampling._Scan(lambda at, doc: found.update(zip(doc.tolist(), at.tolist(), strict=True)), 10_000, 3)
    for k, text in enumerate(texts):
        assert scan.add(k, text) == features(text)[0]
    scan.flush()
    assert found == Counter((k, x) for k, text in enumerate(texts) for x in features(text)[1])


def test_shifts_are_those_of_zlib():
    random.seed(3)
    sizes = np.array([0, 1, 2, 63, 64, 65, 127, 128, 1000, 70_001])
    crcs = np.array([random.getrandbits(32) for _ in sizes], np.uint32)
    wanted = [zlib.crc32(b"\0" * int(n), int(c)) ^ zlib.crc32(b"\0" * int(n)) for c, n in zip(crcs, sizes, strict=True)]
    assert resampling.shifted(crcs, sizes).tolist() == wanted


def plain_lines(texts, least_chars=1, least_docs=10):
    key = lambda line: line.strip(lines.BLANK).translate(UPPER)
    split = [(text or "").split("\n") for text in texts]
    seen = Counter(k for x in split for k in {key(line) for line in x})
    gone = {k for k, n in seen.items() if n >= least_docs and len(k) >= least_chars}
    kept = [[line for line in x if key(line) not in gone] for x in split]
    return [(len(x), len(x) - len(y), "\n".join(y)) for x, y in zip(split, kept, strict=True)]


@pytest.mark.parametrize("least_chars, least_docs", [(1, 10), (4, 3), (0, 2)])
def test_common_lines_go(spark, least_chars, least_docs):
    random.seed(least_docs)
    pool = ["", " ", "\tTop \r", "top", "TOP", "ÉTÉ", "été", "a", "A ", "long line of Text", "x\x0by", "Menu | Home", " menu | home\x0c"]
    texts = ["\n".join(random.choices([*pool, *(f"own {k} {i}" for i in range(9))], k=random.choice([0, 1, 3, 30]))) for k in range(40)]
    texts += [None, "", texts[0], texts[0], "\n".join(["top", "a"] * 20_000)]
    keys = [*range(len(texts) - 3), None, None, 7]
    frame = spark.createDataFrame(list(zip(keys, texts, [5] * len(texts), strict=True)), "id long, body string, hash int").repartition(4)
    got = lines.without_common_lines(frame, "id", "body", least_chars, least_docs)
    wanted = [(key, *x) for key, x in zip(keys, plain_lines(texts, least_chars, least_docs), strict=True)]
    assert sorted(map(str, wanted)) == sorted(str((x.id, x.n_lines, x.n_dropped, x.text)) for x in got.collect())


def test_lines_of_an_empty_table(spark, nothing):
    assert lines.without_common_lines(nothing).collect() == []


def plain_phrases(rows, least=10, share=50, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = tuple(x for x in re.split(r"[\x20\x09]+", piece) if x)
            totals[lang] += len(words)
            counts.update((lang, words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    good = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    found, longer = {}, {}
    for (lang, words), a in good.items():
        if len(words) == 3:
            for inside in (words[:2], words[1:]):
                longer[lang, inside] = max(a, longer.get((lang, inside), 0))
    for (lang, words), a in good.items():
        if 100 * longer.get((lang, words), -1) >= share * a:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((10**6 * a * a // (left * right), k, left, right) for k, (left, right) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:first], 1)
    ]


@pytest.mark.parametrize("ranges, block, size", [(1, 1 << 21, 1 << 21), (9, 50, 30), (40, 7, 5)])
def test_phrases_equal_brute_force(spark, monkeypatch, ranges, block, size):
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "BYTES", size)
    random.seed(ranges)
    pool = ["New", "york", "city", "of", "the", "THE", "a\x01", "é", "日本", "\x00", "u", "it's"]
    rows = []
    for k in range(60):
        words = random.choices(pool, weights=[9, 9, 5, 8, 9, 2, 1, 1, 1, 1, 1, 1], k=random.choice([0, 2, 25]))
        rows.append(("".join(x + random.choice([" ", " ", " ", "\t", ", ", "\r\n", "!", "  "]) for x in words), random.choice(["en", "en", "en", None, "und", ""])))
    rows += [("New York City " * 30, "en"), ("new york city. " * 30, "en"), (None, "fr"), ("", None), rows[0], rows[0]]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "text string, lang string, n int").repartition(5)
    for least, share, first in [(4, 50, 2000)] if ranges == 1 else [(2, 100, 7)]:
        got = phrases.collocations(frame, least, share, first, ranges=ranges)
        assert sorted(map(tuple, got.collect())) == sorted(plain_phrases(rows, least, share, first))


def test_phrase_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)]
    found = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, n long"), 3).collect()
    assert [(x.phrase, x.score) for x in found] == [("a b", 10**6 * (big - 1) ** 2 // (big * (big + 1)))]


def test_phrases_of_an_empty_table(nothing):
    got = phrases.collocations(nothing)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.collect() == []


def test_phrases_ignore_other_columns(spark, edge, rows):
    other = edge.withColumnsRenamed({"key": "phrase", "size": "words", "n_chars": "range"})
    got = phrases.collocations(other, least=3).collect()
    assert sorted(map(tuple, got)) == sorted(plain_phrases([(x[1], x[2]) for x in rows], 3))
