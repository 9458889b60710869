"""Operators against plain versions, round trips and planted cases."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash

from moodstream.llm import bpe, licenses, pii, repetition, simhash, spotsigs, substrings, suffixes, warc
from moodstream.llm.bpe import Tokenizer, encoded_bytes, read_ranks, with_ids
from moodstream.llm.catalogue import QUERIES
from moodstream.llm.language import gram_counts, identified, learned
from moodstream.llm.mixing import apportioned, mixed_texts, targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(spark, data):
    return {x.doc_id: x.text for x in spark.read.parquet(f"{data}/documents.parquet").collect()}


def test_languages_are_held_out_and_found(spark, data):
    lang = {x.doc_id: x.lang for x in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op1_language_id"](spark, data).collect()
    held = [x for x in got if x.held_out]
    assert 0.1 < len(held) / len(got) < 0.3
    assert sum(x.lang_pred == lang[x.doc_id] for x in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 for x in got)


def test_language_labels_learned_are_bounded_and_unknown_text_is_und(spark):
    rows = [("aa bb", "x"), ("aa bb", "x"), ("cc dd", "y"), ("ee", None), (None, "x"), ("12", "y")]
    counts = gram_counts(spark.createDataFrame(rows, "text string, lang string"))
    assert learned(counts).labels == ["x", "y"]
    assert learned(counts, 1).labels == ["x"]
    asked = spark.createDataFrame([(1, "aa"), (2, "12 34"), (3, None), (4, "dd")], "id int, text string")
    assert [x.lang_pred for x in identified(asked, learned(counts)).orderBy("id").collect()] == ["x", "und", "und", "y"]
    assert {x.lang_pred for x in identified(asked, learned(counts.limit(0))).collect()} == {"und"}


@pytest.mark.parametrize("memory", [1 << 28, 600])
def test_suffixes_and_common_prefixes_against_brute_force(memory, monkeypatch):
    random.seed(memory)
    for trial in range(60):
        monkeypatch.setattr(suffixes, "BATCH", 7 if trial % 3 == 0 else 1 << 18)
        letters = b"abcdefgh"[: random.choice([1, 2, 8])]
        pieces = [bytes(random.choices(letters, k=random.randint(1, 40))) for _ in range(random.randint(1, 8))]
        pieces += pieces[:2] + [pieces[0] * 3]
        depth = random.choice([3, 8, 20])
        text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.uint16) + 1, 0) for p in pieces]).astype(np.uint16)
        plain = text.tolist()
        found = [(int(p), int(c)) for at, common in suffixes.sorted_suffixes(text, depth, memory) for p, c in zip(at, common, strict=True)]
        assert sorted(p for p, _ in found) == list(range(len(plain)))
        for (p, _), (q, common) in zip(found, found[1:], strict=False):
            a, b = plain[p : p + depth], plain[q : q + depth]
            assert a <= b
            assert common == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        seen, again = set(), suffixes.repeats(text, depth, memory)
        for i in range(len(plain)):
            window = tuple(plain[i : i + depth])
            whole = len(window) == depth and 0 not in window
            assert again[i] == (whole and window in seen)
            seen |= {window} if whole else set()


def brute_cut(texts, length):
    seen, out = set(), {}
    for key in sorted(texts):
        data = (texts[key] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[key] = len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept
    return out


@pytest.mark.parametrize("many", [4096, 2])
def test_repeated_strings_against_brute_force(spark, many, monkeypatch):
    monkeypatch.setattr(substrings, "MANY", many)
    monkeypatch.setattr(substrings, "SHARD", 1 << 12)
    random.seed(3)
    word = lambda: "".join(random.choices("abcdé", k=random.randint(1, 5)))
    passage = " ".join(word() for _ in range(60))
    texts = {i: " ".join(word() for _ in range(40)) + (passage if i % 3 == 0 else "") + " ".join(word() for _ in range(9)) for i in range(40)}
    texts |= {50: texts[4], 51: "z" * 500, 52: texts[6] * 3, 53: None, 54: passage[:99], 55: "é" * 120, 56: "ab" * 200 + "c", 57: "ab" * 90}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in substrings.cut_repeats(frame, length=100).collect()}
    assert got == brute_cut(texts, 100)


def test_surrogates_are_consistent_distinct_and_of_the_same_form(spark, data):
    texts = texts_of(spark, data)
    texts |= {
        -1: "Mrs. Anna Kowalska met Mr Kowalska; mail Anna.K@firm.com, anna.k@FIRM.com or +1 (212) 555-0199, 212-555-0199.",
        -2: "Herr Schmidt zahlt mit 4111 1111 1111 1111 von 10.0.0.7, SSN 078-05-1120, GB82 WEST 1234 5698 7654 32",
        -3: "Господин Иванов и Госпожа Анна Иванова, password=hunter2secret",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x for x in pii.with_surrogates(frame, b"k").collect()}
    before = {(k, v) for t in texts.values() for _, _, k, v in pii.finds(t)}
    after = {}
    for key, text in texts.items():
        old, new = list(pii.finds(text)), list(pii.finds(got[key].text))
        assert [x[2] for x in old] == [x[2] for x in new] == list(got[key].pii_kinds)
        for (*_, kind, value), (*_, surrogate) in zip(old, new, strict=True):
            assert after.setdefault((kind, value), surrogate) == surrogate
            if kind == "card":
                assert pii.luhn(value) == pii.luhn(surrogate) and surrogate[0] == value[0]
            if kind == "iban":
                assert pii.iban_rest(surrogate) == 1
        if not old:
            assert got[key].text == text
    assert len({(k, s) for (k, _), s in after.items()}) == len(after)
    assert not before & {(k, s) for (k, _), s in after.items()}
    assert got[-1].text.startswith("Mrs. ") and got[-3].text[9:12] != "Ива"


def test_clashing_surrogates_are_drawn_again(spark, monkeypatch):
    # 300 two-digit values in a form with few others: first draws fall on originals
    texts = [(i, f"Mr {a}{b}x") for i, (a, b) in enumerate((a, b) for a in "ABCDEFGHIJKLMNOPQRST" for b in "abcdefghijklmno")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(pii, "MOST_SENT", 0)  # by join
    joined = {x.doc_id: x.text for x in pii.with_surrogates(frame, b"k").collect()}
    assert len(set(joined.values())) == len(texts) and not set(joined.values()) & {t for _, t in texts}
    monkeypatch.setattr(pii, "MOST_SENT", 50_000)
    assert {x.doc_id: x.text for x in pii.with_surrogates(frame, b"k").collect()} == joined


def test_license_notices():
    full = next(text for name, _, text in licenses.TEMPLATES if name == "MIT" and len(text) > 500)
    text = f"some prose. {full.replace('sublicense', 'relicense')}\nMore.\nLicensed under CC BY-NC-SA 4.0. End, released under the MIT License."
    found = [(text[a:b][:12], name, differences) for a, b, name, _, differences in licenses.notices(text)]
    assert [x[1] for x in found] == ["MIT", "CC-BY-NC-SA-4.0", "MIT"]
    assert found[0][2] == ["-sublicense", "+relicense"] and found[1][2] == []
    assert list(licenses.notices("a license to fish, copyright nobody")) == list(licenses.notices(None)) == []


def test_bpe_agrees_with_the_library(spark, data, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(list(texts_of(spark, data).items())[:60])
    odd = [None, "", "don't  \n x", "é" * 70, " " * 99 + "a", "a\u0085b\x1cc", "a" * 200, "日本語 🙂🇩🇪", "thequickbrown" * 9, "<|endoftext|>"]
    texts |= {-1 - i: x for i, x in enumerate(odd)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    tokens = Tokenizer(ranks, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "BLOCK", 60_000)  # many blocks
    got = with_ids(frame, tokens)
    got = got.select("doc_id", "text", "ids", tokens.decoded(got["ids"]).alias("back"), tokens.as_bytes(got["ids"]).alias("raw")).collect()
    assert {x.doc_id: x.text for x in got} == texts and len(got) == len(texts)
    for row in got:
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.ids == ids and bytes(row.back).decode() == (texts[row.doc_id] or "")
        assert bytes(row.raw) == np.array(ids, "<u4").tobytes()
    for row in encoded_bytes(frame, tokens, "text", ["doc_id"]).collect():
        ids = library.encode_ordinary(texts[row.row.doc_id] or "")
        assert bytes(row.raw) == np.array(ids, "<u4").tobytes() and bytes(row.back).decode() == (texts[row.row.doc_id] or "")


def test_bpe_keeps_columns_with_names_of_its_own(spark):
    tokens = Tokenizer(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    names = ["ids", "row", "block", "places", "words", "first", "word", "place", "a.b"]
    frame = spark.createDataFrame([(f"text {i}", *range(i, i + len(names))) for i in range(9)], ["text", *names])
    got = with_ids(frame, tokens)
    assert got.columns == ["text", *names, "ids_"]
    assert sorted(tuple(x)[:-1] for x in got.collect()) == sorted(map(tuple, frame.collect()))
    assert with_ids(frame.limit(0), tokens).collect() == []


def test_ranks_whose_tokens_are_not_made_of_lower_ones_are_known():
    single = {bytes([i]): i for i in range(256)}
    assert Tokenizer(single | {b"ab": 256, b"abc": 257}, r"\w+").nested
    assert not Tokenizer(single | {b"abc": 256, b"ab": 257}, r"\w+").nested


def test_sainte_lague_against_one_seat_after_the_other(spark):
    random.seed(5)
    rows = [(g, i, float(random.choice([0, 1, 3, 3, 50, 1000]))) for g in range(6) for i in range(random.randint(1, 30))]
    seats = {g: random.choice([0, 1, 7, 300]) for g in range(6)}
    cells = spark.createDataFrame([(g, i, w, seats[g]) for g, i, w in rows], "g int, i int, w double, seats long")
    got = {(x.g, x.i): x.quota for x in apportioned(cells, ["g"], "w", "seats", ["i"]).collect()}
    for g in range(6):
        own = {i: w for h, i, w in rows if h == g}
        want = dict.fromkeys(own, 0)
        if sum(own.values()):
            for _ in range(seats[g]):
                want[max(own, key=lambda i: (own[i] / (2 * want[i] + 1), -i))] += 1
            assert {i: got[g, i] for i in own} == want


def test_targets_fill_up_to_the_cap(spark):
    sources = spark.createDataFrame([("a", 1, 100), ("b", 1, 1000), ("c", 1, 10), (None, 1, 500)], "source string, docs long, source_size long")
    got = {x.source: x for x in targets(sources).collect()}
    assert [got[x].weight for x in ("a", "b", "c", None)] == [3, 1, 2, 3]
    assert got["a"].target == 200 and got["c"].target == 20
    assert abs(sum(x.target for x in got.values()) - 1.5 * 1610) < 1e-6
    assert all(x.target <= 2 * x.source_size for x in got.values())


def test_mixed_texts_have_the_words_that_are_taken(spark, data):
    taken = {x.doc_id: x.taken for x in QUERIES["op6_mix_sources"](spark, data).collect()}
    documents = spark.read.parquet(f"{data}/documents.parquet")
    words = {}
    for row in mixed_texts(documents).collect():
        words[row.doc_id] = words.get(row.doc_id, 0) + len(WORDS.findall(row.text))
    assert words == {k: v for k, v in taken.items() if v}


def brute_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark, data):
    texts = texts_of(spark, data) | {-1: None, -2: "", -3: "One two", -4: "one  TWO"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = simhash.fingerprints(frame)
    for tile in (simhash.TILE, 8):
        got = {x.doc_id: (x.fp % 2**64, x.component_id) for x in simhash.components(prints, tile=tile).collect()}
        ids = sorted(texts)
        plain = [brute_fingerprint(texts[i]) for i in ids]
        assert [got[i][0] for i in ids] == plain
        near = np.bitwise_count(np.array(plain, np.uint64)[:, None] ^ np.array(plain, np.uint64)) <= 4
        label = np.arange(len(ids))
        while (label != (new := np.array([label[x].min() for x in near]))).any():
            label = new
        assert [got[i][1] for i in ids] == [ids[x] for x in label]
    kept = {x.doc_id for x in simhash.one_of_each(frame).collect()}
    assert kept == {c for _, c in got.values()}


def test_dense_groups_give_spanning_forests_only():
    base = np.uint64(0x0123456789ABCDEF)
    values = np.unique(np.array([base ^ np.uint64(1 << i | 1 << j) for i in range(64) for j in range(64)], np.uint64))
    u, v = simhash.tile_links(values, values, 4)
    assert len(u) < len(values) and len(np.unique(v)) == 1


def test_archives_with_large_payloads_read_in_chunks(spark, tmp_path):
    random.seed(1)
    big = "".join(random.choices("ab\r\n ", k=50_000)) + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://x/a b", big), (2, None, big), (3, "u", ""), (4, "u", None), (5, "u", "\r\n\r\n"), (6, "u", "end\r\n"), (7, "u", "é\r\n\r\n\r\n")]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, segment=7_001)
    chunks = warc.read_chunks(spark, path, chunk=1_000).collect()
    assert max(len(x.payload) for x in chunks) <= 1_000
    for key, _, html in rows:
        own = sorted((x for x in chunks if x.record_id == f"urn:page:{key}"), key=lambda x: x.chunk_no)
        data = (html or "").encode()
        if own[0].type == "response":
            assert b"".join(bytes(x.payload) for x in own) == data
            assert own[-1].digest == own[-1].declared_digest == warc.base32(hashlib.sha1(data).hexdigest())
        assert [x.last for x in own] == [False] * (len(own) - 1) + [True]
    revisits = {x.record_id: x.refers_to for x in chunks if x.type == "revisit"}
    assert revisits == {"urn:page:2": "urn:page:1", "urn:page:4": "urn:page:3"}


def test_repetition_verdicts():
    counts = dict(zip(repetition.COUNTS, repetition.measure("a b c\n" * 30), strict=True))
    assert counts["n_words"] == 90 and counts["n_dup_lines"] == 29 and counts["n_repeat_words"] == 90
    assert not repetition.passes(repetition.measure("a b c\n" * 30)) and not repetition.passes(repetition.measure(None))
    random.seed(2)
    clean = " ".join("".join(random.choices("abcdefghij", k=6)) for _ in range(400))
    assert repetition.passes(repetition.measure(clean))
    assert not repetition.passes(repetition.measure(clean + " " + clean))


def test_spotsigs_with_the_next_document(spark, data):
    texts = texts_of(spark, data)
    texts |= {-1: texts[0], -2: "", -3: None, -4: "oak"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x for x in spotsigs.fingerprints_with_next(frame).collect()}
    ids = sorted(texts, reverse=True)
    for at, key in enumerate(ids):
        own, after = texts[key] or "", texts[ids[(at + 1) % len(ids)]] or ""
        n = len(own) // 3
        changed = own[: len(own) - n] + after[:n]
        a, b, c = (spotsigs.signatures(x) for x in (own, changed, after))
        assert got[key].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (got[key].fingerprint, got[key].edited_fingerprint) == (spotsigs.spelled(a), spotsigs.spelled(b))
        assert (got[key].near_edited, got[key].near_next) == (spotsigs.likeness(a, b), spotsigs.likeness(a, c))
    assert got[-1].fingerprint == got[0].fingerprint and got[-2].near_next == 1.0


def test_length_partitions_lose_no_likeness():
    random.seed(4)
    for _ in range(500):
        a, b = (np.unique(np.array(random.sample(range(60), random.randint(1, 50)), np.uint32)) for _ in range(2))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert spotsigs.likeness(a, b, 0.3) == exact or (exact < 0.3 and spotsigs.likeness(a, b, 0.3) == 0)


def test_every_character_is_cut_as_the_library_cuts_it():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cuts = regex.compile(public_tokenizers.PATTERN)
    for x in map(chr, (*range(0xD800), *range(0xE000, 0x110000))):
        text = f"the{x}the 12{x}34 ..{x}..  {x}{x} x"
        assert [i for cut in cuts.findall(text) for i in library._encode_single_piece(cut)] == library.encode_ordinary(text), hex(ord(x))
