"""Collocations against plain Python, tries against counting, and the pieces of texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pairprep.llm import collocations as K


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, min_count, top, inside=50, longest=3):
    totals, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    found = {}
    for (lang, words), a in candidates.items():
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        covered = any(
            lang == other and len(w) > len(words) and 100 * b >= inside * a
            and any(w[i : i + len(words)] == words for i in range(len(w)))
            for (other, w), b in candidates.items()
        )
        if not covered:
            row = (-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]])
            found.setdefault(lang, []).append(row)
    out = set()
    for lang, kept in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def rows():
    rnd = random.Random(21)
    common = ["new", "York", "of", "the", "É", "état", "字", " x", "New", "don't", "a-b", " "]
    between = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "! "]
    made = []
    for _ in range(120):
        words = [rnd.choice(common) + rnd.choice(between) for _ in range(rnd.randint(0, 60))]
        made.append((rnd.choice(["en", "en", "fr", None, ""]), "".join(words)))
    return made + [("en", "New York is a city " * 400), ("en", None), (None, ""), ("de", " \t.,"), ("zz", "one two")] + made[:9]


@pytest.fixture(scope="module")
def table(spark):
    data = [(lang, text, "p", "h") for lang, text in rows()]
    return spark.createDataFrame(data, "lang string, text string, phrase string, hash string")


@pytest.mark.parametrize("top, block, words", [(2000, 1_000_000, 3), (7, 50, 3), (50, 90, 4)])
def test_equals_brute_force(table, top, block, words):
    got = K.collocations(table, min_count=4, top=top, block=block, max_words=words).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute(rows(), 4, top, longest=words)


def test_nothing_to_find(spark, table):
    assert K.collocations(table.limit(0)).count() == 0
    assert K.collocations(spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")).count() == 0


def test_ties_between_cuts_and_phrases(spark):
    text = "x y z. " * 20 + "q r. " * 20 + "b c. " * 20
    rows = [("en", text)]
    got = K.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert {tuple(r) for r in got} == brute(rows, 10, 2000)
    assert [r.phrase for r in sorted(got, key=lambda r: r.rank)] == ["b c", "q r", "x y z"]


def test_words_and_pieces():
    data = "A b.c  d\té\n\nlast".encode()
    words = K.words_in("en", data)
    spoken = [words.distinct[i].as_py().decode() for i in words.codes]
    assert spoken == ["a", "b", "c", "d", "é", "last"]
    assert words.together(2).tolist() == [True, False, True, True, False]
    assert words.together(3).tolist() == [False, False, True, False]
    assert len(K.words_in("en", b" ., ").codes) == 0 and len(K.words_in("en", b"").codes) == 0


def test_long_texts_are_cut_at_piece_ends(monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 20)
    rnd = random.Random(1)
    for _ in range(100):
        data = "".join(rnd.choice(["a", "bb ", "cc. ", "d" * 30, " "]) for _ in range(rnd.randint(0, 80))).encode()
        parts = list(K._cut(data))
        assert b"".join(parts) == data
        assert all(p[-1:] in (b".",) for p in parts[:-1])
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr", "en"]), pa.array(["a b c", "x. y " * 9, "d e"])], ["l", "t"])
    spoken = Counter((w.language, w.distinct[c].as_py()) for w in K.words_of(iter([batch])) for c in w.codes)
    assert spoken["fr", b"x"] == spoken["fr", b"y"] == 9 and spoken["en", b"d"] == 1


def test_trie_accepts_its_phrases_only():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    phrases = {(rnd.choice("ab"), " ".join(rnd.choices(words, k=rnd.randint(1, 4)))) for _ in range(3000)}
    phrases |= {(lang, w) for lang, p in phrases for w in p.split()}
    languages, texts = map(pa.array, zip(*sorted(phrases)))
    trie, states = K.build_trie(languages, texts)
    assert len(set(states.tolist())) == len(phrases)
    name = {s: p for s, p in zip(states.tolist(), sorted(phrases))}
    said = [rnd.choice(words + ["unknown"]) for _ in range(5000)]
    part = K.words_in("a", " ".join(said).encode())
    found = Counter(name[s] for reached in K.advance(trie, part, 4) for s in reached.tolist() if s in name)
    expected = Counter(
        ("a", " ".join(said[i : i + k])) for k in range(1, 5) for i in range(len(said) - k + 1)
        if ("a", " ".join(said[i : i + k])) in phrases
    )
    # A phrase of four words is only reached through its beginnings, which need not be asked for.
    assert found == expected
    assert list(K.advance(trie, K.words_in("other", b"w1 w2"), 3)) == []


def test_bitmap_loses_no_hash(spark):
    hashes = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000)
    rows = spark.createDataFrame([(int(h),) for h in hashes] + [(0,), (-1,)], "hash long")
    bits = K.bitmap_of(rows)
    known = np.concatenate((hashes, [0, -1])).view(np.uint64)
    assert K.in_bitmap(bits, known).all()
    others = np.random.default_rng(3).integers(0, 1 << 63, 5000).view(np.uint64)
    assert K.in_bitmap(bits, others).sum() < 5


def test_bitmap_reaches_the_driver_in_few_jobs(spark, monkeypatch):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    rows = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    fetched, fetch = [], type(rows).toLocalIterator

    def counted(df, *args):
        fetched.append(df.rdd.getNumPartitions())  # a job for each
        return fetch(df, *args)

    monkeypatch.setattr(type(rows), "toLocalIterator", counted)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        bits = K.bitmap_of(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert fetched == [K.SLICES] and K.SLICES < 40
    assert K.in_bitmap(bits, np.array([r.hash for r in rows.collect()]).view(np.uint64)).all()


def test_long_words_make_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_BYTES", 5_000)
    rows = [("en", f"{'x' * 3000} {'y' * 3000} z. " * 12 + f"a b c{i}. " * 11) for i in range(3)]
    got = K.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert {tuple(r) for r in got} == brute(rows, 10, 2000)


@pytest.mark.parametrize("settings, passes", [({}, 1), ({"PASS_BYTES": 1}, 2), ({"WORDS": 1}, 3)])
def test_texts_are_read_once_for_many_tries(spark, monkeypatch, settings, passes):
    for name, value in settings.items():
        monkeypatch.setattr(K, name, value)
    made, staged = [], K.stage
    monkeypatch.setattr(K, "stage", lambda df, name: made.append(name) or staged(df, name))
    rows = [(lang, "a b c. d e f. a c d. b e. e c " * 5) for lang in ("en", "fr")]
    phrases = {(lang, p) for lang in ("en", "fr") for p in ("a", "b", "c", "d", "e", "f", "a b", "a b c", "d e f", "b e", "a e", "c d")}
    counts = K.count_phrases(
        spark.createDataFrame(rows, "lang string, text string"), spark.createDataFrame(sorted(phrases), "lang string, phrase string"), 3, 8
    )
    expected = Counter(
        (lang, " ".join(w[i : i + k])) for lang, text in rows for w in pieces(text) for k in (1, 2, 3) for i in range(len(w) - k + 1)
    )
    assert {(r.lang, r.phrase): r.n for r in counts.collect()} == {p: expected[p] for p in phrases if expected[p]}
    assert made.count("phrase-counts") == passes


def test_words_with_one_hash_are_kept_apart(monkeypatch):
    hashes = K.word_hashes
    monkeypatch.setattr(K, "word_hashes", lambda words, seed: hashes(words, seed) % np.uint64(40 if seed < 8 else 1000))
    languages, words = pa.array(["a"] * 20 + ["b"] * 20), pa.array([f"w{i}" for i in range(20)] * 2)
    known = K.vocabulary_of(languages, words, np.arange(40))
    assert known.seed >= 8 and sorted(known.numbers.tolist()) == list(range(40))
    asked = pa.array([f"w{i}".encode() for i in range(300)], pa.large_binary())
    a, b = known.numbers_of("a", asked), known.numbers_of("b", asked)
    assert a[:20].tolist() == list(range(19, -1, -1)) and b[:20].tolist() == list(range(39, 19, -1))
    assert (a[20:] == 40).all() and (b[20:] == 40).all() and (known.numbers_of("c", asked) == 40).all()


def test_word_hashes_differ():
    words = pa.array([b"", b"a", b"b", b"ab", b"ba", b"aa", b"aaa", b"\x00", b"\x00\x00"] + [f"{i}".encode() for i in range(5000)], pa.large_binary())
    hashes = K.word_hashes(words, 7)
    assert len(set(hashes.tolist())) == len(words) and not set(hashes.tolist()) & set(K.word_hashes(words, 8).tolist())
    assert K.word_hashes(words.slice(3), 7).tolist() == hashes[3:].tolist() and len(K.word_hashes(words[:0], 7)) == 0


def test_bitmaps_grow_with_their_hashes():
    assert K.bits_for(0) == K.bits_for(1_000_000) == K.BITS and K.bits_for(1 << 40) == K.MOST_BITS
    assert K.bits_for(K.BITS // K.HASH_BITS + 1) == 2 * K.BITS
