"""Groups of near copies against all pairs of shingle sets."""

import random
from itertools import combinations

import numpy as np
import pytest

from pairprep.llm import near_copies as N
from tests.llm.test_simhash_bytes import classes


def plain_set(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(texts):
    sets = [plain_set(t) for t in texts]
    return classes(len(texts), [(i, j) for i, j in combinations(range(len(texts)), 2) if similarity(sets[i], sets[j]) >= 0.8])


def reworded(seed, n=240, heads=12):
    """Texts and copies with up to 12 of 200 words replaced, on both sides of 0.8."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    made = [[word() for _ in range(200)] for _ in range(heads)]
    while len(made) < n:
        copy = list(rnd.choice(made[:heads]))
        for _ in range(rnd.randint(0, 12)):
            copy[rnd.randrange(len(copy))] = word()
        made.append(copy)
    return [" ".join(words) for words in made] + [None, "", " ", "one two", "ONE two", "x " * 50, "x " * 70]


def kept_of(table):
    kept = N.keep_one(table)
    assert kept.columns == table.columns
    return sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_forests(seed):
    texts = list(dict.fromkeys(reworded(seed)[:-7]))
    sets = [N.shingles_of(t) for t in texts]
    assert all(len(s) == len(plain_set(t)) for s, t in zip(sets, texts))
    assert classes(len(texts), N.similar_forest(sets)) == brute(texts)
    sketches = np.stack([np.frombuffer(N.mark_of(s), np.uint8)[N.DIGEST :] for s in sets])
    group = {i: k for k, g in enumerate(classes(len(texts), N.candidate_forest(sketches))) for i in g}
    assert all(len({group[i] for i in g}) == 1 for g in brute(texts))


def test_keeps_the_first_of_each_group(docs):
    texts = reworded(7)
    groups = brute(texts)
    assert 12 < len(groups) < 200
    assert [i for i, _ in kept_of(docs(list(enumerate(texts))))] == sorted((g[0] for g in groups), key=str)


@pytest.mark.parametrize("limit", [10**6, 9])
def test_blocks_do_not_change_links(spark, limit):
    texts = list(dict.fromkeys(reworded(5)[:-7]))
    sets = [(i, bytearray(N.mark_of(N.shingles_of(t))[N.DIGEST :])) for i, t in enumerate(texts)]
    table = spark.createDataFrame(sets, "node long, sketch binary")
    pairs = [(r.u, r.v) for r in N.candidate_links(table, limit).collect()]
    group = {i: k for k, g in enumerate(classes(len(texts), pairs)) for i in g}
    assert all(len({group[i] for i in g}) == 1 for g in brute(texts))
    members = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "root long, node long, text string")
    links = [(r.u, r.v) for r in N.similar_links(members, limit).collect()]
    assert classes(len(texts), links) == brute(texts)


def test_copies_beyond_four_bits(docs):
    from pairprep.llm.simhash_bytes import fingerprint_of

    texts = reworded(3)
    sets = [plain_set(t) for t in texts[:240]]
    far = next(
        (i, j)
        for i, j in combinations(range(240), 2)
        if 0.8 <= similarity(sets[i], sets[j]) < 1 and (fingerprint_of(texts[i]) ^ fingerprint_of(texts[j])).bit_count() > 4
    )
    assert kept_of(docs([(1, texts[far[0]]), (2, texts[far[1]])])) == [(1, texts[far[0]])]


def test_empty_table(docs):
    assert N.keep_one(docs([(1, "x")]).limit(0)).count() == 0


def test_rows_not_ids_are_kept(docs):
    first, second, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, first), (1, second), (2, first), (3, third), (None, third), (None, second), (None, "alone"), (None, "alone")]
    assert kept_of(docs(rows)) == sorted([(1, first), (1, second), (3, third), (None, "alone")], key=str)
    assert kept_of(docs([(4, first), (4, first)])) == [(4, first)]


def test_columns_of_any_name_stay(docs):
    text = " ".join(f"a{i}" for i in range(60))
    table = docs([(1, text), (2, text), (3, "other")], "_row string, row string, _mark string, node string, digest string")
    rows = N.keep_one(table).collect()
    assert sorted((r.doc_id, r._row, r.row, r._mark, r.node, r.digest) for r in rows) == [(i, *"xxxxx") for i in (1, 3)]


def test_intermediate_tables_go(spark, docs):
    from pairprep.sources import scratch

    text = " ".join(f"a{i}" for i in range(60))
    before = scratch.made()
    kept = N.keep_one(docs([(1, text), (2, text + " more"), (3, "other")]))
    assert scratch.made() == before + 2  # the rows, and which of them are dropped
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_simhash_proposes_pairs_that_the_sets_decide_on(spark):
    """With no pair from the longer index, the SimHash index still finds close texts; sets of less than 0.8 stay apart."""
    text = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, text), (2, text + " end"), (3, " ".join(f"v{i}" for i in range(400))), (4, text + " end")]
    marked = N.with_mark(spark.createDataFrame(rows, "_row long, text string")).select("_row", "_mark", "_fp", "text")
    nodes = marked.selectExpr("_row AS node", "_fp AS fp")
    assert {frozenset((r.u, r.v)) for r in N.simhash_links(nodes).collect()} >= {frozenset((2, 4)), frozenset((1, 2))}
    none = spark.createDataFrame([], "u long, v long")
    before, N.candidate_links = N.candidate_links, lambda sets: none
    try:
        found = {r._row: r.component for r in N.grouped(marked).collect()}
    finally:
        N.candidate_links = before
    assert found[1] == found[2] == found[4] and found[3] == 3
    far = [(n, N.shingles_of(t)) for n, t in ((1, "a b c d e f"), (2, "a b c d e g"))]
    assert N.similar_forest([s for _, s in far]) == []
