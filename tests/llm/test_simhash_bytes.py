"""Fingerprints, links and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from pairprep.llm import simhash_bytes as H
from pairprep.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    size = min(4, len(words))
    made = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    groups = {}
    for x in range(n):
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def brute_classes(fps):
    near = [(a, b) for a, b in combinations(range(len(fps)), 2) if (int(fps[a]) ^ int(fps[b])).bit_count() <= 4]
    return classes(len(fps), near)


def clustered(seed, n, centres=4, flips=9):
    rnd = random.Random(seed)
    heads = [rnd.getrandbits(64) for _ in range(centres)]
    made = set()
    for _ in range(n):
        value = rnd.choice(heads)
        for _ in range(rnd.randint(0, flips)):
            value ^= 1 << rnd.randrange(64)
        made.add(value)
    return np.array(sorted(made), np.uint64)


def test_triples_cover_all_quadruples():
    triples = H.position_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(q) for t in triples) for q in combinations(range(8), 4))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b c", "a b c d", "É é A B\x0bc d e f g", "x y " * 500])
def test_fingerprint(text):
    assert H.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(6))
def test_forest_has_the_components_of_all_pairs(seed):
    fps = clustered(seed, 250)
    assert classes(len(fps), H.forest(fps)) == brute_classes(fps)


@pytest.mark.parametrize("list_rows", [H.LIST_ROWS, 20])
def test_links_over_spark(spark, list_rows):
    fps = clustered(9, 300)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    links = [(place[r.u], place[r.v]) for r in H.fingerprint_links(table, list_rows).collect()]
    assert all((int(fps[a]) ^ int(fps[b])).bit_count() <= 4 for a, b in links)
    assert classes(len(fps), links) == brute_classes(fps)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    loops = [(500, 500), (7, 6), (6, 7)]
    edges = spark.createDataFrame(chain + star + loops, "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(edges.limit(0)).count() == 0


def test_whole_operator(spark, docs):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(7, words), (3, words), (9, words.upper()), (4, "other text entirely with words"), (5, None), (8, "")]
    table = docs(rows + [(3, words)], "fp string")
    got = sorted((r.doc_id, r.component_id) for r in H.near_duplicates(table).collect())
    assert got == [(3, 3), (3, 3), (4, 4), (5, 5), (7, 3), (8, 5), (9, 3)]
    kept = H.keep_one(table.union(docs([(None, words)], "fp string")))
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0 for r in kept.collect())) == [0, 3, 4, 5]
    assert H.near_duplicates(table.limit(0)).count() == 0
