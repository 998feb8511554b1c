"""Removal of repeated strings against a count of every string."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairprep.llm import suffix_levels as L
from pairprep.llm import windows as W

SIZE = W.SIZE


def brute(rows):
    """(doc_id, kept bytes, removed runs) of every row."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + SIZE] for b in data for i in range(len(b) - SIZE + 1))
    out = []
    for (doc, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - SIZE + 1):
            if seen[b[i : i + SIZE]] > 1:
                gone[i + 1 : i + 1 + SIZE] = True
        edges = np.flatnonzero(np.diff(gone.astype(int)))
        out.append((doc, bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]]), [tuple(e) for e in edges.reshape(-1, 2)]))
    return sorted(out, key=repr)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def rows_with_passages(seed=1):
    rnd = random.Random(seed)
    passages = [prose(rnd, n) for n in (60, 80, 100, 150, 300)]
    rows = []
    for i in range(50):
        text = prose(rnd, rnd.randint(5, 150))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            p = p[rnd.randint(0, len(p) // 3) : len(p) - rnd.randint(0, len(p) // 4)]
            if rnd.random() < 0.5:
                k = rnd.randrange(len(p))
                p = p[:k] + "Z" + p[k + 1 :]
            text += p + prose(rnd, rnd.randint(0, 40))
        rows.append((i, text))
    rows += [(100, "a" * 1500), (101, None), (102, ""), (103, "ab" * 700), (5, rows[5][1])]
    return rows + [(None, rows[6][1][:900]), (None, rows[7][1]), (104, (prose(rnd, 30) + "\n") * 12)]


@pytest.mark.parametrize("hot_runs", [L.HOT_RUNS, 7, 1])
def test_removed_bytes(docs, hot_runs):
    rows = rows_with_passages()
    table = docs(rows, "spans string")
    found = L.remove_repeated(table, hot_runs=hot_runs)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "kept"]
    got = [(r.doc_id, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_hot_core_is_cut_into_pieces(docs, monkeypatch):
    """A passage between many different contexts: its ends are one core each, with a kind per text."""
    rnd = random.Random(9)
    passage = prose(rnd, 120)
    rows = [(i, prose(rnd, 12) + passage + prose(rnd, 12)) for i in range(60)]
    rows += [(100 + i, prose(rnd, 4)[-9:] + passage[:700]) for i in range(40)]
    rounds = []
    halves = L._halves
    monkeypatch.setattr(L, "_halves", lambda contents: rounds.append(1) or halves(contents))
    found = L.remove_repeated(docs(rows, "spans string"), hot_runs=10)
    got = [(r.doc_id, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows) and 1 <= len(rounds) <= 8


def test_pieces_hold_every_string_once(spark):
    rnd = random.Random(2)
    text = bytes(rnd.randrange(97, 123) for _ in range(900))
    _, _, first, last, at = (x[1:-1] for x in W.runs_of(text))
    rows = [
        (7, 8, 0, 1, int(f), int(l), int(a), 0, W.SPREAD, text[f : l + SIZE]) for f, l, a in zip(first, last, at)
    ]
    kinds = "core long, run long, _doc long, _hash long, first long, last long, at long, lo long, hi long, content binary"
    pieces = L._halves(spark.createDataFrame(rows, kinds)).collect()
    starts = sorted(i for p in pieces for i in range(p.first, p.last + 1))
    assert starts == list(range(int(first[0]), int(last[-1]) + 1))
    for p in pieces:
        assert bytes(p.content) == text[p.first : p.last + SIZE]
        assert p.lo <= p.at - (p.last - p.first) and p.at <= p.hi
        assert (p.of_core, p.of_run) == (7, 8) and p.skip == p.first - max(f for f in first if f <= p.first)


def test_removal_comes_from_the_levels(docs, monkeypatch):
    """Equal hashes alone remove nothing: without the scan, copies stay whole."""
    scan = L._scan_runs
    monkeypatch.setattr(L, "_scan_runs", lambda contents: scan(contents).limit(0))
    table = docs([(i, "word " * 200) for i in range(3)], "spans string")
    assert [len(r.spans) for r in L.remove_repeated(table).collect()] == [0, 0, 0]


def test_own_columns_and_many_repeated_rows(docs):
    """Columns named like those of the module keep their values; a row forty times is one text of forty."""
    text = prose(random.Random(4), 90)
    table = docs([(1, text)] * 40 + [(2, "x" + text[50:]), (3, "short")], "spans string")
    for name in ("_doc", "_hash", "_text", "_all", "core", "run", "first"):
        table = table.withColumn(name, F.lit(name))
    found = L.remove_repeated(table, hot_runs=20).collect()
    assert all(r[c] == c for r in found for c in ("_doc", "_hash", "_text", "_all", "core", "run", "first"))
    got = [(r.doc_id, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in found]
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in table.collect()])


def test_empty_table(docs):
    assert L.remove_repeated(docs([(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("batch", [1, 3, 64])
def test_levels_find_what_one_array_finds(batch):
    """Runs around a shared core, in batches of any size, against all strings compared."""
    rnd = random.Random(batch)
    size, core = 40, bytes(rnd.randrange(97, 100) for _ in range(30))
    runs = []
    for _ in range(60):
        back = bytes(rnd.randrange(97, 99) for _ in range(rnd.randint(0, 12)))
        ahead = core + bytes(rnd.randrange(97, 99) for _ in range(rnd.randint(10, 20)))
        runs.append((ahead, back))
    family = L.LevelFamily(size)
    for at in range(0, len(runs), batch):
        family.add(runs[at : at + batch])
    sizes = [len(level) for level in family.levels]
    assert sum(sizes) == 60 and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    strings = {}
    for i, (ahead, back) in enumerate(runs):
        for a in range(len(back) + 1):
            if len(ahead) >= size - a:
                strings.setdefault((back[:a][::-1] + ahead[: size - a], a), []).append(i)
    want = {(i, a) for (_, a), owners in strings.items() if len(owners) > 1 for i in owners}
    assert {(i, int(a)) for i, m in enumerate(family.marks) for a in np.flatnonzero(m)} == want


def test_runs_of_a_long_text_are_whole(monkeypatch):
    rnd = random.Random(3)
    data = bytes(rnd.randrange(97, 123) for _ in range(5000)) * 2
    monkeypatch.setattr(W, "AT_ONCE", 1 << 12)
    _, _, first, last, at = W.runs_of(data)
    assert first[0] == 0 and last[-1] == len(data) - SIZE
    assert (first[1:] == last[:-1] + 1).all() and (at >= last - first).all()
