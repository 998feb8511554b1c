"""Word-window search against a direct comparison at every place."""

import random

from pairprep.llm import wu_manber as M


def brute(text, items, window=13):
    words = M.words_of(text)
    hit, found = set(), set()
    for item, said in items:
        own = M.words_of(said)
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[at : at + size]:
                    hit |= set(range(i, i + size))
                    found.add(item)
    return len(words), sorted(hit), sorted(found)


def cases():
    rnd = random.Random(7)
    vocabulary = ["a", "b", "É1", "c2"]
    items = [(n, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 20)))) for n in range(12)]
    items += [(50, ""), (51, "zz"), (52, "zz"), (3, items[3][1])]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    texts += [texts[0] + ", " + items[0][1].upper().replace("É", "é") + "! " + items[1][1], None, "", "...", "zz"]
    return items, texts


def check(row, text, items):
    n, hit, found = brute(text, items)
    inside = [w for s in row.hits for w in range(s.start, s.end)]
    assert (row.n_words, inside, row["items"]) == (n, hit, found)
    ends = [(s.start, s.end) for s in row.hits]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_search_equals_brute_force(spark, docs):
    items, texts = cases()
    bench = spark.createDataFrame([*items, (None, "a b"), (60, None)], "item_id long, text string")
    table = docs(list(enumerate(texts)) + [(0, texts[0])], "hits string")
    for block_bytes in (M.BLOCK_BYTES, 100):
        rows = M.find_contamination(table, bench, block_bytes=block_bytes).collect()
        assert len(rows) == len(texts) + 1
        for r in rows:
            check(r, texts[r.doc_id], items)


def test_rejected_documents_go(spark, docs):
    said = " ".join(f"w{i}" for i in range(13))
    bench = spark.createDataFrame([(1, said)], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(300))
    table = docs([(1, said), (2, filler + " " + said), (3, filler), (4, None), (None, said)])
    kept = M.decontaminate(table, bench)
    assert kept.columns == table.columns
    # Document 2: 20 * 13 < 313, below one word in twenty.
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert M.decontaminate(table.limit(0), bench).count() == 0
    assert M.decontaminate(table, bench.limit(0)).count() == 5
