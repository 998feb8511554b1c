"""Repeated lines against plain Python, the levels of the runs, and joins without a shuffle of runs."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairprep.llm import line_runs as L

CLASHING = "kept string, key string, doc string, row string, places string, lines string"


def key_of(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)


def brute(rows, min_chars, min_docs):
    count, holder = Counter(), defaultdict(lambda: None)
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in texts:
        for key in {key_of(x) for x in lines}:
            count[key] += 1
            if i is not None and (holder[key] is None or i > holder[key]):
                holder[key] = i
    found = []
    for i, lines in texts:
        gone = [
            len(key_of(x)) >= min_chars and count[key_of(x)] >= min_docs and i != holder[key_of(x)] for x in lines
        ]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        found.append((i, len(lines), sum(gone), kept))
    return Counter(found)


def rows():
    rnd = random.Random(12)
    shared = ["The same long line", "the SAME long line \t", "Éa long line of its own", "éa long line of its own"]
    shared += [f"line number {n} of many" for n in range(30)] + ["", " ", "short", "\x0b\x0c", " line with other blanks"]
    made = []
    for i in range(120):
        lines = [rnd.choice(shared) for _ in range(rnd.randint(0, 12))] + [f"only here {i}"] * rnd.randint(0, 2)
        made.append((i * 3 - 50, "\n".join(lines)))
    hot = [(1000 + i, f"hot line that very many hold\nown {i}\nhot line that very many hold") for i in range(300)]
    odd = [(7, None), (8, ""), (None, "the same long line\nx"), (None, None), (9, "\n\n"), (10, "x" * 300_000 + "\ny")]
    return made + made[:20] + hot + odd + [(10, "x" * 300_000)] * 5


@pytest.mark.parametrize("batches, min_docs", [(4, 5), (1, 2), (7, 1)])
def test_equals_brute_force(docs, batches, min_docs):
    table = rows()
    got = L.drop_repeated_lines(docs(table, CLASHING).drop("kept"), min_chars=12, min_docs=min_docs, batches=batches)
    found = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect())
    assert found == brute(table, 12, min_docs)
    assert {r.key for r in got.select("key").distinct().collect()} == {"x"}


def test_lines_that_only_rows_without_id_hold_stay(docs):
    line = "a line that is long enough to be looked at"
    got = L.drop_repeated_lines(docs([(None, f"{line}\n{n}") for n in range(6)])).collect()
    assert all(r.n_dropped == 0 for r in got)
    got = L.drop_repeated_lines(docs([(None, f"{line}\n{n}") for n in range(6)] + [(1, line)])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 1)] * 6 + [(1, 0)]


def test_empty_table_and_given_results(docs):
    assert L.drop_repeated_lines(docs([(1, "x")], "kept string").limit(0)).count() == 0
    row = L.drop_repeated_lines(docs([(1, "a\nb")], "kept string, n_lines string")).first()
    assert (row.n_lines, row.n_dropped, row.kept) == (2, 0, "a\nb")


def test_runs_merge_level_by_level(spark, docs):
    table = docs([(i, "\n".join(f"line {n} that is long enough to be counted" for n in range(i, i + 4))) for i in range(40)])
    places = L.with_batches(L.line_places(table, "text", "doc_id", 20), table, "doc_id", 4)
    family = L.LineRuns(spark, buckets=3)
    sizes = []
    for batch in range(4):
        family.add(places.where(F.col("batch") == batch))
        sizes.append([len(level) for level in family.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1]]
    exact = {r.key: (r.n, r.holder) for r in family.merged().collect()}
    lines = Counter(n for i in range(40) for n in range(i, i + 4))
    assert sorted(exact.values()) == sorted((c, min(n, 39)) for n, c in lines.items())
    family.close()
    assert not family.runs() and family.merged() is None


def test_merging_moves_only_the_new_batch(spark, docs):
    table = docs([(i, f"line {i % 7} that is long enough to be counted") for i in range(40)])
    places = L.with_batches(L.line_places(table, "text", "doc_id", 20), table, "doc_id", 3)
    family = L.LineRuns(spark, buckets=4, fan_out=5)
    for batch in range(2):
        family.add(places.where(F.col("batch") == batch))
    own = places.where("batch = 2").groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = family.with_known(own.repartition(4, "key"))._jdf.queryExecution().executedPlan().toString()
        merge = family.merged()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Two runs are joined; what moves is the batch: once to group it and, by other buckets, once more.
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") <= 2
    assert "Exchange" not in merge
    family.close()


def test_no_python_in_the_plan(docs):
    plan = L.drop_repeated_lines(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
