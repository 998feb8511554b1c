"""Base metrics against plain Python, and the cascade's verdict in any order."""

import random
import re
from collections import Counter
from itertools import pairwise

from pyspark.sql import functions as F

from pairprep.llm import rule_cascade as R


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    repeat = {w for i, g in enumerate(grams) if seen[g] > 1 for w in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeat),
    )


def texts():
    rnd = random.Random(5)
    parts = ["a", "b", "É", "x|y", "\n", "\n\n", " ", "\t", "\x0b", "字", "#", "\u00a0", "\u2028", "same line\n"]
    made = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    return made + [None, "", " ", "a b c " * 2000, "one two", " ".join(f"w{i}" for i in range(20_000))]


def test_metrics(docs):
    values = texts()
    rows = R.with_metrics(docs(list(enumerate(values)), "n_words string")).drop("_words").collect()
    for r in rows:
        assert tuple(r[m] for m in R.METRICS) == brute(values[r.doc_id]), values[r.doc_id]


def test_the_order_does_not_change_the_verdict(docs):
    table = docs([(i, f"{'word ' * (i % 90)}{'#' * (i % 13)} {i}") for i in range(300)] + [(None, None)])
    scored = R.with_metrics(table)
    rules = R.default_rules()
    names = list(rules)
    for order in (names, names[::-1], names[3:] + names[:3]):
        got = scored.where(R.cascade(rules, order).isNull()).count()
        assert got == scored.where(~F.greatest(*rules.values())).count()


def test_rules_are_ordered_by_rejections_per_cost(docs):
    table = R.with_metrics(docs([(i, "some words " * 30 + "#" * (i % 50)) for i in range(200)]))
    found = R.measured(table, R.default_rules())
    rates = [share / seconds for _, share, seconds in found]
    assert all(a >= b for a, b in pairwise(rates)) and found[0][0] == "symbols"
    empty = R.measured(table.limit(0), R.default_rules())
    assert [name for name, *_ in empty] == list(R.default_rules())


def test_whole_operator(docs):
    good = " ".join(f"word{chr(97 + i % 26)}{i}x" for i in range(80))
    rows = R.judge(docs([(1, good), (2, "short"), (3, None), (1, good), (4, good + " #" * 40)], "base_failed string")).collect()
    got = sorted((r.doc_id, r.base_failed, r.failed_rule) for r in rows)
    assert got == [(1, False, None), (1, False, None), (2, True, "base"), (3, True, "base"), (4, False, "symbols")]
    assert R.judge(docs([(1, good)]).limit(0)).count() == 0


def test_the_sample_is_drawn_from_all_rows_and_moves_only_itself(docs):
    table = docs([(i, f"text {i}") for i in range(4000)]).repartition(8)
    ids = [r.doc_id for r in R.sampled(table, 400).collect()]
    assert len(ids) == len(set(ids)) and 300 < len(ids) < 500 and min(ids) < 400 and max(ids) > 3600
    assert R.sampled(table, 10_000).count() == 4000 and R.sampled(table.limit(0)).count() == 0
