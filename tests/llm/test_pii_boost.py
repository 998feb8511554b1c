"""Base spans against Python's regex engine, further spans, and redaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pairprep.llm import pii_boost as B


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


STATED = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
)


def brute(text):
    return [(k, m.start(), m.end()) for k, p, holds in STATED for m in re.finditer(p, text or "") if holds(m)]


PARTS = ["a@b.c", "@", "x.y", "1.2.3.4", "300.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111", "+49 170 1234567"]
PARTS += ["+", "(", ")", " ", "-", ".", "_", "12", "0", "é", "字", "\n", "d.e@f.g_h@i.j", "%", "5500000000000004", "9"]


def test_base_spans(docs):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "a" * 50_000 + "@b.co"), (2003, "a@" + "b." * 20_000 + "c")]
    rows += [(2004, "+1" + "(" * 20_000), (2005, "1 " * 20_000), (2006, "00000000255.0.0.1"), (1, rows[1][1])]
    texts = dict(rows)
    found = B.find_personal_data(docs(rows, "spans string"), B.NOTHING).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(s) for s in r.spans] == brute(texts[r.doc_id]), texts[r.doc_id][:200]


def modulo_97(m):
    return int("".join(str(int(c, 36)) for c in m[4:] + m[:4])) % 97 == 1


def account(rnd):
    """A valid account number, in groups of four or in one."""
    body = "".join(rnd.choice("0123456789") for _ in range(18))
    check = 98 - int(body + "131400") % 97  # D is 13, E is 14
    whole = f"DE{check:02d}{body}"
    return " ".join(whole[i : i + 4] for i in range(0, 22, 4)) if rnd.random() < 0.5 else whole


def planted(n, seed=11):
    """(doc_id, text), planted further personal data by doc_id, and things that only look like it.

    Cues stand before seven of ten mail addresses and phone numbers, before none of the others.
    """
    rnd = random.Random(seed)
    word = lambda k=6: "".join(rnd.choice("abcdefghij") for _ in range(k))
    cued = lambda cue: [cue] if rnd.random() < 0.7 else []
    rows, truth = [], {}
    for i in range(n):
        said, put = [word() for _ in range(30)], None
        kind = i % 6
        if kind == 0:
            said[7:7] = [*cued("mail"), f"{word()}@{word()}.com"]
        elif kind == 1:
            put = f"{word()}[at]{word()}.com"
            said[7:7] = [*cued("contact"), put]
        elif kind == 2:
            put = f"(0{rnd.randrange(20, 99)}) {rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
            said[7:7] = [*cued("phone"), put]
        elif kind == 3:
            put = account(rnd)
            said[7:7] = [put]
        elif kind == 4:
            said[9] = f"{rnd.randrange(10**7, 10**8)}"
        else:
            said[9] = f"+49 170 {rnd.randrange(10**6, 10**7)}" if i % 4 else "AB12 " + "WXYZ " * 4
        rows.append((i, " ".join(said)))
        if put:
            truth[i] = put
    return rows, truth


@pytest.mark.parametrize("n, least", [(600, 0.6), (3000, 0.95)])
def test_further_spans_of_planted_data(docs, n, least):
    """Few rows leave a form's share of evidence uncertain, so that it may add nothing, not more."""
    rows, truth = planted(n)
    table = docs(rows, "spans string")
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in B.find_personal_data(table, B.fit(table)).collect()}
    caught, wrong = set(), []
    for i, text in rows:
        base = [s for s in found[i] if s[0] != "pii"]
        more = [s for s in found[i] if s[0] == "pii"]
        assert base == brute(text) and found[i] == base + more and len(set(more)) == len(more)
        assert not any(s[1] < b[2] and b[1] < s[2] for s in more for b in base)
        for _, start, end in more:
            at = text.find(truth[i]) if i in truth else -1
            (caught.add(i) if at >= 0 and start < at + len(truth[i]) and at < end else wrong.append(text[start:end]))
    hit = [i for i in truth if i in caught or brute(rows[i][1])]
    assert len(hit) >= least * len(truth) and len(wrong) <= 0.02 * len(caught), (len(hit), len(truth), wrong[:5])


def test_sample_bounds_the_fit_not_the_thresholds(docs):
    """A small sample fits the trees; forms are calibrated on all other documents."""
    rows, truth = planted(1800)
    table = docs(rows)
    booster = B.fit(table, train_docs=300)
    assert booster.trees and all(t < 1 for t in booster.thresholds)
    more = B.find_personal_data(table, booster).where(F.exists("spans", lambda s: s["kind"] == "pii"))
    assert more.count() >= 0.9 * len(truth)


def test_account_check_digits(spark):
    rnd = random.Random(5)
    rows = [(account(rnd),) for _ in range(50)] + [("GB82 WEST 1234 5698 7654 32",), ("GB82 WEST 1234 5698 7654 33",)]
    got = spark.createDataFrame(rows, "m string").select("m", B.modulo_97(F.col("m")).alias("ok")).collect()
    assert [r.ok for r in got] == [modulo_97(r.m.replace(" ", "")) for r in got]
    assert [r.ok for r in got[-2:]] == [True, False] and all(r.ok for r in got[:50])


def test_without_evidence_nothing_is_added(docs):
    assert B.fit(docs([(i, "no such data 12345678") for i in range(50)])) == B.NOTHING
    assert B.fit(docs([(i, f"x a{i}@b.co and 1234567 here") for i in range(50)])) == B.NOTHING
    assert B.fit(docs([(1, "x")]).limit(0)) == B.NOTHING


def bins(*rows):
    return [dict(zip(("base", "bin", "n", "hits"), r)) for r in rows]


def test_thresholds():
    # Half of the base matches have a cue: a further set needs 0.9 of that, at any size.
    known = (True, 500, 100, 50)
    for k in (1, 1000):
        assert B._calibrated(bins(known, (False, 900, 10 * k, 5 * k), (False, 100, 10 * k, k))) == 0.9
    assert B._calibrated(bins(known, (False, 900, 10, 4))) == B.NEVER
    # Chance cues count for nothing, and without base matches nearly all need evidence.
    assert B._calibrated(bins((True, 500, 100, 1), (False, 900, 100, 2))) == B.NEVER
    assert B._calibrated(bins((False, 900, 100, 95), (False, 800, 100, 60))) == 0.9
    assert B._calibrated([]) == B.NEVER


def test_redaction(docs):
    rows = [(1, "é a@b.co, 1.2.3.4!"), (2, None), (3, "clean"), (None, "+49 170 1234567"), (4, "")]
    table = docs(rows, "spans string")
    got = {r.doc_id: (r.text, r.n_chars) for r in B.redact(table).collect()}
    assert B.redact(table).columns == table.columns
    assert got == {1: ("é [EMAIL], [IP]!", 16), 2: (None, None), 3: ("clean", 5), None: ("[PHONE]", 7), 4: ("", 0)}
    assert B.redact(table.limit(0)).count() == 0


def test_overlapping_spans_leave_one_mark(spark):
    df = spark.sql(
        "SELECT 'abcdefghij' AS t, array(named_struct('kind', 'x', 'start', 2L, 'end', 5L), "
        "named_struct('kind', 'y', 'start', 4L, 'end', 7L)) AS s"
    )
    assert df.select(B.redacted(F.col("t"), F.col("s"))).first()[0] == "ab[X]hij"
