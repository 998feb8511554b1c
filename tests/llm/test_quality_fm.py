"""The pair identity, held-out accuracy, and inputs that must not matter."""

import numpy as np
import pytest

from pairprep.llm import quality_fm as Q
from tests.llm.tables import SF_DIR, needs_tables


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    machine = Q.Machine(0.3, rng.normal(size=40), rng.normal(size=(40, 5)))
    rows = [(np.sort(rng.choice(40, n, replace=False)), rng.normal(size=n)) for n in (1, 2, 9, 17)]
    places, values, begin = Q._stacked(rows)
    got = machine.raw(places, values, begin)[0]
    for (p, x), value in zip(rows, got):
        v = machine.factor[p] * x[:, None]
        pairs = sum(v[i] @ v[j] for i in range(len(p)) for j in range(i))
        assert value == pytest.approx(0.3 + machine.weight[p] @ x + pairs)


@pytest.mark.parametrize("text", [None, "", " ", "é", "Word " * 50_000, "a" * 3_000_000])
def test_features_of_odd_texts(text):
    places, values = Q.features(text, None)
    assert len(places) == len(values) and np.isfinite(values).all()
    assert len(np.unique(places)) == len(places)


def test_words_are_hashed_without_case():
    assert (Q._word_hashes(np.frombuffer(b"One tWo", np.uint8)) == Q._word_hashes(np.frombuffer(b" one\ttwo\n", np.uint8))).all()


@needs_tables
def test_held_out_accuracy(spark):
    scored = Q.op2_quality_fm(spark, SF_DIR).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    own = scored.merge(labels, on="doc_id")
    own = own[own.held_out]
    assert scored.score.between(0, 1).all() and len(own) > 40
    assert (own.predicted == own.quality).mean() > 0.95


def test_small_and_empty_inputs(spark, docs):
    rows = [(i, "fine words here " * 20 if i % 2 else "### $$$ " * 20) for i in range(60)]
    table = docs([*rows, (None, None), (500, "")], "score string")
    label_rows = [(i, i % 2, 0) for i in range(60)] + [(1, None, 0), (None, 1, 0), (3, 7, 0)]
    labels = spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int")
    scored = Q.with_score(table, Q.fit(table, labels)).collect()
    assert all(0 <= r.score <= 1 for r in scored)
    assert all((r.score >= 0.3) == (r.doc_id % 2 == 1) for r in scored if r.doc_id is not None and r.doc_id < 60)
    unfitted = Q.with_score(table, Q.fit(table, labels.limit(0))).collect()
    assert all(abs(r.score - 0.5) < 0.3 for r in unfitted)
    assert Q.keep_good(table.limit(0), labels).count() == 0
    assert Q.keep_good(table, labels).columns == table.columns


def test_the_driver_holds_features_as_numbers(spark, docs, monkeypatch):
    texts = [(i, f"some words {i} " * (i % 4)) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "train", lambda rows, _: seen.extend(rows))
    Q.fit(docs(texts), labels)
    ids = sorted(r.doc_id for r in labels.where(~Q.held_out()).collect())
    assert len(seen) == len(ids)
    for (places, values), i in zip(seen, ids):
        right = Q.features(texts[i][1], len(texts[i][1]))
        assert (places == right[0]).all() and (values == right[1]).all()
        # Views of what Spark sent, not copies made from Python lists.
        assert not places.flags.owndata and not values.flags.owndata
