import hashlib
import math
import random

import pytest
from pairprep.operators.batching import length_batches, pad_batches, step_plan
from pairprep.operators.ranking import global_hash_rank


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, [rng.randint(2, 99) for _ in range(rng.randint(1, 30))]) for i in range(1000)]


@pytest.fixture(scope="module")
def tokens(spark, rows):
    data = [(i, ids, [1] * len(ids), [-100] + ids[1:]) for i, ids in rows]
    schema = "pair_id long, input_ids array<int>, attention_mask array<int>, labels array<int>"
    return spark.createDataFrame(data, schema)


def plan(rows, size):
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))
    batches = []
    for at in range(0, len(order), 50 * size):
        mega = sorted(order[at : at + 50 * size], key=lambda r: -len(r[1]))
        batches += [mega[i : i + size] for i in range(0, len(mega), size)]
    return batches


@pytest.mark.parametrize("size", [6, 7])
def test_batches_and_padding(tokens, rows, size):
    expected = plan(rows, size)
    batched = length_batches(tokens.repartition(5), size)
    padded = {r.batch_id: r for r in pad_batches(batched).collect()}
    assert sorted(padded) == list(range(len(expected)))
    for n, batch in enumerate(expected):
        width = math.ceil(max(len(ids) for _, ids in batch) / 8) * 8
        row = padded[n]
        assert row.width == width
        assert row.pair_ids == [k for k, _ in batch]
        assert row.input_ids == [ids + [0] * (width - len(ids)) for _, ids in batch]
        assert row.attention_mask == [[1] * len(ids) + [0] * (width - len(ids)) for _, ids in batch]
        assert row.labels == [[-100] + ids[1:] + [-100] * (width - len(ids)) for _, ids in batch]


def test_wide_rows_move_once(tokens):
    """One exchange carries the arrays, and neither the windows nor padding add one."""
    plan = pad_batches(length_batches(tokens))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    wide = [line for line in exchanges if "REPARTITION_BY_NUM" in line]
    assert len(wide) == 1
    narrow = [line for line in exchanges if line not in wide]
    # The others are below the broadcast side, on keys.
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    assert all(indent(line) > indent(wide[0]) for line in narrow)


@pytest.mark.parametrize("size, partitions", [(1, 3), (1, 64), (7, 2), (400, 4)])
def test_parts_hold_whole_megabatches(spark, tokens, rows, size, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = length_batches(tokens.repartition(6), size).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = {}
    for r in found:
        parts.setdefault(r.megabatch, set()).add(r.batch_part)
    assert all(len(p) == 1 for p in parts.values())
    expected = [[k for k, _ in batch] for batch in plan(rows, size)]
    got = {}
    for r in sorted(found, key=lambda r: (r.batch_id, r.batch_pos)):
        got.setdefault(r.batch_id, []).append(r.pair_id)
    assert [got[b] for b in sorted(got)] == expected
    assert found[0].asDict().keys() >= {"input_ids", "labels", "batch_pos"}


def test_no_rows(tokens):
    assert pad_batches(length_batches(tokens.limit(0))).count() == 0


def test_steps(tokens):
    steps = step_plan(length_batches(tokens, 6), 8).collect()
    assert all(r.optimizer_step == r.batch_id // 8 and r.micro_batch == r.batch_id for r in steps)
    per_step = {}
    for r in steps:
        per_step[r.optimizer_step] = per_step.get(r.optimizer_step, 0) + 1
    assert [per_step[s] for s in sorted(per_step)] == [48] * 20 + [40]


def test_rank_is_dense_and_stable(tokens):
    first = {r.pair_id: r.rank for r in global_hash_rank(tokens.select("pair_id"), 1, "pair_id").collect()}
    again = global_hash_rank(tokens.select("pair_id").repartition(9), 1, "pair_id").collect()
    assert sorted(first.values()) == list(range(1000))
    assert first == {r.pair_id: r.rank for r in again}
