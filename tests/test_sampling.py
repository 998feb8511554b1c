import hashlib

import pytest
from pairprep.operators.sampling import cap_splits, eval_sample
from pairprep.plans.prepare import as_splits, get_splits


def order(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, "train" if i % 10 < 8 else "validation" if i % 10 == 8 else "test") for i in range(3000)]
    return spark.createDataFrame(rows, "pair_id long, split string")


@pytest.mark.parametrize("caps", [{"train": 100, "validation": 300, "test": 299}, {"train": 2399}, {"test": 1, "train": 0}])
def test_cap_is_exact_and_in_seeded_order(table, caps):
    rows = table.collect()
    expected = set()
    for split in ("train", "validation", "test"):
        keys = sorted((r.pair_id for r in rows if r.split == split), key=lambda k: order(5, k))
        expected |= set(keys[: caps.get(split, len(keys))])
    for partitions in (1, 7):
        got = cap_splits(table.repartition(partitions), caps, seed=5)
        assert got.columns == table.columns
        assert {r.pair_id for r in got.collect()} == expected


def test_unknown_cap_is_refused(table):
    with pytest.raises(ValueError):
        cap_splits(table, {"dev": 3})


def test_wide_rows_are_not_shuffled(spark, tmp_path):
    rows = [(i, "train", "x" * 50) for i in range(500)]
    spark.createDataFrame(rows, "pair_id long, split string, diff string").write.parquet(str(tmp_path / "t"))
    capped = cap_splits(spark.read.parquet(str(tmp_path / "t")), {"train": 10})
    plan = capped._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanged and plan.count("ReadSchema: struct<pair_id:bigint,split:string,diff:string>") == 1
    assert plan.count("ReadSchema: struct<pair_id:bigint,split:string>") == 2
    assert capped.count() == 10


def test_get_splits(spark):
    diff = "+" + "x" * 60
    rows = [(i, diff, "Add the feature" if i % 2 else "fix", "train" if i < 50 else "test") for i in range(80)]
    df = spark.createDataFrame(rows, "pair_id long, diff string, message string, split string")
    splits = as_splits(get_splits(df, {"train": 10, "test": 100}))
    assert [s.count() for s in splits] == [10, 0, 15]


def test_eval_sample_draws_before_dropping(spark):
    rows = [(i, [-100, -100, i] if i % 2 else [-100, -100]) for i in range(100)]
    df = spark.createDataFrame(rows, "pair_id long, labels array<int>")
    drawn = sorted(range(100), key=lambda k: order(42, k))[:20]
    assert {r.pair_id for r in eval_sample(df, 20).collect()} == {k for k in drawn if k % 2}
    assert eval_sample(df, 500).count() == 50
