import math
import random

import pytest
from pairprep.functions.metrics import fixed4, format_log, perplexity
from pairprep.operators import runlog as L

SCHEMA = "run_id int, step long, eval_loss double"


def replay(evals, patience, threshold, lower):
    """What a callback fed one evaluation at a time ends up with."""
    best = previous = at = stop = None
    counter = 0
    for step, v in sorted(evals):
        if v is None:
            continue
        if best is None:
            best, at = v, step
        elif (v < best - threshold) if lower else (v > best + threshold):
            previous, best, at, counter = best, v, step, 0
        else:
            counter += 1
            if counter >= patience:
                stop = step
                break
    return None if at is None else (best, at, previous, counter, stop)


def same(a, b):
    return all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b)
    )


def make_runs(seed):
    rng = random.Random(seed)
    runs = {}
    for run in range(40):
        n = rng.randint(1, 60)
        falling = rng.random() < 0.4
        evals = []
        for i in range(n):
            v = (1000.0 - i * rng.choice([0.5, 1, 2])) if falling else rng.choice([1.0, 2.0, 2.5, 3.0, 4.0]) + rng.random()
            roll = rng.random()
            v = None if roll < 0.1 else math.nan if roll < 0.17 else math.inf if roll < 0.2 else v
            evals.append((300 * (i + 1) + (run % 3), v))
        runs[run] = evals
    runs[40] = [(300, math.nan), (600, 1.0), (900, 0.5)]
    runs[41] = [(300, None), (600, None)]
    runs[42] = [(300 * i, 500.0 - i) for i in range(1, 200)]
    runs[43] = [(300 * i, 1.0) for i in range(1, 6)]
    runs[44] = [(1_000_000 * i, 50.0 - i) for i in range(1, 20)]
    return runs


@pytest.mark.parametrize(
    "threshold, lower", [(0.0, True), (0.0, False), (0.4, True), (1.5, False), (-0.2, True)]
)
@pytest.mark.parametrize(
    "patience, chunk_steps, chunk_rows", [(5, 100_000, 50_000), (3, 1000, 4), (1, 301, 1)]
)
def test_early_stop_equals_replay(spark, lower, threshold, patience, chunk_steps, chunk_rows):
    runs = make_runs(patience)
    rows = [(r, s, v if lower or v is None else -v) for r, evals in runs.items() for s, v in evals]
    log = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = L.early_stop(
        log, patience, threshold, lower_is_better=lower, chunk_steps=chunk_steps, chunk_rows=chunk_rows
    )
    assert got.columns == ["run_id", "best_value", "best_step", "previous_best", "counter", "stop_step"]
    found = {r.run_id: tuple(r)[1:] for r in got.collect()}
    expected = {}
    for run, evals in runs.items():
        signed = [(s, v if lower or v is None else -v) for s, v in evals]
        state = replay(signed, patience, threshold, lower)
        if state is not None:
            expected[run] = state
    assert found.keys() == expected.keys()
    for run in expected:
        assert same(found[run], expected[run]), (run, found[run], expected[run])


def test_early_stop_refuses_nonsense(spark):
    log = spark.createDataFrame([(1, 1, 1.0)], SCHEMA)
    with pytest.raises(ValueError):
        L.early_stop(log, patience=0)


def test_best_checkpoint(spark):
    rows = [(1, 300, 2.0), (1, 600, 1.5), (1, 700, 0.1), (1, 900, 1.5), (2, 300, None), (3, 300, math.nan), (3, 600, 9.0)]
    got = {tuple(r) for r in L.best_checkpoint(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 600, 1.5), (3, 600, 9.0)}


def test_perplexity(evaluate):
    got = evaluate(perplexity, [0.0, 1.0, -0.5, 1000.0, None], "double")
    assert got[0] == 1.0 and math.isclose(got[1], math.e) and 0 < got[2] < 1
    assert got[3:] == [math.inf, None]


def test_run_perplexity(spark):
    df = spark.createDataFrame([(0.0, None)], "val_loss double, test_loss double")
    assert tuple(L.run_perplexity(df).first()) == (0.0, None, 1.0, None)


def test_eval_summary(spark):
    df = spark.createDataFrame(
        [("test", 1.0, 1), ("test", 2.0, 3), ("train", 5.0, 0)], "split string, loss double, n_target int"
    )
    got = {r.split: (r.loss, r.perplexity) for r in L.eval_summary(df).collect()}
    assert got["test"][0] == 1.75 and math.isclose(got["test"][1], math.exp(1.75))
    assert got["train"] == (None, None)
    df = spark.createDataFrame([("a", 1.0, 1), ("a", None, 9)], "split string, loss double, n_target int")
    assert L.eval_summary(df).first().loss == 1.0


def test_run_summary(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00', 100L), (1, TIMESTAMP '2024-01-01 00:00:08', 60L),"
        " (2, TIMESTAMP '2024-01-01 00:00:00', 5L) AS t(run_id, ts, samples)"
    )
    got = {tuple(r) for r in L.run_summary(df).collect()}
    assert got == {(1, 8.0, 160, 20.0), (2, 0.0, 5, None)}


def test_fixed4_rounds_like_a_c_library(evaluate):
    rng = random.Random(4)
    values = [0.0, -0.0, 2.00005, 5e-05, -1e-05, 1.03125, 0.03125, 1e20, 123456.78905, math.inf, -math.inf, math.nan]
    values += [k / 32 for k in range(-70, 70)] + [(2 * k + 1) / 20000 for k in range(3000)]
    values += [rng.uniform(-50, 50) for _ in range(500)] + [rng.uniform(0, 1e12) for _ in range(200)]
    values += [math.exp(50), 1e23, 1e300, 1.7976931348623157e308, 2.0**53, 2.0**63, -(2.0**64)]
    values += [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(40, 1023) for _ in range(400)]
    values += [2.0**n for n in range(50, 1024, 7)]
    assert evaluate(fixed4, values, "double") == ["%.4f" % v for v in values]


def test_log_lines(spark):
    rows = [(30, {"loss": 1.23456, "lr": 1.8e-4}), (31, {"loss": 1.0}), (60, {}), (90, {"x": None})]
    df = spark.createDataFrame(rows, "step int, logs map<string,double>")
    assert {r.line for r in L.log_lines(df, 30).collect()} == {
        "Step 30: loss=1.2346, lr=0.0002",
        "Step 90: x=None",
    }
    assert L.thin_log(df, 30).count() == 3
    assert df.select(format_log("step", "logs")).where("step = 60").first()[0] is None


def test_threshold_follows_many_runs_in_a_batch(spark):
    """Runs and chunks of every length, cut by small batches; no call of pandas for each group."""
    from pairprep.operators.runlog import early_stop

    rows = [(r, 300 * (i + 1), float((i * 7 + r * 5) % 11) / 4) for r in range(40) for i in range(1 + r * 3 % 50)]
    df = spark.createDataFrame(rows, "run_id long, step long, eval_loss double")
    wanted = sorted(map(str, early_stop(df, 3, 0.3).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = early_stop(df, 3, 0.3, chunk_rows=4)
        assert sorted(map(str, small.collect())) == wanted and len(wanted) == 40
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for run in (0, 7, 33):
        best = best_at = previous = stop = None
        counter = 0
        for step, value in ((s, v) for r, s, v in rows if r == run):
            if best is None or value < best - 0.3:
                best, best_at, previous, counter = value, step, best, 0
            elif (counter := counter + 1) == 3:
                stop = step
                break
        got = next(r for r in small.collect() if r.run_id == run)
        assert (got.best_value, got.best_step, got.previous_best, got.counter, got.stop_step) == (best, best_at, previous, counter, stop)


@pytest.mark.parametrize("threshold, lower", [(0.0, False), (0.4, True), (-0.2, True)])
@pytest.mark.parametrize("patience, chunk_steps, chunk_rows", [(7, 700, 2), (4, 1, 50)])
def test_chunks_shorter_and_longer_than_the_patience(spark, lower, threshold, patience, chunk_steps, chunk_rows):
    """Improvements and stops on both sides of chunks; rows without a run count nowhere."""
    runs = make_runs(patience)
    runs[45] = [(300, math.nan)] + [(300 * i, 9.0 - i) for i in range(2, 12)]
    runs[46] = [(300 * i, math.nan if i % 4 else 50.0 - i) for i in range(1, 90)]
    sign = 1 if lower else -1
    rows = [(r, s, None if v is None else sign * v) for r, evals in runs.items() for s, v in evals]
    log = spark.createDataFrame(rows + [(None, 300, -99.0 * sign)], SCHEMA).repartition(3)
    got = L.early_stop(log, patience, threshold, lower_is_better=lower, chunk_steps=chunk_steps, chunk_rows=chunk_rows)
    found = {r.run_id: tuple(r)[1:] for r in got.collect()}
    replayed = {r: replay([x[1:] for x in rows if x[0] == r], patience, threshold, lower) for r in runs}
    expected = {r: state for r, state in replayed.items() if state is not None}
    assert found.keys() == expected.keys()
    for run in expected:
        assert same(found[run], expected[run]), (run, found[run], expected[run])


def test_threshold_leaves_out_rows_without_a_step(spark):
    rows = [(1, None, -99.0), (1, 300, 2.0), (1, 600, 1.0), (2, None, 5.0), (None, 300, 1.0)]
    got = L.early_stop(spark.createDataFrame(rows, SCHEMA), 3, 0.5)
    assert [tuple(r) for r in got.collect()] == [(1, 1.0, 600, 2.0, 0, None)]


def test_threshold_follows_runs_over_batches(spark):
    """A run's entries lie in many batches, and its key is of any type."""
    rows = [(r, 300 * (i + 1), float((i * 7 + r * 5) % 11) + 99 * (i < 40) - i) for r in range(6) for i in range(60)]
    expected = {r: replay([x[1:] for x in rows if x[0] == r], 3, 0.5, True) for r in range(6)}
    df = spark.createDataFrame(rows, "run long, step long, eval_loss double")
    key = "CASE run WHEN 0 THEN double('nan') ELSE run END AS run_id"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        for kind in (key, "timestamp_seconds(run) AS run_id", "date_add(DATE'2024-01-01', int(run)) AS run_id"):
            log = df.selectExpr(kind, "step", "eval_loss")
            got = L.early_stop(log, 3, 0.5, chunk_steps=600, chunk_rows=2)
            assert got.schema["run_id"].dataType == log.schema["run_id"].dataType
            assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(expected.values())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def exchanges(df):
    """The columns by which the plan deals rows out, one for each exchange that is not used again."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_threshold_deals_the_log_out_once(spark):
    log = spark.range(900).selectExpr("id % 7 AS run_id", "300 * id AS step", "double(id % 13) AS eval_loss")
    stops = L.early_stop(log, threshold=0.25)
    assert exchanges(stops) == ["run_id", "run_id"]
    assert stops._jdf.queryExecution().executedPlan().toString().count("Range (0, 900") == 1


def test_log_is_dealt_out_once_for_ranks_too(spark):
    """The summary of the chunks and the rows read one exchange; no second copy of the rows moves."""
    log = spark.range(9000).selectExpr("id % 7 AS run_id", "300 * id AS step", "double(id % 13) AS eval_loss")
    stops = L.early_stop(log)
    assert stops.count() == len(stops.collect()) == 7
    plan = stops._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "== Final Plan ==" in plan and plan.count("Range (0, 9000") == 1 and "ReusedExchange" in plan
    assert "Generate explode" not in plan


def test_rows_without_a_step_come_first(spark):
    """Without a threshold they count as evaluations before all others, but none of them is a best one."""
    rows = [(1, None, 5.0), (1, 300, 7.0), (1, 600, 4.0), (1, 900, 6.0), (1, 1200, 6.0)]
    rows += [(2, None, -9.0), (2, 300, 1.0), (3, None, 1.0), (None, 300, 1.0)]
    got = L.early_stop(spark.createDataFrame(rows, SCHEMA), 2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 4.0, 600, 5.0, 2, 1200), (2, None, None, None, None, None)]
