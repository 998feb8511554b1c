import random

import numpy as np
import pandas as pd
import pytest
from pairprep.operators.cleaning import clean_pairs
from pairprep.operators.runlog import early_stop
from pairprep.streaming.cleaning import clean_pairs_stream, write_pairs_stream
from pairprep.streaming.runlog import _advance_run, advance_stops, early_stop_stream, latest_states

LOG = "run_id long, step long, eval_loss double"


def test_cleaning_stream_equals_batch(spark, tmp_path):
    rows = [(i, "+" + "x" * (i % 80), f"Add the {i}\r\n" if i % 3 else "fix", ("train", "test")[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "pair_id long, diff string, message string, split string")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = write_pairs_stream(clean_pairs_stream(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(*df.columns)
    assert sorted(got.collect()) == sorted(clean_pairs(df).collect())
    with pytest.raises(ValueError):
        clean_pairs_stream(df)


@pytest.mark.parametrize("threshold, lower", [(0.0, True), (0.3, False)])
def test_stop_stream_equals_batch_over_several_triggers(spark, tmp_path, threshold, lower):
    rng = random.Random(11)
    rows = [
        (run, 300 * s, None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else rng.choice([1.0, 2.0, 3.0]) - s / 50)
        for run in range(30)
        for s in range(1, rng.randint(3, 40))
    ]
    log = spark.createDataFrame(rows, LOG)
    out = str(tmp_path / "out")
    for part in range(3):
        piece = log.where(f"step > {part} * 4000 and step <= {part + 1} * 4000")
        piece.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
        query = early_stop_stream(
            stream, out, str(tmp_path / "state"), patience=4, threshold=threshold, lower_is_better=lower
        )
        query.awaitTermination()
    got = latest_states(spark, out)
    assert got.where("late_rows <> 0").count() == 0
    expected = early_stop(log, 4, threshold, lower_is_better=lower)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.drop("last_step", "late_rows").collect())) == sorted(map(key, expected.collect()))


def test_late_rows_are_counted_not_used(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in ([(1, 600, 2.0)], [(1, 300, 0.1), (1, 900, 3.0)]):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        early_stop_stream(stream, out, state).awaitTermination()
    row = latest_states(spark, out).first()
    assert (row.best_value, row.best_step, row.counter, row.late_rows) == (2.0, 600, 1, 1)
    with pytest.raises(ValueError):
        early_stop_stream(spark.createDataFrame([(1, 1, 1.0)], LOG), out, state)


def test_repeated_trigger_gives_the_same_state(spark, tmp_path):
    old = spark.createDataFrame([(1, 300, 2.0), (1, 600, 2.5), (2, 300, 1.0)], LOG)
    new = spark.createDataFrame([(1, 900, 1.0), (3, 300, 4.0), (2, 600, None)], LOG)
    state = advance_stops(None, old)
    rows = {tuple(r) for r in advance_stops(state, new).collect()}
    assert rows == {
        (1, 1.0, 900, 2.0, 0, None, 900, 0),
        (2, 1.0, 300, None, 0, None, 300, 0),
        (3, 4.0, 300, None, 0, None, 300, 0),
    }


def test_a_trigger_writes_changed_runs_only(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    triggers = [
        [(run, 300, 2.0) for run in range(40)],
        [(3, 600, 1.0), (7, 600, float("nan")), (None, 300, 5.0)],
        [(7, 300, 0.0), (41, 300, None)],
    ]
    updated = []
    for rows in triggers:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        query = early_stop_stream(spark.readStream.schema(LOG).parquet(source), out, state, patience=1)
        query.awaitTermination()
        updated.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]))
    assert updated == [40, 3, 1]
    written = spark.read.parquet(out).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in written] == updated
    found = {r.run_id: r for r in latest_states(spark, out).collect()}
    assert len(found) == 41 and (found[3].best_value, found[3].previous_best, found[3].stop_step) == (1.0, 2.0, None)
    assert (found[7].stop_step, found[7].counter, found[7].late_rows) == (600, 1, 1)
    assert found[None].best_value == 5.0


def test_a_run_costs_no_typed_column_each():
    class State:
        exists = False

        def update(self, row):
            self.exists, self.get = True, row

    frame = pd.DataFrame({"step": [600, 300], "value": [1.0, 2.0]})
    (made,) = _advance_run(3, 0.0)((7,), iter([frame]), State())
    assert made.iloc[0].tolist() == [7, 1.0, 600, 2.0, 0, None, 600, 0]
    assert set(made.dtypes) == {np.dtype(object)}


def test_long_run_ids_beside_a_missing_one(spark, tmp_path):
    ids = [2**60 + 1, None, 2**60 + 3, 5]
    log = spark.createDataFrame([(run, 300 * s, 1.0 / s) for run in ids for s in (1, 2)], LOG)
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    early_stop_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r.run_id: r.best_value for r in latest_states(spark, str(tmp_path / "out")).collect()}
    assert got == dict.fromkeys(ids, 0.5)
