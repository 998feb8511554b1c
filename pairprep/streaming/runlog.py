"""Early stopping while the evaluations come in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pairprep import constants as C
from pairprep.operators.runlog import CHUNK_STEPS, early_stop

_RESULT = ("best_value", "best_step", "previous_best", "counter", "stop_step")


def advance_stops(
    state: DataFrame | None,
    batch: DataFrame,
    patience: int = C.PATIENCE,
    threshold: float = 0.0,
    metric: str = "eval_loss",
    lower_is_better: bool = True,
    run: str = "run_id",
    step: str = "step",
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """State of every run after one more batch of evaluations.

    One row per run: what `early_stop` returns, last_step, and late_rows, the count of rows that
    came at or before the last step of their run and were not used. An open run is continued by
    putting its best value in front of the new rows, followed by as many copies as evaluations
    have passed without improvement: the batch operator then ends up where a replay of the whole
    run would, and spreads a run with very many new rows in the same way.
    """
    rows = batch.select(
        run, F.col(step).cast("long").alias("step"), F.col(metric).cast("double").alias("value")
    ).where(F.col("value").isNotNull())

    def stops(log: DataFrame) -> DataFrame:
        return early_stop(
            log, patience, threshold, "value", lower_is_better, run, "step", chunk_steps
        )

    if state is None:
        last = rows.groupBy(run).agg(F.max("step").alias("last_step"))
        return stops(rows).join(last, run).withColumn("late_rows", F.lit(0).cast("long"))

    # Known runs meet their rows chunk by chunk, so that no run's rows meet in one task.
    rows = rows.withColumn("_chunk", F.floor(F.col("step") / chunk_steps))
    known = state.select(
        run, F.col("last_step").alias("_last"), F.col("stop_step").isNotNull().alias("_closed")
    )
    chunks = rows.select(run, "_chunk").distinct().join(known, run)
    placed = rows.join(chunks, [run, "_chunk"], "left").withColumn(
        "_late", F.coalesce(F.col("step") <= F.col("_last"), F.lit(False))
    )
    seen = placed.groupBy(run).agg(
        F.max("step").alias("_newest"), F.count_if("_late").alias("_late_rows")
    )
    usable = placed.where(~F.col("_late") & ~F.coalesce("_closed", F.lit(False)))
    open_runs = state.where(F.col("stop_step").isNull()).join(seen, run, "left_semi")
    replayed = open_runs.select(
        run, "best_step", "best_value", F.explode(F.sequence(F.lit(0), F.col("counter"))).alias("_i")
    ).select(run, (F.col("best_step") + F.col("_i")).alias("step"), F.col("best_value").alias("value"))
    fresh = stops(usable.select(run, "step", "value").unionByName(replayed))
    fresh = fresh.select(run, *[F.col(c).alias(f"_{c}") for c in _RESULT])

    merged = state.join(fresh, run, "full").join(seen, run, "left")
    updated = F.col("_best_step").isNotNull()
    same_best = F.coalesce(F.col("best_step") == F.col("_best_step"), F.lit(False))
    columns = {c: F.when(updated, F.col(f"_{c}")).otherwise(F.col(c)) for c in _RESULT}
    columns["previous_best"] = F.when(updated & ~same_best, F.col("_previous_best")).otherwise(
        F.col("previous_best")
    )
    columns["last_step"] = F.greatest("last_step", "_newest")
    columns["late_rows"] = F.coalesce("late_rows", F.lit(0)) + F.coalesce("_late_rows", F.lit(0))
    return merged.select(run, *[value.alias(name) for name, value in columns.items()])


# What Spark keeps of a run between triggers; one row, however long the run is.
_STATE = (
    "best_value double, best_step long, previous_best double, counter int, stop_step long, last_step long, "
    "late_rows long"
)


def _advance_run(patience: int, threshold: float):
    """Function of a run's key, new rows and stored state, for `applyInPandasWithState`."""
    columns = ["_run", *(c.split()[0] for c in _STATE.split(", "))]

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np
        import pandas as pd

        new = [(f["step"].to_numpy(np.int64), f["value"].to_numpy(np.float64)) for f in frames]
        steps, values = (np.concatenate(c) for c in zip(*new))
        best, best_step, previous, counter, stop, last, late = state.get if state.exists else (None,) * 6 + (0,)
        if last is not None:
            fresh = steps > last
            late += int(np.count_nonzero(~fresh))
            steps, values = steps[fresh], values[fresh]
        order = np.lexsort((values, steps))
        if len(order):
            last = int(steps[order[-1]])
        for at in order.tolist() if stop is None else ():
            value = float(values[at])
            # A comparison with NaN is never an improvement.
            if best_step is None or value < best - threshold:
                best, best_step, previous, counter = value, int(steps[at]), best, 0
            else:
                counter += 1
                if counter >= patience:
                    stop = int(steps[at])
                    break
        row = (best, best_step, previous, counter, stop, last, late)
        state.update(row)
        # One block of objects: a typed column each would cost more than following the run.
        made = np.empty((1, len(columns)), object)
        made[0] = key[0], *row
        yield pd.DataFrame(made, columns=columns, copy=False)

    return advance


def early_stop_stream(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    patience: int = C.PATIENCE,
    threshold: float = 0.0,
    metric: str = "eval_loss",
    lower_is_better: bool = True,
    run: str = "run_id",
    step: str = "step",
) -> StreamingQuery:
    """Keep the state of every run in Spark's state store, and write the runs that a trigger changes
    to `path`, one folder a trigger; a run that has no new row is neither written nor moved.

    Rows of a run must come in step order from trigger to trigger, in any order inside one; later
    ones are counted, not used. A repeated trigger starts from the state before it and overwrites its
    own folder. The new rows of one run in one trigger are one task's, as two numbers each, so limit
    a trigger (`maxFilesPerTrigger`, `maxBytesPerTrigger`); a backlog with runs beyond that goes
    through `early_stop` or `advance_stops`, which spread a run.
    """
    if not sdf.isStreaming:
        raise ValueError("early_stop_stream needs a streaming table; use early_stop")
    if patience < 1:
        raise ValueError("patience must be at least 1")
    value = F.col(metric).cast("double")
    rows = sdf.select(
        F.col(run).alias("_run"), F.col(step).cast("long").alias("step"), (value if lower_is_better else -value).alias("value")
    ).where(F.col("value").isNotNull())
    run_type = rows.schema["_run"].dataType.simpleString()
    changed = rows.groupBy("_run").applyInPandasWithState(
        _advance_run(patience, threshold), f"_run {run_type}, {_STATE}", _STATE, "update", GroupStateTimeout.NoTimeout
    )
    # pandas hands a NaN over as null; a best value is never missing otherwise.
    changed = changed.withColumn("best_value", F.coalesce("best_value", F.lit(float("nan"))))
    if not lower_is_better:
        changed = changed.withColumns({c: -F.col(c) for c in ("best_value", "previous_best")})

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumnRenamed("_run", run).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = changed.writeStream.outputMode("update").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(save).start()


def latest_states(spark: SparkSession, path: str, run: str = "run_id") -> DataFrame:
    """The newest row of every run."""
    changes = spark.read.parquet(path)
    kept = [c for c in changes.columns if c not in (run, "batch")]
    newest = changes.groupBy(run).agg(F.max_by(F.struct(*kept), "batch").alias("s"))
    return newest.select(run, "s.*")
