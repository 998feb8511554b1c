"""Results over run logs: early stopping, best checkpoint, perplexity, throughput, log lines.

A log has one row per (run, step). One run may hold a large share of all rows, so nothing here
gathers a run in one task: rows are numbered in chunks of a run, and the only thing that crosses
chunks is a summary row for each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.metrics import format_log, perplexity
from pairprep.functions.text import as_column
from pairprep.operators.ranking import bucket_offsets

CHUNK_STEPS = 100_000
CHUNK_ROWS = 50_000
# The chunk of rows without a step: they count as evaluations before all others.
NO_STEP = -(1 << 63)


def _ranked(log: DataFrame, run: str, chunk_steps: int, patience: int) -> DataFrame:
    """Number the evaluations of each run and mark those better than all before.

    Adds _rank (from 1), _previous (best value before the row), _improved, and _n, the rows of the run.
    Of the row's _chunk it tells whether no row before is better than the earlier chunks (_carried),
    whether one of the next `patience` rows has a lower value (_passed) and the step of the last of
    those (_ahead); _best_through is the last rank of the earlier chunk with the best value. _late rows
    come behind one that would stop its run: none of them is an improvement before the run's first stop.
    _unplaced runs have rows without a step. The rows stay dealt out by run and chunk.
    """
    chunk = F.coalesce(F.floor(F.col("_step") / chunk_steps), F.lit(NO_STEP))
    # Dealt out once, for the summary and for the rows.
    chunked = log.where(F.col(run).isNotNull()).withColumn("_chunk", chunk).repartition(run, "_chunk")
    summary = bucket_offsets(
        chunked,
        "_chunk",
        (run,),
        (F.min("_value").alias("_low"), F.min_by("_value", "_step").alias("_first")),
    ).withColumn("_through", F.col("rows_before") + F.col("bucket_rows"))
    earlier = Window.partitionBy(run).orderBy("_chunk")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    best = F.min(F.struct("_low", "_chunk", "_through")).over(before)
    summary = summary.select(
        run,
        "_chunk",
        "rows_before",
        best["_low"].alias("_low_before"),
        best["_through"].alias("_best_through"),
        F.first("_first").over(earlier).alias("_run_first"),
        F.max("_through").over(Window.partitionBy(run)).alias("_n"),
        (F.min("_chunk").over(Window.partitionBy(run)) == NO_STEP).alias("_unplaced"),
    )
    inside = Window.partitionBy(run, "_chunk").orderBy("_step", "_value")
    preceding = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = chunked.withColumns(
        {
            "_local": F.row_number().over(inside),
            "_local_low": F.min("_value").over(preceding),
            "_next_low": F.min("_value").over(inside.rowsBetween(1, patience)),
            "_ahead": F.lead("_step", patience).over(inside),
        }
    )
    lowest = F.coalesce(F.col("_value") < F.col("_local_low"), F.lit(True))
    passed = F.coalesce(F.col("_next_low") < F.col("_value"), F.lit(False))
    stops = F.count_if(lowest & ~passed & F.col("_ahead").isNotNull()).over(preceding)
    numbered = numbered.withColumn("_stops", stops).where(F.col("_step").isNotNull())
    # A comparison with NaN is never an improvement; Spark itself sorts NaN above every number.
    fixed = F.isnan("_run_first")
    better = (F.col("_value") < F.col("_previous")) & ~F.isnan("_value") & ~fixed
    return (
        numbered.join(summary, [run, "_chunk"])
        .withColumns(
            {
                "_rank": F.col("rows_before") + F.col("_local"),
                "_previous": F.least("_low_before", "_local_low"),
                "_carried": fixed | F.coalesce(F.col("_local_low") >= F.col("_low_before"), F.lit(True)),
                "_passed": ~fixed & passed,
                # Rows without a step, which are no improvements, can take a run past such a row.
                "_late": (F.col("_stops") > 0) & ~F.col("_unplaced"),
            }
        )
        .withColumn("_improved", F.coalesce((F.col("_rank") == 1) | better, F.lit(False)))
        .drop("rows_before", "_local", "_local_low", "_next_low", "_low_before", "_run_first", "_stops")
    )


_PART = (
    "{run} {run_type}, part long, place long, value double, step long, best_value double, best_step long, "
    "previous double, rest int, stop_step long"
)
_FINAL = (
    "{run} {run_type}, best_value double, best_step long, previous_best double, counter int, "
    "stop_step long"
)


def _by_group(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], follow: Callable, layout: str) -> DataFrame:
    """What follow makes of the other columns of each group, in order, behind the first key.

    Groups go to Python many in a batch: most are short, and a call for each would cost more than its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        def made_of(held: pa.Table, bounds: list[int]) -> pa.RecordBatch:
            found, of = [], []
            columns = [c.combine_chunks() for c in held.columns]
            for a, b in zip(bounds, bounds[1:]):
                for row in follow([c.slice(a, b - a) for c in columns[1:]]):
                    found.append(row)
                    of.append(a)
            return _batch(columns[0].take(pa.array(of, pa.int64())), found, layout)

        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if not len(held):
                continue
            differs = np.zeros(len(held) - 1, bool)
            for i in range(len(keys)):
                codes = held.column(i).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                differs |= codes[1:] != codes[:-1]
            bounds = [0, *(np.flatnonzero(differs) + 1).tolist()]
            if len(bounds) > 1:
                yield made_of(held, bounds)
                held = held.slice(bounds[-1])
        if held is not None and len(held):
            yield made_of(held, [0, len(held)])

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, layout)


def _batch(first: pa.Array, rows: list[tuple], layout: str) -> pa.RecordBatch:
    """A batch of a layout: its first column and the values of the others, row by row."""
    import pyarrow as pa

    names, kinds = zip(*(c.split() for c in layout.split(", ")))
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    others = [pa.array([r[i] for r in rows], types[kind]) for i, kind in enumerate(kinds[1:])]
    return pa.RecordBatch.from_arrays([first, *others], names=list(names))


def _followed_stops(
    log: DataFrame, run: str, patience: int, threshold: float, chunk_steps: int, chunk_rows: int
) -> DataFrame:
    """Stops when an improvement must beat the last accepted value by a threshold.

    Which row is accepted depends on the one accepted before, but the next one is at most
    `patience` rows away or the run stops. So a chunk of steps, in parts of chunk_rows rows, can be
    entered at no more than its first `patience` rows, and where each entry leads is worked out part
    by part. The rows move once; what is left to follow per run is one short row per part and entry.
    """
    run_type = log.schema[run].dataType.simpleString()
    part_layout = _PART.format(run=run, run_type=run_type)
    final_layout = _FINAL.format(run=run, run_type=run_type)

    def follow_part(chunk: int, start: int, steps, values) -> Iterator[tuple]:
        import numpy as np

        count = len(values)
        following = np.full(count, -1)
        for ahead in range(min(patience, count - 1), 0, -1):
            better = values[ahead:] < values[:-ahead] - threshold
            following[:-ahead][better] = np.nonzero(better)[0] + ahead
        # Where each row leads, from behind: to itself, or to where the row it follows leads.
        following = following.tolist()
        end, before = list(range(count)), [-1] * count
        for at in range(count - 1, -1, -1):
            if (next_at := following[at]) >= 0:
                end[at] = end[next_at]
                before[at] = before[next_at] if before[next_at] >= 0 else at
        for entry in range(min(patience, count)):
            at, came = end[entry], before[entry]
            rest = count - 1 - at
            yield (
                chunk,
                start + entry,
                float(values[entry]),
                int(steps[entry]),
                float(values[at]),
                int(steps[at]),
                float(values[came]) if came >= 0 else None,
                min(rest, patience),
                int(steps[at + patience]) if rest >= patience else None,
            )

    def follow_chunk(group: list) -> Iterator[tuple]:
        chunks, steps, values = (a.to_numpy(zero_copy_only=False) for a in group)
        for start in range(0, len(values), chunk_rows):
            part = slice(start, start + chunk_rows)
            yield from follow_part(int(chunks[0]), start, steps[part], values[part])

    def follow_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries come run by run, in order; of a run only where it stands is kept."""
        import pyarrow as pa

        last = None  # the run of the row before
        best = best_step = previous = stop = followed = None
        counter = 0
        for batch in batches:
            runs = batch.column(0) if last is None else pa.concat_arrays([last, batch.column(0)])
            codes = runs.dictionary_encode(null_encoding="encode").indices.to_pylist()
            found, of = [], []
            rows = zip(*(c.to_pylist() for c in batch.columns[1:]))
            for at, (chunk, place, value, step, *leads) in enumerate(rows, len(runs) - len(batch)):
                part = chunk, place // chunk_rows
                if at == 0 or codes[at] != codes[at - 1]:
                    if at:
                        found.append((best, best_step, previous, counter, stop))
                        of.append(at - 1)
                    best = stop = None
                elif stop is not None or part == followed:
                    continue
                if best is None or value < best - threshold:
                    came, followed = best, part
                    best, best_step, previous, counter, stop = leads
                    previous = came if previous is None else previous
                else:
                    counter += 1
                    stop = step if counter >= patience else None
            if found:
                yield _batch(runs.take(pa.array(of)), found, final_layout)
            last = runs[-1:]
        if last is not None and len(last):
            yield _batch(last, [(best, best_step, previous, counter, stop)], final_layout)

    chunks = log.select(run, F.floor(F.col("_step") / chunk_steps).alias("part"), "_step", "_value")
    found = _by_group(chunks, (run, "part"), ("_step", "_value"), follow_chunk, part_layout)
    return found.repartition(run).sortWithinPartitions(run, "part", "place").mapInArrow(follow_runs, final_layout)


def early_stop(
    df: DataFrame,
    patience: int = C.PATIENCE,
    threshold: float = 0.0,
    metric: str = "eval_loss",
    lower_is_better: bool = True,
    run: str = "run_id",
    step: str = "step",
    chunk_steps: int = CHUNK_STEPS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Where each run stops when `patience` evaluations in a row bring no improvement.

    One row per run that has a value: best_value, best_step, previous_best, counter and
    stop_step (null when the run never stops). Evaluations without a value are skipped, rows
    after the stop do not count. (run, step) must be unique.
    """
    if patience < 1:
        raise ValueError("patience must be at least 1")
    value = F.col(metric).cast("double")
    log = df.select(
        run, F.col(step).alias("_step"), (value if lower_is_better else -value).alias("_value")
    ).where(F.col("_value").isNotNull())
    if threshold != 0:
        placed = log.where(F.col(run).isNotNull() & F.col("_step").isNotNull())
        stops = _followed_stops(placed, run, patience, threshold, chunk_steps, max(chunk_rows, patience))
        signs = {c: -F.col(c) for c in ("best_value", "previous_best")}
        return stops if lower_is_better else stops.withColumns(signs)
    return _stop_state(_ranked(log, run, chunk_steps, patience), run, patience, lower_is_better)


def _stop_state(ranked: DataFrame, run: str, patience: int, lower_is_better: bool) -> DataFrame:
    """A run stops at the first row whose last improvement lies exactly `patience` rows back.

    Few rows go on to where a run is followed: an improvement after which the run stops in its chunk or
    that is the chunk's last, up to the first such stop; of a chunk's rows before its first improvement
    those that can lie `patience` rows behind one of an earlier chunk; and the last row of a run that may
    have no improvement.
    """
    rank = F.col("_rank")
    last_one = F.col("_improved") & ~F.col("_passed") & ~F.col("_late")
    waiting = ~F.col("_improved") & F.col("_carried") & (rank - F.col("_best_through") <= patience)
    unbettered = F.col("_unplaced") & (rank == F.col("_n"))
    kept = ranked.where(last_one | waiting | unbettered).select(
        run,
        "_rank",
        F.when(last_one, F.struct("_rank", "_step", "_value", "_previous")).alias("_last"),
        # Where a row says that its run stops, if the last improvement is that far back.
        F.when(last_one, rank + patience).otherwise(rank).alias("_at"),
        F.when(last_one, F.col("_ahead")).otherwise(F.col("_step")).alias("_stop"),
        "_n",
    )
    up_to = Window.partitionBy(run).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    stops = F.col("_stop").isNotNull() & (F.col("_at") - F.col("_last._rank") == patience)
    ends = (
        kept.withColumn("_last", F.max("_last").over(up_to))
        .groupBy(run)
        .agg(
            F.min(F.when(stops, F.struct("_at", F.col("_stop").alias("_step"), F.col("_last").alias("s")))).alias("stop"),
            F.max("_last").alias("last"),
            F.max("_n").alias("_n"),
        )
    )
    best = F.coalesce("stop.s", "last")
    signed = (lambda c: c) if lower_is_better else (lambda c: -c)
    return ends.select(
        run,
        signed(best["_value"]).alias("best_value"),
        best["_step"].alias("best_step"),
        signed(best["_previous"]).alias("previous_best"),
        F.when(F.col("stop").isNotNull(), patience)
        .otherwise(F.col("_n") - F.col("last._rank"))
        .cast("int")
        .alias("counter"),
        F.col("stop._step").alias("stop_step"),
    )


def best_checkpoint(
    df: DataFrame,
    metric: str = "eval_loss",
    every: int = C.EVAL_EVERY,
    run: str = "run_id",
    step: str = "step",
) -> DataFrame:
    """Step with the lowest metric among the evaluated steps, the earliest on ties."""
    rows = df.where((F.col(step) % every == 0) & F.col(metric).isNotNull())
    return (
        rows.groupBy(run)
        .agg(F.min(F.struct(F.col(metric).alias("v"), F.col(step).alias("s"))).alias("best"))
        .select(run, F.col("best.s").alias("best_step"), F.col("best.v").alias(metric))
    )


def run_perplexity(df: DataFrame, prefixes: tuple[str, ...] = ("val", "test")) -> DataFrame:
    """Perplexity next to each loss, null where the loss is."""
    return df.withColumns({f"{p}_perplexity": perplexity(f"{p}_loss") for p in prefixes})


def run_summary(
    df: DataFrame, run: str = "run_id", ts: str = "ts", samples: str = "samples"
) -> DataFrame:
    """Seconds from the first to the last row of a run and samples per second."""
    micros = F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))
    summed = df.groupBy(run).agg(
        (micros / F.lit(1e6)).alias("runtime"), F.sum(samples).alias("samples")
    )
    return summed.withColumn("samples_per_second", F.try_divide("samples", "runtime"))


def eval_summary(
    df: DataFrame, loss: str = "loss", weight: str = "n_target", split: str = C.SPLIT
) -> DataFrame:
    """Mean loss per target token and its perplexity, per split; a row without a loss has no weight."""
    counted = F.when(F.col(loss).isNotNull(), F.col(weight))
    summed = df.groupBy(split).agg(
        F.sum(F.col(loss) * F.col(weight)).alias("_total"), F.sum(counted).alias("_weight")
    )
    return summed.select(split, F.try_divide("_total", "_weight").alias("loss")).withColumn(
        "perplexity", perplexity("loss")
    )


def thin_log(df: DataFrame, every_n: int = C.LOG_EVERY, step: str = "step") -> DataFrame:
    return df.where(as_column(step) % every_n == 0)


def log_lines(
    df: DataFrame, every_n: int = C.LOG_EVERY, logs: str = "logs", step: str = "step"
) -> DataFrame:
    """The kept rows with their printed form; rows without anything to print are dropped."""
    return thin_log(df, every_n, step).withColumn("line", format_log(step, logs)).where("line is not null")
