"""Bulk generation with a caller's model."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pairprep import constants as C
from pairprep.functions.rules import has_input
from pairprep.functions.text import build_prompt, extract_completion, preview, split_tokens
from pairprep.functions.tokens import truncate

Generator = Callable[..., list[str]]


def generate_batch(
    df: DataFrame,
    factory: Callable[[], Generator],
    diff: str = C.DIFF,
    separator: str = C.SEPARATOR,
    max_length: int = C.MAX_LENGTH,
    batch_size: int = 32,
    profile: ResourceProfile | None = None,
    **generation,
) -> DataFrame:
    """Add commit_message, prompt, generation_time and truncated_diff to every diff.

    `factory()` runs once per task and returns a function from prompts to full generated texts,
    each starting with its prompt; `generation` is handed to that function as it is. The model
    sees the prompt cut at max_length tokens, and that cut prompt is what is removed from its
    answer. Only cutting to batches and the model itself run in Python, once per row whatever is
    filtered afterwards. Rows without a diff are refused.

    With a `profile` the stage of the model gets its resources (a GPU a task, more memory), and the
    stages before and after a shuffle do not; a local master has none to give and is refused.
    """
    if profile is not None:
        _require_cluster(df.sparkSession)
    sent = F.array_join(truncate(split_tokens("prompt"), max_length), "")
    prompted = df.where(has_input(diff)).withColumn("prompt", build_prompt(diff, separator)).withColumn("_sent", sent)
    answered = _answered if profile is None else functools.partial(_answered_in_stage, profile=profile)
    return (
        answered(prompted, factory, batch_size, generation)
        .withColumns(
            {
                "commit_message": extract_completion("_answer.generated", "_sent"),
                "generation_time": F.col("_answer.seconds"),
                "truncated_diff": preview(diff),
            }
        )
        .drop("_sent", "_answer")
    )


_ANSWER = "generated string, seconds double"


def _require_cluster(spark: SparkSession) -> None:
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        raise ValueError("a resource profile needs a cluster; a local master cannot place the model's stage")


def _ask(model: Generator, prompts: list[str], batch_size: int, generation: dict) -> tuple[list[str], list[float]]:
    """The model's texts and the seconds that each took, prompts in batches."""
    import time

    texts: list[str] = []
    seconds: list[float] = []
    for start in range(0, len(prompts), batch_size):
        part = prompts[start : start + batch_size]
        began = time.perf_counter()
        texts.extend(model(part, **generation))
        seconds.extend([(time.perf_counter() - began) / len(part)] * len(part))
    return texts, seconds


def _answered(rows: DataFrame, factory: Callable[[], Generator], batch_size: int, generation: dict) -> DataFrame:
    """Add _answer to rows with _sent; all other columns stay in the JVM."""

    @F.pandas_udf(_ANSWER)
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        model = factory()
        for prompts in batches:
            texts, seconds = _ask(model, prompts.tolist(), batch_size, generation)
            yield pd.DataFrame({"generated": texts, "seconds": seconds})

    return rows.withColumn("_answer", answer.asNondeterministic()("_sent"))


def _answered_in_stage(
    rows: DataFrame,
    factory: Callable[[], Generator],
    batch_size: int,
    generation: dict,
    profile: ResourceProfile | None,
) -> DataFrame:
    """The same by `mapInArrow`, which takes a resource profile and carries all columns."""
    schema = StructType([*rows.schema.fields, StructField("_answer", StructType.fromDDL(_ANSWER))])
    place = rows.columns.index("_sent")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        model = factory()
        for batch in batches:
            texts, seconds = _ask(model, batch.column(place).to_pylist(), batch_size, generation)
            arrays = [pa.array(texts, pa.string()), pa.array(seconds, pa.float64())]
            answer = pa.StructArray.from_arrays(arrays, ["generated", "seconds"])
            yield pa.RecordBatch.from_arrays([*batch.columns, answer], [*batch.schema.names, "_answer"])

    return rows.mapInArrow(run, schema, profile=profile)


def generation_results(df: DataFrame, diff: str = C.DIFF) -> DataFrame:
    """The result table of a generation run."""
    return df.select(
        F.col(diff).alias("diff"), "commit_message", "prompt", "generation_time", "truncated_diff"
    )


def split_diff_by_file(df: DataFrame, diff: str = C.DIFF, key: str = C.KEY) -> DataFrame:
    """(key, part, diff): one row per file of a diff, in order from zero. Text before the first
    header is a part of its own; the parts make the diff again; rows without a diff have none."""
    parts = F.split(diff, r"(?<![^\n])(?=diff --git )")
    return df.where(has_input(diff)).select(key, F.posexplode(parts).alias("part", diff))
