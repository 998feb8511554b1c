"""Review records for sampled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import extract_completion, strip
from pairprep.functions.tokens import has_target, prompt_ids, target_ids
from pairprep.operators.vocabulary import decode


def sample_prompts(samples: DataFrame, vocab: DataFrame, key: str = C.KEY) -> DataFrame:
    """Sampled token rows with a target, as (key, prompt text, ground truth text)."""
    parts = samples.where(has_target("labels")).select(
        key, prompt_ids("input_ids", "labels").alias("_prompt"), target_ids("labels").alias("_target")
    )
    texts = decode(decode(parts, vocab, "_prompt", "prompt"), vocab, "_target", "_truth")
    return texts.select(key, "prompt", strip("_truth").alias("ground_truth"))


def eval_records(prompts: DataFrame, predictions: DataFrame, key: str = C.KEY) -> DataFrame:
    """index, prompt, prediction and ground truth for every sampled prompt that was generated for.

    `prompts` is a stored table of `sample_prompts`, so that the model gets the same texts and
    nothing is decoded twice; `predictions` has one row per key with the full `generated` text.
    """
    return prompts.join(predictions.select(key, "generated"), key).select(
        F.col(key).alias("index"),
        "prompt",
        extract_completion("generated", "prompt").alias("prediction"),
        "ground_truth",
    )


def sample_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("n_samples"))
