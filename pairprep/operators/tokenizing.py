"""Pairs to input ids, attention mask and labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import build_prompt, build_training_text, split_tokens, starts_with_space
from pairprep.functions.tokens import attention_mask, mask_labels, target_ids, truncate
from pairprep.operators.slices import bounded_batches, slices
from pairprep.operators.vocabulary import BLOCK_BYTES, lookup_ids

Tokenizer = Callable[[list[str]], list[list[int]]]


def _pair_tokens(diff: str, message: str, separator: str) -> Column:
    """Tokens of diff + separator + message, without splitting the diff twice.

    Tokens of the two parts are those of the whole unless a token runs across the seam. With a
    separator that ends in whitespace only a message that starts with whitespace can do that.
    """
    whole = split_tokens(build_training_text(diff, message, separator, ""))
    if not separator or separator[-1] not in C.WHITESPACE:
        return whole
    parts = F.concat(F.col("_prompt"), split_tokens(message))
    return F.when(starts_with_space(message), whole).otherwise(parts)


def tokenize_pairs(
    df: DataFrame,
    vocab: DataFrame,
    diff: str = C.DIFF,
    message: str = C.MESSAGE,
    separator: str = C.SEPARATOR,
    max_length: int = C.MAX_LENGTH,
    keep_columns: bool = False,
    key: str = C.KEY,
    split: str = C.SPLIT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """input_ids, attention_mask and labels of diff + separator + message + end token.

    Both the prompt and the sequence are cut from the right at max_length, so a long diff leaves
    no target; such rows stay. A row with a null text has null arrays. Key and split are always kept, other columns on request.
    """
    sequence = F.array_append(_pair_tokens(diff, message, separator), F.lit(C.EOS_TOKEN))
    made = F.struct(
        truncate(sequence, max_length).alias("_tokens"),
        F.least(F.size("_prompt"), F.lit(max_length)).alias("_prompt_size"),
    )
    kept = df.columns if keep_columns else [c for c in (key, split) if c in df.columns]
    # `inline` keeps the texts out of the rows that wait while the lookup runs in Python.
    narrow = df.withColumn("_prompt", split_tokens(build_prompt(diff, separator))).select(
        *kept, F.inline(F.array(made))
    )
    coded = lookup_ids(narrow, vocab, "_tokens", "input_ids", block_bytes)
    return _with_labels(coded, kept)


def tokenize_pairs_with(
    df: DataFrame,
    tokenizer: Callable[[], Tokenizer],
    diff: str = C.DIFF,
    message: str = C.MESSAGE,
    separator: str = C.SEPARATOR,
    eos: str = C.EOS_TOKEN,
    max_length: int = C.MAX_LENGTH,
    keep_columns: bool = False,
    key: str = C.KEY,
    split: str = C.SPLIT,
) -> DataFrame:
    """The same with the caller's tokenizer, built once per task and called once per slice of a bounded
    number of bytes, with its prompts and whole texts. It need not be deterministic: each row is
    tokenised once. Of the prompt only the number of its ids comes back, of the whole what is kept."""

    @F.arrow_udf("prompt_size int, ids array<int>")
    def ids_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import pyarrow as pa

        encode = tokenizer()
        for batch in batches:
            for prompts, wholes in slices(*batch):
                made = encode(prompts.to_pylist() + wholes.to_pylist())
                sizes = pa.array([min(len(ids), max_length) for ids in made[: len(prompts)]], pa.int32())
                kept = pa.array([ids[:max_length] for ids in made[len(prompts) :]], pa.list_(pa.int32()))
                yield pa.StructArray.from_arrays([sizes, kept], ["prompt_size", "ids"])

    bounded_batches(df.sparkSession)
    kept = df.columns if keep_columns else [c for c in (key, split) if c in df.columns]
    prompt = F.coalesce(build_prompt(diff, separator), F.lit(""))
    whole = F.coalesce(build_training_text(diff, message, separator, eos), F.lit(""))
    absent = F.col(diff).isNull() | F.col(message).isNull()
    made = df.withColumn("_absent", absent).withColumn("_made", ids_of.asNondeterministic()(prompt, whole))
    coded = made.select(
        *kept, F.col("_made.prompt_size").alias("_prompt_size"), F.when(~F.col("_absent"), F.col("_made.ids")).alias("input_ids")
    )
    return _with_labels(coded, kept)


def _with_labels(coded: DataFrame, kept: list[str]) -> DataFrame:
    return coded.select(
        *kept,
        "input_ids",
        attention_mask("input_ids").alias("attention_mask"),
        mask_labels("_prompt_size", "input_ids").alias("labels"),
    )


def token_stats(df: DataFrame, max_length: int = C.MAX_LENGTH, split: str = C.SPLIT) -> DataFrame:
    """What truncation and label masks did, per split: rows, tokens, the longest row and the exact
    median, rows that fill max_length, target tokens and rows that have none."""
    size, targets = F.size("input_ids"), F.size(target_ids("labels"))
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"),
        F.sum(size).alias("n_tokens"),
        F.max(size).alias("longest"),
        F.percentile(size, F.lit(0.5)).alias("median"),
        F.count_if(size >= max_length).alias("n_full"),
        F.sum(targets).alias("n_targets"),
        F.count_if(targets == 0).alias("n_without_target"),
    )
