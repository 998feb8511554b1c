"""The data path as one job: raw pairs to cleaned, capped and tokenised splits."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import build_training_text
from pairprep.operators.cleaning import assert_nonempty, clean_pairs
from pairprep.operators.sampling import cap_splits
from pairprep.operators.tokenizing import tokenize_pairs
from pairprep.operators.vocabulary import build_vocab
from pairprep.sources.scratch import stage
from pairprep.sources.token_cache import fingerprint, load_token_cache, save_token_cache


class Splits(NamedTuple):
    train: DataFrame
    validation: DataFrame
    test: DataFrame


def as_splits(df: DataFrame) -> Splits:
    return Splits(*[df.where(F.col(C.SPLIT) == name) for name in C.SPLITS])


def get_splits(
    df: DataFrame,
    caps: Mapping[str, int] = C.CAPS,
    seed: int = C.SHUFFLE_SEED,
    diff: str = C.DIFF,
    message: str = C.MESSAGE,
    key: str = C.KEY,
    **thresholds,
) -> DataFrame:
    """Clean, then cap. The cleaned table is written once, by split: the two passes that find
    the cutoffs then read keys only, and nothing is cleaned three times."""
    cleaned = stage(clean_pairs(df, diff, message, **thresholds), "cleaned", (C.SPLIT,))
    return cap_splits(cleaned, caps, seed, key)


def load_or_tokenize(
    df: DataFrame,
    cache: str,
    vocab_size: int,
    dataset: str,
    max_length: int = C.MAX_LENGTH,
    separator: str = C.SEPARATOR,
    caps: Mapping[str, int] = C.CAPS,
    seed: int = C.SHUFFLE_SEED,
    **thresholds,
) -> DataFrame:
    """Tokenised splits from the cache, else made and cached.

    `dataset` names the input in the fingerprint, so give another input another name; the vocabulary is learned on the kept train
    pairs.
    """
    spark = df.sparkSession
    digest = fingerprint(
        dataset=dataset,
        vocab_size=vocab_size,
        max_length=max_length,
        separator=separator,
        caps=dict(caps),
        seed=seed,
        thresholds=thresholds,
    )
    cached = load_token_cache(spark, cache, digest)
    if cached is not None:
        return cached
    kept = stage(get_splits(df, caps, seed, **thresholds), "capped", (C.SPLIT,))
    assert_nonempty(kept)
    whole = build_training_text(C.DIFF, C.MESSAGE, separator, "")
    vocab = stage(build_vocab(as_splits(kept).train, vocab_size, whole), "vocabulary")
    save_token_cache(
        tokenize_pairs(kept, vocab, separator=separator, max_length=max_length), cache, digest
    )
    return load_token_cache(spark, cache, digest)
