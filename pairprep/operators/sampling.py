"""Seeded caps and draws. Keys must be unique per split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.tokens import has_target
from pairprep.operators.ranking import bucket_offsets, hash_bucket, seeded_hash


def _cap_of(split: str, caps: Mapping[str, int]) -> Column:
    pairs = [F.lit(v) for item in caps.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), F.col(split)).cast("long")


def cap_cutoffs(
    df: DataFrame, caps: Mapping[str, int], seed: int, key: str, split: str
) -> DataFrame:
    """Last (hash, key) that still fits, for each split above its cap: at most one row a cap.

    Two passes that read only key and split: bucket counts find the bucket where the cap falls,
    then only that bucket, about one 65,536th of a split, is numbered.
    """
    hashed = (
        df.where(F.col(split).isin(*caps))
        .select(split, key, seeded_hash(seed, key).alias("_hash"))
        .withColumn("_bucket", hash_bucket("_hash"))
    )
    edges = (
        bucket_offsets(hashed.select(split, "_bucket"), "_bucket", (split,))
        .withColumn("_need", _cap_of(split, caps) - F.col("rows_before"))
        .where((F.col("_need") > 0) & (F.col("_need") <= F.col("bucket_rows")))
        .select(split, "_bucket", "_need")
    )
    window = Window.partitionBy(split, "_bucket").orderBy("_hash", key)
    return (
        hashed.join(F.broadcast(edges), [split, "_bucket"])
        .withColumn("_rn", F.row_number().over(window))
        .where(F.col("_rn") == F.col("_need"))
        .select(split, F.struct(F.col("_hash"), F.col(key).alias("_key")).alias("_cutoff"))
    )


def cap_splits(
    df: DataFrame,
    caps: Mapping[str, int] = C.CAPS,
    seed: int = C.SHUFFLE_SEED,
    key: str = C.KEY,
    split: str = C.SPLIT,
) -> DataFrame:
    """Exactly the first `cap` rows of each split in seeded order; smaller splits as they are.

    Wide rows are never shuffled: they are compared with a broadcast cutoff of one row a split.
    The input is read three times, twice for its key only, so hand in a stored table.
    """
    unknown = set(caps) - set(C.SPLITS)
    if unknown:
        raise ValueError(f"caps for unknown splits: {sorted(unknown)}")
    cutoffs = cap_cutoffs(df, caps, seed, key, split)
    position = F.struct(seeded_hash(seed, key).alias("_hash"), F.col(key).alias("_key"))
    closed = [name for name, cap in caps.items() if cap == 0]
    kept = df if not closed else df.where(~F.col(split).isin(*closed))
    return (
        kept.join(F.broadcast(cutoffs), split, "left")
        .where(F.col("_cutoff").isNull() | (position <= F.col("_cutoff")))
        .select(*df.columns)
    )


def eval_sample(
    df: DataFrame,
    n: int = C.EVAL_SAMPLES,
    seed: int = C.SAMPLE_SEED,
    key: str = C.KEY,
    labels: str = "labels",
) -> DataFrame:
    """n rows drawn without replacement, then those without a target dropped.

    The draw reads keys only; the n keys, a bounded table, then fetch their rows.
    """
    drawn = df.select(key).orderBy(seeded_hash(seed, key), key).limit(n)
    return df.join(F.broadcast(drawn), key, "left_semi").where(has_target(labels))
