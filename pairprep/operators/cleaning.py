"""Normalising, filtering and counting pairs. No shuffle but the per-split counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.rules import keep_pair, reject_reason
from pairprep.functions.text import normalize_newlines, text_or_empty


def preprocess_pair(df: DataFrame, diff: str = C.DIFF, message: str = C.MESSAGE) -> DataFrame:
    """Both pair columns normalised, missing text read as empty, other columns untouched.

    The two texts are produced through a one-element `inline`. A plain projection would be merged
    into whatever filter follows and normalise each text once per rule.
    """
    texts = dict.fromkeys((diff, message))
    fresh = F.struct(*[normalize_newlines(text_or_empty(c)).alias(c) for c in texts])
    others = [c for c in df.columns if c not in texts]
    return df.select(*others, F.inline(F.array(fresh))).select(*df.columns)


def clean_pairs(
    df: DataFrame, diff: str = C.DIFF, message: str = C.MESSAGE, **thresholds
) -> DataFrame:
    """Normalise, then keep the pairs that pass every rule.

    `thresholds` are those of `keep_pair`. Works on batch and streaming tables alike.
    """
    return preprocess_pair(df, diff, message).where(
        keep_pair(diff, message, normalized=True, **thresholds)
    )


def retention_report(
    df: DataFrame,
    diff: str = C.DIFF,
    message: str = C.MESSAGE,
    split: str = C.SPLIT,
    **thresholds,
) -> DataFrame:
    """Pairs before and after cleaning and the percentage kept, in one pass over the raw table."""
    keep = keep_pair(diff, message, normalized=True, **thresholds)
    counted = (
        preprocess_pair(df.select(split, diff, message), diff, message)
        .groupBy(split)
        .agg(F.count("*").alias("before"), F.count_if(keep).alias("after"))
    )
    return counted.withColumn(
        "kept_pct", F.when(F.col("before") > 0, 100.0 * F.col("after") / F.col("before")).otherwise(0.0)
    )


def clean_pairs_counted(
    df: DataFrame,
    diff: str = C.DIFF,
    message: str = C.MESSAGE,
    split: str = C.SPLIT,
    splits: Sequence[str] = C.SPLITS,
    **thresholds,
) -> tuple[DataFrame, Observation]:
    """What `clean_pairs` returns, and its counts per split, which are there once the rows have been
    used: the pass that writes them counts them, and the raw table is read once."""
    keep = keep_pair(diff, message, normalized=True, **thresholds)
    judged = preprocess_pair(df, diff, message).select("*", F.inline(F.array(F.struct(keep.alias("_keep")))))
    counted = Observation("retention")
    of = [(s, F.col(split) == s) for s in splits]
    counts = [F.count_if(rows).alias(f"before_{s}") for s, rows in of]
    counts += [F.count_if(rows & F.col("_keep")).alias(f"after_{s}") for s, rows in of]
    return judged.observe(counted, *counts).where("_keep").drop("_keep"), counted


def retention_of(
    spark: SparkSession, counted: Observation, split: str = C.SPLIT, splits: Sequence[str] = C.SPLITS
) -> DataFrame:
    """`retention_report` from the counts of `clean_pairs_counted`; waits for the first use of its rows.
    Splits without a row are left out, as they are there."""
    found = counted.get
    rows = [(s, found[f"before_{s}"], found[f"after_{s}"]) for s in splits if found[f"before_{s}"]]
    return spark.createDataFrame(rows, f"{split} string, before long, after long").withColumn(
        "kept_pct", 100.0 * F.col("after") / F.col("before")
    )


def total_size(df: DataFrame) -> DataFrame:
    """Rows over all splits."""
    return df.agg(F.count("*").alias("n_rows"))


def assert_nonempty(df: DataFrame, split: str = "train") -> DataFrame:
    """The table itself, or an error when the split has no row."""
    if df.where(F.col(C.SPLIT) == split).isEmpty():
        raise ValueError(f"split '{split}' is empty")
    return df


def reject_breakdown(df: DataFrame, diff: str = C.DIFF, message: str = C.MESSAGE, split: str = C.SPLIT) -> DataFrame:
    """Rows per split and first failing rule; the reason is null for pairs that are kept."""
    return df.select(split, reject_reason(diff, message).alias("reason")).groupBy(split, "reason").agg(
        F.count("*").alias("n_rows")
    )


def split_overlap(
    df: DataFrame, texts: tuple[str, ...] = (C.DIFF, C.MESSAGE), split: str = C.SPLIT, train: str = "train"
) -> DataFrame:
    """Rows per other split, and how many of them have normalised texts that a train row has too.

    Both sides are counted per digest first, so a text that very many rows share is one row of the
    join; a null text counts as empty.
    """
    parts = [normalize_newlines(F.coalesce(t, F.lit(""))) for t in texts]
    digest = F.sha2(F.array_join(F.array(*[F.sha2(p, 256) for p in parts]), ","), 256)
    counted = df.select(split, digest.alias("_digest")).groupBy(split, "_digest").agg(F.count("*").alias("_n"))
    known = counted.where(F.col(split) == train).select("_digest", F.lit(True).alias("_known"))
    return (
        counted.where(F.col(split) != train)
        .join(known, "_digest", "left")
        .groupBy(split)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.sum(F.when(F.col("_known"), F.col("_n")).otherwise(0)).alias("n_in_train"),
        )
    )
