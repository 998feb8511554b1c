"""Batches of similar length, padded rectangles and step numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.tokens import pad_to
from pairprep.operators.ranking import global_hash_rank, partition_by_rank

MEGABATCH_BATCHES = 50
PART = "batch_part"


def plan_batches(
    df: DataFrame,
    batch_size: int = C.BATCH_SIZE,
    seed: int = C.SAMPLE_SEED,
    key: str = C.KEY,
    length: str | None = None,
    ids: str = "input_ids",
) -> DataFrame:
    """(key, megabatch, batch_id, batch_pos): seeded order, cut into megabatches of 50 batches,
    each sorted by length, longest first, and cut into batches. Only the last batch is short.

    Only key and length are read and moved; hand in a stored table. Every window is small by
    construction: a hash bucket, then one megabatch.
    """
    size = F.col(length) if length else F.size(ids)
    ranked = global_hash_rank(df.select(key, size.alias("_size")), seed, key, "_rank")
    return _batched(ranked, batch_size)


def _batched(ranked: DataFrame, batch_size: int, *parts: str) -> DataFrame:
    """Add megabatch, batch_id and batch_pos to rows with _rank and _size."""
    megabatch = F.floor(F.col("_rank") / (MEGABATCH_BATCHES * batch_size))
    window = Window.partitionBy(*parts, "megabatch").orderBy(F.desc("_size"), "_rank")
    return (
        ranked.withColumn("megabatch", megabatch)
        .withColumn("_at", F.row_number().over(window) - 1)
        .withColumns(
            {
                "batch_id": F.col("megabatch") * MEGABATCH_BATCHES + F.floor(F.col("_at") / batch_size),
                "batch_pos": (F.col("_at") % batch_size).cast("int"),
            }
        )
        .drop("_rank", "_at", "_size")
    )


def length_batches(
    df: DataFrame,
    batch_size: int = C.BATCH_SIZE,
    seed: int = C.SAMPLE_SEED,
    key: str = C.KEY,
    length: str | None = None,
    ids: str = "input_ids",
) -> DataFrame:
    """The rows with their place in `plan_batches`, and batch_part, the partition they lie in.

    The rows move once, to partitions that hold whole megabatches; hand in a stored table.
    """
    size = F.col(length) if length else F.size(ids)
    ranked = partition_by_rank(df, seed, key, MEGABATCH_BATCHES * batch_size, PART, "_rank")
    return _batched(ranked.withColumn("_size", size), batch_size, PART)


def pad_batches(
    batched: DataFrame,
    multiple: int = C.PAD_MULTIPLE,
    pad_id: int = C.EOS_ID,
    key: str = C.KEY,
) -> DataFrame:
    """One row per batch with its arrays padded to the longest, rounded up to `multiple`, and
    padding, the number of places that hold no token.

    Grouping starts from the part the rows are already partitioned by, so no shuffle is added, and
    a group never holds more than batch_size rows.
    """
    groups = [c for c in (PART, "megabatch", "batch_id") if c in batched.columns]
    row = F.struct("batch_pos", key, "input_ids", "attention_mask", "labels")
    longest = F.array_max(F.transform("_rows", lambda r: F.size(r["input_ids"])))
    width = (F.ceil(longest / multiple) * multiple).cast("int")
    return (
        batched.groupBy(*groups)
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"))
        .withColumn("width", width)
        .select(
            "batch_id",
            "width",
            (F.col("width") * F.size("_rows") - _tokens_in("_rows")).cast("long").alias("padding"),
            F.transform("_rows", lambda r: r[key]).alias(f"{key}s"),
            F.transform("_rows", lambda r: pad_to(r["input_ids"], F.col("width"), pad_id)).alias("input_ids"),
            F.transform("_rows", lambda r: pad_to(r["attention_mask"], F.col("width"), 0)).alias(
                "attention_mask"
            ),
            F.transform("_rows", lambda r: pad_to(r["labels"], F.col("width"), C.IGNORED_LABEL)).alias(
                "labels"
            ),
        )
    )


def _tokens_in(rows: str) -> Column:
    return F.aggregate(F.transform(rows, lambda r: F.size(r["input_ids"])), F.lit(0), lambda a, b: a + b)


def padding_waste(padded: DataFrame) -> DataFrame:
    """Places and padding over all batches, and the share of places that is padding."""
    places = F.sum(F.col("width") * F.size("input_ids")).cast("long")
    return padded.agg(places.alias("places"), F.sum("padding").cast("long").alias("padding")).withColumn(
        "padding_pct", F.round(F.try_divide(100 * F.col("padding"), F.col("places")), 6)
    )


def step_plan(batched: DataFrame, accumulation: int = C.ACCUMULATION) -> DataFrame:
    """Micro-batch and optimiser step, both from zero, of every row that has a batch."""
    return batched.withColumns(
        {
            "micro_batch": F.col("batch_id"),
            "optimizer_step": F.floor(F.col("batch_id") / accumulation),
        }
    )
