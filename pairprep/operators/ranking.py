"""Exact positions without one task that sees everything.

Rows are put in buckets that follow the wanted order. Bucket sizes are counted first
(map-side combined), summed up into offsets, and rows are numbered inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairprep.sources.scratch import stage

# monotonically_increasing_id keeps the partition above this many bits, the row below.
PLACE_BITS = 33
HASH_DIGITS = 4
HASH_BUCKETS = 16**HASH_DIGITS
# Groups of rows that stay one partition while there are as many partitions as the session shuffles into.
GROUPS_TOGETHER = 64


def seeded_hash(seed: int, *keys: str) -> Column:
    """Deterministic, uniform order value of a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_bucket(digest: Column | str) -> Column:
    """First 16 bits of a digest: follows the digest's order, evenly filled."""
    digest = F.col(digest) if isinstance(digest, str) else digest
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int")


def bucket_offsets(
    df: DataFrame, bucket: str, groups: tuple[str, ...] = (), extra: tuple[Column, ...] = ()
) -> DataFrame:
    """Per group and bucket: rows in it and rows in all earlier buckets of the group."""
    counted = df.groupBy(*groups, bucket).agg(F.count("*").alias("bucket_rows"), *extra)
    window = Window.partitionBy(*(groups or (F.lit(0),))).orderBy(bucket)
    running = F.sum("bucket_rows").over(window)
    return counted.withColumn("rows_before", running - F.col("bucket_rows"))


def global_hash_rank(df: DataFrame, seed: int, key: str, out: str = "rank") -> DataFrame:
    """Zero-based position of every row in the seeded order.

    The offset table has at most HASH_BUCKETS rows whatever the input, so it is broadcast; each
    numbering task gets about one 65,536th of the rows.
    """
    hashed = df.withColumns({"_hash": seeded_hash(seed, key)}).withColumn("_bucket", hash_bucket("_hash"))
    offsets = bucket_offsets(hashed.select("_bucket"), "_bucket").select("_bucket", "rows_before")
    window = Window.partitionBy("_bucket").orderBy("_hash", key)
    return (
        hashed.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("rows_before") + F.row_number().over(window) - 1)
        .drop("_bucket", "_hash", "rows_before")
    )


def partition_by_rank(df: DataFrame, seed: int, key: str, group_rows: int, part: str, out: str = "rank") -> DataFrame:
    """The rows with `out`, their zero-based position in the seeded order, and `part`, the number of
    the partition they lie in: whole groups of group_rows positions, in order.

    The rows themselves move once. Where each partition begins is found on keys alone: buckets are
    counted, and only those buckets are numbered that a partition begins in. What is broadcast is a row
    per bucket and a (hash, key) per partition, of either at most HASH_BUCKETS. Hand in a stored table.
    """
    session = df.sparkSession
    keys = df.select(key, seeded_hash(seed, key).alias("_hash"))
    keys = keys.withColumn("_bucket", hash_bucket("_hash"))
    offsets = stage(bucket_offsets(keys.select("_bucket"), "_bucket"), "offsets")
    total = offsets.agg(F.max(F.col("rows_before") + F.col("bucket_rows"))).first()[0] or 0
    groups = -(-total // group_rows)
    wanted = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-groups // GROUPS_TOGETHER))
    together = max(-(-groups // min(wanted, HASH_BUCKETS)), 1)
    rows, parts = together * group_rows, max(-(-groups // together), 1)

    # Of the positions rows, 2 * rows, ... that begin a partition, those inside a bucket.
    first = F.greatest(F.ceil(F.col("rows_before") / rows), F.lit(1)) * rows
    begins = offsets.where(first < F.col("rows_before") + F.col("bucket_rows")).select("_bucket", "rows_before")
    inside = Window.partitionBy("_bucket").orderBy("_hash", key)
    position = F.col("rows_before") + F.row_number().over(inside) - 1
    numbered = keys.join(F.broadcast(begins), "_bucket").withColumn("_at", position)
    cuts = numbered.where((F.col("_at") > 0) & (F.col("_at") % rows == 0)).groupBy("_bucket").agg(
        F.collect_list(F.struct("_hash", key)).alias("_cuts")
    )
    before = F.greatest(F.ceil(F.col("rows_before") / rows) - 1, F.lit(0)).cast("int")
    table = offsets.join(cuts, "_bucket", "left").select("_bucket", before.alias("_before"), "_cuts")
    own = F.struct("_hash", key)
    passed = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= own)), F.lit(0))
    placed = (
        df.withColumn("_hash", seeded_hash(seed, key))
        .withColumn("_bucket", hash_bucket("_hash"))
        .join(F.broadcast(table), "_bucket")
        .withColumn(part, F.col("_before") + passed)
        .drop("_bucket", "_before", "_cuts")
    )
    order = Window.partitionBy(part).orderBy("_hash", key)
    return (
        placed.repartitionById(parts, part)
        .withColumn(out, F.col(part).cast("long") * rows + F.row_number().over(order) - 1)
        .drop("_hash")
    )


def global_rank(df: DataFrame, order: tuple[Column, ...], out: str = "rank") -> DataFrame:
    """Zero-based position of every row in any order, ties broken arbitrarily.

    The rows are range-partitioned and numbered inside their partition; what crosses partitions is
    one count of each, so the broadcast has as many rows as there are partitions.
    """
    place = F.monotonically_increasing_id()
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "ordered"
    )
    part = F.shiftright("_place", PLACE_BITS)
    numbered = placed.withColumns({"_part": part, "_at": F.col("_place") - F.shiftleft(part, PLACE_BITS)})
    offsets = bucket_offsets(numbered, "_part").select("_part", "rows_before")
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("rows_before") + F.col("_at"))
        .drop("_part", "_at", "_place", "rows_before")
    )
