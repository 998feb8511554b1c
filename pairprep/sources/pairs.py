"""Reading pair tables with named splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairprep import constants as C
from pairprep.sources import patches


def load_pairs(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """A dataset laid out as one folder per split (`split=train/…`) or with a split column."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if C.SPLIT not in df.columns:
        raise ValueError(f"{path} has no '{C.SPLIT}' column or partition folder")
    return df


def save_pairs(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(C.SPLIT).parquet(path)


def split_inventory(df: DataFrame, split: str = C.SPLIT) -> DataFrame:
    """Rows and column names per split."""
    names = ",".join(c for c in df.columns if c != split)
    return df.groupBy(split).agg(F.count("*").alias("n_rows")).withColumn("columns", F.lit(names))


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """One row per diff file below a folder (path, diff), decoded as UTF-8; an empty file has none.

    Spark's own reader lets the driver list every file and puts a few of them in a task, so it is left
    for what `read_whole` does not take."""
    found = patches.read_whole(spark, path)
    if found is not None:
        return found.withColumnRenamed("value", C.DIFF)
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias(C.DIFF))
    )
