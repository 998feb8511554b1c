"""Cleaning pairs as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pairprep import constants as C
from pairprep.operators.cleaning import clean_pairs


def clean_pairs_stream(
    sdf: DataFrame, diff: str = C.DIFF, message: str = C.MESSAGE, **thresholds
) -> DataFrame:
    """The batch filter on a streaming table: stateless, so append mode and no watermark."""
    if not sdf.isStreaming:
        raise ValueError("clean_pairs_stream needs a streaming table; use clean_pairs")
    return clean_pairs(sdf, diff, message, **thresholds)


def write_pairs_stream(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now, appended to a table partitioned by split."""
    writer = sdf.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).partitionBy(C.SPLIT).start(path)
