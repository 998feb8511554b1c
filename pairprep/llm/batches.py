"""Arrow batch size for columns of long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_AT_ONCE = 500


def small_batches(spark: SparkSession) -> None:
    """Let the session hand at most TEXTS_AT_ONCE rows to Python at once.

    The default of 10,000 rows is meant for short rows: with texts of many kilobytes a batch is held
    by the JVM and by a worker at the same time, and a worker keeps what it once needed. A lower
    setting of the session stays.
    """
    now = int(spark.conf.get(SETTING))
    if now <= 0 or now > TEXTS_AT_ONCE:
        spark.conf.set(SETTING, str(TEXTS_AT_ONCE))
