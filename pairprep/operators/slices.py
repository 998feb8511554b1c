"""Arrow batches of bounded size for functions that run in Python.

A batch is 10,000 rows by default, whatever their length: the JVM and a worker hold it at the same
time, and a worker keeps what it once needed. What a function makes of a batch can be many times
larger, so it takes the batch in slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
SLICE_BYTES = 512 << 10
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30}


def bounded_batches(spark: SparkSession) -> None:
    """Let the session hand at most about BATCH_BYTES, or one row, to Python at once. A lower setting
    of the session stays."""
    number, unit = re.match(r"\s*(\d+)\s*([kmg]?)", spark.conf.get(SETTING).lower()).groups()
    if int(number) << _UNITS[unit] > BATCH_BYTES:
        spark.conf.set(SETTING, str(BATCH_BYTES))


def slices(*arrays: pa.Array, at_once: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """The rows of arrays of texts or of 32-bit numbers in order, about at_once bytes or one row at a time."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held = np.zeros(len(arrays[0]), np.int64)
    for a in arrays:
        lists = pa.types.is_list(a.type)
        sizes = pc.list_value_length(a) if lists else pc.binary_length(a)
        held += pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False) * (4 if lists else 1)
    ends = np.cumsum(held)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, before + at_once, "right")), start + 1)
        yield tuple(a.slice(start, stop - start) for a in arrays)
        start = stop
