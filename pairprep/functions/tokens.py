"""Array scalars over token ids, masks and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import as_column


def truncate(arr: Column | str, max_length: int = C.MAX_LENGTH) -> Column:
    return F.slice(as_column(arr), 1, max_length)


def attention_mask(ids: Column | str) -> Column:
    return F.array_repeat(F.lit(1), F.size(as_column(ids)))


def mask_labels(prompt_size: Column | str, ids: Column | str) -> Column:
    """Ids with the first prompt_size entries replaced by the ignored label."""
    ids = as_column(ids)
    hidden = F.least(as_column(prompt_size), F.size(ids))
    return F.concat(
        F.array_repeat(F.lit(C.IGNORED_LABEL), hidden), F.slice(ids, hidden + 1, F.size(ids))
    )


def prompt_len(labels: Column | str) -> Column:
    """Length of the leading run of ignored labels."""
    labels = as_column(labels)
    first_target = F.array_position(F.transform(labels, lambda x: x != C.IGNORED_LABEL), True)
    return F.when(first_target > 0, (first_target - 1).cast("int")).otherwise(F.size(labels))


def has_target(labels: Column | str) -> Column:
    labels = as_column(labels)
    return prompt_len(labels) < F.size(labels)


def target_ids(labels: Column | str) -> Column:
    return F.filter(as_column(labels), lambda x: x != C.IGNORED_LABEL)


def prompt_ids(ids: Column | str, labels: Column | str) -> Column:
    return F.slice(as_column(ids), 1, prompt_len(labels))


def pad_to(arr: Column | str, length: Column, value: int) -> Column:
    arr = as_column(arr)
    return F.concat(arr, F.array_repeat(F.lit(value), length - F.size(arr)))
