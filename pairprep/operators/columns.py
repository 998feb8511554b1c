"""Guessing which column is the diff and which the message."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pairprep import constants as C
from pairprep.functions.text import looks_like_diff, looks_like_message


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def column_scores(names: list[str]) -> Column:
    """Array of (name, diff_score, msg_score) in column order; null values are left out."""

    def score(name: str) -> Column:
        text = F.col(f"`{name}`")
        diff = 2 * looks_like_diff(text).cast("int") + (F.length(text) > C.DIFF_LIKE_CHARS).cast("int")
        msg = looks_like_message(text).cast("int") + (F.length(text) < C.MESSAGE_LIKE_CHARS).cast("int")
        return F.when(
            text.isNotNull(),
            F.struct(F.lit(name).alias("name"), diff.alias("diff_score"), msg.alias("msg_score")),
        )

    return F.array_compact(F.array(*[score(n) for n in names]))


def score_text_columns(df: DataFrame) -> DataFrame:
    """The table with a `scores` column over all its string columns."""
    return df.withColumn("scores", column_scores(string_columns(df)))


def _first_best(scores: Column, field: str) -> Column:
    best = F.array_max(F.transform(scores, lambda s: s[field]))
    return F.try_element_at(F.filter(scores, lambda s: s[field] == best), F.lit(1))["name"]


def choose_columns(scores: Column | str) -> Column:
    """(diff_column, message_column) for an array of scores.

    Ties go to the earliest column. When one column wins both, the message is the best of the
    others; a single column is both; none gives nulls.
    """
    scores = F.col(scores) if isinstance(scores, str) else scores
    diff = _first_best(scores, "diff_score")
    msg = _first_best(scores, "msg_score")
    others = F.filter(scores, lambda s: s["name"] != msg)
    message = F.when((diff == msg) & (F.size(scores) > 1), _first_best(others, "msg_score")).otherwise(msg)
    return F.struct(diff.alias("diff_column"), message.alias("message_column"))


def _equals(row: Row, names: list[str]) -> Column:
    return reduce(and_, [F.col(n).eqNullSafe(F.lit(row[n])) for n in names])


def first_row(df: DataFrame, key: str = C.KEY, split: str = C.SPLIT) -> DataFrame:
    """First row of train by key, else of the first split by name.

    The row is found on key and split alone and then fetched by its values, which parquet uses to
    skip all row groups but one; a top-1 over whole rows would read every text.
    """
    if split in df.columns:
        place = [split, key]
        order = [(F.col(split) != "train").cast("int"), F.col(split), F.col(key)]
    else:
        place, order = [key], [F.col(key)]
    found = df.select(*place).orderBy(*order).limit(1).first()
    if found is None:
        return df.limit(0)
    return df.where(_equals(found, place)).limit(1)


def inferred_columns(df: DataFrame, key: str = C.KEY, split: str = C.SPLIT) -> DataFrame:
    """(diff_column, message_column) guessed from one row, defaults where nothing can be guessed.

    The split column is a property of our layout, not of the data, so it is never a candidate.
    """
    names = [n for n in string_columns(df) if n != split]
    if not names:
        schema = "diff_column string, message_column string"
        return df.sparkSession.createDataFrame([(C.DIFF, C.MESSAGE)], schema)
    guess = first_row(df, key, split).select(choose_columns(column_scores(names)).alias("c"))
    return guess.select(
        F.coalesce("c.diff_column", F.lit(C.DIFF)).alias("diff_column"),
        F.coalesce("c.message_column", F.lit(C.MESSAGE)).alias("message_column"),
    )


def infer_columns(df: DataFrame, key: str = C.KEY, split: str = C.SPLIT) -> tuple[str, str]:
    """The two names on the driver, ready to be used as arguments; the defaults for an empty table."""
    row = inferred_columns(df, key, split).first()
    return (row.diff_column, row.message_column) if row else (C.DIFF, C.MESSAGE)


def summed_columns(df: DataFrame, split: str = C.SPLIT) -> DataFrame:
    """(diff_column, message_column) from the scores of all rows together, ties to the earliest
    column, defaults where nothing can be guessed."""
    names = [n for n in string_columns(df) if n != split]
    if not names:
        return inferred_columns(df, split=split)
    places = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    totals = (
        df.select(F.inline(column_scores(names)))
        .groupBy("name")
        .agg(F.sum("diff_score").alias("diff_score"), F.sum("msg_score").alias("msg_score"))
    )
    row = F.struct(F.try_element_at(places, F.col("name")).alias("place"), "name", "diff_score", "msg_score")
    scores = totals.agg(F.array_sort(F.collect_list(row)).alias("scores"))
    return scores.select(choose_columns("scores").alias("c")).select(
        F.coalesce("c.diff_column", F.lit(C.DIFF)).alias("diff_column"),
        F.coalesce("c.message_column", F.lit(C.MESSAGE)).alias("message_column"),
    )
