"""Writing generated messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C


def prediction_columns(with_diff: bool = False) -> list[str]:
    return ["commit_message", "generation_time"] + ([C.DIFF] if with_diff else [])


def write_predictions_json(
    df: DataFrame, path: str, with_diff: bool = False, mode: str = "errorifexists"
) -> None:
    """One JSON object per line; the diff only on request."""
    df.select(*prediction_columns(with_diff)).write.mode(mode).json(path)


def one_line(col: str) -> Column:
    """A message on a single line: backslash, LF and CR become two characters each."""
    text = F.replace(F.col(col), F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("\n"), F.lit("\\n"))
    return F.replace(text, F.lit("\r"), F.lit("\\r"))


def write_predictions_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Bare messages, one per line."""
    df.select(one_line("commit_message").alias("value")).write.mode(mode).text(path)
