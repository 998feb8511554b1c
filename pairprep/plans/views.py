"""Inputs for the registered queries, derived row by row from whole driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import build_prompt, word_count
from pairprep.operators.cleaning import clean_pairs
from pairprep.operators.ranking import bucket_offsets

HEADER = "diff --git a/f b/f"

# Messages by doc_id % 23; 0 and 22 are computed.
MESSAGES = {
    1: "fix",
    2: "FIXED",
    3: "WIP ",
    4: "",
    5: "ab",
    6: "two words",
    7: "Fixes #123 in parser",
    8: "Refactor the parser code",
    9: "Look at <URL> for more",
    10: "Bump #<I> to latest",
    11: "Closes\nthe open issue",
    12: "Fixes the bug\n\nLong body text here",
    13: "\u3000Add new option\xa0",
    14: "fix the crash in parser",
    15: "fix #123",
    16: "Look at <url> for more",
    17: "Add <HASH> lookup table",
    18: "- add a bullet",
    19: "closest pair search added",
    20: "resolve: odd case here",
    21: "Closed, as agreed",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _choose(selector: Column, values: dict[int, Column]) -> Column:
    chain = None
    for n, value in values.items():
        chain = F.when(selector == n, value) if chain is None else chain.when(selector == n, value)
    return chain


def _diff() -> Column:
    text = F.col("text")
    shapes = {
        0: text,
        1: F.concat(F.lit(HEADER + "\n@@ -1 +1 @@\n+"), text),
        2: F.concat(F.lit(HEADER + "\r\n@@ -1 +1 @@\r\n+"), text),
        3: F.concat(F.lit(HEADER + "\n+"), text, F.lit("\ndiff --git a/g b/g\n-"), text),
        4: F.concat(F.lit("index 12..34\n"), text),
        5: F.concat(F.lit("\u3000\r\n"), text, F.lit(" \r")),
        6: F.concat(F.lit("+++ b/f\n"), text),
    }
    return F.when(F.col("doc_id") % 29 != 0, _choose(F.col("doc_id") % 7, shapes))


def _message() -> Column:
    first_sentence = F.regexp_extract("text", r"\A[^.\n]*", 0)
    values = {0: first_sentence} | {n: F.lit(m) for n, m in MESSAGES.items()}
    return _choose(F.col("doc_id") % 23, values)


def _split() -> Column:
    part = F.col("doc_id") % 10
    return F.when(part < 8, "train").when(part == 8, "validation").otherwise("test")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_of(documents(spark, sf_dir))


def pairs_of(texts: DataFrame) -> DataFrame:
    """One pair per document, batch or streaming; the shapes mix all rules."""
    return texts.select(
        F.col("doc_id").alias(C.KEY),
        _diff().alias(C.DIFF),
        _message().alias(C.MESSAGE),
        _split().alias(C.SPLIT),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pairs(pairs(spark, sf_dir))


def texts_with_specials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with one of the added tokens inside and at its end."""
    tokens = F.array(*[F.lit(t) for t, _, _ in C.SPECIAL_TOKENS])
    token = F.element_at(tokens, (F.col("doc_id") % len(C.SPECIAL_TOKENS) + 1).cast("int"))
    return documents(spark, sf_dir).select(
        "doc_id", F.concat(token, F.col("text"), token).alias("text")
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user, one evaluation per event in time order, 300 steps apart.

    The position in a run is found minute by minute, so a user with very many events does not
    end up in one task.
    """
    events = (
        read(spark, sf_dir, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("_minute", F.date_trunc("minute", "ts"))
    )
    offsets = bucket_offsets(events, "_minute", ("user_id",)).drop("bucket_rows")
    inside = Window.partitionBy("user_id", "_minute").orderBy("ts", "event_id")
    return (
        events.withColumn("_at", F.row_number().over(inside))
        .join(offsets, ["user_id", "_minute"])
        .select(
            F.col("user_id").alias("run_id"),
            ((F.col("rows_before") + F.col("_at")) * C.EVAL_EVERY).alias("step"),
            F.when(F.col("event_type") != "error", 1 + F.col("value") / 100).alias("eval_loss"),
            F.lit(C.BATCH_SIZE * C.ACCUMULATION * C.EVAL_EVERY).cast("long").alias("samples"),
            "ts",
        )
    )


def run_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final losses of each run: lowest value of two event types, null where a run has none."""
    value = 1 + F.col("value") / 100
    return (
        read(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("run_id"))
        .agg(
            F.min(F.when(F.col("event_type") == "view", value)).alias("val_loss"),
            F.min(F.when(F.col("event_type") == "error", value)).alias("test_loss"),
        )
    )


def row_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loss, missing for one pair in eleven, and a target length for every raw pair."""
    loss = 1 + F.length(F.coalesce(C.DIFF, F.lit(""))) % 500 / F.lit(100.0)
    return pairs(spark, sf_dir).select(
        C.KEY,
        C.SPLIT,
        F.when(F.col(C.KEY) % 11 != 0, loss).alias("loss"),
        word_count(C.MESSAGE).alias("n_target"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed stand-in for a model: the prompt, then a line about the whole diff."""
    rows = clean(spark, sf_dir).withColumn("prompt", build_prompt(C.DIFF))
    said = F.concat(F.lit("  Update "), F.length(C.DIFF).cast("string"), F.lit(" characters\n"))
    return rows.select(
        C.KEY,
        C.DIFF,
        "prompt",
        F.concat("prompt", said).alias("generated"),
        F.lit(0.0).alias("generation_time"),
    )


# Signatures that the tool conversations are offered.
TOOLS = (
    {"type": "function", "function": {"name": "look_up", "parameters": {"query": "string", "limit": "integer"}}},
    {"type": "function", "function": {"name": "note", "description": "Keeps a \"note\", é", "parameters": {}}},
)


def tool_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations; assistant messages of odd turns call one tool or two with their whole text
    among the nested arguments, and some of them say nothing else."""
    arguments = F.struct(
        F.col("text").alias("query"),
        F.struct(F.col("turn").alias("limit"), (F.col("conv_id") % 2 == 0).alias("exact")).alias("options"),
        F.array(F.lit("a, b: c"), F.col("role")).alias("tags"),
    )
    call = lambda name: F.struct(F.lit(name).alias("name"), arguments.alias("arguments"))
    one, two = F.array(call("look_up")), F.array(call("look_up"), call("note"))
    calls = F.when(F.col("conv_id") % 3 == 0, two).otherwise(one)
    calling = (F.col("role") == "assistant") & (F.col("turn") % 2 == 1)
    silent = calling & (F.col("conv_id") % 4 == 0)
    rows = read(spark, sf_dir, "conversations").withColumn("tool_calls", F.when(calling, calls))
    return rows.withColumn("text", F.when(~silent, F.col("text")))
