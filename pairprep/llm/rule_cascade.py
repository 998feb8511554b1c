"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule says when a document fails. On a sample of bounded size (about SAMPLE_ROWS rows) the share of documents
that a rule rejects and the time that it takes are measured; rules are then asked in the order of
rejections per cost, and a document that one rejects is not asked the next. The verdict does not
depend on the order, so neither does it depend on the sample or the clock.

The base metrics are plain expressions over the text. Words that repeat are found without a
shuffle and in n log n steps: hashes of all 3-word windows are sorted with their places, and
neighbours are compared.

Defined results: a null or empty text has no words and fails the base rules; repeated rows get the
same values again; other columns are kept, those with a metric's name are replaced; an empty table
gives no rows (the rules then keep their given order).
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2000
SAMPLE_SEED = 42
SAMPLE_TASKS = 8
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words(text: Column) -> Column:
    """Runs of other than ASCII blanks."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def removed_chars(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    return F.size(lines) - F.size(F.array_distinct(lines))


def place_bits(ws: Column) -> Column:
    """Bits that hold any place in the words."""
    return F.ceil(F.log2(F.size(ws) + F.lit(2))).cast("int")


def window_keys(ws: Column) -> Column:
    """Sorted numbers of the 3-word windows: a hash in the upper bits, the window's place below.

    Sorting longs is the one step that is not linear, and runs on a primitive array.
    """
    n = F.size(ws) - 2
    places = F.when(n > 0, F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    bits = F.col("_bits")

    def key(i: Column) -> Column:
        at = i.cast("int")
        digest = F.xxhash64(F.get(ws, at), F.get(ws, at + 1), F.get(ws, at + 2))
        return F.call_function("shiftleft", F.call_function("shiftright", digest, bits), bits).bitwiseOR(i)

    return F.sort_array(F.transform(places, key))


def repeat_words(ws: Column, keys: Column) -> Column:
    """Words inside 3-word windows that are found twice or more.

    Equal windows are neighbours among the keys; where the hashes agree the words are compared.
    """
    bits = F.col("_bits")
    place = lambda k: (k - F.call_function("shiftleft", F.call_function("shiftright", k, bits), bits)).cast("int")

    def same(x: Column, y: Column) -> Column:
        hashes = F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0
        equal = [F.get(ws, place(x) + n) == F.get(ws, place(y) + n) for n in range(3)]
        return F.coalesce(hashes & equal[0] & equal[1] & equal[2], F.lit(False))

    again = F.filter(keys, lambda x, j: same(x, F.get(keys, j + 1)) | same(x, F.get(keys, j - 1)))
    # Each window covers three words, or up to the next repeated window.
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def covered(at: Column) -> Column:
        step = lambda i, j: F.least(F.coalesce(F.get(at, j + 1) - i, F.lit(3)), F.lit(3))
        return F.aggregate(F.transform(at, step), F.lit(0), lambda a, b: a + b)

    return once(F.sort_array(F.transform(again, place)), covered)


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base metrics; the words stay in `_words` for the rules behind them."""
    value = F.coalesce(F.col(text), F.lit(""))
    # `inline` keeps an expression from being copied into every one that uses its value.
    split = F.inline(F.array(F.struct(words(value).alias("_words"))))
    held = docs.drop(*METRICS, "_words", "_bits", "_keys").select("*", split)
    ready = held.withColumn("_bits", place_bits(F.col("_words")))
    keys = F.inline(F.array(F.struct(window_keys(F.col("_words")).alias("_keys"))))
    return ready.select("*", keys).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": removed_chars(value, BLANKS).cast("long"),
            "n_symbols": (F.length(value) - removed_chars(value, SYMBOLS)).cast("long"),
            "n_dup_lines": dup_lines(value).cast("long"),
            "n_repeat_words": repeat_words(F.col("_words"), F.col("_keys")).cast("long"),
        }
    ).drop("_bits", "_keys")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules(text: str = "text") -> dict[str, Column]:
    """When a document fails, by rule; shares are compared in whole numbers."""
    value = F.coalesce(F.col(text), F.lit(""))
    ended = F.size(F.split(value, r"(?:\.\.\.|…)\s*(?:\n|\z)")) - 1
    share = lambda chars: F.length(value) - removed_chars(value, chars)
    return {
        "word_length_low": F.col("word_chars") < 2 * F.col("n_words"),
        "word_length_high": F.col("word_chars") > 20 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > 8 * F.size(F.split(value, "\n")),
        "digits": 10 * share("0123456789") > 3 * F.col("word_chars"),
        "capitals": 2 * share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") > F.col("word_chars"),
        "ellipses": 10 * ended > 3 * F.size(F.split(value, "\n")),
    }


def sampled(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About sample_rows rows of the table, drawn where they lie; nothing but they moves."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    return docs.sample(fraction=share, seed=SAMPLE_SEED).repartition(SAMPLE_TASKS)


def measured(sample: DataFrame, rules: Mapping[str, Column]) -> list[tuple]:
    """(rule, share of the sample that it rejects, seconds a row), the best first.

    The time of a rule is that of one pass over the stored sample, less that of a pass without.
    """
    sample = sample.persist()
    try:
        rows = sample.count()

        def timed(condition: Column) -> tuple[float, int]:
            best, hits = float("inf"), 0
            for _ in range(2):
                began = time.perf_counter()
                hits = sample.agg(F.count_if(condition)).first()[0]
                best = min(best, time.perf_counter() - began)
            return best, hits

        if not rows:
            return [(name, 0.0, 0.0) for name in rules]
        empty = timed(F.lit(False))[0]
        found = []
        for name, condition in rules.items():
            seconds, hits = timed(condition)
            found.append((name, hits / rows, max(seconds - empty, 1e-4) / rows))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda f: -f[1] / f[2])


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule in this order that rejects, else null; later ones are not evaluated."""
    first = F.when(rules[order[0]], order[0])
    for name in order[1:]:
        first = first.when(rules[name], name)
    return first


def judge(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add the metrics, base_failed, and failed_rule, null for what all rules let through."""
    rules = default_rules(text)
    scored = with_metrics(docs.drop("base_failed", "failed_rule"), text)
    sample = with_metrics(sampled(docs.drop("base_failed", "failed_rule"), sample_rows), text).where(~base_failed())
    order = [name for name, _, _ in measured(sample, rules)]
    verdict = F.when(F.col("base_failed"), "base").otherwise(cascade(rules, order))
    return scored.withColumn("base_failed", base_failed()).withColumn("failed_rule", verdict).drop("_words")


def op6_rule_cascade(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select(
        "doc_id", *METRICS, "base_failed", F.col("failed_rule").isNull().alias("kept")
    )


OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), grams AS (
  SELECT r, i, ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] AS g FROM (
    SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS word FROM again) GROUP BY r
), m AS (
  SELECT doc_id, text, ws, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(string_split(text, chr(10))) AS n_lines
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 8 * n_lines
    OR 10 * (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) > 3 * word_chars
    OR 2 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > word_chars
    OR 10 * len(regexp_extract_all(text, '(?:\.\.\.|…)\s*(?:\n|\z)')) > 3 * n_lines) AS kept
FROM b
"""
