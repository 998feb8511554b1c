"""Metric scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairprep.functions.text import as_column

# Doubles from here on are whole numbers.
_WHOLE_FROM = 2.0**53
_LIMB = 10**9


def perplexity(loss: Column | str) -> Column:
    """exp(loss); Spark already gives infinity on overflow and null on null."""
    return F.exp(as_column(loss))


def _times(limbs: Column, factor: Column) -> Column:
    """A number in limbs of nine digits, lowest first, times a factor below 2**30."""
    form = "struct<carry:bigint,done:array<bigint>>"

    def step(s: Column, limb: Column) -> Column:
        product = limb * factor + s["carry"]
        low = F.array_append(s["done"], product % _LIMB)
        return F.struct(_div(product, _LIMB).alias("carry"), low.alias("done")).cast(form)

    start = F.struct(F.lit(0).alias("carry"), F.array().alias("done")).cast(form)
    return F.aggregate(limbs, start, step, lambda s: F.array_append(s["done"], s["carry"]))


def _whole_digits(size: Column) -> Column:
    """All digits of a whole double: its significand in limbs, doubled as often as needed."""
    shift = F.greatest(F.floor(F.log2(size)).cast("int") - 53, F.lit(0))
    significand = (size / F.pow(F.lit(2.0), shift)).cast("long")
    limbs = F.array(significand % _LIMB, _div(significand, _LIMB) % _LIMB, _div(significand, _LIMB**2))
    power = lambda n: F.pow(F.lit(2.0), n).cast("long")
    rounds = F.sequence(F.lit(0), F.floor(shift / 29).cast("int"))
    last = F.floor(shift / 29).cast("int")
    factor = lambda i: F.when(i < last, F.lit(2**29).cast("long")).otherwise(power(shift % 29))
    grown = F.aggregate(rounds, limbs, lambda held, i: _times(held, factor(i)))
    padded = F.transform(F.reverse(grown), lambda x: F.lpad(x.cast("string"), 9, "0"))
    return F.ltrim(F.array_join(padded, ""), F.lit("0"))


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("long"))


def fixed4(value: Column | str) -> Column:
    """Four decimals, rounded on the exact binary value with ties to even.

    Java's formatters round the shortest decimal form instead, so 2.00005 or 1.03125 would
    come out one unit higher. The fraction times 10000 is split into a rounded product and its
    exact error. Doubles without a fraction are written with all their digits.
    """
    x = as_column(value)
    size = F.abs(x)
    whole = F.floor(size)
    part = size - whole
    product = part * F.lit(10000.0)
    scaled = part * F.lit(134217729.0)
    high = scaled - (scaled - part)
    error = (high * F.lit(10000.0) - product) + (part - high) * F.lit(10000.0)
    below = F.floor(product)
    over_half = (product - below) - F.lit(0.5)
    up = (over_half > 0) | ((over_half == 0) & ((error > 0) | ((error == 0) & (below % 2 == 1))))
    units = below + F.when(up, 1).otherwise(0)
    negative = F.format_string("%.1f", x).startswith("-")
    exact = F.concat(
        F.when(negative, "-").otherwise(""),
        (whole + F.floor(units / 10000)).cast("string"),
        F.lit("."),
        F.lpad((units % 10000).cast("string"), 4, "0"),
    )
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), "nan")
        .when(x == float("inf"), "inf")
        .when(x == float("-inf"), "-inf")
        .when(size < _WHOLE_FROM, exact)
        .otherwise(F.concat(F.when(negative, "-").otherwise(""), _whole_digits(size), F.lit(".0000")))
    )


def format_log(step: Column | str, logs: Column | str) -> Column:
    """`Step n: k=v, k=v` with four decimals; null when there is nothing to show."""
    items = F.transform(
        F.map_entries(as_column(logs)),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(fixed4(e["value"]), F.lit("None"))),
    )
    line = F.concat(
        F.lit("Step "), as_column(step).cast("string"), F.lit(": "), F.array_join(items, ", ")
    )
    return F.when(F.size(as_column(logs)) > 0, line)
