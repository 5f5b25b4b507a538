"""Rounding and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2**27 + 1)


def rounded(value: Column) -> Column:
    """Round a double to two decimals, half to even on its exact binary value.

    ``round`` and ``bround`` decide ties on the shortest decimal form, so they
    turn 0.075 (stored as 0.07499...) into 0.08. Reports need 0.07.
    The tie test below is exact: the value is split into two short halves whose
    products with 200 carry no rounding error.

    The one-element arrays bind each step once, as nested columns would repeat
    the value in every place that uses it.
    """

    def split(number: Column) -> Column:
        size = F.abs(number)
        scaled = size * _SPLIT
        return F.struct(
            F.when(number < 0, -1.0).otherwise(1.0).alias("sign"),
            F.floor(size * 100).cast("double").alias("cents"),
            size.alias("size"),
            (scaled - (scaled - size)).alias("high"),
        )

    def decide(parts: Column) -> Column:
        cents, high = parts["cents"], parts["high"]
        above = (high * 200 - (cents * 2 + 1)) + (parts["size"] - high) * 200
        up = (above > 0) | ((above == 0) & (cents % 2 == 1))
        return parts["sign"] * F.when(up, cents + 1).otherwise(cents) / 100

    bound = F.transform(F.array(value), split)
    return F.get(F.transform(bound, decide), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Share in per cent, two decimals."""
    return rounded(ratio(part, whole) * 100)
