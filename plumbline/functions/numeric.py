"""Rounding and ratios that give the same doubles in every engine that follows IEEE 754."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_n(value: Column | str, digits: int) -> Column:
    """Half-up rounding of doubles at ``digits`` decimals: floor(v * 10^n + 0.5) / 10^n.

    The same few operations in plain SQL give the same bits, which ``round`` of two engines doesn't.
    """
    v = F.col(value) if isinstance(value, str) else value
    scale = float(10**digits)
    return F.floor(v.cast("double") * scale + 0.5).cast("double") / F.lit(scale)


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """``top / bottom`` in doubles, rounded; null where the bottom is null or 0."""
    b = bottom.cast("double")
    return F.when(b != 0, round_n(top.cast("double") / b, digits))


def money(value: Column | str) -> Column:
    """A score of two decimals as an exact number, so that sums don't depend on their order."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")


def exact_sum(value: Column | str) -> Column:
    """The sum of two-decimal scores, added exactly, as a double."""
    return F.sum(money(value)).cast("double")


def stable_mean(value: Column | str, digits: int = 6) -> Column:
    """The mean of doubles taken at ``digits`` decimals: whole numbers are added, so the order doesn't matter."""
    v = F.col(value) if isinstance(value, str) else value
    scale = float(10**digits)
    return F.sum(F.floor(v * scale + 0.5)).cast("double") / F.count(v).cast("double") / F.lit(scale)
