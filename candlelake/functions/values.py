"""Null-safe arithmetic and display text of measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trend colours and the amount invested in the growth report.
COLOR_UP = "#039520"
COLOR_DOWN = "#DD0012"
MONEY_INVESTED = 10000


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth(last: Column, first: Column) -> Column:
    return ratio(last - first, first)


def growth_text(value: Column) -> Column:
    """Signed percent with two decimals; a blank value gives empty text."""
    pct = F.round(value * 100, 2).cast("decimal(18,2)")
    sign = F.when(pct > 0, F.lit("+")).otherwise(F.lit(""))
    return F.coalesce(F.concat(sign, pct.cast("string"), F.lit("%")), F.lit(""))


def investment_growth(value: Column) -> Column:
    """Worth of the invested amount; blank growth counts as none."""
    return F.lit(MONEY_INVESTED) * (1 + F.coalesce(value, F.lit(0.0)))


def is_up(last: Column, first: Column) -> Column:
    """Blank prices act as zero, so a series without data counts as up."""
    zero = F.lit(0).cast("decimal(18,3)")
    return F.coalesce(last, zero) >= F.coalesce(first, zero)


def trend_color(last: Column, first: Column) -> Column:
    return F.when(is_up(last, first), F.lit(COLOR_UP)).otherwise(F.lit(COLOR_DOWN))

