"""Rounding, clipping and time distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(column: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back, all in double."""
    scale = float(10**digits)
    return F.rint(column * F.lit(scale)) / F.lit(scale)


def not_below_zero(column: Column) -> Column:
    """Clip at zero, keeping null (``greatest`` would replace it)."""
    return F.when(column < 0, F.lit(0.0)).otherwise(column)


def hours_between(later: Column, earlier: Column) -> Column:
    """Hours with fractions, down to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def midnight(date_text: Column) -> Column:
    return F.to_timestamp(date_text, "yyyy-MM-dd")

