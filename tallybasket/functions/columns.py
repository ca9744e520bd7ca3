"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def nan_to_null(c: Column) -> Column:
    """Missing numbers are NULL throughout: in Spark NaN is greater than every number."""
    return F.when(~F.isnan(c), c)


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down also below zero."""
    gap = F.unix_micros(later) - F.unix_micros(earlier)
    return ((gap - F.pmod(gap, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("long")


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def half_even(c: Column, digits: int = 2) -> Column:
    return F.bround(c, digits)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """ISO date or date-time text; ``strict`` raises on bad text, otherwise it gives NULL."""
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def squared_distance(points: Sequence[Column], centre: Sequence[Column | float]) -> Column:
    total = None
    for x, c in zip(points, centre, strict=True):
        gap = x - (c if isinstance(c, Column) else F.lit(float(c)))
        total = gap * gap if total is None else total + gap * gap
    return total


def standardized(c: Column, mean: Column | float, scale: Column | float) -> Column:
    """(x - mean) / scale; a constant feature has scale 0 and is only centred."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    mean = mean if isinstance(mean, Column) else F.lit(float(mean))
    return (c - mean) / F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def one_decimal(c: Column) -> Column:
    return F.format_string("%.1f", c)


def whole_dollars(c: Column) -> Column:
    return F.format_number(c, 0)
