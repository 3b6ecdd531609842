"""Exact ratios, means and HALF-UP rounding shared by every operator.

Sums run on decimals or integers (order-independent); one division follows; the quotient goes
through DECIMAL(24,9) before it is rounded, so decimal ties round half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
MICROS_PER_HOUR = 3_600_000_000.0


def rounded(value: Column, digits: int) -> Column:
    return F.round(value.cast("decimal(24,9)"), digits).cast("double")


def per(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    return per(F.sum(value), F.count(value))


def total(value: Column) -> Column:
    return F.sum(value).cast("double")


def rate_percent(flag: Column) -> Column:
    """Share of TRUE among non-NULL flags, in percent."""
    return per(F.sum(flag.cast("int")), F.count(flag)) * 100


def share_percent(condition: Column) -> Column:
    """Share of rows that satisfy the condition; NULL counts as not satisfied."""
    return per(F.count_if(condition), F.count(F.lit(1))) * 100


def days_between(end: Column, start: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / MICROS_PER_DAY


def hours_between(end: Column, start: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / MICROS_PER_HOUR


def mean_days(days: Column) -> Column:
    """Mean of a duration in days, summed as whole microseconds."""
    micros = F.round(days * MICROS_PER_DAY).cast("decimal(20,0)")
    return per(F.sum(micros), F.count(days)) / MICROS_PER_DAY


def month_of(moment: Column) -> Column:
    return F.trunc(moment, "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
