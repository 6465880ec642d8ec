"""Time buckets and ratios that never abort a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hour_bucket(moment: Column) -> Column:
    return F.date_trunc("hour", moment)


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment).cast("bigint")


def day_of_week(moment: Column) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(moment) - 1).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def second_boundaries(start: Column, end: Column) -> Column:
    """Number of whole-second marks crossed between two instants."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def correlation(covariance: Column, variance_x: Column, variance_y: Column) -> Column:
    """Pearson r from a covariance and two variances; null for a constant series."""
    return F.try_divide(covariance, F.sqrt(variance_x) * F.sqrt(variance_y))
