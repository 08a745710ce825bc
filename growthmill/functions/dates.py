"""Calendar arithmetic with weeks that start on Sunday."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start_sunday(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_of_year_sunday(day: Column) -> Column:
    """0..53; days before the first Sunday of the year are in week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def hours_between(start: Column, end: Column) -> Column:
    """Whole elapsed hours from ``start`` to ``end``."""
    return F.timestamp_diff("HOUR", start, end)


def in_days(moment: Column, start: date, end: date) -> Column:
    """From the beginning of day ``start`` to the end of day ``end``, for a date or a timestamp; prunes partitions."""
    return (moment >= F.lit(start)) & (moment < F.date_add(F.lit(end), 1))
