"""Unit and time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def megabytes(value: Column) -> Column:
    return value / 1024 / 1024


def per_hour(per_second: Column) -> Column:
    return per_second * 3600


def per_day(per_second: Column) -> Column:
    return per_second * 86400


def days(hours: Column) -> Column:
    return hours / 24


def seconds_since(ts: Column, origin: Column) -> Column:
    return (F.unix_micros(ts) - F.unix_micros(origin)) / F.lit(1e6)


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
