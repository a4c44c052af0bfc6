"""Selection by metric and labels, comparisons and row gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach


def select_metric(samples: DataFrame, name: str) -> DataFrame:
    """One metric; a partition filter when the table is partitioned by ``metric``."""
    return samples.filter(F.col("metric") == name)


def label(labels: str | Column, key: str, default: str = "") -> Column:
    """Label value; an absent label equals the empty string."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    return F.coalesce(labels[key], F.lit(default))


def matches(matchers: Mapping[str, tuple[str, str]], labels: str | Column = "labels") -> Column:
    """Conjunction of ``{label: (op, value)}`` with op one of ``= != =~ !~``.

    Regular expressions must match the whole value.
    """
    out = F.lit(True)
    for key, (op, value) in matchers.items():
        have = label(labels, key)
        if op in ("=", "!="):
            hit = have == value
        elif op in ("=~", "!~"):
            hit = have.rlike(f"^(?:{value})$")
        else:
            raise ValueError(f"unknown matcher {op}")
        out = out & (~hit if op.startswith("!") else hit)
    return out


COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


def keep(df: DataFrame, op: str, limit: float | Column, value: str = "value") -> DataFrame:
    """Comparison as a filter: matching samples keep their value."""
    return df.filter(COMPARE[op](F.col(value), F.lit(limit) if isinstance(limit, (int, float)) else limit))


def static_threshold(df: DataFrame, by: Sequence[str], limit: float) -> DataFrame:
    """Violations of a fixed threshold: count and percent."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value") > limit).alias("violations"),
        (F.try_divide(F.count_if(F.col("value") > limit), F.count("*")) * 100).alias("percent"),
    )


def point_counts(df: DataFrame, by: Sequence[str], minimum: int) -> DataFrame:
    """Rows per series and whether they reach ``minimum``."""
    enough = F.when(F.count("*") >= minimum, "OK").otherwise("NO_DATA")
    return df.groupBy(*by).agg(F.count("*").alias("n"), enough.alias("status"))


def enough_points(df: DataFrame, by: Sequence[str], minimum: int) -> DataFrame:
    """Rows of the series with at least ``minimum`` rows."""
    good = point_counts(df, by, minimum).filter("status = 'OK'").select(*by)
    return attach(df, good, by)
