"""Algebra of instant vectors: aggregation, matching, ratios, defaults."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.model import match_key

AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "max": F.max, "min": F.min}


def aggregate(
    vector: DataFrame, ops: Sequence[str], by: Sequence[str] = (), at: Sequence[str] = ("eval_ts",), value: str = "value"
) -> DataFrame:
    """``sum | avg | count | max | min`` over series, keeping the labels in ``by``."""
    return vector.groupBy(*by, *at).agg(*[AGGREGATES[op](value).alias(op) for op in ops])


def topk(vector: DataFrame, k: int, order: Sequence[Column], at: Sequence[str] = ("eval_ts",)) -> DataFrame:
    """First ``k`` rows of each group by ``order``; cut per partition before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*at).orderBy(*order))
    return vector.withColumn("rank", rank).filter(F.col("rank") <= k)


def divide(left: DataFrame, right: DataFrame, at: Sequence[str] = ()) -> DataFrame:
    """One-to-one division of series with identical label sets."""
    a = left.select(match_key("labels").alias("_key"), "labels", *at, F.col("value").alias("_a"))
    b = right.select(match_key("labels").alias("_key"), *at, F.col("value").alias("_b"))
    return a.join(b, ["_key", *at]).select("labels", *at, F.try_divide("_a", "_b").alias("value"))


def used_percent(available: DataFrame, total: DataFrame, at: Sequence[str] = ()) -> DataFrame:
    """``(1 - available / total) * 100`` per label set."""
    return divide(available, total, at).withColumn("value", (1 - F.col("value")) * 100)


def ratio_of_sums(vector: DataFrame, part: Column, by: Sequence[str] = (), at: Sequence[str] = ("eval_ts",), value: str = "value") -> DataFrame:
    """Sum of the series selected by ``part`` over the sum of all, in one pass."""
    chosen = F.sum(F.when(part, F.col(value)))
    return vector.groupBy(*by, *at).agg(F.try_divide(chosen, F.sum(value)).alias("ratio"))


def busy_percent(idle_rates: DataFrame, by: Sequence[str] = (), at: Sequence[str] = ("eval_ts",), value: str = "rate") -> DataFrame:
    """``100 - avg(rate of idle) * 100``."""
    return idle_rates.groupBy(*by, *at).agg((100 - F.avg(value) * 100).alias("busy"))


def steps(spark, start: datetime, end: datetime, step: timedelta) -> DataFrame:
    """Evaluation times from ``start`` to ``end``; their number does not depend on the data."""
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.lit(step))).alias("eval_ts"))


def or_default(vector: DataFrame, grid: DataFrame, default: float = 0.0, value: str = "value") -> DataFrame:
    """Vector without labels on every step, ``default`` where it is empty."""
    return grid.join(vector, "eval_ts", "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def cardinality(samples: DataFrame, series: Sequence[str], by: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of series per metric; duplicates are removed map-side first."""
    if approximate:
        return samples.groupBy(*by).agg(F.approx_count_distinct(F.xxhash64(*series)).alias("series_count"))
    return samples.select(*by, *[c for c in series if c not in by]).distinct().groupBy(*by).agg(
        F.count("*").alias("series_count")
    )
