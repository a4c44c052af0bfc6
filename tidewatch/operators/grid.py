"""Step alignment: as-of values on a grid, regular frequency, wide frames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import attach, join_keys, number_rows
from tidewatch.model import from_micros, micros, point_us, span_us


def asof_grid(
    samples: DataFrame,
    by: Sequence[str],
    step: timedelta,
    lookback: timedelta = timedelta(minutes=5),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Value at each step: the latest sample in ``(t - lookback, t]``.

    The latest sample of every step is taken first with partial aggregation;
    only those are offered to the later steps that may still see them.
    """
    step, lookback = span_us(step), span_us(lookback)
    us = F.col("_us")
    latest = (
        samples.select(*by, micros("ts").alias("_us"), "value")
        .withColumn("_p", us + F.pmod(-us, F.lit(step)))
        .groupBy(*by, "_p")
        .agg(F.max("_us").alias("_lu"), F.max_by("value", F.struct("_us", "value")).alias("_lv"))
    )
    reach = F.col("_lu") + (lookback - 1)
    first, last = F.col("_p"), reach - F.pmod(reach, F.lit(step))
    if start is not None:
        first = F.greatest(first, F.lit(-(-point_us(start) // step) * step))
    if end is not None:
        last = F.least(last, F.lit(point_us(end) // step * step))
    return (
        latest.withColumn("_t", F.explode(F.when(first <= last, F.sequence(first, last, F.lit(step)))))
        .groupBy(*by, "_t")
        .agg(F.max_by("_lv", F.struct("_lu", "_lv")).alias("value"))
        .select(*by, from_micros("_t").alias("eval_ts"), "value")
    )


def instant(
    samples: DataFrame, by: Sequence[str], at: datetime, lookback: timedelta = timedelta(minutes=5)
) -> DataFrame:
    """Latest value per series in ``(at - lookback, at]``; one partial aggregation."""
    us, t = micros("ts"), point_us(at)
    return (
        samples.filter((us <= t) & (us > t - span_us(lookback)))
        .groupBy(*by)
        .agg(F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts"))
    )


def fill_gaps(points: DataFrame, by: Sequence[str], index: str, values: Sequence[str]) -> DataFrame:
    """Repeat each point at the integer positions up to the next one.

    ``points`` has one row per grid position, so a key's window holds at most
    as many rows as its grid has positions, whatever the number of samples.
    """
    nxt = F.lead(index).over(Window.partitionBy(*by).orderBy(index))
    until = F.coalesce(nxt - 1, F.col(index))
    return (
        points.withColumn("_until", until)
        .select(*by, F.explode(F.sequence(F.col(index), F.col("_until"))).alias("_k"), *values)
        .withColumnRenamed("_k", index)
    )


def regularize(samples: DataFrame, by: Sequence[str], every: timedelta) -> DataFrame:
    """Fixed frequency from each series' first sample on, last value carried forward."""
    width = span_us(every)
    bounds = samples.groupBy(*by).agg(F.min(micros("ts")).alias("_from"), F.max(micros("ts")).alias("_to"))
    rows = attach(samples.select(*by, micros("ts").alias("_us"), "value"), bounds, by)
    since = F.col("_us") - F.col("_from")
    slot = F.floor((since + (width - 1)) / F.lit(width))
    points = (
        rows.withColumn("k", F.when(slot * width <= F.col("_to") - F.col("_from"), slot))
        .filter("k IS NOT NULL")
        .groupBy(*by, "k")
        .agg(
            F.max_by("value", F.struct("_us", "value")).alias("value"),
            F.min("_from").alias("_from"),
            F.floor((F.max("_to") - F.max("_from")) / F.lit(width)).alias("_kmax"),
        )
    )
    nxt = F.lead("k").over(Window.partitionBy(*by).orderBy("k"))
    return (
        points.withColumn("_until", F.coalesce(nxt - 1, F.col("_kmax")))
        .withColumn("k", F.explode(F.sequence("k", "_until")))
        .select(*by, from_micros(F.col("_from") + F.col("k") * width).alias("ts"), "value", "k")
    )


def complete_grid(points: DataFrame, by: Sequence[str], every: timedelta) -> DataFrame:
    """All steps between a series' first and last point; missing ones have a NULL value."""
    width = span_us(every)
    steps = (
        points.groupBy(*by)
        .agg(F.min(micros("ts")).alias("_a"), F.max(micros("ts")).alias("_b"))
        .select(*by, F.explode(F.sequence("_a", "_b", F.lit(width))).alias("_us"))
        .select(*by, from_micros("_us").alias("ts"))
    )
    return join_keys(steps, points, [*by, "ts"], "left")


def wide(points: DataFrame, at: str, metric: str, names: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """One column per metric, rows aligned on ``at``; one pass over one scan."""
    return points.groupBy(*scope, at).pivot(metric, list(names)).agg(F.first("value"))


def complete_cases(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the ticks at which every metric is present."""
    return frame.na.drop(subset=list(names))


def align_positional(points: DataFrame, metric: str, names: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pair the i-th samples of all metrics, cut to the shortest (parity mode only)."""
    ranked = number_rows(points.filter(F.col(metric).isin(list(names))), [metric], order, rn="pos")
    return ranked.groupBy("pos").pivot(metric, list(names)).agg(F.first("value")).na.drop(subset=list(names))
