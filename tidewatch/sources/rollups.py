"""Metrics made from raw events: counters, gauges, histograms, summaries, info.

Events are reduced to one row per label set and scrape interval with map-side
aggregation. What follows runs over those rows only, whose number per series is
the number of scrape intervals, whatever the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import attach
from tidewatch.model import from_micros, micros, span_us


def scrape_time(every: timedelta, ts: str = "ts") -> Column:
    """End of the scrape interval a time falls in."""
    us = micros(ts)
    return from_micros(us + F.pmod(-us, F.lit(span_us(every))))


def _running(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.sum(c).over(w) for c in columns})


def counter(events: DataFrame, by: Sequence[str], every: timedelta, amount: Column | None = None) -> DataFrame:
    """Counter incremented by each event, as seen at each scrape that changed it."""
    step = F.count("*").cast("double") if amount is None else F.sum(amount)
    rows = events.withColumn("ts", scrape_time(every)).groupBy(*by, "ts").agg(step.alias("value"))
    return _running(rows, by, ["value"])


def gauge(events: DataFrame, by: Sequence[str], every: timedelta, value: str = "value") -> DataFrame:
    """Last value set before each scrape."""
    return (
        events.withColumn("_t", scrape_time(every))
        .groupBy(*by, "_t")
        .agg(F.max_by(value, F.struct("ts", value)).alias("value"))
        .withColumnRenamed("_t", "ts")
    )


def histogram(
    events: DataFrame, by: Sequence[str], every: timedelta, bounds: Sequence[float], value: str = "value",
    running: bool = True,
) -> DataFrame:
    """Cumulative ``le`` buckets per scrape, as rows; ``running`` adds up over time.

    All bounds are counted in one aggregation; no event is copied per bound.
    """
    bounds = sorted(set(bounds) | {float("inf")})
    rows = (
        events.withColumn("ts", scrape_time(every))
        .groupBy(*by, "ts")
        .agg(
            *[F.count_if(F.col(value) <= b).cast("double").alias(f"_b{i}") for i, b in enumerate(bounds)],
            F.sum(value).alias("sum"),
        )
    )
    names = [f"_b{i}" for i in range(len(bounds))]
    if running:
        rows = _running(rows, by, [*names, "sum"])
    entries = [F.struct(F.lit(b).alias("le"), F.col(n).alias("value")) for b, n in zip(bounds, names)]
    return rows.select(*by, "ts", "sum", F.explode(F.array(*entries)).alias("_e")).select(
        *by, "ts", "_e.le", "_e.value", "sum"
    )


def summary(events: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Count and sum of observations per label set."""
    return events.groupBy(*by).agg(F.count(value).alias("count"), F.sum(value).alias("sum"))


def with_info(samples: DataFrame, info: DataFrame, on: Sequence[str]) -> DataFrame:
    """Constant labels of an info metric joined to the samples of the same target."""
    return attach(samples, info, on, how="left")


def with_targets(samples: DataFrame, targets: DataFrame, on: Sequence[str] = ("instance",)) -> DataFrame:
    """Job and scrape interval of the target each sample came from."""
    return attach(samples, targets, on)
