"""Reading samples: tables by metric and date, range and instant reads, wide frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.grid import asof_grid, instant, wide
from tidewatch.operators.selectors import matches

FIVE_MINUTES = timedelta(minutes=5)


def write_samples(samples: DataFrame, path: str, mode: str = "append") -> None:
    """Sample table partitioned by metric and date, so both prune the scan."""
    dated = samples.withColumn("date", F.to_date("ts"))
    dated.write.mode(mode).partitionBy("metric", "date").parquet(path)


def read_samples(
    spark: SparkSession, path: str, metrics: Sequence[str] = (), start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Sample table cut to metrics and time; partition and row-group filters are pushed down."""
    out = spark.read.parquet(path)
    if metrics:
        out = out.filter(F.col("metric").isin(list(metrics)))
    if start is not None:
        out = out.filter((F.col("date") >= F.lit(start).cast("date")) & (F.col("ts") >= F.lit(start)))
    if end is not None:
        out = out.filter((F.col("date") <= F.lit(end).cast("date")) & (F.col("ts") <= F.lit(end)))
    return out.drop("date")


def range_read(
    samples: DataFrame,
    metric: str,
    by: Sequence[str],
    start: datetime,
    end: datetime,
    step: timedelta = timedelta(seconds=15),
    lookback: timedelta = FIVE_MINUTES,
    matchers: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One value per step and series between ``start`` and ``end``."""
    rows = samples.filter(
        (F.col("metric") == metric) & (F.col("ts") > F.lit(start - lookback)) & (F.col("ts") <= F.lit(end))
    )
    if matchers:
        rows = rows.filter(matches(matchers))
    return asof_grid(rows, by, step, lookback, start, end)


def instant_read(
    samples: DataFrame, metric: str, by: Sequence[str], at: datetime, lookback: timedelta = FIVE_MINUTES
) -> DataFrame:
    """Latest value per series at one time."""
    return instant(samples.filter(F.col("metric") == metric), by, at, lookback)


def aligned_read(
    samples: DataFrame, metric: str, names: Sequence[str], start: datetime, end: datetime, step: timedelta,
    lookback: timedelta = FIVE_MINUTES,
) -> DataFrame:
    """Several metrics on one grid, one column each, from a single scan."""
    rows = samples.filter(F.col(metric).isin(list(names)))
    return wide(asof_grid(rows, [metric], step, lookback, start, end), "eval_ts", metric, names)
