"""Stream building blocks: complete ticks from single-metric samples, sliding statistics.

All functions work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_stats(samples: DataFrame, by: Sequence[str], length: str, slide: str, delay: str | None = None) -> DataFrame:
    """Mean, maximum and count over sliding windows; give ``delay`` on streams."""
    rows = samples.withWatermark("ts", delay) if delay else samples
    return (
        rows.groupBy(*by, F.window("ts", length, slide))
        .agg(F.avg("value").alias("avg"), F.max("value").alias("max"), F.count("*").alias("n"))
        .select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "avg", "max", "n")
    )


def ticks(
    samples: DataFrame, metrics: Sequence[str], every: str, metric: str = "metric", scope: str | None = None,
    delay: str | None = None, complete: bool = True,
) -> DataFrame:
    """One row per interval with the last value of every metric; incomplete ticks are left out."""
    rows = samples.withWatermark("ts", delay) if delay else samples
    keys = [F.col(scope).alias("scope") if scope else F.lit("all").alias("scope"), F.window("ts", every)]
    last = [F.max_by(F.when(F.col(metric) == m, F.col("value")), F.when(F.col(metric) == m, F.col("ts"))).alias(m) for m in metrics]
    out = rows.filter(F.col(metric).isin(list(metrics))).groupBy(*keys).agg(*last)
    if complete:
        present = F.lit(True)
        for m in metrics:
            present = present & F.col(m).isNotNull()
        out = out.filter(present)
    return out.select("scope", F.col("window.start").alias("tick_start"), F.col("window.end").alias("tick"), *metrics)
