"""Additive decomposition into trend, season and residual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import BLOCK_ROWS, attach, join_keys, number_rows, windowed

LONGEST = 24


def _trend_by_window(df, by, order, period: int, block_rows: int) -> DataFrame:
    half = period // 2

    def columns(w):
        frame = w.rowsBetween(-half, half)
        total, full = F.sum("value").over(frame), F.count("value").over(frame) == 2 * half + 1
        if period % 2 == 0:
            total = total - (F.lag("value", half).over(w) + F.lead("value", half).over(w)) / 2
        return {"trend": F.when(full, total / period)}

    rows = windowed(df, by, order, columns, before=half, after=half, block_rows=block_rows)
    return rows.withColumn("period", F.lit(period))


def _trend_by_parts(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For short series, each with a period of its own: a row adds to the means about it."""
    half, even = F.floor(F.col("period") / 2), F.col("period") % 2 == 0
    parts = (
        rows.withColumn("_d", F.explode(F.sequence(-half, half)))
        .withColumn("_w", F.when(even & (F.abs("_d") == half), 0.5).otherwise(1.0))
        .groupBy(*by, (F.col("rn") + F.col("_d")).alias("rn"))
        .agg(F.sum(F.col("value") * F.col("_w")).alias("_s"), F.count("value").alias("_c"))
    )
    full = F.col("_c") == 2 * half + 1
    return (
        join_keys(rows, parts, [*by, "rn"], "left")
        .withColumn("trend", F.when(full, F.col("_s") / F.col("period")))
        .drop("_s", "_c")
    )


def seasonal_decompose(
    df: DataFrame, by: Sequence[str], order: Sequence[str] = ("ts",), period: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Columns ``trend``, ``seasonal``, ``residual`` and ``period`` of regular series.

    Without a period: ``min(24, n // 3)`` per series, at least 4. Series long
    enough for 24 use block windows; the others have fewer than 72 rows each.
    """
    if period:
        rows = _trend_by_window(df, by, order, period, block_rows)
    else:
        sizes = df.groupBy(*by).agg(F.count("*").alias("_size"))
        sized = attach(df, sizes, by)
        columns = [*df.columns, "rn", "n_rows", "period", "trend"]
        long = _trend_by_window(sized.filter(F.col("_size") >= 3 * LONGEST), by, order, LONGEST, block_rows)
        short = number_rows(sized.filter(F.col("_size") < 3 * LONGEST), by, order, n="n_rows").withColumn(
            "period", F.floor(F.col("n_rows") / 3).cast("int")
        )
        short = _trend_by_parts(short.filter("period >= 4"), by, order)
        rows = long.select(*columns).unionByName(short.select(*columns))
    rows = rows.withColumn("phase", F.pmod(F.col("rn") - 1, F.col("period")))
    # one row per series and phase
    phases = rows.groupBy(*by, "phase").agg(F.avg(F.col("value") - F.col("trend")).alias("_raw"))
    centre = phases.groupBy(*by).agg(F.avg("_raw").alias("_centre"))
    season = join_keys(phases, centre, by).select(*by, "phase", (F.col("_raw") - F.col("_centre")).alias("seasonal"))
    return attach(rows, season, [*by, "phase"]).withColumn(
        "residual", F.col("value") - F.col("trend") - F.col("seasonal")
    )


def component_summary(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Trend range, seasonal amplitude and residual deviation."""
    return parts.groupBy(*by).agg(
        F.max("period").alias("period"),
        F.min("trend").alias("trend_min"),
        F.max("trend").alias("trend_max"),
        (F.max("seasonal") - F.min("seasonal")).alias("amplitude"),
        F.stddev_samp("residual").alias("residual_std"),
    )
