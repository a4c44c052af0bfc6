"""Least-squares trend per series and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach
from tidewatch.model import from_micros, micros, span_us

LAST_SECOND = 253_402_300_799


def linear_fit(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """One aggregation per series: slope per second, intercept at the first sample, R², residual RMSE.

    The moments are merged from partial results, so the size of a series does
    not matter. Seconds count from the first sample.
    """
    us = micros("ts")
    x = us / F.lit(1e6)
    y = F.col(value)
    known = df.filter(y.isNotNull())
    r2 = F.regr_r2(y, x)
    out = known.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.avg(x).alias("_ax"),
        F.avg(y).alias("_ay"),
        r2.alias("r2"),
        F.sqrt(F.var_pop(y) * F.greatest(1 - r2, F.lit(0.0))).alias("rmse"),
        F.min(us).alias("_first"),
        F.max(us).alias("_last"),
        F.max_by(y, F.struct(us.alias("t"), (F.col(y) if isinstance(y, str) else y).alias("y"))).alias("last_value"),
    )
    return out.select(
        *by,
        "n",
        "slope",
        (F.col("_ay") - F.col("slope") * (F.col("_ax") - F.col("_first") / F.lit(1e6))).alias("intercept"),
        "r2",
        "rmse",
        "last_value",
        from_micros("_first").alias("first_ts"),
        from_micros("_last").alias("last_ts"),
    )


def fitted_at(us: Column) -> Column:
    """Value of the line at a time, from the columns of ``linear_fit``."""
    return F.col("intercept") + F.col("slope") * (us - micros("first_ts")) / F.lit(1e6)


def future_grid(fits: DataFrame, by: Sequence[str], horizon: timedelta, step: timedelta, first: int = 0) -> DataFrame:
    """Future times of each series from its ``last_ts`` on; the end is left out."""
    count = span_us(horizon) // span_us(step)
    steps = F.explode(F.sequence(F.lit(first), F.lit(first + count - 1)))
    rows = fits.withColumn("h", steps)
    return rows.withColumn("ts", from_micros(micros("last_ts") + F.col("h").cast("bigint") * span_us(step)))


def linear_forecast(
    df: DataFrame, by: Sequence[str], horizon: timedelta = timedelta(minutes=120), step: timedelta = timedelta(seconds=30),
    k: float = 2.0, minimum: int = 10,
) -> DataFrame:
    """Line carried on from the last sample, whose time is the first row; band of ``k`` RMSE."""
    fits = linear_fit(df, by).filter(F.col("n") > minimum)
    rows = future_grid(fits, by, horizon, step)
    yhat = fitted_at(micros("ts"))
    return rows.select(
        *by, "ts", yhat.alias("yhat"), (yhat - k * F.col("rmse")).alias("yhat_lower"), (yhat + k * F.col("rmse")).alias("yhat_upper")
    )


def in_sample(df: DataFrame, by: Sequence[str], k: float = 1.96) -> DataFrame:
    """Actual values beside the fitted line and its interval."""
    fits = linear_fit(df, by).select(*by, "slope", "intercept", "rmse", "first_ts")
    rows = attach(df, fits, by)
    yhat = fitted_at(micros("ts"))
    return rows.withColumns(
        {"yhat": yhat, "yhat_lower": yhat - k * F.col("rmse"), "yhat_upper": yhat + k * F.col("rmse")}
    ).drop("slope", "intercept", "rmse", "first_ts")


def time_to_limit(fits: DataFrame, limit: float | Column, value: str = "last_value") -> Column:
    """Seconds until a rising line from the last value meets ``limit``; NULL when it does not."""
    limit = F.lit(float(limit)) if isinstance(limit, (int, float)) else limit
    seconds = F.try_divide(limit - F.col(value), F.when(F.col("slope") > 0, F.col("slope")))
    return F.when(seconds > 0, seconds)


def time_to_threshold(fits: DataFrame, limit: float | Column) -> DataFrame:
    seconds = time_to_limit(fits, limit)
    whole = F.floor(micros("last_ts") / F.lit(1e6) + seconds)
    # a breach past the last year a timestamp can show has no time
    breach = F.when(whole < LAST_SECOND, F.timestamp_seconds(whole))
    return fits.withColumns({"hours_to_limit": seconds / 3600, "breach_ts": breach})


def fit_quality(fits: DataFrame, poor: float = 0.3, good: float = 0.8) -> DataFrame:
    grade = F.when(F.col("r2") < poor, "poor").when(F.col("r2") > good, "good").otherwise("fair")
    return fits.withColumn("quality", grade)


def first_breach(forecast: DataFrame, by: Sequence[str], limit: float, now: str | None = None) -> DataFrame:
    """First row whose upper edge passes ``limit``, minutes until then, and the largest upper edge."""
    over = F.col("yhat_upper") > limit
    return forecast.groupBy(*by).agg(
        F.min(F.when(over, F.col("ts"))).alias("breach_ts"),
        ((F.min(F.when(over, micros("ts"))) - F.min(micros("ts"))) / F.lit(6e7)).alias("minutes_until"),
        F.max("yhat_upper").alias("max_upper"),
    )
