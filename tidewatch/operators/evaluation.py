"""Hold-out evaluation and comparison of forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach, join_keys, number_rows
from tidewatch.model import micros
from tidewatch.operators.linear import fitted_at, linear_fit
from tidewatch.operators.smoothing import final_states, fit_smoothing


def split_now(forecast: DataFrame, history: DataFrame, by: Sequence[str]) -> DataFrame:
    """Forecast rows marked as history (up to the last actual sample) or future."""
    now = history.groupBy(*by).agg(F.max("ts").alias("_now"))
    return attach(forecast, now, by).withColumn("is_future", F.col("ts") > F.col("_now")).drop("_now")


def with_actuals(forecast: DataFrame, actual: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on series and time; both sides have one row per time."""
    return join_keys(forecast, actual.select(*by, "ts", "value"), [*by, "ts"])


def interval_anomalies(rows: DataFrame) -> DataFrame:
    """Values outside ``[yhat_lower, yhat_upper]``."""
    outside = (F.col("value") > F.col("yhat_upper")) | (F.col("value") < F.col("yhat_lower"))
    return rows.withColumn("is_anomaly", outside)


def holdout(df: DataFrame, by: Sequence[str], order: Sequence[str] = ("ts",), share: int = 5) -> tuple[DataFrame, DataFrame]:
    """Training rows and the last ``n // share`` rows; ``h`` counts the test rows from 1."""
    rows = number_rows(df, by, order, n="_n")
    cut = F.col("_n") - F.floor(F.col("_n") / share)
    rows = rows.withColumn("h", F.col("rn") - cut)
    return rows.filter("h <= 0").drop("_n", "rn", "h"), rows.filter("h > 0").drop("_n", "rn")


def errors(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAE, MAPE (rows with a zero actual left out) and RMSE."""
    miss = F.col("value") - F.col("yhat")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(miss)).alias("mae"),
        (F.avg(F.abs(F.try_divide(miss, F.col("value")))) * 100).alias("mape"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
    )


def linear_holdout(train: DataFrame, test: DataFrame, by: Sequence[str]) -> DataFrame:
    rows = attach(test, linear_fit(train, by).select(*by, "slope", "intercept", "first_ts"), by)
    return rows.withColumn("yhat", fitted_at(micros("ts")))


def smoothing_holdout(
    train: DataFrame, test: DataFrame, by: Sequence[str], m: int = 1, multiplicative: bool = False,
    params: tuple[float, float, float] | None = None,
) -> DataFrame:
    """Forecast of each test row from the states after the training rows; fitted when ``params`` is None."""
    if params:
        states = final_states(train, by, *params, m=m, multiplicative=multiplicative)
    else:
        states = fit_smoothing(train, by, m, multiplicative)
    rows = attach(test, states.select(*by, "n", "level", "trend", "season"), by)
    season = F.get("season", F.pmod(F.col("n") + F.col("h") - 1, F.lit(m)).cast("int"))
    line = F.col("level") + F.col("h") * F.col("trend")
    return rows.withColumn("yhat", line * season if multiplicative else line + season).drop("season")


def best_method(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Method of least MAPE per series from rows of ``method`` and ``errors``."""
    return scores.groupBy(*by).agg(
        F.min_by("method", F.struct("mape", "method")).alias("method"), F.min("mape").alias("mape")
    )
