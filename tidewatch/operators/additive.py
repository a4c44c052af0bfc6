"""Additive regression: piecewise-linear trend plus Fourier seasons.

The design row is a native array expression; its Gram matrix is summed inside
each partition and then per matrix cell, so neither rows nor series pass
through one task. Only the small normal equations of a series are solved in
Python. The prior is normal (ridge), not Laplace, and the interval is analytic,
so results are near, not equal to, those of a sampling implementation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach, join_keys, number_rows
from tidewatch.model import SEASONS, Seasonality, from_micros, micros, span_us

CHANGEPOINTS = 25
DAY_US = 86_400_000_000
FLUSH = 256


def fourier(us: Column, season: Seasonality) -> list[Column]:
    """sin and cos pairs of a season, time in days since the epoch."""
    angle = 2 * math.pi * us / F.lit(float(DAY_US)) / season.period_days
    return [f(angle * n) for n in range(1, season.order + 1) for f in (F.sin, F.cos)]


def changepoints(df: DataFrame, by: Sequence[str], count: int = CHANGEPOINTS, share: float = 0.8) -> DataFrame:
    """Candidate changepoints: rows at even distances over the first ``share`` of a series."""
    ranked = number_rows(df.select(*by, "ts"), by, ["ts"], n="_n")
    history = F.floor(F.col("_n") * share)
    used = F.least(F.lit(count), history - 1)
    # row i is a candidate when it is the rounded position of some j = 1..used
    index = F.col("rn") - 1
    near = F.floor(index * used / F.when(history > 1, history - 1))
    tries = F.array(*[near + d for d in (-1, 0, 1, 2)])
    at = lambda j: (j >= 1) & (j <= used) & (F.rint(j * (history - 1) / used) == index)
    return ranked.filter((used >= 1) & (index < history) & F.exists(tries, at)).select(*by, "ts")


def _frames(df: DataFrame, by: Sequence[str], count: int) -> DataFrame:
    """Per series: first and last time, scale of y, and the changepoints in scaled time."""
    spans = df.groupBy(*by).agg(
        F.min(micros("ts")).alias("_first"), F.max(micros("ts")).alias("_last"), F.max(F.abs("value")).alias("_scale")
    )
    points = changepoints(df, by, count).groupBy(*by).agg(F.array_sort(F.collect_list(micros("ts"))).alias("_cp"))
    return join_keys(spans, points, by, "left").withColumn(
        "_cp",
        F.transform(
            F.coalesce("_cp", F.array().cast("array<bigint>")),
            lambda c: F.try_divide(c - F.col("_first"), F.col("_last") - F.col("_first")),
        ),
    ).withColumn("_scale", F.when(F.col("_scale") > 0, F.col("_scale")).otherwise(1.0))


def _design(count: int, seasons: Sequence[Seasonality]) -> Column:
    us = micros("ts")
    t = F.coalesce(F.try_divide(us - F.col("_first"), F.col("_last") - F.col("_first")), F.lit(0.0))
    hinges = [F.greatest(t - F.coalesce(F.get("_cp", F.lit(j)), F.lit(1e9)), F.lit(0.0)) for j in range(count)]
    return F.array(F.lit(1.0), t, *hinges, *[c for s in seasons for c in fourier(us, s)])


def fit_additive(
    df: DataFrame, by: Sequence[str], seasons: Sequence[Seasonality] = SEASONS, count: int = CHANGEPOINTS,
    changepoint_prior: float = 0.05, season_prior: float = 10.0, minimum: int = 50,
) -> DataFrame:
    """Coefficients ``_beta``, residual deviation and frame of each series of at least ``minimum`` rows."""
    keys = list(by)
    known = df.filter("value IS NOT NULL").select(*by, "ts", "value")
    frames = _frames(known, by, count)
    width = 2 + count + 2 * sum(s.order for s in seasons)
    rows = attach(known, frames, by).select(*by, _design(count, seasons).alias("_x"), (F.col("value") / F.col("_scale")).alias("_v"))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    head = ", ".join(f"`{c}` {types[c]}" for c in by)
    size = (width + 1) ** 2

    def partial(frames_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def drain():
            out = pd.DataFrame([[*k, v.ravel().tolist()] for k, v in sums.items()], columns=[*keys, "_g"])
            sums.clear()
            return out

        for frame in frames_:
            for key, part in frame.groupby(keys, sort=False):
                x = np.column_stack([np.vstack(part["_x"].to_numpy()), part["_v"].to_numpy()])
                sums[key] = sums.get(key, 0.0) + x.T @ x
            if len(sums) > FLUSH:
                yield drain()
        if sums:
            yield drain()

    cells = (
        rows.mapInPandas(partial, f"{head}, _g array<double>")
        .select(*by, F.posexplode("_g").alias("_i", "_s"))
        .groupBy(*by, "_i")
        .agg(F.sum("_s").alias("_s"))
    )
    grams = cells.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_i", "_s"))).alias("_g")).select(
        *by, F.transform("_g", lambda x: x["_s"]).alias("_g")
    )
    loose = 1e-8
    prior = np.array([5.0, 5.0] + [changepoint_prior] * count + [season_prior] * (width - 2 - count))

    def solve(frames_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_:
            out = []
            for row in frame.to_dict("records"):
                g = np.asarray(row["_g"]).reshape(width + 1, width + 1)
                a, b, yy, n = g[:-1, :-1], g[:-1, -1], g[-1, -1], g[0, 0]
                spread = lambda beta: max((yy - 2 * beta @ b + beta @ a @ beta) / n, loose)
                beta = np.linalg.solve(a + np.diag(np.full(width, loose * n)), b)
                for _ in range(3):
                    beta = np.linalg.solve(a + np.diag(spread(beta) / prior**2), b)
                out.append([*(row[c] for c in keys), beta.tolist(), math.sqrt(spread(beta)), int(round(n))])
            yield pd.DataFrame(out, columns=[*keys, "_beta", "_sigma", "n"])

    solved = grams.mapInPandas(solve, f"{head}, _beta array<double>, _sigma double, n bigint")
    return join_keys(solved.filter(F.col("n") >= minimum), frames, keys)


def predict_additive(
    times: DataFrame, model: DataFrame, by: Sequence[str], seasons: Sequence[Seasonality] = SEASONS,
    count: int = CHANGEPOINTS, z: float = 1.96,
) -> DataFrame:
    """``yhat`` with its interval, the trend and one column per season at the given times.

    Past the last sample the interval also holds the variance of trend changes
    as frequent and as large as those of the history.
    """
    rows = attach(times, model, by).withColumn("_x", _design(count, seasons))

    def part(start: int, length: int) -> Column:
        pairs = F.zip_with(F.slice("_x", start + 1, length), F.slice("_beta", start + 1, length), lambda x, b: x * b)
        return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) * F.col("_scale")

    parts, at = {"trend": part(0, 2 + count)}, 2 + count
    for s in seasons:
        parts[s.name] = part(at, 2 * s.order)
        at += 2 * s.order
    rows = rows.withColumns(parts).withColumn("yhat", sum((F.col(s.name) for s in seasons), F.col("trend")))
    change = F.aggregate(F.slice("_beta", 3, count), F.lit(0.0), lambda a, b: a + F.abs(b)) / count
    ahead = F.greatest(F.element_at("_x", 2) - 1, F.lit(0.0))
    drift = 2 * change * change * count * F.pow(ahead, F.lit(3.0)) / 3
    width = z * F.col("_scale") * F.sqrt(F.col("_sigma") * F.col("_sigma") + drift)
    return rows.select(
        *times.columns, "yhat", (F.col("yhat") - width).alias("yhat_lower"), (F.col("yhat") + width).alias("yhat_upper"),
        "trend", *[s.name for s in seasons],
    )


def history_and_future(df: DataFrame, by: Sequence[str], periods: int = 120, every: timedelta = timedelta(minutes=1)) -> DataFrame:
    """Times of the history and ``periods`` further ones per series."""
    ends = df.groupBy(*by).agg(F.max(micros("ts")).alias("_last"))
    future = ends.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(periods)))).select(
        *by, from_micros(F.col("_last") + F.col("_h").cast("bigint") * span_us(every)).alias("ts"), F.lit(True).alias("is_future")
    )
    return df.select(*by, "ts", F.lit(False).alias("is_future")).unionByName(future)


def changes(model: DataFrame, by: Sequence[str], count: int = CHANGEPOINTS, above: float = 0.01) -> DataFrame:
    """Fitted rate change at each candidate and whether it exceeds ``above`` of the scale."""
    rows = model.select(*by, "_first", "_last", F.posexplode("_cp").alias("_j", "_c"), "_beta")
    delta = F.get("_beta", F.col("_j") + 2)
    us = (F.col("_first") + F.col("_c") * (F.col("_last") - F.col("_first"))).cast("bigint")
    return rows.select(*by, from_micros(us).alias("ts"), delta.alias("delta"), (F.abs(delta) > above).alias("is_change"))


def component_ranges(parts: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Smallest and largest value and amplitude of each component, long form."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("component"), F.col(n).alias("v")) for n in names]))
    return parts.select(*by, cells.alias("_c")).groupBy(*by, F.col("_c.component").alias("component")).agg(
        F.min("_c.v").alias("low"), F.max("_c.v").alias("high"), (F.max("_c.v") - F.min("_c.v")).alias("amplitude")
    )
