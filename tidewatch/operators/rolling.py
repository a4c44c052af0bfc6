"""Row-window statistics and detectors on raw samples, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import BLOCK_ROWS, attach, exact_quantiles, join_keys, windowed


def _guarded(w, value: str, rows: int) -> tuple[Column, Column]:
    full = F.count(value).over(w) == rows
    return F.when(full, F.avg(value).over(w)), F.when(full, F.stddev_samp(value).over(w))


def rolling_zscore(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = 20, limit: float = 2.5,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """z against the trailing ``rows`` rows, the current one included; full windows only."""

    def columns(w):
        mean, std = _guarded(w.rowsBetween(1 - rows, 0), "value", rows)
        return {"rolling_mean": mean, "rolling_std": std}

    out = windowed(df, by, order, columns, before=rows - 1, block_rows=block_rows)
    z = F.try_divide(F.col("value") - F.col("rolling_mean"), F.col("rolling_std"))
    return (
        out.withColumn("z_score", z)
        .filter("rolling_mean IS NOT NULL")
        .withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))
    )


def centred_band(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = 20, k: float = 2.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Band of ``k`` deviations about the centred mean; an even window leans to the past."""
    back, ahead = rows - 1 - (rows - 1) // 2, (rows - 1) // 2

    def columns(w):
        mean, std = _guarded(w.rowsBetween(-back, ahead), "value", rows)
        return {"band_mean": mean, "band_std": std}

    return _outside(windowed(df, by, order, columns, before=back, after=ahead, block_rows=block_rows), k)


def _outside(rows: DataFrame, k: float) -> DataFrame:
    """``upper``, ``lower`` and ``is_anomaly`` from the mean and deviation of a band."""
    rows = rows.withColumns({"upper": F.col("band_mean") + k * F.col("band_std"), "lower": F.col("band_mean") - k * F.col("band_std")})
    beyond = (F.col("value") > F.col("upper")) | (F.col("value") < F.col("lower"))
    return rows.withColumn("is_anomaly", F.coalesce(beyond, F.lit(False)))


def adaptive_band(
    df: DataFrame, by: Sequence[str], order: Sequence[str], most: int = 20, share: int = 4, k: float = 2.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``centred_band`` whose width each series gets from its length: ``min(most, n // share)`` rows, in ``width``.

    A series under ``2 * share`` rows has no band. Series of ``most * share`` rows
    and more go through blocks as in ``centred_band``; shorter ones are small
    enough to be one group each, where a frame is cut out of the ``most`` rows around.
    """
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    rows = attach(df, sizes, by)
    long = centred_band(rows.filter(F.col("_n") >= most * share).drop("_n"), by, order, most, k, block_rows)
    long = long.withColumn("width", F.lit(most).cast("bigint"))

    width = F.floor(F.col("_n") / share)
    ahead = F.floor((width - 1) / 2)
    back = width - 1 - ahead
    reach = most - 1 - (most - 1) // 2
    line = Window.partitionBy(*by).orderBy(*order)
    short = rows.filter(F.col("_n") < most * share).withColumns(
        {"_rn": F.row_number().over(line), "_around": F.collect_list(F.struct("value")).over(line.rowsBetween(-reach, (most - 1) // 2)), "width": width}
    )
    first = F.col("_rn") - back
    whole = (width > 1) & (first >= 1) & (F.col("_rn") + ahead <= F.col("_n"))
    at = first - F.greatest(F.lit(1), F.col("_rn") - reach) + 1
    frame = F.transform(F.slice("_around", at.cast("int"), width.cast("int")), lambda x: x["value"])
    short = short.withColumn("_frame", F.when(whole, frame)).withColumn("_frame", F.when(F.forall("_frame", lambda x: x.isNotNull()), F.col("_frame")))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    short = short.withColumn("band_mean", total(F.col("_frame")) / width)
    squares = F.transform("_frame", lambda x: (x - F.col("band_mean")) * (x - F.col("band_mean")))
    short = _outside(short.withColumn("band_std", F.sqrt(F.try_divide(total(squares), width - 1))), k)
    kept = [*df.columns, "width", "band_mean", "band_std", "upper", "lower", "is_anomaly"]
    return long.select(*kept).unionByName(short.select(*kept))


def zscore(df: DataFrame, by: Sequence[str], limit: float = 2.5) -> DataFrame:
    """z against the whole series (sample deviation)."""
    stats = df.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    out = attach(df, stats, by).withColumn("z_score", F.try_divide(F.col("value") - F.col("mean"), F.col("std")))
    return out.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))


def bands(df: DataFrame, ks: Sequence[float] = (2.0, 2.5)) -> DataFrame:
    """Band edges ``mean ± k·std`` beside the columns of ``zscore``."""
    out = {}
    for k in ks:
        tag = f"{k:g}".replace(".", "_")
        out[f"upper_{tag}"] = F.col("mean") + k * F.col("std")
        out[f"lower_{tag}"] = F.col("mean") - k * F.col("std")
    return df.withColumns(out)


def median_mad(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Median and median absolute deviation, exact at any series size."""
    middle = exact_quantiles(df, by, "value", {"median": 0.5})
    distance = attach(df.select(*by, "value"), middle, by).select(
        *by, F.abs(F.col("value") - F.col("median")).alias("value")
    )
    return join_keys(middle, exact_quantiles(distance, by, "value", {"mad": 0.5}), by)


def modified_zscore(df: DataFrame, by: Sequence[str], limit: float = 3.0) -> DataFrame:
    """``0.6745 (x - median) / MAD``; undefined where MAD is 0."""
    z = 0.6745 * F.try_divide(F.col("value") - F.col("median"), F.col("mad"))
    out = attach(df, median_mad(df, by), by).withColumn("modified_z", z)
    return out.withColumn("is_anomaly", F.coalesce(F.abs("modified_z") > limit, F.lit(False)))


def contextual_zscore(df: DataFrame, by: Sequence[str], context: dict[str, Column], limit: float = 2.5) -> DataFrame:
    """z against the samples of the same context, such as the hour of day."""
    return zscore(df.withColumns(context), [*by, *context], limit)


def differences(
    df: DataFrame, by: Sequence[str], order: Sequence[str], lag: int = 1, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``value`` minus the value ``lag`` rows before."""
    cols = lambda w: {"difference": F.col("value") - F.lag("value", lag).over(w)}
    return windowed(df, by, order, cols, before=lag, block_rows=block_rows)


def volatility(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = 20, flat_below: float = 1e-9,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Deviation of the last ``rows`` rows and a flat-line flag for it."""
    cols = lambda w: {"volatility": _guarded(w.rowsBetween(1 - rows, 0), "value", rows)[1]}
    out = windowed(df, by, order, cols, before=rows - 1, block_rows=block_rows)
    return out.filter("volatility IS NOT NULL").withColumn("is_flat", F.col("volatility") < flat_below)


def deviation_features(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = 10, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Features of the single-metric forest: change and distance from the 10-row mean."""
    def columns(w):
        return {
            "rate_of_change": F.coalesce(F.col("value") - F.lag("value").over(w), F.lit(0.0)),
            "rolling_mean": F.avg("value").over(w.rowsBetween(1 - rows, 0)),
        }

    out = windowed(df, by, order, columns, before=rows - 1, block_rows=block_rows)
    return out.withColumns(
        {
            "hour": F.hour("ts"),
            "minute": F.minute("ts"),
            "deviation_from_rolling": F.col("value") - F.col("rolling_mean"),
        }
    )


def change_features(
    frame: DataFrame, metrics: Sequence[str], order: Sequence[str], scope: Sequence[str]
) -> DataFrame:
    """``<metric>_change`` columns: first differences, 0 at the first tick."""
    cols = lambda w: {f"{m}_change": F.coalesce(F.col(m) - F.lag(m).over(w), F.lit(0.0)) for m in metrics}
    return windowed(frame, scope, order, cols, before=1).drop("rn", "n_rows")


def crossings(
    df: DataFrame, by: Sequence[str], order: Sequence[str], sigmas: float = 0.5, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Flapping about ``mean + sigmas·std``: crossings and alerts per hour and day.

    The first row counts as a crossing, as a comparison with nothing differs.
    """
    stats = df.groupBy(*by).agg(
        (F.avg("value") + sigmas * F.stddev_samp("value")).alias("threshold")
    )
    marked = attach(df, stats, by).withColumn("above", F.col("value") > F.col("threshold"))
    cols = lambda w: {"_was": F.lag("above").over(w)}
    rows = windowed(marked, by, order, cols, before=1, block_rows=block_rows)
    crossed = F.col("_was").isNull() | (F.col("_was") != F.col("above"))
    return rows.groupBy(*by).agg(
        F.max("threshold").alias("threshold"), F.count_if(crossed).alias("crossings")
    ).withColumn("alerts_per_hour", F.floor(F.col("crossings") / 2)).withColumn(
        "alerts_per_day", F.col("alerts_per_hour") * 24
    )
