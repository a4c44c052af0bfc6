"""Quantiles: from cumulative buckets, and exact ones from raw observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import exact_quantiles

INF = float("inf")


def _chained(buckets: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Buckets with monotone counts ``c``, the bound and count before them, and the total.

    A group of the windows holds one row per bound.
    """
    ordered = Window.partitionBy(*by).orderBy("le")
    # summed as decimals: whether a rank falls on a bucket's edge must not depend on the order of the rows
    merged = buckets.groupBy(*by, "le").agg(F.sum(F.col(value).cast("decimal(38,18)")).cast("double").alias("_c"))
    running = F.max("_c").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy(*by)
    return merged.withColumn("c", running).withColumns(
        {
            "low": F.coalesce(F.lag("le").over(ordered), F.least(F.lit(0.0), F.col("le"))),
            "before": F.coalesce(F.lag("c").over(ordered), F.lit(0.0)),
            "total": F.max("c").over(whole),
            "top": F.max("le").over(whole),
        }
    )


def _quantile(phi: float) -> Column:
    if phi < 0 or phi > 1:
        return F.lit(-INF if phi < 0 else INF)
    rank = F.col("total") * phi
    inside = F.col("low") + (F.col("le") - F.col("low")) * F.coalesce(
        F.try_divide(rank - F.col("before"), F.col("c") - F.col("before")), F.lit(0.0)
    )
    value = F.when(F.col("le") == INF, F.col("low")).otherwise(inside)
    first = F.min_by(value, F.when(F.col("c") >= rank, F.col("le")))
    return F.when((F.max("top") == INF) & (F.max("total") > 0) & (F.count("*") > 1), first)


def histogram_quantile(
    buckets: DataFrame, by: Sequence[str], phis: Mapping[str, float], value: str = "value"
) -> DataFrame:
    """Quantiles per label set from cumulative ``le`` buckets; one column per entry of ``phis``.

    Without a ``+Inf`` bucket or without observations the result is NULL. A rank
    in the ``+Inf`` bucket gives the largest finite bound. Buckets of series that
    differ in labels outside ``by`` are summed first.
    """
    inner = {n: p for n, p in phis.items() if 0 <= p <= 1}
    rows = _chained(buckets, by, value).groupBy(*by).agg(F.count("*").alias("_k"), *[_quantile(p).alias(n) for n, p in inner.items()])
    return rows.select(*by, *[F.col(n) if n in inner else _quantile(p).alias(n) for n, p in phis.items()])


def bucket_shares(buckets: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Share of observations between neighbouring bounds."""
    share = F.try_divide(F.col("c") - F.col("before"), F.col("total"))
    return _chained(buckets, by, value).select(*by, "low", "le", share.alias("share"))


def observed_quantiles(df: DataFrame, by: Sequence[str], probs: Mapping[str, float], value: str = "value") -> DataFrame:
    """Exact quantiles of raw observations."""
    return exact_quantiles(df, by, value, probs)
