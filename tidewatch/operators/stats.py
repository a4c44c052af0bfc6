"""Summary statistics, correlation, scaling, baselines and explanations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach


def describe(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.stddev_samp(value).alias("std"),
        (F.max(value) - F.min(value)).alias("range"),
    )


def _pearson(a: str, b: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return F.try_divide(
        F.covar_samp(a, b),
        F.stddev_samp(F.when(both, F.col(a))) * F.stddev_samp(F.when(both, F.col(b))),
    )


def correlations(frame: DataFrame, metrics: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Pearson matrix in long form, one aggregation for all pairs; NULL for constant columns."""
    pairs = list(combinations(metrics, 2))
    one = frame.groupBy(*scope).agg(
        *[_pearson(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)],
        *[_pearson(m, m).alias(f"_m{i}") for i, m in enumerate(metrics)],
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_{i}").alias("r")))
    for i, m in enumerate(metrics):
        cells.append(F.struct(F.lit(m).alias("a"), F.lit(m).alias("b"), F.col(f"_m{i}").alias("r")))
    return one.select(*scope, F.explode(F.array(*cells)).alias("_c")).select(*scope, "_c.a", "_c.b", "_c.r")


def strong_pairs(matrix: DataFrame, metrics: Sequence[str], above: float = 0.5) -> DataFrame:
    """Pairs in column order with ``abs(r) > above`` and their direction."""
    place = F.create_map(*[x for i, m in enumerate(metrics) for x in (F.lit(m), F.lit(i))])
    ordered = place[F.col("a")] < place[F.col("b")]
    return matrix.filter(ordered & (F.abs("r") > above)).withColumn(
        "direction", F.when(F.col("r") > 0, "↑↑").otherwise("↑↓")
    )


def standard_scale(frame: DataFrame, columns: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """``<c>_scaled``: zero mean and unit population deviation; constant columns give 0."""
    stats = frame.groupBy(*scope).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns],
    )
    out = attach(frame, stats, scope)
    for c in columns:
        std = F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}"))
        out = out.withColumn(f"{c}_scaled", (F.col(c) - F.col(f"_mean_{c}")) / std)
    return out.drop(*[f"_mean_{c}" for c in columns], *[f"_std_{c}" for c in columns])


def minmax_scale(frame: DataFrame, columns: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """``<c>_scaled`` in [0, 1]; NULL for constant columns."""
    stats = frame.groupBy(*scope).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    out = attach(frame, stats, scope)
    for c in columns:
        low, high = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out = out.withColumn(f"{c}_scaled", F.try_divide(F.col(c) - low, high - low))
    return out.drop(*[f"_lo_{c}" for c in columns], *[f"_hi_{c}" for c in columns])


def normal_baseline(
    frame: DataFrame, metrics: Sequence[str], scope: Sequence[str], flag: str = "is_anomaly", population: bool = False
) -> DataFrame:
    """Mean and deviation per metric of the rows not flagged."""
    deviation = F.stddev_pop if population else F.stddev_samp
    return frame.filter(~F.col(flag)).groupBy(*scope).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics],
        *[deviation(m).alias(f"{m}_std") for m in metrics],
    )


def reasons(metrics: Sequence[str], keep: int | None = 3, above: float = 0.0) -> Column:
    """Contributions of the row's metrics by falling ``abs(z)`` against ``<m>_mean`` and ``<m>_std``.

    Works inside the row: no metric is exploded and nothing is shuffled.
    """
    entries = []
    for place, m in enumerate(metrics):
        z = F.try_divide(F.col(m) - F.col(f"{m}_mean"), F.col(f"{m}_std"))
        entries.append(
            F.when(
                (F.col(f"{m}_std") > 0) & (F.abs(z) > above),
                F.struct(
                    (-F.abs(z)).alias("order"),
                    F.lit(place).alias("place"),
                    F.lit(m).alias("metric"),
                    z.alias("z"),
                    F.when(z > 0, "HIGH").otherwise("LOW").alias("direction"),
                    F.col(m).alias("value"),
                ),
            )
        )
    ranked = F.array_sort(F.array_compact(F.array(*entries)))
    if keep:
        ranked = F.slice(ranked, 1, keep)
    return F.transform(
        ranked,
        lambda x: F.struct(
            x["metric"].alias("metric"), x["z"].alias("z"), x["direction"].alias("direction"), x["value"].alias("value")
        ),
    )


def explain(frame: DataFrame, baseline: DataFrame, metrics: Sequence[str], scope: Sequence[str], keep: int = 3) -> DataFrame:
    """Rows with their ``keep`` largest contributions in ``reason``."""
    drop = [f"{m}_{s}" for m in metrics for s in ("mean", "std")]
    return attach(frame, baseline, scope).withColumn("reason", reasons(metrics, keep)).drop(*drop)


def anomaly_rate(df: DataFrame, by: Sequence[str], flag: str = "is_anomaly") -> DataFrame:
    hits = F.count_if(F.col(flag))
    return df.groupBy(*by).agg(
        F.count("*").alias("checks"), hits.alias("anomalies"), (F.try_divide(hits, F.count("*")) * 100).alias("percent")
    )


def latest(df: DataFrame, by: Sequence[str], order: str = "ts", value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.max_by(value, F.struct(order, value)).alias(value), F.max(order).alias(order))
