"""Synthetic series: trend, sine seasons, noise and spikes, made where they are used.

Noise comes from a hash of series and step, so a series is the same under any
partitioning and after a lost task is run again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.units import clip
from tidewatch.model import from_micros, point_us, span_us


@dataclass(frozen=True)
class Shape:
    base: float
    slope: float
    seasons: Sequence[tuple[float, float]] = field(default_factory=tuple)  # (amplitude, period in steps)
    noise: float = 0.0
    spike_share: float = 0.0
    spike: tuple[float, float] = (15.0, 30.0)
    bounds: tuple[float, float] | None = None


# The two demonstration series.
SEASONAL = Shape(30.0, 0.1, ((15.0, 24.0),), 3.0)
ADDITIVE = Shape(35.0, 0.02, ((15.0, 1440.0), (5.0, 10080.0)), 3.0, 10 / 500, (15.0, 30.0), (5.0, 95.0))


def _uniform(by: Sequence[str], seed: int, stream: int) -> Column:
    """In (0, 1), from the upper 53 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*by, "step", F.lit(seed), F.lit(stream)), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 53))


def synthetic(
    series: DataFrame, by: Sequence[str], points: int, shape: Shape, start: datetime,
    every: timedelta = timedelta(minutes=1), seed: int = 42,
) -> DataFrame:
    """``points`` rows for every row of ``series``."""
    rows = series.select(*by, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step"))
    t = F.col("step")
    value = shape.base + shape.slope * t
    for amplitude, period in shape.seasons:
        value = value + amplitude * F.sin(2 * math.pi * t / F.lit(period))
    if shape.noise:
        radius = F.sqrt(-2 * F.log(_uniform(by, seed, 1)))
        value = value + shape.noise * radius * F.cos(2 * math.pi * _uniform(by, seed, 2))
    if shape.spike_share:
        low, high = shape.spike
        height = low + (high - low) * _uniform(by, seed, 4)
        value = value + F.when(_uniform(by, seed, 3) < shape.spike_share, height).otherwise(0.0)
    if shape.bounds:
        value = clip(value, *shape.bounds)
    at = from_micros(F.lit(point_us(start)) + t.cast("bigint") * span_us(every))
    return rows.select(*by, at.alias("ts"), value.alias("value"), "step")
