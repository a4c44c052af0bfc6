"""Schemas, series identity and specs given as data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = T.MapType(T.StringType(), T.StringType())

SAMPLES = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("labels", LABELS),
        T.StructField("job", T.StringType()),
        T.StructField("instance", T.StringType()),
        T.StructField("series_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("le", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Bucket bounds of the latency and of the job duration histogram.
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, float("inf"))
JOB_BOUNDS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, float("inf"))


def series_id(metric: str | Column = "metric", labels: str | Column = "labels") -> Column:
    """Identity of a series: metric name and unordered label set."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    entries = F.array_sort(F.map_entries(labels))
    return F.xxhash64(metric, F.to_json(entries))


def match_key(labels: str | Column = "labels") -> Column:
    """Key for matching two vectors on equal label sets, metric name left out."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    return F.to_json(F.array_sort(F.map_entries(labels)))


def micros(ts: str | Column = "ts") -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def from_micros(us: str | Column) -> Column:
    return F.timestamp_micros(us)


def span_us(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def point_us(at: datetime) -> int:
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@dataclass(frozen=True)
class Rule:
    """Threshold alert: ``value <op> limit`` held for ``hold``."""

    name: str
    limit: float
    hold: timedelta
    severity: str
    op: str = ">"
    summary: str = ""
    description: str = ""


@dataclass(frozen=True)
class Resource:
    name: str
    metric: str
    capacity_limit: float
    unit: str = "%"
    warning: float = 0.8
    critical: float = 0.9


@dataclass(frozen=True)
class Seasonality:
    name: str
    period_days: float
    order: int


# The six rules, the four resources and the additive model's seasons.
RULES = (
    Rule("HighCpuUsage", 80.0, timedelta(minutes=5), "warning", ">",
         "High CPU usage on {instance}", "CPU usage is above 80% (current: {value}%)"),
    Rule("HighMemoryUsage", 85.0, timedelta(minutes=5), "warning", ">",
         "High memory usage on {instance}", "Memory usage is above 85% (current: {value}%)"),
    Rule("DiskSpaceLow", 90.0, timedelta(minutes=10), "critical", ">",
         "Disk space critically low on {instance}", "Disk usage is above 90% (current: {value}%)"),
    Rule("HighErrorRate", 0.05, timedelta(minutes=2), "critical", ">",
         "High error rate detected", "Error rate is above 5% (current: {percent})"),
    Rule("HighLatency", 1.0, timedelta(minutes=5), "warning", ">",
         "High latency detected", "95th percentile latency is above 1s (current: {value}s)"),
    Rule("InstanceDown", 0.0, timedelta(minutes=1), "critical", "==",
         "Instance {instance} is down", "{job} instance has been unreachable for 1 minute"),
)
RESOURCES = (
    Resource("CPU", "app_cpu_usage_percent", 100.0, "%"),
    Resource("Memory", "app_memory_usage_mb", 512.0, "MB"),
    Resource("Request Queue", "app_queue_depth", 50.0, "items"),
    Resource("Connections", "active_connections", 200.0, "conns"),
)
SEASONS = (
    Seasonality("weekly", 7.0, 3),
    Seasonality("daily", 1.0, 4),
    Seasonality("shift_pattern", 0.5, 3),
)


def spec_table(spark, specs) -> DataFrame:
    """Specs as a table; the number of rows is that of the given tuple."""
    rows = []
    for s in specs:
        row = dict(s.__dict__)
        for key, value in row.items():
            if isinstance(value, timedelta):
                row[key] = span_us(value)
        rows.append(row)
    return spark.createDataFrame(rows)
