"""The given tables as metric series, in Spark and as SQL common table expressions."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.layout import number_rows
from tidewatch.operators.overtime import counter_over_time
from tidewatch.operators.grid import complete_cases, complete_grid, fill_gaps, wide
from tidewatch.sources import rollups

KINDS = ("click", "error", "purchase", "signup", "view")
HOUR, DAY = timedelta(hours=1), timedelta(days=1)
# Evaluation runs over whole days, from the first event's to the last one's.
SQL_START = "(SELECT date_trunc('day', min(ts))::TIMESTAMP FROM events)"
SQL_END = "(SELECT date_trunc('day', max(ts))::TIMESTAMP + INTERVAL 1 DAY FROM events)"
GAUGE_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, float("inf"))


class Tables:
    """Lazy access to one folder of tables and to the series derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        casts = {
            f.name: F.col(f.name).cast("timestamp")
            for f in df.schema
            if f.dataType.typeName() == "timestamp_ntz"
        }
        return df.withColumns(casts) if casts else df

    @cached_property
    def days(self) -> tuple[datetime, datetime]:
        """First and last evaluation time: one row of the events table's least and greatest time."""
        day = self.table("events").agg(F.date_trunc("day", F.min("ts")).alias("a"), F.date_trunc("day", F.max("ts")).alias("b"))
        a, b = day.select(F.date_format("a", "yyyy-MM-dd"), F.date_format("b", "yyyy-MM-dd")).first()
        if a is None:
            return datetime(1970, 1, 1), datetime(1970, 1, 2)
        return datetime.fromisoformat(a), datetime.fromisoformat(b) + DAY

    @property
    def start(self) -> datetime:
        return self.days[0]

    @property
    def end(self) -> datetime:
        return self.days[1]

    def gauge(self) -> DataFrame:
        """Raw gauge: one series per event type."""
        return self.table("events").select(F.col("event_type").alias("series"), "ts", "value", "event_id")

    def hourly(self) -> DataFrame:
        """Mean per series and hour; hours without events are absent."""
        return (
            self.gauge()
            .groupBy("series", F.date_trunc("hour", "ts").alias("ts"))
            .agg(F.avg("value").alias("value"))
        )

    def hourly_grid(self) -> DataFrame:
        return complete_grid(self.hourly(), ["series"], HOUR)

    def hourly_filled(self) -> DataFrame:
        """Hourly means, empty hours repeat the last one; ``k`` is the position."""
        points = self.hourly().withColumn("k", F.unix_seconds("ts").cast("bigint") / F.lit(3600))
        points = points.withColumn("k", F.col("k").cast("bigint")).drop("ts")
        return fill_gaps(points, ["series"], "k", ["value"]).select(
            "series", F.timestamp_seconds(F.col("k") * 3600).alias("ts"), "value"
        )

    def daily_counter(self) -> DataFrame:
        """Counter per series that restarts every midnight."""
        days = self.table("events").select(
            F.col("event_type").alias("series"), F.date_trunc("day", "ts").alias("day"), "ts", "event_id"
        )
        return number_rows(days, ["series", "day"], ["ts", "event_id"]).select(
            "series", "ts", "event_id", F.col("rn").cast("double").alias("value")
        )

    def shard_counter(self) -> DataFrame:
        """Counter without reset, labels event type and shard."""
        rows = self.table("events").select("event_type", (F.col("user_id") % 4).alias("shard"), "ts", "event_id")
        return number_rows(rows, ["event_type", "shard"], ["ts", "event_id"]).select(
            F.lit("events_total").alias("metric"),
            F.create_map(
                F.lit("event_type"), F.col("event_type"), F.lit("shard"), F.col("shard").cast("string")
            ).alias("labels"),
            "event_type",
            F.col("shard").cast("string").alias("shard"),
            "ts",
            "event_id",
            F.col("rn").cast("double").alias("value"),
        )

    def shard_rates(self) -> DataFrame:
        """Events per hour for each type and shard, six-hour frames on an hourly grid."""
        rates = counter_over_time(
            self.shard_counter(), ["event_type", "shard"], timedelta(hours=6), HOUR, tie=["event_id"], start=self.start, end=self.end
        )
        return rates.select("event_type", "shard", "eval_ts", (F.col("rate") * 3600).alias("value"))

    def buckets(self) -> DataFrame:
        """Running hourly ``le`` buckets of the gauge."""
        return rollups.histogram(self.gauge(), ["series"], HOUR, GAUGE_BOUNDS)

    def bucket_rates(self) -> DataFrame:
        """Observations per hour and bucket, six-hour frames."""
        rates = counter_over_time(self.buckets(), ["series", "le"], timedelta(hours=6), HOUR, start=self.start, end=self.end)
        return rates.select("series", "le", "eval_ts", (F.col("rate") * 3600).alias("value"))

    def wide_hours(self) -> DataFrame:
        """One column per event type, complete hours only."""
        return complete_cases(wide(self.hourly(), "ts", "series", KINDS), KINDS)

    def revenue(self) -> DataFrame:
        """Daily revenue per return flag."""
        return self.table("lineitem").groupBy(
            F.col("l_returnflag").alias("series"), F.date_trunc("day", "l_shipdate").alias("ts")
        ).agg(F.sum("l_extendedprice").alias("value"))

    def order_counts(self) -> DataFrame:
        """Orders per priority and day."""
        return self.table("orders").groupBy(
            F.col("o_orderpriority").alias("series"), F.date_trunc("day", "o_orderdate").alias("ts")
        ).agg(F.count("*").cast("double").alias("value"))

    def balances(self, table: str, prefix: str) -> DataFrame:
        """Account balances summed by nation, labels {nation}."""
        rows = self.table(table).groupBy(F.col(f"{prefix}_nationkey").alias("n_nationkey")).agg(
            F.sum(f"{prefix}_acctbal").alias("value")
        )
        return rows.join(self.table("nation"), "n_nationkey").select(
            F.create_map(F.lit("nation"), F.col("n_name")).alias("labels"), F.col("n_name").alias("nation"), "value"
        )


def counter_sql(source: str, by: str, hours: int, tie: str = ", event_id") -> str:
    """Expressions ending in ``rated``: rise and extrapolated increase per series and hour."""
    return f"""
c AS (SELECT {by}, ts, value, lag(value) OVER (PARTITION BY {by} ORDER BY ts{tie}) AS prev FROM {source}),
d AS (SELECT {by}, epoch_us(ts) AS us, ts, value,
             CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS delta FROM c),
f AS (SELECT {by}, e.eval_ts, count(*) AS n, sum(delta) - arg_min(delta, us) AS rise, min(us) AS fu,
             max(us) AS lu, arg_min(value, us) AS fv, epoch_us(e.eval_ts) AS t
      FROM d JOIN evals e ON d.ts BETWEEN e.eval_ts - INTERVAL {hours} HOUR AND e.eval_ts
      GROUP BY {by}, e.eval_ts HAVING count(*) >= 2),
g AS (SELECT *, (lu - fu) / 1e6 AS len, (lu - fu) / 1e6 / (n - 1) AS gap,
             (fu - t) / 1e6 + {hours} * 3600.0 AS head0, (t - lu) / 1e6 AS tail FROM f),
h AS (SELECT *, CASE WHEN rise > 0 AND fv >= 0 THEN least(head0, len * fv / rise) ELSE head0 END AS head FROM g),
rated AS (SELECT {by}, eval_ts, rise, rise * (len + CASE WHEN head < gap * 1.1 THEN head ELSE gap / 2 END
             + CASE WHEN tail < gap * 1.1 THEN tail ELSE gap / 2 END) / len AS increase FROM h)
"""


# name: (other expressions it needs, SQL)
CTES: dict[str, tuple[str, str]] = {
    "gauge": ("", "SELECT event_type AS series, ts, value, event_id FROM events"),
    "hourly": (
        "",
        "SELECT event_type AS series, date_trunc('hour', ts)::TIMESTAMP AS ts, avg(value) AS value "
        "FROM events GROUP BY 1, 2",
    ),
    "steps": (
        "hourly",
        "SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY series",
    ),
    "hourly_grid": (
        "hourly steps",
        "SELECT s.series, s.ts, h.value FROM steps s LEFT JOIN hourly h ON h.series = s.series AND h.ts = s.ts",
    ),
    "hourly_filled": (
        "hourly steps",
        "SELECT s.series, s.ts, h.value FROM steps s ASOF JOIN hourly h ON h.series = s.series AND s.ts >= h.ts",
    ),
    "daily_counter": (
        "",
        "SELECT event_type AS series, ts, event_id, CAST(count(*) OVER (PARTITION BY event_type, "
        "date_trunc('day', ts) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value FROM events",
    ),
    "shard_counter": (
        "",
        "SELECT event_type, CAST(user_id % 4 AS VARCHAR) AS shard, ts, event_id, CAST(count(*) OVER "
        "(PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value "
        "FROM events",
    ),
    "wide_hours": (
        "hourly",
        "SELECT ts, "
        + ", ".join(f"max(value) FILTER (series = '{k}') AS \"{k}\"" for k in KINDS)
        + " FROM hourly GROUP BY ts HAVING count(*) = 5",
    ),
    "revenue": (
        "",
        "SELECT l_returnflag AS series, date_trunc('day', l_shipdate)::TIMESTAMP AS ts, "
        "sum(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2",
    ),
    "order_counts": (
        "",
        "SELECT o_orderpriority AS series, date_trunc('day', o_orderdate)::TIMESTAMP AS ts, "
        "CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2",
    ),
    "customer_balance": (
        "",
        "SELECT n_name AS nation, sum(c_acctbal) AS value FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
    ),
    "supplier_balance": (
        "",
        "SELECT n_name AS nation, sum(s_acctbal) AS value FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1",
    ),
    "shard_rates": (
        "shard_counter evals",
        "WITH " + counter_sql("shard_counter", "event_type, shard", 6)
        + " SELECT event_type, shard, eval_ts, increase / 21600.0 * 3600 AS value FROM rated",
    ),
    "buckets": (
        "",
        "WITH b AS (SELECT event_type AS series, CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE "
        "date_trunc('hour', ts) + INTERVAL 1 HOUR END AS ts, le, count(*) FILTER (value <= le) AS n, sum(value) AS s "
        "FROM events, (SELECT unnest([1, 5, 10, 25, 50, 100, 250, 500, 'Infinity'::DOUBLE]) AS le) GROUP BY 1, 2, 3) "
        "SELECT series, ts, le, CAST(sum(n) OVER (PARTITION BY series, le ORDER BY ts ROWS UNBOUNDED PRECEDING) AS DOUBLE) "
        "AS value, sum(s) OVER (PARTITION BY series, le ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sum FROM b",
    ),
    "bucket_rates": (
        "buckets evals",
        "WITH " + counter_sql("buckets", "series, le", 6, "")
        + " SELECT series, le, eval_ts, increase / 21600.0 * 3600 AS value FROM rated",
    ),
    "evals": (
        "",
        f"SELECT unnest(generate_series({SQL_START}, {SQL_END}, INTERVAL 1 HOUR)) AS eval_ts",
    ),
}
