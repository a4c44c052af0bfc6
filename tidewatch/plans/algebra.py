"""Queries of selectors, vector algebra, quantiles and summary statistics."""

from __future__ import annotations

from datetime import timedelta
from itertools import combinations

from pyspark.sql import functions as F

from tidewatch.functions import text, units
from tidewatch.model import LATENCY_BOUNDS
from tidewatch.operators import quantile, rolling, selectors, stats, vectors
from tidewatch.operators import grid
from tidewatch.plans.registry import query
from tidewatch.plans.tables import DAY, GAUGE_BOUNDS, HOUR, KINDS, SQL_END, SQL_START
from tidewatch.sources import read, rollups

BY = ["event_type", "shard"]


@query("select_metric", "SELECT event_type, shard, ts, value FROM shard_counter", uses="shard_counter", doubles="value")
def select_metric(t):
    return selectors.select_metric(t.shard_counter(), "events_total").select("event_type", "shard", "ts", "value")


@query(
    "label_match",
    "SELECT event_type, shard, ts, value FROM shard_counter WHERE regexp_full_match(event_type, 'err.*|.*i.*') "
    "AND shard <> '2' AND NOT regexp_full_match(shard, '[13]') AND '' = ''",
    uses="shard_counter",
    doubles="value",
)
def label_match(t):
    wanted = {"event_type": ("=~", "err.*|.*i.*"), "shard": ("!=", "2"), "absent": ("=", "")}
    rows = t.shard_counter().filter(selectors.matches(wanted))
    return rows.filter(selectors.matches({"shard": ("!~", "[13]")})).select("event_type", "shard", "ts", "value")


@query(
    "unit_convert",
    "SELECT o_orderkey, o_totalprice / 1024 / 1024 AS mb, 1 - o_totalprice AS rest, o_totalprice * 100 AS percent, "
    "o_totalprice / 3600 * 86400 / 24 AS daily FROM orders",
    doubles="mb rest percent daily",
)
def unit_convert(t):
    price = F.col("o_totalprice")
    return t.table("orders").select(
        "o_orderkey",
        units.megabytes(price).alias("mb"),
        (1 - price).alias("rest"),
        (price * 100).alias("percent"),
        units.days(units.per_day(price / 3600)).alias("daily"),
    )


@query("threshold_filter", "SELECT event_id, value FROM events WHERE value > 80", doubles="value")
def threshold_filter(t):
    return selectors.keep(t.gauge(), ">", 80.0).select("event_id", "value")


@query(
    "static_threshold",
    "SELECT series, count(*) AS n, count(*) FILTER (value > 70) AS violations, "
    "count(*) FILTER (value > 70) / count(*) * 100 AS percent FROM gauge GROUP BY 1",
    uses="gauge",
    doubles="percent",
)
def static_threshold(t):
    return selectors.static_threshold(t.gauge(), ["series"], 70.0)


@query(
    "min_points",
    "SELECT user_id, event_type, count(*) AS n, CASE WHEN count(*) >= 10 THEN 'OK' ELSE 'NO_DATA' END AS status "
    "FROM events GROUP BY 1, 2",
)
def min_points(t):
    return selectors.point_counts(t.table("events"), ["user_id", "event_type"], 10)


@query(
    "enough_points",
    "SELECT event_id, value FROM events WHERE (user_id, event_type) IN "
    "(SELECT (user_id, event_type) FROM events GROUP BY user_id, event_type HAVING count(*) >= 15)",
    doubles="value",
)
def enough_points(t):
    return selectors.enough_points(t.table("events"), ["user_id", "event_type"], 15).select("event_id", "value")


@query(
    "range_read",
    """SELECT s.event_type, s.shard, e.eval_ts, g.value
    FROM (SELECT DISTINCT event_type, shard FROM shard_counter) s CROSS JOIN evals e
    ASOF JOIN shard_counter g ON g.event_type = s.event_type AND g.shard = s.shard AND e.eval_ts >= g.ts
    WHERE g.ts > e.eval_ts - INTERVAL 3 HOUR""",
    uses="shard_counter evals",
    doubles="value",
)
def range_read(t):
    return read.range_read(t.shard_counter(), "events_total", BY, t.start, t.end, HOUR, timedelta(hours=3))


@query(
    "instant_read",
    "SELECT event_type, shard, arg_max(value, ts) AS value, max(ts) AS ts FROM shard_counter "
    f"WHERE ts <= {SQL_END} AND ts > {SQL_END} - INTERVAL 40 DAY GROUP BY 1, 2",
    uses="shard_counter",
    doubles="value",
)
def instant_read(t):
    return read.instant_read(t.shard_counter(), "events_total", BY, t.end, timedelta(days=40))


@query(
    "aligned_wide",
    """WITH a AS (SELECT s.series, e.eval_ts, g.value
    FROM (SELECT DISTINCT series FROM gauge) s CROSS JOIN evals e
    ASOF JOIN gauge g ON g.series = s.series AND e.eval_ts >= g.ts WHERE g.ts > e.eval_ts - INTERVAL 2 HOUR)
    SELECT eval_ts, """
    + ", ".join(f"max(value) FILTER (series = '{k}') AS \"{k}\"" for k in KINDS)
    + " FROM a GROUP BY 1",
    uses="gauge evals",
    doubles=" ".join(KINDS),
)
def aligned_wide(t):
    return read.aligned_read(t.gauge(), "series", KINDS, t.start, t.end, HOUR, timedelta(hours=2))


@query(
    "align_positional",
    "WITH r AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY ts) AS pos, value FROM hourly) SELECT pos, "
    + ", ".join(f"max(value) FILTER (series = '{k}') AS \"{k}\"" for k in KINDS)
    + " FROM r GROUP BY 1 HAVING count(*) = 5",
    uses="hourly",
    doubles=" ".join(KINDS),
)
def align_positional(t):
    return grid.align_positional(t.hourly(), "series", KINDS, ["ts"])


@query("complete_case", "SELECT * FROM wide_hours", uses="wide_hours", doubles=" ".join(KINDS))
def complete_case(t):
    return t.wide_hours()


RATES = {"uses": "shard_rates"}


@query("sum_by", "SELECT event_type, eval_ts, sum(value) AS sum FROM shard_rates GROUP BY 1, 2", doubles="sum", **RATES)
def sum_by(t):
    return vectors.aggregate(t.shard_rates(), ["sum"], ["event_type"])


@query("avg_by", "SELECT shard, eval_ts, avg(value) AS avg FROM shard_rates GROUP BY 1, 2", doubles="avg", **RATES)
def avg_by(t):
    return vectors.aggregate(t.shard_rates(), ["avg"], ["shard"])


@query(
    "count_series",
    "SELECT eval_ts, count(*) AS count, max(value) AS max, min(value) AS min FROM shard_rates GROUP BY 1",
    doubles="max min",
    **RATES,
)
def count_series(t):
    return vectors.aggregate(t.shard_rates(), ["count", "max", "min"])


@query(
    "topk_series",
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY eval_ts ORDER BY round(value, 6) DESC, event_type, shard) AS rank "
    "FROM shard_rates) SELECT eval_ts, event_type, shard, value, rank FROM r WHERE rank <= 3",
    doubles="value",
    **RATES,
)
def topk_series(t):
    order = [F.round("value", 6).desc(), F.col("event_type"), F.col("shard")]
    out = vectors.topk(t.shard_rates(), 3, order)
    return out.select("eval_ts", "event_type", "shard", "value", F.col("rank").cast("bigint"))


ERRORS = "sum(value) FILTER (regexp_full_match(event_type, 'err.*')) / nullif(sum(value), 0)"


@query("error_rate", f"SELECT eval_ts, {ERRORS} AS ratio FROM shard_rates GROUP BY 1", doubles="ratio", **RATES)
def error_rate(t):
    return vectors.ratio_of_sums(t.shard_rates(), F.col("event_type").rlike("^(?:err.*)$"))


@query(
    "cpu_busy",
    "SELECT shard, eval_ts, 100 - avg(value / 10) * 100 AS busy FROM shard_rates WHERE event_type = 'view' GROUP BY 1, 2",
    doubles="busy",
    **RATES,
)
def cpu_busy(t):
    idle = t.shard_rates().filter("event_type = 'view'").withColumn("rate", F.col("value") / 10)
    return vectors.busy_percent(idle, ["shard"])


@query(
    "vector_div",
    "SELECT nation, s.value / nullif(c.value, 0) AS ratio FROM supplier_balance s JOIN customer_balance c USING (nation)",
    uses="supplier_balance customer_balance",
    doubles="ratio",
)
def vector_div(t):
    out = vectors.divide(t.balances("supplier", "s"), t.balances("customer", "c"))
    return out.select(F.col("labels")["nation"].alias("nation"), F.col("value").alias("ratio"))


@query(
    "used_percent",
    "SELECT nation, (1 - s.value / nullif(c.value, 0)) * 100 AS percent "
    "FROM supplier_balance s JOIN customer_balance c USING (nation)",
    uses="supplier_balance customer_balance",
    doubles="percent",
)
def used_percent(t):
    out = vectors.used_percent(t.balances("supplier", "s"), t.balances("customer", "c"))
    return out.select(F.col("labels")["nation"].alias("nation"), F.col("value").alias("percent"))


@query(
    "or_default",
    "SELECT e.eval_ts, coalesce(n.value, 0) AS value FROM evals e LEFT JOIN (SELECT eval_ts, "
    "CAST(count(*) AS DOUBLE) AS value FROM shard_rates WHERE value > 4 GROUP BY 1) n ON n.eval_ts = e.eval_ts",
    uses="shard_rates evals",
    doubles="value",
)
def or_default(t):
    busy = t.shard_rates().filter("value > 4").groupBy("eval_ts").agg(F.count("*").cast("double").alias("value"))
    return vectors.or_default(busy, vectors.steps(t.spark, t.start, t.end, HOUR))


@query(
    "series_cardinality",
    "SELECT event_type, count(DISTINCT user_id) AS series_count FROM events GROUP BY 1",
)
def series_cardinality(t):
    return vectors.cardinality(t.table("events"), ["event_type", "user_id"], ["event_type"])


CUMULATIVE = """SELECT series, eval_ts, le, value, 
  coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(value) OVER w, 0) AS before, max(value) OVER (PARTITION BY series, eval_ts) AS total
  FROM (SELECT series, eval_ts, le, max(value) OVER (PARTITION BY series, eval_ts ORDER BY le) AS value FROM bucket_rates)
  WINDOW w AS (PARTITION BY series, eval_ts ORDER BY le)"""


def quantile_sql(phi: float) -> str:
    return f"""min(CASE WHEN le = 'Infinity'::DOUBLE THEN low
      ELSE low + (le - low) * ({phi} * total - before) / nullif(value - before, 0) END)
      FILTER (total > 0 AND value >= {phi} * total AND (before < {phi} * total OR before = 0 AND low = 0))"""


PHIS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@query(
    "histogram_quantile",
    f"WITH b AS ({CUMULATIVE}) SELECT series, eval_ts, "
    + ", ".join(f"{quantile_sql(phi)} AS {name}" for name, phi in PHIS.items())
    + " FROM b GROUP BY 1, 2",
    uses="bucket_rates",
    doubles=" ".join(PHIS),
)
def histogram_quantile(t):
    return quantile.histogram_quantile(t.bucket_rates(), ["series", "eval_ts"], PHIS)


@query(
    "latency_bands",
    """WITH b AS (SELECT series, le, max(value) AS value FROM buckets GROUP BY 1, 2)
    SELECT series, coalesce(lag(le) OVER w, 0) AS low, CASE WHEN le = 'Infinity'::DOUBLE THEN -1 ELSE le END AS le,
      (value - coalesce(lag(value) OVER w, 0)) / max(value) OVER (PARTITION BY series) AS share
    FROM b WINDOW w AS (PARTITION BY series ORDER BY le)""",
    uses="buckets",
    doubles="low le share",
)
def latency_bands(t):
    final = t.buckets().groupBy("series", "le").agg(F.max("value").alias("value"))
    out = quantile.bucket_shares(final, ["series"])
    return out.withColumn("le", F.when(F.col("le") == float("inf"), -1.0).otherwise(F.col("le")))


@query(
    "summary_quantiles",
    "SELECT series, " + ", ".join(f"quantile_cont(value, {p}) AS {n}" for n, p in PHIS.items()) + " FROM gauge GROUP BY 1",
    uses="gauge",
    doubles=" ".join(PHIS),
)
def summary_quantiles(t):
    return quantile.observed_quantiles(t.gauge(), ["series"], PHIS)


@query(
    "series_describe",
    "SELECT series, count(value) AS n, avg(value) AS mean, max(value) AS max, min(value) AS min, "
    "stddev_samp(value) AS std, max(value) - min(value) AS range FROM gauge GROUP BY 1",
    uses="gauge",
    doubles="mean max min std range",
)
def series_describe(t):
    return stats.describe(t.gauge(), ["series"])


def _corr_sql() -> str:
    cells = [f"SELECT '{a}' AS a, '{b}' AS b, corr(\"{a}\", \"{b}\") AS r FROM wide_hours" for a in KINDS for b in KINDS]
    return " UNION ALL ".join(cells)


@query("corr_matrix", _corr_sql(), uses="wide_hours", doubles="r")
def corr_matrix(t):
    return stats.correlations(t.wide_hours(), KINDS)


LINES = ("l_quantity", "l_extendedprice", "l_discount", "charge", "saving")
LINES_SQL = (
    "SELECT *, l_extendedprice * (1 - l_discount) AS charge, l_extendedprice * -l_discount AS saving FROM lineitem"
)


@query(
    "strong_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, CASE WHEN corr({a}, {b}) > 0 THEN '↑↑' ELSE '↑↓' END AS direction "
        f"FROM ({LINES_SQL}) HAVING abs(corr({a}, {b})) > 0.5"
        for a, b in combinations(LINES, 2)
    ),
    doubles="r",
)
def strong_pairs(t):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    frame = t.table("lineitem").withColumns({"charge": price * (1 - discount), "saving": price * -discount})
    return stats.strong_pairs(stats.correlations(frame, LINES), LINES)


def _scaled(expr: str) -> str:
    return ", ".join(expr.format(c=f'"{k}"') + f" AS {k}_scaled" for k in KINDS)


@query(
    "standard_scale",
    "SELECT ts, " + _scaled("({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + " FROM wide_hours",
    uses="wide_hours",
    doubles=" ".join(f"{k}_scaled" for k in KINDS),
)
def standard_scale(t):
    frame = t.wide_hours().withColumn("scope", F.lit("all"))
    return stats.standard_scale(frame, KINDS, ["scope"]).drop("scope", *KINDS)


@query(
    "minmax_scale",
    "SELECT ts, " + _scaled("({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())") + " FROM wide_hours",
    uses="wide_hours",
    doubles=" ".join(f"{k}_scaled" for k in KINDS),
)
def minmax_scale(t):
    frame = t.wide_hours().withColumn("scope", F.lit("all"))
    return stats.minmax_scale(frame, KINDS, ["scope"]).drop("scope", *KINDS)


FLAGGED = "SELECT *, " + " OR ".join(f'"{k}" > 100' for k in KINDS) + " AS is_anomaly FROM wide_hours"


def _flagged(t):
    over = F.lit(False)
    for k in KINDS:
        over = over | (F.col(k) > 100)
    return t.wide_hours().withColumns({"is_anomaly": over, "scope": F.lit("all")})


@query(
    "normal_baseline",
    f"WITH f AS ({FLAGGED}) SELECT "
    + ", ".join(f'avg("{k}") AS {k}_mean, stddev_samp("{k}") AS {k}_std' for k in KINDS)
    + " FROM f WHERE NOT is_anomaly HAVING count(*) > 0",
    uses="wide_hours",
    doubles=" ".join(f"{k}_{s}" for k in KINDS for s in ("mean", "std")),
)
def normal_baseline(t):
    return stats.normal_baseline(_flagged(t), KINDS, ["scope"]).drop("scope")


@query(
    "explain_top3",
    f"""WITH f AS ({FLAGGED}), b AS (SELECT """
    + ", ".join(f'avg("{k}") AS {k}_m, stddev_samp("{k}") AS {k}_s' for k in KINDS)
    + """ FROM f WHERE NOT is_anomaly), z AS ("""
    + " UNION ALL ".join(
        f"SELECT ts, '{k}' AS metric, \"{k}\" AS value, (\"{k}\" - {k}_m) / {k}_s AS z FROM f, b WHERE is_anomaly AND {k}_s > 0"
        for k in KINDS
    )
    + """), r AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY abs(z) DESC, metric) AS place FROM z)
    SELECT ts, metric, value, z, CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS direction FROM r WHERE place <= 3""",
    uses="wide_hours",
    doubles="value z",
)
def explain_top3(t):
    rows = _flagged(t)
    baseline = stats.normal_baseline(rows, KINDS, ["scope"])
    out = stats.explain(rows.filter("is_anomaly"), baseline, KINDS, ["scope"])
    return out.select("ts", F.explode("reason").alias("r")).select("ts", "r.metric", "r.value", "r.z", "r.direction")


@query(
    "anomaly_rate",
    """WITH z AS (SELECT series, coalesce(abs((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0)) > 2.5, false)
      AS hit FROM gauge WINDOW w AS (PARTITION BY series))
    SELECT series, count(*) AS checks, count(*) FILTER (hit) AS anomalies, count(*) FILTER (hit) / count(*) * 100 AS percent
    FROM z GROUP BY 1""",
    uses="gauge",
    doubles="percent",
)
def anomaly_rate(t):
    return stats.anomaly_rate(rolling.zscore(t.gauge(), ["series"]), ["series"])


@query("latest_value", "SELECT series, arg_max(value, ts) AS value, max(ts) AS ts FROM gauge GROUP BY 1", uses="gauge", doubles="value")
def latest_value(t):
    return stats.latest(t.gauge(), ["series"])


ZS = """z AS (SELECT series, event_id, ts, value, (value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) AS z_score
  FROM gauge WINDOW w AS (PARTITION BY series))"""


@query(
    "top_anomalies",
    f"""WITH {ZS}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY round(z_score, 6) DESC, event_id) AS rank
      FROM z WHERE abs(z_score) > 2.5) SELECT series, event_id, z_score, rank FROM r WHERE rank <= 5""",
    uses="gauge",
    doubles="z_score",
)
def top_anomalies(t):
    hits = rolling.zscore(t.gauge(), ["series"]).filter("is_anomaly")
    out = vectors.topk(hits, 5, [F.round("z_score", 6).desc(), F.col("event_id")], at=["series"])
    return out.select("series", "event_id", "z_score", F.col("rank").cast("bigint"))


@query(
    "first_anomalies",
    f"""WITH {ZS}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS rank
      FROM z WHERE abs(z_score) > 2.5) SELECT series, event_id, ts, rank FROM r WHERE rank <= 3""",
    uses="gauge",
)
def first_anomalies(t):
    hits = rolling.zscore(t.gauge(), ["series"]).filter("is_anomaly")
    out = vectors.topk(hits, 3, [F.col("ts"), F.col("event_id")], at=["series"])
    return out.select("series", "event_id", "ts", F.col("rank").cast("bigint"))


@query(
    "scalar_functions",
    """SELECT event_id, hour(ts) AS hour, minute(ts) AS minute, isodow(ts) - 1 AS weekday,
      strftime(ts, '%Y-%m-%d %H:%M') AS stamp, strftime(ts, '%H:%M:%S') AS clock,
      repeat('█', CAST(floor(value / 1000 * 20) AS INT)) AS bar, regexp_full_match(event_type, '.*i.*') AS has_i,
      'unknown' AS endpoint, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      event_type || ' ' || CAST(user_id AS VARCHAR) || ' (' || CAST(user_id % 4 AS VARCHAR) || ')' AS legend,
      CASE WHEN value > 5 THEN 'ELEVATED' ELSE 'Normal' END AS level,
      least(95.0, greatest(5.0, value)) AS clipped, sqrt(value) AS root, CAST(floor(value / 2) AS BIGINT) AS half,
      (epoch_us(ts) - epoch_us(""" + SQL_START + """)) / 1e6 AS since
    FROM events""",
    doubles="clipped root since",
)
def scalar_functions(t):
    labels = F.create_map(F.lit("method"), F.col("event_type"))
    value = F.col("value")
    return t.table("events").withColumn("shard", F.col("user_id") % 4).select(
        "event_id",
        F.hour("ts").cast("bigint").alias("hour"),
        F.minute("ts").cast("bigint").alias("minute"),
        units.weekday(F.col("ts")).cast("bigint").alias("weekday"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("stamp"),
        F.date_format("ts", "HH:mm:ss").alias("clock"),
        text.bar(value / 1000).alias("bar"),
        selectors.matches({"method": ("=~", ".*i.*")}, labels).alias("has_i"),
        selectors.label(labels, "endpoint", "unknown").alias("endpoint"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        text.legend("event_type", "user_id", "shard").alias("legend"),
        text.level(value).alias("level"),
        units.clip(value, 5.0, 95.0).alias("clipped"),
        F.sqrt(value).alias("root"),
        F.floor(value / 2).alias("half"),
        units.seconds_since(F.col("ts"), F.lit(t.start)).alias("since"),
    )
