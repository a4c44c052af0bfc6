"""Queries of alert rules, notifications and dashboard panels."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from tidewatch.model import RULES
from tidewatch.operators import alerts, overtime, quantile, selectors, stats, vectors
from tidewatch.plans.algebra import CUMULATIVE, PHIS, quantile_sql
from tidewatch.plans.registry import query
from tidewatch.plans.tables import HOUR, SQL_END
from tidewatch.session import settle
from tidewatch.sources import ingest, read

RULE = {r.name: r for r in RULES}
# The rules as they are, with hold times of hours for hourly steps.
HOURLY = tuple(
    replace(RULE[name], hold=timedelta(hours=hours))
    for name, hours in (
        ("HighCpuUsage", 2), ("HighMemoryUsage", 2), ("DiskSpaceLow", 3), ("HighErrorRate", 1), ("HighLatency", 2), ("InstanceDown", 1),
    )
)


def is_error():
    return F.col("event_type").rlike("^(?:err.*)$")


def cpu_vector(t, rates=None):
    idle = (t.shard_rates() if rates is None else rates).filter("event_type = 'view'").withColumn("rate", F.col("value") / 4)
    return vectors.busy_percent(idle, ["shard"]).select(
        F.lit("HighCpuUsage").alias("rule"), F.col("shard").alias("instance"), "eval_ts", F.col("busy").alias("value")
    )


def memory_vector(t, rule="HighMemoryUsage", available="avg"):
    """Share of the six-hour peak that the six-hour mean (or minimum) leaves free."""
    rows = overtime.over_time(t.gauge(), ["series"], timedelta(hours=6), HOUR, (available, "max"), t.start, t.end)
    labels = F.create_map(F.lit("instance"), F.col("series"))
    free = rows.select(labels.alias("labels"), "eval_ts", F.col(available).alias("value"))
    total = rows.select(labels.alias("labels"), "eval_ts", F.col("max").alias("value"))
    out = vectors.used_percent(free, total, ["eval_ts"])
    return out.select(F.lit(rule).alias("rule"), F.col("labels")["instance"].alias("instance"), "eval_ts", "value")


def disk_vector(t):
    return memory_vector(t, "DiskSpaceLow", "min")


def error_vector(t, rates=None):
    ratio = vectors.ratio_of_sums(t.shard_rates() if rates is None else rates, is_error(), ["shard"]).filter("ratio IS NOT NULL")
    return ratio.select(F.lit("HighErrorRate").alias("rule"), F.col("shard").alias("instance"), "eval_ts", F.col("ratio").alias("value"))


def latency_vector(t):
    p95 = quantile.histogram_quantile(t.bucket_rates(), ["series", "eval_ts"], {"p95": 0.95}).filter("p95 IS NOT NULL")
    return p95.select(
        F.lit("HighLatency").alias("rule"), F.col("series").alias("instance"), "eval_ts", (F.col("p95") / 200).alias("value")
    )


def up_samples(t):
    """1 for each hour with events of the series, else 0."""
    return t.hourly_grid().select(
        "series", "ts", F.when(F.col("value").isNull(), 0.0).otherwise(1.0).alias("value")
    )


def down_vector(t):
    return up_samples(t).select(
        F.lit("InstanceDown").alias("rule"), F.col("series").alias("instance"), F.col("ts").alias("eval_ts"), "value"
    )


def rule_vectors(t):
    rates = settle(t.shard_rates())  # read by two rules
    return (
        cpu_vector(t, rates).unionByName(memory_vector(t)).unionByName(disk_vector(t))
        .unionByName(error_vector(t, rates)).unionByName(latency_vector(t)).unionByName(down_vector(t))
    )


VECTORS = {
    "HighCpuUsage": "SELECT 'HighCpuUsage' AS rule, shard AS instance, eval_ts, 100 - avg(value / 4) * 100 AS value "
    "FROM shard_rates WHERE event_type = 'view' GROUP BY ALL",
    "HighMemoryUsage": "SELECT 'HighMemoryUsage' AS rule, series AS instance, eval_ts, (1 - avg(value) / nullif(max(value), 0)) * 100 "
    "AS value FROM gauge JOIN evals ON ts BETWEEN eval_ts - INTERVAL 6 HOUR AND eval_ts GROUP BY ALL",
    "HighErrorRate": "SELECT 'HighErrorRate' AS rule, shard AS instance, eval_ts, sum(value) FILTER (event_type = 'error') / "
    "nullif(sum(value), 0) AS value FROM shard_rates GROUP BY ALL HAVING value IS NOT NULL",
    "HighLatency": f"SELECT 'HighLatency' AS rule, series AS instance, eval_ts, {quantile_sql(0.95)} / 200 AS value "
    f"FROM ({CUMULATIVE}) GROUP BY ALL HAVING value IS NOT NULL",
    "InstanceDown": "SELECT 'InstanceDown' AS rule, series AS instance, ts AS eval_ts, CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END "
    "AS value FROM hourly_grid",
}
VECTORS["DiskSpaceLow"] = VECTORS["HighMemoryUsage"].replace("HighMemoryUsage", "DiskSpaceLow").replace("avg(value)", "min(value)")
USES = "shard_rates bucket_rates gauge evals hourly_grid"


def states_sql(*names: str) -> str:
    """Expression ``states`` for the named rules."""
    rules = [r for r in HOURLY if r.name in names]
    hit = " OR ".join(f"(rule = '{r.name}' AND value {'=' if r.op == '==' else r.op} {r.limit})" for r in rules)
    pick = lambda f: "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {f(r)}" for r in rules) + " END"
    hold = pick(lambda r: f"INTERVAL {int(r.hold.total_seconds() // 3600)} HOUR")
    severity = pick(lambda r: f"'{r.severity}'")
    return f"""
vec AS ({" UNION ALL ".join(VECTORS[r.name] for r in rules)}),
hit AS (SELECT *, {severity} AS severity,
  eval_ts - to_hours(CAST(row_number() OVER (PARTITION BY rule, instance ORDER BY eval_ts) AS INT)) AS island FROM vec WHERE {hit}),
states AS (SELECT rule, severity, instance, eval_ts, value, min(eval_ts) OVER (PARTITION BY rule, instance, island) AS active_since,
  CASE WHEN eval_ts - min(eval_ts) OVER (PARTITION BY rule, instance, island) >= {hold} THEN 'firing' ELSE 'pending' END AS state FROM hit)"""


def states(t):
    return alerts.alert_states(rule_vectors(t), HOURLY, ["instance"], HOUR)


ALL = states_sql(*RULE)


@query("alert_states", f"WITH {ALL} SELECT * FROM states", uses=USES, doubles="value")
def alert_states(t):
    return states(t)


def _canned(name: str, vector):
    uses = {
        "HighCpuUsage": "shard_rates", "HighErrorRate": "shard_rates", "HighLatency": "bucket_rates", "InstanceDown": "hourly_grid",
    }.get(name, "gauge evals")

    @query(name, f"WITH {states_sql(name)} SELECT * FROM states", uses=uses, doubles="value")
    def run(t):
        return alerts.alert_states(vector(t), HOURLY, ["instance"], HOUR)


_canned("HighCpuUsage", cpu_vector)
_canned("HighMemoryUsage", memory_vector)
_canned("DiskSpaceLow", disk_vector)
_canned("HighErrorRate", error_vector)
_canned("HighLatency", latency_vector)
_canned("InstanceDown", down_vector)


@query(
    "HighErrorRate_strict",
    """WITH e AS (SELECT event_type, shard, eval_ts, value / nullif(value, 0) AS value FROM shard_rates WHERE event_type = 'error')
    SELECT * FROM e WHERE value > 0.05""",
    uses="shard_rates",
    doubles="value",
)
def high_error_rate_strict(t):
    """The rule as written: each error series over itself, so 1 wherever errors occur."""
    rates = t.shard_rates().withColumn(
        "labels", F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("shard"), F.col("shard"))
    )
    ratio = vectors.divide(rates.filter(is_error()), rates, ["eval_ts"])
    return selectors.keep(ratio, ">", 0.05).select(
        F.col("labels")["event_type"].alias("event_type"), F.col("labels")["shard"].alias("shard"), "eval_ts", "value"
    )


@query(
    "active_alerts",
    f"WITH {ALL} SELECT eval_ts, count(*) AS value FROM states WHERE state = 'firing' GROUP BY 1",
    uses=USES,
)
def active_alerts(t):
    return alerts.active_alerts(states(t))


@query(
    "panel_active_alerts",
    f"""WITH {ALL} SELECT e.eval_ts, coalesce(n.value, 0) AS value FROM evals e LEFT JOIN
    (SELECT eval_ts, count(*) AS value FROM states WHERE state = 'firing' GROUP BY 1) n ON n.eval_ts = e.eval_ts""",
    uses=USES,
)
def panel_active_alerts(t):
    firing = alerts.active_alerts(states(t))
    return vectors.or_default(firing, vectors.steps(t.spark, t.start, t.end, HOUR), 0)


@query(
    "alert_annotations",
    f"""WITH {ALL} SELECT rule, instance, eval_ts, CASE rule """
    + " ".join(f"WHEN '{r.name}' THEN replace('{r.summary}', '{{instance}}', instance)" for r in RULES)
    + " END AS summary FROM states",
    uses=USES,
)
def alert_annotations(t):
    return alerts.annotate(states(t), RULES, ["instance"]).select("rule", "instance", "eval_ts", "summary")


NOTIFY = f"""{ALL},
grp AS (SELECT rule, severity, eval_ts, count(*) AS alerts, string_agg(instance, ',' ORDER BY instance) AS members
  FROM states WHERE state = 'firing' GROUP BY 1, 2, 3),
mrk AS (SELECT *, lag(eval_ts) OVER w AS prev, lag(members) OVER w AS was, lead(eval_ts) OVER w AS nxt FROM grp
  WINDOW w AS (PARTITION BY rule, severity ORDER BY eval_ts)),
opn AS (SELECT *, prev IS NULL OR eval_ts - prev > INTERVAL 1 HOUR AS fresh FROM mrk),
seg AS (SELECT *, sum(CASE WHEN fresh OR members <> was THEN 1 ELSE 0 END) OVER (PARTITION BY rule, severity ORDER BY eval_ts) AS seg,
  nxt IS NULL OR nxt - eval_ts > INTERVAL 1 HOUR AS closes FROM opn),
run AS (SELECT rule, severity, seg, min(eval_ts) AS a, max(eval_ts) + INTERVAL 1 HOUR AS b, bool_or(fresh) AS fresh, bool_or(closes) AS closes,
  arg_min(alerts, eval_ts) AS alerts FROM seg GROUP BY 1, 2, 3),
notices AS (SELECT rule, severity, sent_at, 'firing' AS status, alerts, sent_at > a + INTERVAL 20 SECOND AS is_repeat FROM (
    SELECT *, unnest(generate_series(a + INTERVAL 10 SECOND, b - INTERVAL 1 MICROSECOND, INTERVAL 4 HOUR)) AS sent_at FROM run)
  UNION ALL SELECT rule, severity, b + INTERVAL 10 SECOND, 'resolved', alerts, false FROM run WHERE closes)"""


def _notices(t):
    return alerts.notifications(states(t), ["instance"], HOUR, repeat=timedelta(hours=4))


@query("alert_notify", f"WITH {NOTIFY} SELECT * FROM notices", uses=USES)
def alert_notify(t):
    return _notices(t)


@query(
    "alert_payload",
    f"WITH {NOTIFY} SELECT status, count(*) AS payloads, CAST(sum(alerts) AS BIGINT) AS alerts FROM notices GROUP BY 1",
    uses=USES,
)
def alert_payload(t):
    return ingest.payload_rollup(alerts.payloads(_notices(t)))


SILENCES = (
    ("InstanceDown", "2024-01-05 00:00:00", "2024-01-12 00:00:00"),
    ("InstanceDown", "2024-01-20 06:00:00", "2024-01-21 00:00:00"),
    ("HighMemoryUsage", "2024-01-10 00:00:00", "2024-01-11 00:00:00"),
)


@query(
    "alert_silence",
    f"""WITH {ALL}, s(rule, a, b) AS (VALUES """
    + ", ".join(f"('{r}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for r, a, b in SILENCES)
    + """) SELECT rule, instance, eval_ts, state FROM states x WHERE NOT EXISTS
      (SELECT 1 FROM s WHERE s.rule = x.rule AND x.eval_ts >= s.a AND x.eval_ts < s.b)""",
    uses=USES,
)
def alert_silence(t):
    rows = states(t)
    table = t.spark.createDataFrame(SILENCES, "rule string, a string, b string").select(
        "rule", F.col("a").cast("timestamp").alias("starts_at"), F.col("b").cast("timestamp").alias("ends_at")
    )
    return alerts.silence(rows, table).select("rule", "instance", "eval_ts", "state")


@query(
    "alert_dedup",
    f"""WITH {ALL} SELECT rule, instance, min(eval_ts) AS first_ts, max(eval_ts) AS last_ts,
    count(*) AS repeats FROM states WHERE state = 'firing' GROUP BY rule, instance, active_since""",
    uses=USES,
)
def alert_dedup(t):
    rows = states(t)
    return alerts.deduplicate(rows, ["instance"]).select("rule", "instance", "first_ts", "last_ts", "repeats")


@query(
    "alert_route",
    f"""WITH {ALL} SELECT rule, instance, eval_ts,
    CASE severity WHEN 'critical' THEN 'pager' ELSE 'default' END AS receiver FROM states WHERE state = 'firing'""",
    uses=USES,
)
def alert_route(t):
    rows = states(t)
    return alerts.route(rows.filter("state = 'firing'"), {"critical": "pager"}).select("rule", "instance", "eval_ts", "receiver")


@query(
    "target_health",
    f"""WITH u AS (SELECT series, ts, CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END AS value FROM hourly_grid),
    s AS (SELECT series, arg_max(value, ts) AS up, max(ts) AS last_sample, max(ts) FILTER (value = 1) AS last_up FROM u GROUP BY 1)
    SELECT *, epoch({SQL_END} - last_sample) AS age_seconds, CASE WHEN {SQL_END} - last_sample > INTERVAL 2 HOUR THEN 'stale'
      WHEN up = 0 THEN 'down' ELSE 'up' END AS health FROM s""",
    uses="hourly_grid",
    doubles="up age_seconds",
)
def target_health(t):
    return alerts.target_health(up_samples(t), ["series"], t.end, timedelta(hours=2))


@query("panel_request_rate", "SELECT event_type, shard, eval_ts, value FROM shard_rates", uses="shard_rates", doubles="value")
def panel_request_rate(t):
    return t.shard_rates()


@query(
    "panel_latency_p95",
    f"WITH b AS ({CUMULATIVE}) SELECT series, eval_ts, {quantile_sql(0.95)} AS p95 FROM b GROUP BY 1, 2",
    uses="bucket_rates",
    doubles="p95",
)
def panel_latency_p95(t):
    return quantile.histogram_quantile(t.bucket_rates(), ["series", "eval_ts"], {"p95": 0.95})


@query(
    "panel_error_pct",
    "SELECT eval_ts, sum(value) FILTER (event_type = 'error') / nullif(sum(value), 0) * 100 AS percent FROM shard_rates GROUP BY 1",
    uses="shard_rates",
    doubles="percent",
)
def panel_error_pct(t):
    out = vectors.ratio_of_sums(t.shard_rates(), is_error())
    return out.select("eval_ts", (F.col("ratio") * 100).alias("percent"))


@query(
    "panel_cpu",
    "SELECT eval_ts, 100 - avg(value / 4) * 100 AS busy FROM shard_rates WHERE event_type = 'view' GROUP BY 1",
    uses="shard_rates",
    doubles="busy",
)
def panel_cpu(t):
    return vectors.busy_percent(t.shard_rates().filter("event_type = 'view'").withColumn("rate", F.col("value") / 4))


@query("panel_memory", f"SELECT instance, eval_ts, value FROM ({VECTORS['HighMemoryUsage']})", uses="gauge evals", doubles="value")
def panel_memory(t):
    return memory_vector(t).select("instance", "eval_ts", "value")


FRAME = """frame AS (SELECT g.series, e.eval_ts, g.value, (epoch_us(g.ts) - epoch_us(e.eval_ts)) / 1e6 AS x
  FROM gauge g JOIN evals e ON g.ts BETWEEN e.eval_ts - INTERVAL {hours} HOUR AND e.eval_ts),
line AS (SELECT series, eval_ts, regr_intercept(value, x) + regr_slope(value, x) * {ahead} AS predicted FROM frame
  GROUP BY 1, 2 HAVING count(*) >= 2)"""


@query(
    "disk_full_4h",
    f"WITH {FRAME.format(hours=12, ahead=4 * 3600)} SELECT * FROM line WHERE predicted < 0",
    uses="gauge evals",
    doubles="predicted",
)
def disk_full_4h(t):
    rows = overtime.regress_over_time(t.gauge(), ["series"], timedelta(hours=12), HOUR, timedelta(hours=4), t.start, t.end)
    return selectors.keep(rows, "<", 0.0, "predicted").select("series", "eval_ts", "predicted")


@query(
    "memory_in_1h",
    f"WITH {FRAME.format(hours=24, ahead=3600)} SELECT * FROM line",
    uses="gauge evals",
    doubles="predicted",
)
def memory_in_1h(t):
    rows = overtime.regress_over_time(t.gauge(), ["series"], timedelta(hours=24), HOUR, HOUR, t.start, t.end)
    return rows.select("series", "eval_ts", "predicted")


@query(
    "endpoint_request_rate",
    "SELECT event_type AS endpoint, eval_ts, sum(value) AS sum FROM shard_rates GROUP BY 1, 2",
    uses="shard_rates",
    doubles="sum",
)
def endpoint_request_rate(t):
    return vectors.aggregate(t.shard_rates().withColumnRenamed("event_type", "endpoint"), ["sum"], ["endpoint"])


@query(
    "latency_percentiles",
    f"""WITH merged AS (SELECT 'all' AS series, eval_ts, le, sum(value) AS value FROM bucket_rates GROUP BY 2, 3), b AS (
    {CUMULATIVE.replace('bucket_rates', 'merged')}) SELECT eval_ts, """
    + ", ".join(f"{quantile_sql(phi)} AS {name}" for name, phi in PHIS.items())
    + " FROM b GROUP BY 1",
    uses="bucket_rates",
    doubles=" ".join(PHIS),
)
def latency_percentiles(t):
    return quantile.histogram_quantile(t.bucket_rates(), ["eval_ts"], PHIS)


@query(
    "cpu_range_stats",
    """WITH a AS (SELECT s.series, e.eval_ts, g.value FROM (SELECT DISTINCT series FROM gauge) s CROSS JOIN evals e
    ASOF JOIN gauge g ON g.series = s.series AND e.eval_ts >= g.ts WHERE g.ts > e.eval_ts - INTERVAL 1 HOUR)
    SELECT series, count(value) AS n, avg(value) AS mean, max(value) AS max, min(value) AS min, stddev_samp(value) AS std,
    max(value) - min(value) AS range FROM a GROUP BY 1""",
    uses="gauge evals",
    doubles="mean max min std range",
)
def cpu_range_stats(t):
    samples = t.gauge().withColumn("metric", F.lit("cpu"))
    return stats.describe(read.range_read(samples, "cpu", ["series"], t.start, t.end, HOUR, HOUR), ["series"])


@query(
    "sliding_avg",
    """WITH w AS (SELECT event_type AS series, value, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 5 HOUR, date_trunc('hour', ts),
      INTERVAL 1 HOUR)) AS window_start FROM events)
    SELECT series, CAST(window_start AS TIMESTAMP) AS window_start, avg(value) AS avg, max(value) AS max, count(*) AS n FROM w GROUP BY 1, 2""",
    doubles="avg max",
)
def sliding_avg(t):
    from tidewatch.streaming.ticks import sliding_stats

    return sliding_stats(t.gauge(), ["series"], "6 hours", "1 hour").select("series", "window_start", "avg", "max", "n")
