"""Queries of the forest, density and live detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.layout import attach
from tidewatch.operators import density, forest, rolling, stats, vectors
from tidewatch.plans.alerting import HOURLY
from tidewatch.plans.registry import query
from tidewatch.plans.tables import HOUR, KINDS
from tidewatch.streaming import detector, rules
from tidewatch.streaming.run import event_stream, run_once
from tidewatch.streaming.ticks import sliding_stats, ticks


def wide(t):
    return t.wide_hours().withColumn("scope", F.lit("all"))


def _single(t):
    rows = rolling.deviation_features(t.gauge(), ["series"], ["ts", "event_id"])
    return forest.detect(
        rows, ["series"], ["event_id"], ["value", "rate_of_change", "deviation_from_rolling"], 100, 0.05
    )


@query("iforest_single")
def iforest_single(t):
    return _single(t).select("series", "event_id", "value", "score", "decision", "is_anomaly")


@query("iforest_top")
def iforest_top(t):
    hits = _single(t).filter("is_anomaly")
    out = vectors.topk(hits, 5, [F.col("score"), F.col("event_id")], at=["series"])
    return out.select("series", "event_id", "value", "rate_of_change", "score", "rank")


@query("iforest_multi")
def iforest_multi(t):
    return forest.detect(wide(t), ["scope"], ["ts"], KINDS[:4], 200, 0.03)


@query("iforest_corr")
def iforest_corr(t):
    rows = rolling.change_features(wide(t), KINDS, ["ts"], ["scope"])
    return forest.detect(rows, ["scope"], ["ts"], [*KINDS, *[f"{k}_change" for k in KINDS]], 200, 0.05)


@query("iforest_sweep")
def iforest_sweep(t):
    scored = forest.detect(wide(t), ["scope"], ["ts"], KINDS, 100)
    return forest.sweep(scored, ["scope"], [0.01, 0.02, 0.03, 0.05, 0.1])


SCALED = [f"{k}_scaled" for k in KINDS]
SCALED_SQL = "sc AS (SELECT ts, " + ", ".join(
    f'("{k}" - avg("{k}") OVER ()) / stddev_pop("{k}") OVER () AS {k}_scaled' for k in KINDS
) + " FROM wide_hours)"
NEAR_SQL = SCALED_SQL + ", nb AS (SELECT a.ts, count(*) AS neighbours FROM sc a JOIN sc b ON " + " + ".join(
    f"pow(a.{c} - b.{c}, 2)" for c in SCALED
) + " <= {eps} * {eps} GROUP BY 1)"


def scaled(t):
    return stats.standard_scale(wide(t), KINDS, ["scope"])


@query("eps_neighbors", f"WITH {NEAR_SQL.format(eps=1.5)} SELECT ts, neighbours FROM nb", uses="wide_hours")
def eps_neighbors(t):
    return density.eps_neighbours(scaled(t), ["scope"], "ts", SCALED).select("ts", F.col("neighbours").cast("bigint"))


@query("dbscan_core", f"WITH {NEAR_SQL.format(eps=0.8)} SELECT ts, neighbours >= 5 AS is_core FROM nb", uses="wide_hours")
def dbscan_core(t):
    rows = scaled(t)
    sites = density.core_sites(rows, ["scope"], "ts", SCALED, 0.8, 5)
    return rows.join(sites, ["scope", *SCALED]).select("ts", F.col("core").alias("is_core"))


def _clusters_sql(eps: float) -> str:
    """Expressions ending in ``cl`` (ts, cluster, is_core): labels spread over core pairs until nothing is left to spread."""
    near = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in SCALED)
    return f"""{SCALED_SQL},
pr AS (SELECT a.ts AS a, b.ts AS b FROM sc a JOIN sc b ON {near} <= {eps} * {eps}),
co AS (SELECT a AS ts FROM pr GROUP BY 1 HAVING count(*) >= 5),
ed AS (SELECT a, b FROM pr SEMI JOIN co ON co.ts = pr.a),
ce AS (SELECT a, b FROM ed SEMI JOIN co ON co.ts = ed.b),
lb AS (SELECT 0 AS turn, ts, ts AS label FROM co
  UNION ALL SELECT any_value(turn) + 1, ce.b, min(label) FROM lb JOIN ce ON ce.a = lb.ts WHERE turn < 60 GROUP BY ce.b),
fi AS (SELECT ts, dense_rank() OVER (ORDER BY label) - 1 AS cluster FROM lb WHERE turn = 60),
cl AS (SELECT sc.ts, coalesce(any_value(own.cluster), min(other.cluster), -1)::BIGINT AS cluster, any_value(own.cluster) IS NOT NULL AS is_core
  FROM sc LEFT JOIN fi own ON own.ts = sc.ts LEFT JOIN ed ON ed.b = sc.ts LEFT JOIN fi other ON other.ts = ed.a GROUP BY sc.ts)"""


@query(
    "dbscan",
    f"WITH RECURSIVE {_clusters_sql(1.5)} SELECT ts, " + ", ".join(f'"{k}"' for k in KINDS) + ", cluster, is_core FROM cl JOIN wide_hours USING (ts)",
    uses="wide_hours",
    doubles=" ".join(KINDS),
)
def dbscan(t):
    return density.dbscan(scaled(t), ["scope"], "ts", SCALED, 1.5, 5).select("ts", *KINDS, "cluster", "is_core")


@query("dbscan_sizes", f"WITH RECURSIVE {_clusters_sql(0.8)} SELECT cluster, count(*) AS n FROM cl GROUP BY 1", uses="wide_hours")
def dbscan_sizes(t):
    return density.cluster_sizes(density.dbscan(scaled(t), ["scope"], "ts", SCALED, 0.8, 5))


@query(
    "cluster_count",
    f"WITH RECURSIVE {_clusters_sql(0.8)} SELECT count(DISTINCT cluster) FILTER (cluster >= 0) AS clusters, "
    "count(*) FILTER (cluster < 0) AS noise FROM cl",
    uses="wide_hours",
)
def cluster_count(t):
    return density.cluster_count(density.dbscan(scaled(t), ["scope"], "ts", SCALED, 0.8, 5))


def batch_ticks(t):
    """Complete four-hour ticks; the one still open at the last event is left out, as on the stream."""
    out = ticks(t.gauge(), KINDS, "4 hours", metric="series")
    last = t.gauge().agg(F.max("ts").alias("_last"))
    return attach(out.withColumn("_one", F.lit(1)), last.withColumn("_one", F.lit(1)), ["_one"]).filter("tick <= _last").drop("_one", "_last")


SHARDS = 4


def sharded(events):
    """Samples with the shard of the user they come from, as a host's label would be."""
    shard = F.concat(F.lit("shard-"), F.pmod(F.col("user_id"), F.lit(SHARDS)).cast("string"))
    return events.select(F.coalesce(shard, F.lit("none")).alias("shard"), F.col("event_type").alias("series"), "ts", "value")


def shard_ticks(t):
    """Complete four-hour ticks of each shard that eight hours of delay leave closed at the last event, as on the stream."""
    out = ticks(sharded(t.table("events")), KINDS, "4 hours", metric="series", scope="shard")
    closed = t.table("events").filter(F.col("event_type").isin(list(KINDS))).agg((F.max("ts") - F.expr("INTERVAL 8 HOURS")).alias("_closed"))
    return out.join(closed, F.col("tick") <= F.col("_closed")).drop("_closed")


def stream_ticks(t):
    return ticks(sharded(event_stream(t.spark, t.sf_dir)), KINDS, "4 hours", metric="series", scope="shard", delay="8 hours")


SHARD_TICKS = f"""sh AS (SELECT coalesce('shard-' || (((user_id % {SHARDS}) + {SHARDS}) % {SHARDS})::VARCHAR, 'none') AS scope,
  time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '2024-01-01') + INTERVAL 4 HOUR AS tick, event_type, ts FROM events
  WHERE event_type IN ({', '.join(f"'{k}'" for k in KINDS)})),
st AS (SELECT scope, tick, row_number() OVER (PARTITION BY scope ORDER BY tick) AS checks FROM
  (SELECT scope, tick FROM sh GROUP BY ALL HAVING count(DISTINCT event_type) = {len(KINDS)}
   AND tick <= (SELECT max(ts) - INTERVAL 8 HOUR FROM sh)))"""


TICKS = """g AS (SELECT time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '2024-01-01') + INTERVAL 4 HOUR AS tick, series, ts, value FROM gauge),
tk AS (SELECT tick, """ + ", ".join(
    f"arg_max(value, ts) FILTER (series = '{k}') AS \"{k}\"" for k in KINDS
) + """ FROM g GROUP BY 1 HAVING count(DISTINCT series) = 5 AND tick <= (SELECT max(ts) FROM gauge)),
nm AS (SELECT *, row_number() OVER (ORDER BY tick) AS checks FROM tk),
ep AS (SELECT *, CASE WHEN checks >= 30 THEN (checks - 30) // 50 END AS epoch FROM nm)"""


@query(
    "retrain_epochs",
    f"WITH {TICKS} SELECT tick, checks, coalesce(epoch, -1) AS epoch, coalesce(epoch * 50 + 30, -1) AS train_to, "
    "CASE WHEN epoch IS NULL THEN -1 ELSE greatest(epoch * 50 + 30 - 199, 1) END AS train_from FROM ep",
    uses="gauge",
)
def retrain_epochs(t):
    known = [F.coalesce(F.col(c), F.lit(-1)).alias(c) for c in ("epoch", "train_to", "train_from")]
    rows = detector.epochs(batch_ticks(t))
    # NULL in the warm-up; -1 here, so that whole numbers stay whole in any client
    return rows.select("tick", "checks", *known)


@query(
    "explain_stream",
    f"WITH {TICKS}, e AS (SELECT DISTINCT epoch FROM ep WHERE epoch IS NOT NULL), st AS (SELECT e.epoch, "
    + ", ".join(f'avg("{k}") AS {k}_m, stddev_pop("{k}") AS {k}_s' for k in KINDS)
    + " FROM e JOIN nm ON checks BETWEEN e.epoch * 50 + 30 - 199 AND e.epoch * 50 + 30 GROUP BY 1), z AS ("
    + " UNION ALL ".join(
        f"SELECT tick, ep.epoch, '{k}' AS metric, (\"{k}\" - {k}_m) / {k}_s AS z FROM ep JOIN st ON st.epoch = ep.epoch WHERE {k}_s > 0"
        for k in KINDS
    )
    + ") SELECT tick, epoch, metric, z, CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS direction FROM z WHERE abs(z) > 1.5",
    uses="gauge",
    doubles="z",
)
def explain_stream(t):
    rows = detector.explain_batch(batch_ticks(t), KINDS)
    return rows.select("tick", "epoch", F.explode("reason").alias("r")).select("tick", "epoch", "r.metric", "r.z", "r.direction")


@query("detect_batch")
def detect_batch(t):
    return detector.detect_batch(shard_ticks(t), KINDS)


@query("stream_detect")
def stream_detect(t):
    return run_once(detector.detect_stream(stream_ticks(t), KINDS))


@query("stream_window")
def stream_window(t):
    return run_once(detector.detect_stream(stream_ticks(t), KINDS)).select("scope", "tick", "checks", "window_rows", "status")


@query(
    "stream_epochs",
    f"WITH {SHARD_TICKS} SELECT scope, tick, checks, least(checks, 200)::INTEGER AS window_rows, "
    "CASE WHEN checks >= 30 THEN (checks - 30) // 50 ELSE -1 END AS epoch, checks < 30 AS collecting FROM st",
)
def stream_epochs(t):
    """Which model judges each tick of the live detector, and on how much history."""
    out = run_once(detector.detect_stream(stream_ticks(t), KINDS))
    epoch = F.coalesce("epoch", F.lit(-1)).alias("epoch")
    return out.select("scope", "tick", "checks", "window_rows", epoch, (F.col("status") == detector.COLLECTING).alias("collecting"))


@query("stream_sliding")
def stream_sliding(t):
    events = event_stream(t.spark, t.sf_dir).select(F.col("event_type").alias("series"), "ts", "value")
    return run_once(sliding_stats(events, ["series"], "6 hours", "1 hour", "2 hours"))


@query("stream_alerts")
def stream_alerts(t):
    """Hourly event counts of each type as a stream of vectors for one rule."""
    events = event_stream(t.spark, t.sf_dir)
    hours = events.withWatermark("ts", "2 hours").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.max("value").alias("value"))
    vectors_ = hours.select(
        F.lit("HighCpuUsage").alias("rule"), F.col("event_type").alias("instance"), F.col("window.end").alias("eval_ts"), "value",
        F.window_time("window").alias("event_time"),
    )
    return run_once(rules.alert_stream(vectors_, HOURLY, HOUR))
