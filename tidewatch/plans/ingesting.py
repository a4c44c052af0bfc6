"""Queries of event roll-ups and of the text and JSON formats."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidewatch.plans.registry import query
from tidewatch.plans.tables import HOUR
from tidewatch.sources import ingest, rollups

SCRAPE = "CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR END"
BY = ["event_type", "shard"]


def _events(t):
    return t.table("events").withColumn("shard", F.col("user_id") % 4)


@query(
    "counter_rollup",
    f"""WITH b AS (SELECT event_type, user_id % 4 AS shard, {SCRAPE} AS ts, count(*) AS n FROM events GROUP BY 1, 2, 3)
    SELECT event_type, shard, ts, CAST(sum(n) OVER (PARTITION BY event_type, shard ORDER BY ts) AS DOUBLE) AS value FROM b""",
    doubles="value",
)
def counter_rollup(t):
    return rollups.counter(_events(t), BY, HOUR)


@query(
    "gauge_snapshot",
    f"SELECT event_type, {SCRAPE} AS ts, arg_max(value, events.ts) AS value FROM events GROUP BY 1, 2",
    doubles="value",
)
def gauge_snapshot(t):
    return rollups.gauge(_events(t), ["event_type"], HOUR)


@query(
    "histogram_rollup",
    "SELECT series, ts, CASE WHEN le = 'Infinity'::DOUBLE THEN -1 ELSE le END AS le, value, sum FROM buckets",
    uses="buckets",
    doubles="le value sum",
)
def histogram_rollup(t):
    return t.buckets().withColumn("le", F.when(F.col("le") == float("inf"), -1.0).otherwise(F.col("le")))


@query(
    "summary_rollup",
    "SELECT event_type, user_id % 4 AS shard, count(value) AS count, sum(value) AS sum FROM events GROUP BY 1, 2",
    doubles="sum",
)
def summary_rollup(t):
    return rollups.summary(_events(t), BY)


@query(
    "info_join",
    "SELECT c_custkey, c_acctbal AS value, n_name AS nation, n_regionkey AS version FROM customer JOIN nation ON n_nationkey = c_nationkey",
    doubles="value",
)
def info_join(t):
    info = t.table("nation").select(
        F.col("n_nationkey").alias("instance"), F.col("n_name").alias("nation"), F.col("n_regionkey").alias("version")
    )
    samples = t.table("customer").select("c_custkey", F.col("c_nationkey").alias("instance"), F.col("c_acctbal").alias("value"))
    return rollups.with_info(samples, info, ["instance"]).select("c_custkey", "value", "nation", "version")


@query(
    "target_labels",
    "SELECT s_suppkey, s_acctbal AS value, r_name AS job, n_name AS instance, 5 + 10 * n_regionkey AS interval_s FROM supplier "
    "JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey",
    doubles="value",
)
def target_labels(t):
    targets = t.table("nation").join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("target"), F.col("r_name").alias("job"), F.col("n_name").alias("instance"),
        (5 + 10 * F.col("n_regionkey")).alias("interval_s"),
    )
    samples = t.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("target"), F.col("s_acctbal").alias("value"))
    return rollups.with_targets(samples, targets, ["target"]).drop("target")


@query(
    "ingest_text",
    "SELECT 'event_value' AS metric, event_type, CAST(user_id AS VARCHAR) AS user, 'gauge' AS type, value, "
    "epoch_us(ts) // 1000 AS ts_ms FROM events",
    doubles="value",
)
def ingest_text(t):
    """The events written as metric text, and read back."""
    samples = t.table("events").select(
        F.format_string(
            'event_value{event_type="%s",user="%d"} %s %d', "event_type", "user_id", F.col("value").cast("string"),
            F.floor(F.unix_micros("ts") / 1000),
        ).alias("value")
    )
    heads = t.table("events").select("event_type").distinct().select(
        F.explode(F.array(F.lit("# HELP event_value last value"), F.lit("# TYPE event_value gauge"))).alias("value")
    )
    rows = ingest.typed_samples(heads.unionByName(samples))
    return rows.select(
        "metric", F.col("labels")["event_type"].alias("event_type"), F.col("labels")["user"].alias("user"), "type", "value", "ts_ms"
    )


def _scrapes(t):
    """The events as two targets expose them: a gauge, its ``_total`` counter and, of every seventh event, a broken line."""
    target = F.concat(F.lit("host-"), (F.col("user_id") % 2).cast("string"))
    text = F.col("value").cast("string")
    labels = F.format_string('{event_type="%s",path="c:\\\\%d\\"\\n",instance="own"}', "event_type", "user_id")
    stamp = F.floor(F.unix_micros("ts") / 1000).cast("string")
    samples = t.table("events").select(
        target.alias("instance"),
        F.explode(F.array_compact(F.array(
            F.concat(F.lit("load"), labels, F.lit(" "), text, F.lit(" "), stamp),
            F.concat(F.lit("load_total"), labels, F.lit(" "), text, F.lit(" "), stamp, F.lit(' # {trace="x}"} 1')),
            F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('load{event_type="'), F.col("event_type"), F.lit('"x} 1'))),
        ))).alias("line"),
    )
    heads = t.table("events").select(target.alias("instance")).distinct().select(
        "instance",
        F.explode(F.array(F.when(F.col("instance") == "host-0", "# TYPE load gauge").otherwise("# TYPE load untyped"), F.lit("# TYPE load_total counter"))).alias("line"),
    )
    return heads.unionByName(samples)


@query(
    "ingest_targets",
    """SELECT 'host-' || (user_id % 2) AS instance, metric, CASE WHEN metric = 'load_total' THEN 'counter' WHEN user_id % 2 = 0 THEN 'gauge'
      ELSE 'untyped' END AS type, event_type, 'c:' || chr(92) || user_id || '"' || chr(10) AS path, 'own' AS exported_instance, count(*) AS n, sum(value) AS total,
      max(epoch_us(ts) // 1000) AS last_ms
    FROM events, (SELECT unnest(['load', 'load_total']) AS metric) GROUP BY ALL""",
    doubles="total",
)
def ingest_targets(t):
    """Metric text of two targets: types per target and full name, escapes, labels of the target."""
    rows = ingest.typed_samples(_scrapes(t), "line", ["instance"])
    label = lambda name: F.col("labels")[name].alias(name)
    return rows.select(label("instance"), "metric", "type", label("event_type"), label("path"), label("exported_instance"), "value", "ts_ms").groupBy(
        "instance", "metric", "type", "event_type", "path", "exported_instance"
    ).agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("ts_ms").alias("last_ms"))


@query(
    "ingest_rejected",
    """SELECT 'host-' || (user_id % 2) AS instance, 'load{event_type="' || event_type || '"x} 1' AS line, count(*) AS n
    FROM events WHERE event_id % 7 = 0 GROUP BY ALL""",
)
def ingest_rejected(t):
    """Lines of two targets that are no metric text."""
    return ingest.rejected(_scrapes(t), "line").groupBy("instance", "line").agg(F.count("*").alias("n"))


@query(
    "ingest_json",
    "SELECT event_id, 'event_value' AS metric, event_type, ts, value FROM events UNION ALL "
    "SELECT event_id, 'event_value', event_type, ts + INTERVAL 1 SECOND, value FROM events WHERE event_id % 2 = 1",
    doubles="value",
)
def ingest_json(t):
    """The events written as instant (even id) and range responses, and read back."""
    stamp = lambda s: ((F.unix_micros("ts") + s * 1_000_000).cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").cast("string")
    head = '{"status":"success","data":{"resultType":"%s","result":[{"metric":{"__name__":"event_value","event_type":"%s"},'
    text = F.col("value").cast("string")
    docs = t.table("events").select(
        "event_id",
        F.when(
            F.col("event_id") % 2 == 0,
            F.format_string(head + '"value":[%s,"%s"]}]}}', F.lit("vector"), "event_type", stamp(0), text),
        ).otherwise(
            F.format_string(
                head + '"values":[[%s,"%s"],[%s,"%s"]]}]}}', F.lit("matrix"), "event_type", stamp(0), text, stamp(1), text
            )
        ).alias("value"),
    )
    rows = ingest.parse_responses(docs)
    return rows.select("event_id", "metric", F.col("labels")["event_type"].alias("event_type"), "ts", "value")


@query("props_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_parse(t):
    return t.table("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
