"""Worked numbers of rates, quantiles, selectors, alerts and roll-ups."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import humanize_percentage, joined_reasons
from tidewatch.model import RESOURCES, RULES, Rule, series_id, spec_table
from tidewatch.operators import alerts, capacity, grid, linear, overtime, quantile, rolling, selectors, stats, vectors

MIN = timedelta(minutes=1)


def rate(frame, span, step, **kw):
    rows = overtime.counter_over_time(frame, ["series"], span, step, **kw).collect()
    return {(r.series, r.eval_ts): r for r in rows}


def test_plain_rate(series):
    frame = series({"a": [(60 * i, 1000 + 60 * i) for i in range(6)]})
    row = rate(frame, 5 * MIN, MIN, mode="plain")["a", datetime(1970, 1, 1, 0, 5)]
    assert row.rate == pytest.approx(1.0) and row.increase == pytest.approx(300)


def test_extrapolated_rate_and_reset(series):
    frame = series({"a": [(0, 342), (15, 350), (30, 371)], "r": [(0, 10), (10, 20), (20, 5), (30, 15)]})
    got = rate(frame, timedelta(seconds=30), timedelta(seconds=30))
    assert got["a", datetime(1970, 1, 1, 0, 0, 30)].increase == pytest.approx(29)
    assert got["a", datetime(1970, 1, 1, 0, 0, 30)].rate == pytest.approx(0.9667, abs=1e-4)
    # 10 up, reset to 5, 10 up
    assert got["r", datetime(1970, 1, 1, 0, 0, 30)].increase == pytest.approx(25)


def test_rate_needs_two_samples_and_a_counter_from_zero_is_not_overshot(series):
    frame = series({"one": [(30, 5)], "z": [(50, 1), (110, 4)]})
    got = rate(frame, 2 * MIN, 2 * MIN)
    assert ("one", datetime(1970, 1, 1, 0, 2)) not in got
    # towards zero at most 20 s before the first sample, then half a gap is not exceeded at the end
    assert got["z", datetime(1970, 1, 1, 0, 2)].increase == pytest.approx(3 * (60 + 20 + 10) / 60)


def test_closed_frame_counts_both_ends(series):
    frame = series({"a": [(0, 1), (60, 2), (120, 3)]})
    rows = overtime.over_time(frame, ["series"], 2 * MIN, MIN, ("count", "sum", "min", "last")).collect()
    at = {r.eval_ts.minute: r for r in rows}
    assert at[2]["count"] == 3 and at[2]["sum"] == 6 and at[2]["min"] == 1 and at[2]["last"] == 3
    assert at[4]["count"] == 1 and 5 not in at


def test_stddev_of_large_values(series):
    frame = series({"a": [(15 * i, 8e9 + i % 2) for i in range(1, 9)]})
    rows = overtime.over_time(frame, ["series"], 2 * MIN, MIN, ("stddev",)).collect()
    assert [r.stddev for r in rows if r.eval_ts.minute == 2] == [pytest.approx(0.5)]


def test_regression_of_a_line(series):
    frame = series({"a": [(1.7e9 + 15 * i, 5 + 2 * 15 * i) for i in range(20)], "one": [(1.7e9, 1)]})
    rows = overtime.regress_over_time(frame, ["series"], 5 * MIN, MIN, timedelta(hours=1)).collect()
    assert rows and all(r.series == "a" and r.deriv == pytest.approx(2.0) for r in rows)


def test_asof_is_open_at_the_old_end(series):
    frame = series({"a": [(60, 7)]})
    minutes = sorted(r.eval_ts.minute for r in grid.asof_grid(frame, ["series"], MIN, 5 * MIN).collect())
    assert minutes == [1, 2, 3, 4, 5]


def test_regularize_from_first_sample(series):
    frame = series({"a": [(10, 1), (75, 2), (200, 3)]})
    rows = sorted((r.ts.minute * 60 + r.ts.second, r.value) for r in grid.regularize(frame, ["series"], MIN).collect())
    assert rows == [(10, 1), (70, 1), (130, 2), (190, 2)]


def test_bucket_quantiles(spark):
    inf = float("inf")
    rows = [("a", 0.1, 3200.0), ("a", 0.5, 3700.0), ("a", 1.0, 3850.0), ("a", inf, 3900.0),
            ("nofin", inf, 3.0), ("noinf", 1.0, 3.0), ("zero", 1.0, 0.0), ("zero", inf, 0.0),
            ("dip", 1.0, 5.0), ("dip", 2.0, 4.0), ("dip", inf, 10.0)]
    frame = spark.createDataFrame(rows, "s string, le double, value double")
    phis = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "low": -1.0, "high": 2.0}
    got = {r.s: r for r in quantile.histogram_quantile(frame, ["s"], phis).collect()}
    assert [got["a"][p] for p in ("p50", "p90", "p95", "p99")] == pytest.approx([0.0609375, 0.348, 0.5166667, 1.0])
    assert got["a"].low == -inf and got["a"].high == inf
    assert all(got[s].p50 is None for s in ("nofin", "noinf", "zero"))
    assert got["dip"].p50 == pytest.approx(1.0)


def test_matchers(spark):
    rows = [({"status": "500", "fstype": "tmpfs"},), ({"status": "5001"},), ({"status": "200"},), ({},)]
    frame = spark.createDataFrame(rows, "labels map<string,string>")
    count = lambda **m: frame.filter(selectors.matches(m)).count()
    assert count(status=("=~", "5..")) == 1
    assert count(status=("!~", "5..")) == 3
    assert count(fstype=("!=", "tmpfs")) == 3
    assert count(status=("=", "")) == 1
    assert count(status=("=~", "5.*"), fstype=("=", "")) == 1


def test_sum_by(spark):
    rows = [("GET", "a", 0.9533), ("GET", "b", 0.0467), ("POST", "c", 0.1267), ("POST", "d", 0.0033), ("GET", "e", 0.28)]
    frame = spark.createDataFrame(rows, "method string, endpoint string, value double")
    total = vectors.aggregate(frame, ["sum"], at=[]).first()["sum"]
    by = {r.method: r["sum"] for r in vectors.aggregate(frame, ["sum"], ["method"], at=[]).collect()}
    assert total == pytest.approx(1.41) and by["GET"] == pytest.approx(1.28) and by["POST"] == pytest.approx(0.13)


def test_used_percent_and_zero_total(spark):
    make = lambda v, w: spark.createDataFrame([({"i": "a"}, v), ({"i": "z"}, w)], "labels map<string,string>, value double")
    got = {r.labels["i"]: r.value for r in vectors.used_percent(make(5.24288e9, 1.0), make(8.589934592e9, 0.0)).collect()}
    assert got["a"] == pytest.approx(38.96, abs=0.01) and got["z"] is None


def test_series_id_ignores_label_order(spark):
    frame = spark.createDataFrame([("m", {"a": "1", "b": "2"}), ("m", {"b": "2", "a": "1"}), ("n", {"a": "1", "b": "2"})],
                                  "metric string, labels map<string,string>")
    ids = [r[0] for r in frame.select(series_id()).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_flapping_counts_the_first_row(series):
    values = [69, 71, 68, 72, 70, 71, 69, 73, 68, 72]
    frame = series({"a": list(enumerate(values))})
    row = rolling.crossings(frame, ["series"], ["ts"], sigmas=-0.2).first()
    above = [v > row.threshold for v in values]
    assert row.crossings == 1 + sum(a != b for a, b in zip(above, above[1:]))
    assert row.alerts_per_day == row.crossings // 2 * 24


def test_differences_and_constant_series(series):
    frame = series({"a": list(enumerate([10, 12, 15, 19, 24, 30])), "flat": [(i, 5) for i in range(30)], "one": [(0, 1)]})
    got = [r.difference for r in rolling.differences(frame, ["series"], ["ts"]).filter("series = 'a'").orderBy("ts").collect()]
    assert got == [None, 2, 3, 4, 5, 6]
    z = rolling.zscore(frame, ["series"]).filter("series <> 'a'").collect()
    assert all(r.z_score is None and r.is_anomaly is False for r in z)
    assert rolling.modified_zscore(frame, ["series"]).filter("series = 'flat' AND modified_z IS NOT NULL").isEmpty()
    assert rolling.rolling_zscore(frame, ["series"], ["ts"]).groupBy("series").count().collect()[0]["count"] == 11


def test_correlation_of_a_constant_is_null(spark):
    frame = spark.range(5).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("c"), (-F.col("id")).cast("double").alias("y"))
    got = {(r.a, r.b): r.r for r in stats.correlations(frame, ["x", "c", "y"]).collect()}
    assert got["x", "y"] == pytest.approx(-1) and got["x", "c"] is None and got["c", "c"] is None
    pairs = stats.strong_pairs(stats.correlations(frame, ["x", "c", "y"]), ["x", "c", "y"]).collect()
    assert [(p.a, p.b, p.direction) for p in pairs] == [("x", "y", "↑↓")]


def test_capacity_status(spark, series):
    grow = lambda first, per_hour: [(360 * i, first + per_hour * i / 10) for i in range(11)]
    frame = series({
        "app_cpu_usage_percent": grow(95, 0), "app_memory_usage_mb": grow(263.2, 11.3), "app_queue_depth": grow(41, 0),
        "active_connections": [(0, 1), (60, 2)],
    })
    got = {r.name: r for r in capacity.capacity_status(frame, spec_table(spark, RESOURCES), "series").collect()}
    status = [got[r.name].status for r in RESOURCES]
    assert status == ["CRITICAL", "WATCH", "WARNING", "NO_DATA"]
    memory = got["Memory"]
    assert memory.current_value == pytest.approx(274.5) and memory.growth_rate_per_hour == pytest.approx(11.3)
    assert memory.time_to_critical_hours == pytest.approx((512 * 0.9 - 274.5) / 11.3)
    fits = linear.linear_fit(frame.filter("series = 'app_memory_usage_mb'"), ["series"])
    hours = fits.select((linear.time_to_limit(fits, 512.0) / 3600).alias("h")).first().h
    assert hours == pytest.approx(21.0, abs=0.05)
    texts = {r.name: r.recommendation for r in capacity.recommendations(capacity.capacity_status(frame, spec_table(spark, RESOURCES), "series")).collect()}
    assert "IMMEDIATE" in texts["CPU"] and "Monitor closely (~16h" in texts["Memory"] and len(texts) == 3


RULE = Rule("HighCpuUsage", 80.0, timedelta(minutes=2), "warning")


def test_alert_holds_and_gaps(series):
    frame = series({"a": [(60 * m, v) for m, v in enumerate([90, 91, 92, 93, 50, 95, 96])], "b": [(0, 99), (60, 99), (180, 99), (240, None)]})
    rows = frame.select(F.lit("HighCpuUsage").alias("rule"), F.col("series").alias("instance"), F.col("ts").alias("eval_ts"), "value")
    states = alerts.alert_states(rows, [RULE], ["instance"], MIN)
    got = {(r.instance, r.eval_ts.minute): (r.state, r.active_since.minute) for r in states.collect()}
    assert got == {
        ("a", 0): ("pending", 0), ("a", 1): ("pending", 0), ("a", 2): ("firing", 0), ("a", 3): ("firing", 0),
        ("a", 5): ("pending", 5), ("a", 6): ("pending", 5), ("b", 0): ("pending", 0), ("b", 1): ("pending", 0), ("b", 3): ("pending", 3),
    }
    notices = alerts.notifications(states, ["instance"], MIN, repeat=timedelta(seconds=40)).orderBy("sent_at").collect()
    assert [(n.status, n.sent_at.minute, n.sent_at.second, n.is_repeat) for n in notices] == [
        ("firing", 2, 10, False), ("firing", 2, 50, True), ("firing", 3, 30, True), ("resolved", 4, 10, False),
    ]


def test_annotations(spark):
    rows = spark.createDataFrame([("HighErrorRate", "api", 0.0512345), ("InstanceDown", "db", 0.0)], "rule string, instance string, value double")
    got = {r.rule: r for r in alerts.annotate(rows.withColumn("job", F.lit("app")), RULES, ["instance", "job"]).collect()}
    assert got["HighErrorRate"].description == "Error rate is above 5% (current: 5.123%)"
    assert got["InstanceDown"].summary == "Instance db is down"
    assert got["InstanceDown"].description == "app instance has been unreachable for 1 minute"
    shown = [r[0] for r in spark.createDataFrame([(0.5,), (0.0,), (1.23456,)], "v double").select(humanize_percentage(F.col("v"))).collect()]
    assert shown == ["50%", "0%", "123.5%"]


def test_explanation_text(spark):
    frame = spark.createDataFrame([(85.0, 10.0, 45.0, 10.0, 9.0, 0.0)], "cpu double, mem double, cpu_mean double, cpu_std double, mem_mean double, mem_std double")
    row = frame.withColumn("reason", stats.reasons(["cpu", "mem"])).select("reason", joined_reasons("reason").alias("t")).first()
    assert len(row.reason) == 1 and row.reason[0].z == pytest.approx(4.0) and row.t == "cpu=85.0 (HIGH, z=+4.0)"


@pytest.mark.parametrize("n", [1, 7, 8, 9, 12, 19, 40, 79, 80, 130])
def test_adaptive_band_has_a_width_for_each_series(series, n):
    import random

    import numpy as np

    rng = random.Random(n)
    values = [None if i == 5 and n == 40 else rng.gauss(0, 1) for i in range(n)]
    got = rolling.adaptive_band(series({"a": list(enumerate(values)), "b": [(0, 1.0)]}), ["series"], ["ts"], block_rows=32).collect()
    rows = sorted((r for r in got if r.series == "a"), key=lambda r: r.ts)
    width = min(20, n // 4)
    assert len(rows) == n and len(got) == n + 1 and {r.width for r in rows} == {width}
    for i, r in enumerate(rows):
        frame = values[max(0, i + (width - 1) // 2 - width + 1) : i + (width - 1) // 2 + 1]
        whole = width > 1 and i + (width - 1) // 2 - width + 1 >= 0 and len(frame) == width and None not in frame
        assert (r.upper is not None) == whole
        if whole:
            mean, std = np.mean(frame), np.std(frame, ddof=1)
            assert r.upper == pytest.approx(mean + 2 * std) and r.lower == pytest.approx(mean - 2 * std)
            assert r.is_anomaly == (abs(values[i] - mean) > 2 * std)


def test_many_silences_of_one_rule(spark):
    """A hundred thousand, overlapping, touching, empty and reversed, against their union."""
    at = lambda c: F.timestamp_seconds(c)
    spans = spark.range(100_000).select(
        F.lit("r").alias("rule"), at(F.col("id") * 50).alias("starts_at"), at(F.col("id") * 50 + (F.col("id") % 7) * 10 - 5).alias("ends_at")
    )
    rows = spark.range(0, 5_000_000, 997).select(F.lit("r").alias("rule"), at("id").alias("eval_ts"))
    rows = rows.unionByName(rows.withColumn("rule", F.lit("other")))
    covered = [(50 * i, 50 * i + i % 7 * 10 - 5) for i in range(100_000)]
    inside = lambda t: any(a <= t < b for a, b in covered[max(0, t // 50 - 2) : t // 50 + 1])
    left = {(r.rule, int(r.u)) for r in alerts.silence(rows, spans).selectExpr("rule", "unix_seconds(eval_ts) as u").collect()}
    assert left == {("r", t) for t in range(0, 5_000_000, 997) if not inside(t)} | {("other", t) for t in range(0, 5_000_000, 997)}
    days = spark.createDataFrame([("r", 100, 40 * 86400)], "rule string, a bigint, b bigint").select("rule", at("a").alias("starts_at"), at("b").alias("ends_at"))
    assert alerts.silence(rows, days).filter("rule = 'r'").count() == sum(not 100 <= t < 40 * 86400 for t in range(0, 5_000_000, 997))
