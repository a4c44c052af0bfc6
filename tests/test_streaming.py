"""Streams give what the batch definitions give."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.model import Rule
from tidewatch.operators import alerts
from tidewatch.streaming import detector, rules
from tidewatch.streaming.run import run_once
from tidewatch.streaming.ticks import sliding_stats, ticks

METRICS = ["cpu", "mem", "queue"]


@pytest.fixture(scope="module")
def samples(spark):
    """130 minutes of three metrics; one spike; one minute lacks a metric."""
    rows = spark.range(130 * 3 * 2).select(
        F.timestamp_seconds(F.col("id") % 260 * 30 + 7).alias("ts"),
        F.element_at(F.array(*[F.lit(m) for m in METRICS]), (F.floor(F.col("id") / 260) + 1).cast("int")).alias("metric"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0).alias("value"), "id",
    )
    spike = (F.col("metric") == "cpu") & (F.floor(F.unix_seconds("ts") / 60) == 80)
    rows = rows.withColumn("value", F.when(spike, 500.0).otherwise(F.col("value")))
    lost = (F.col("metric") == "mem") & (F.floor(F.unix_seconds("ts") / 60) == 40)
    return rows.filter(~lost)


@pytest.fixture(scope="module")
def chunks(spark, samples, tmp_path_factory):
    """The samples in four files in time order, shuffled inside each."""
    folder = str(tmp_path_factory.mktemp("chunks") / "in")
    for part in range(4):
        piece = samples.filter(F.floor(F.unix_seconds("ts") / 1980) == part).orderBy(F.xxhash64("id"))
        piece.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_detector_stream_equals_batch(spark, samples, chunks):
    verdicts = run_once(detector.detect_stream(ticks(stream(spark, chunks), METRICS, "1 minute", delay="2 minutes"), METRICS))
    got = {r.tick: r for r in verdicts.collect()}
    last = samples.agg(F.max("ts")).first()[0] - timedelta(minutes=2)
    batch = detector.detect_batch(ticks(samples, METRICS, "1 minute").filter(F.col("tick") <= F.lit(last)), METRICS)
    want = {r.tick: r for r in batch.collect()}
    assert got.keys() == want.keys() and len(got) >= 125
    for at, w in want.items():
        g = got[at]
        assert (g.checks, g.window_rows, g.status, g.reason, g.epoch) == (w.checks, w.window_rows, w.status, w.reason, w.epoch)
        assert (g.score is None) == (w.score is None) and (g.score is None or g.score == pytest.approx(w.score, abs=1e-12))
    assert sum(r.status == "COLLECTING" for r in got.values()) == 29
    # tick 80 retrains, on a window that holds the spike
    spike = got[datetime(1970, 1, 1, 1, 21)]
    assert spike.is_anomaly and "cpu=500.0 (HIGH" in spike.reason
    assert max(r.anomalies for r in got.values()) == sum(bool(r.is_anomaly) for r in got.values())
    assert datetime(1970, 1, 1, 0, 41) not in got


def test_epochs(spark):
    frame = spark.range(300).select(F.lit("s").alias("scope"), F.timestamp_seconds("id").alias("tick"), F.col("id").cast("double").alias("x"))
    got = {r.checks: r for r in detector.epochs(frame).collect()}
    assert got[29].epoch is None and got[30].epoch == 0 and got[79].epoch == 0 and got[80].epoch == 1
    assert (got[280].train_from, got[280].train_to) == (81, 280) and (got[30].train_from, got[30].train_to) == (1, 30)
    first = detector.window_stats(frame, ["x"]).filter("epoch = 5").first()
    assert first.x_mean == pytest.approx(sum(range(80, 280)) / 200)


def test_sliding_stream_equals_batch(spark, samples, chunks):
    args = (["metric"], "5 minutes", "1 minute")
    got = {(r.metric, r.window_start): (r.avg, r.n) for r in run_once(sliding_stats(stream(spark, chunks), *args, "2 minutes")).collect()}
    want = {(r.metric, r.window_start): (r.avg, r.n) for r in sliding_stats(samples, *args).collect()}
    last = samples.agg(F.max("ts")).first()[0] - timedelta(minutes=2)
    closed = {k: v for k, v in want.items() if k[1] + timedelta(minutes=5) <= last}
    assert got.keys() == closed.keys()
    assert all(got[k][1] == v[1] and got[k][0] == pytest.approx(v[0]) for k, v in closed.items())


def test_late_rows_are_dropped(spark, samples, chunks, tmp_path):
    folder = str(tmp_path / "late")
    for part in (0, 1, 2):
        samples.filter(F.floor(F.unix_seconds("ts") / 1980) == part).coalesce(1).write.mode("append").parquet(folder)
    late = samples.filter("unix_seconds(ts) < 60").withColumn("value", F.lit(1e6))
    late.coalesce(1).write.mode("append").parquet(folder)
    out = run_once(sliding_stats(stream(spark, folder), ["metric"], "1 minute", "1 minute", "2 minutes"))
    assert out.filter("max >= 1e6").isEmpty() and out.count() > 200


def test_alert_stream_equals_batch(spark, tmp_path):
    rule = Rule("HighCpuUsage", 80.0, timedelta(minutes=2), "warning")
    hot = F.pmod(F.floor(F.col("id") / 4), F.lit(3)) < 2
    vectors = spark.range(60).select(
        F.lit(rule.name).alias("rule"), F.concat(F.lit("i"), F.col("id") % 2).alias("instance"),
        F.timestamp_seconds(86400 + F.floor(F.col("id") / 2) * 60).alias("eval_ts"), F.when(hot, 90.0).otherwise(10.0).alias("value"),
    ).filter("NOT (instance = 'i1' AND unix_seconds(eval_ts) >= 87900)")
    folder = str(tmp_path / "v")
    for part in range(3):
        vectors.filter(F.floor((F.unix_seconds("eval_ts") - 86400) / 600) == part).coalesce(1).write.mode("append").parquet(folder)
    out = run_once(rules.alert_stream(stream(spark, folder), [rule], timedelta(minutes=1), "1 minute")).collect()
    got = sorted((r.instance, r.eval_ts, r.state, r.active_since) for r in out if r.state != "resolved")
    batch = alerts.alert_states(vectors, [rule], ["instance"], timedelta(minutes=1)).collect()
    assert got == sorted((r.instance, r.eval_ts, r.state, r.active_since) for r in batch) and got
    ends = {(r.instance, r.eval_ts) for r in out if r.state == "resolved"}
    # every run that a later step or the watermark has closed is resolved once
    assert ("i0", datetime(1970, 1, 2, 0, 4)) in ends and len(ends) == sum(r.state == "resolved" for r in out)


def test_stream_deduplication(spark, tmp_path):
    rows = [("r", "a", 60, "firing", 0), ("r", "a", 120, "firing", 0), ("r", "b", 60, "firing", 0), ("r", "b", 120, "pending", 60), ("r", "a", 240, "firing", 240)]
    frame = spark.createDataFrame(rows, "rule string, instance string, e bigint, state string, s bigint").select(
        "rule", "instance", "state", F.timestamp_seconds(F.col("e") + 86400).alias("eval_ts"), F.timestamp_seconds("s").alias("active_since"))
    folder = str(tmp_path / "a")
    frame.coalesce(1).write.parquet(folder)
    out = run_once(alerts.deduplicate_stream(stream(spark, folder), ["instance"], "1 hour")).collect()
    assert sorted((r.instance, r.active_since.minute) for r in out) == [("a", 0), ("a", 4), ("b", 0)]


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_of_part_files_streams_whole(spark, tmp_path, parts):
    from tidewatch.streaming.run import event_stream, run_once

    rows = spark.range(1000).select(F.timestamp_seconds(F.col("id")).alias("ts"), "id")
    rows.repartition(parts).write.parquet(str(tmp_path / "events.parquet"))
    assert run_once(event_stream(spark, str(tmp_path))).count() == 1000


def test_a_single_file_streams_whole(spark, tmp_path):
    import shutil

    from tidewatch.streaming.run import event_stream, run_once

    shutil.copy("/root/testdata/sf0.001/events.parquet", tmp_path / "events.parquet")
    rows = spark.read.parquet(str(tmp_path / "events.parquet"))
    assert run_once(event_stream(spark, str(tmp_path))).count() == rows.count()


def test_evaluation_runs_to_the_last_day(spark, tmp_path):
    from tidewatch.plans.tables import Tables

    rows = spark.createDataFrame([("2024-01-03 05:00:00",), ("2024-02-07 23:00:00",)], "ts string").select(F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    start, end = Tables(spark, str(tmp_path)).days
    assert (start.isoformat(), end.isoformat()) == ("2024-01-03T00:00:00", "2024-02-08T00:00:00")
