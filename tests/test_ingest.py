from datetime import datetime, timedelta

import pytest

from tidewatch.sources import ingest, read, rollups, synthetic
from tidewatch.model import LATENCY_BOUNDS

TEXT = r'''# HELP http_requests_total Requests
# TYPE http_requests_total counter
http_requests_total{method="GET",endpoint="/a b",status="500"} 42
http_requests_total{method="PO\"ST",path="c:\\d\ne"} 1.5e3 1700000000123

# TYPE lat histogram
lat_bucket{le="0.5"} 3
lat_bucket{le="+Inf"} 4
lat_sum 1.25
up 1
temp NaN
cold -Inf
not a metric line!
'''


def test_text(spark, tmp_path):
    (tmp_path / "scrape.prom").write_text(TEXT)
    rows = ingest.typed_samples(spark.read.text(str(tmp_path))).collect()
    got = {(r.metric, r.le): r for r in rows}
    assert len(rows) == 8
    first = [r for r in rows if r.labels.get("status") == "500"][0]
    assert first.value == 42 and first.type == "counter" and first.labels["endpoint"] == "/a b"
    second = [r for r in rows if r.ts_ms][0]
    assert second.labels == {"method": 'PO"ST', "path": "c:\\d\ne"} and second.ts_ms == 1700000000123 and second.value == 1500
    assert got["lat_bucket", float("inf")].value == 4 and got["lat_bucket", 0.5].type == "histogram"
    assert got["temp", None].value is None and got["cold", None].value == float("-inf") and got["up", None].type is None


def test_text_line_by_line(spark):
    """Escapes, a brace inside a label, exemplars, long lines; what is no sample is rejected whole."""
    good = {
        r'a{x="1\\n",y="}\" 2",} 1': ("a", {"x": "1\\n", "y": '}" 2'}, 1.0),
        r'a{x="\\\n"} 2 # {t="}"} 0.5': ("a", {"x": "\\\n"}, 2.0),
        "a { x = \"1\" , y=\"\" }+Inf 12": ("a", {"x": "1", "y": ""}, float("inf")),
        "a{} 3": ("a", {}, 3.0),
        'long{x="' + "ab\\\\" * 20000 + '"} 4': ("long", {"x": "ab\\" * 20000}, 4.0),
        "b\tNaN": ("b", {}, None),
    }
    bad = ["a", "1a 2", "a 1 2 3", 'a{x="1"', 'a{x="1"y="2"} 1', 'a{x="1",x="2"} 1', "a{x=1} 1", "a one", "a{x=\"1\"}", "a1"]
    rows = [(i, text) for i, text in enumerate([*good, *bad, "", "# a comment", "  ", None])]
    lines = spark.createDataFrame(rows, "metric int, value string").withColumnRenamed("metric", "id")
    got = {r.id: (r.metric, r.labels, r.value) for r in ingest.parse_text(lines).collect()}
    assert got == dict(enumerate(good.values()))
    assert sorted(r.value for r in ingest.rejected(lines).collect()) == sorted(bad)
    assert ingest.rejected(lines.limit(0)).isEmpty() and ingest.typed_samples(lines.limit(0)).isEmpty()


def test_families_by_full_name_and_target(spark):
    """A gauge and a counter whose names differ by a suffix, and another type of one name on another target."""
    text = [
        ("a", "# TYPE go_memory gauge"), ("a", "# TYPE go_memory_total counter"), ("a", "go_memory 1"), ("a", "go_memory_total 2"),
        ("a", "# TYPE wait summary"), ("a", "wait_sum 3"), ("a", "wait_bucket 4"), ("a", "# TYPE hits counter"), ("a", "hits_total 5"),
        ("b", "# TYPE go_memory untyped"), ("b", 'go_memory{instance="own"} 1'), ("b", "wait_sum 3"), (None, "go_memory 1"),
    ]
    rows = ingest.typed_samples(spark.createDataFrame(text, "instance string, value string"), target=["instance"]).collect()
    got = {(r.instance, r.metric): r for r in rows}
    assert {k: r.type for k, r in got.items()} == {
        ("a", "go_memory"): "gauge", ("a", "go_memory_total"): "counter", ("a", "wait_sum"): "summary", ("a", "wait_bucket"): None,
        ("a", "hits_total"): "counter", ("b", "go_memory"): "untyped", ("b", "wait_sum"): None, (None, "go_memory"): None,
    }
    assert got["b", "go_memory"].labels == {"exported_instance": "own", "instance": "b"} and got[None, "go_memory"].labels == {}
    assert len({r.series_id for r in rows}) == len(rows)


def test_responses(spark):
    docs = [
        ('{"status":"success","data":{"resultType":"vector","result":[{"metric":{"__name__":"up","job":"a"},"value":[1700000000.5,"1"]}]}}',),
        ('{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"__name__":"x"},"values":[[1700000000,"1.5"],[1700000015,"NaN"]]}]}}',),
        ('{"status":"success","data":{"resultType":"vector","result":[]}}',),
    ]
    rows = ingest.parse_responses(spark.createDataFrame(docs, "value string")).collect()
    got = sorted((r.metric, r.ts.second, r.value) for r in rows if r.value is not None)
    assert len(rows) == 3 and got == [("up", 20, 1.0), ("x", 20, 1.5)]
    assert [r.labels for r in rows if r.metric == "up"] == [{"job": "a"}]
    assert [r.ts.microsecond for r in rows if r.metric == "up"] == [500000]


def test_payloads(spark):
    docs = [('{"status":"firing","alerts":[{"a":"1"},{"a":"2"}]}',), ('{"status":"resolved","alerts":[]}',), ('{"alerts":[{"a":"1"}]}',)]
    got = {r.status: (r.payloads, r.alerts) for r in ingest.payload_rollup(spark.createDataFrame(docs, "value string")).collect()}
    assert got == {"firing": (1, 2), "resolved": (1, 0), "unknown": (1, 1)}


def test_rollups(series):
    frame = series({"a": [(1, 0.02), (2, 0.3), (61, 20.0), (120, 0.01)]})
    minute = timedelta(minutes=1)
    assert [(r.ts.minute, r.value) for r in rollups.counter(frame, ["series"], minute).orderBy("ts").collect()] == [(1, 2), (2, 4)]
    assert [(r.ts.minute, r.value) for r in rollups.gauge(frame, ["series"], minute).orderBy("ts").collect()] == [(1, 0.3), (2, 0.01)]
    rows = rollups.histogram(frame, ["series"], minute, LATENCY_BOUNDS).filter("minute(ts) = 2").collect()
    got = {r.le: r.value for r in rows}
    assert len(got) == 11 and got[0.01] == 1 and got[0.025] == 2 and got[10.0] == 3 and got[float("inf")] == 4


def test_sample_table_prunes(spark, series, tmp_path):
    from pyspark.sql import functions as F

    frame = series({"a": [(i * 3600, i) for i in range(72)]})
    both = frame.withColumn("metric", F.lit("m1")).unionByName(frame.withColumn("metric", F.lit("m2")))
    read.write_samples(both, str(tmp_path / "t"))
    cut = read.read_samples(spark, str(tmp_path / "t"), ["m1"], datetime(1970, 1, 2), datetime(1970, 1, 2, 23))
    assert cut.count() == 24
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [metric" in plan or "metric#" in plan.split("PartitionFilters:")[1][:200]


def test_synthetic_is_the_same_under_any_partitioning(spark):
    keys = spark.range(6).selectExpr("cast(id as string) as s")
    make = lambda n: sorted(
        (r.s, r.step, r.value) for r in synthetic.synthetic(keys.repartition(n), ["s"], 300, synthetic.ADDITIVE, datetime(2024, 1, 1)).collect()
    )
    rows = make(1)
    assert rows == make(5) and len(rows) == 1800
    assert all(5 <= v <= 95 for *_, v in rows)
    noise = [v - (35 + 0.02 * t) for _, t, v in rows]
    assert sum(noise) / len(noise) == pytest.approx(10, abs=6)


def test_package_goes_to_the_workers(spark):
    import zipfile

    from pyspark import SparkFiles

    from tidewatch.session import ship_package

    ship_package(spark)
    with zipfile.ZipFile(SparkFiles.get("tidewatch.zip")) as sent:
        assert {"tidewatch/session.py", "tidewatch/functions/trees.py"} <= set(sent.namelist())


SHIPPED = """
import sys
from tidewatch import get_session
from tidewatch.session import ship_package
spark = get_session("shipped", "local-cluster[2,1,700]", **{"spark.executor.memory": "600m", "spark.ui.enabled": "false",
    "spark.checkpoint.dir": sys.argv[1], "spark.sql.shuffle.partitions": "4"})
assert ship_package(spark) == ship_package(spark)
get_session("again")
assert len(spark.sparkContext.listFiles) == 1
sys.path.pop(0)

def where(batches):
    import tidewatch
    for batch in batches:
        yield batch.assign(at=tidewatch.__file__)

for _ in range(2):
    rows = spark.range(0, 100, 1, 6).selectExpr("id % 7 as id").groupBy("id").count().selectExpr("id", "'' as at").mapInPandas(where, "id bigint, at string").collect()
    assert len(rows) == 7 and all("tidewatch.zip" in r["at"] for r in rows), rows
spark.stop()
print("shipped")
"""


def test_workers_run_after_the_package_was_sent(tmp_path):
    """A session of its own whose workers start in another folder and find the library only in the archive."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "job.py"
    script.write_text(f"import sys\nsys.path.insert(0, {str(root)!r})\n" + SHIPPED)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script), str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0 and "shipped" in ran.stdout, ran.stderr[-3000:]
