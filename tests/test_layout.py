"""Blocks, salts and ranks give what one window per key would."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.layout import attach, exact_quantiles, number_rows, windowed


@pytest.fixture(scope="module", autouse=True)
def many_ranges(spark):
    """Keep the ranges of a small sort apart, so that keys span several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; many share a time."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.floor(F.col("id") / 3).alias("at"), "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7.0).alias("value"),
    )
    return rows.repartition(5)


def test_row_numbers(skewed):
    w = Window.partitionBy("key").orderBy("at", "id")
    want = {(r.key, r.id): (r.rn, r.n) for r in skewed.select(
        "key", "id", F.row_number().over(w).alias("rn"), F.count("*").over(Window.partitionBy("key")).alias("n")).collect()}
    got = {(r.key, r.id): (r.rn, r.n) for r in number_rows(skewed, ["key"], ["at", "id"], n="n").collect()}
    assert got == want


@pytest.mark.parametrize("size", [1, 4, 7, 64, 10_000])
def test_blocks_equal_one_window(skewed, size):
    def columns(w):
        return {"s": F.sum("value").over(w.rowsBetween(-3, 2)), "p": F.lag("id").over(w), "c": F.count("*").over(w.rowsBetween(-3, 2))}

    want = skewed.withColumns(columns(Window.partitionBy("key").orderBy("at", "id")))
    got = windowed(skewed, ["key"], ["at", "id"], columns, before=3, after=2, block_rows=size)
    pick = lambda df: sorted((r.key, r.id, round(r.s, 9), r.p, r.c) for r in df.collect())
    same = lambda rows: [tuple(-1 if v is None else v for v in r) for r in rows]
    assert same(pick(got)) == same(pick(want))


def test_attach_keeps_every_row(skewed):
    stats = skewed.groupBy("key").agg(F.count("*").alias("n"))
    out = attach(skewed, stats.filter("key <> 'k1'"), ["key"], how="left")
    assert out.count() == 900
    assert out.filter("key = 'hot' AND n = 720").count() == 720
    assert out.filter("n IS NULL").count() == skewed.filter("key = 'k1'").count()


def test_quantiles(skewed):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    frame = skewed.toPandas()
    for row in exact_quantiles(skewed, ["key"], "value", probs).collect():
        values = frame.loc[frame["key"] == row.key, "value"]
        assert np.allclose([row[n] for n in probs], np.quantile(values, list(probs.values())))


@pytest.fixture(scope="module")
def absent(spark):
    """Half of the rows have no key."""
    rows = [(("a", None)[i % 2], i, float(i % 7)) for i in range(60)]
    return spark.createDataFrame(rows, "key string, id bigint, value double").withColumn("ts", F.timestamp_seconds(F.col("id") * 20))


def test_absent_keys_are_kept(absent):
    numbered = number_rows(absent, ["key"], ["ts", "id"], n="n").collect()
    assert len(numbered) == 60 and {r.n for r in numbered} == {30}
    assert sorted(r.rn for r in numbered if r.key is None) == list(range(1, 31))
    stats = absent.groupBy("key").agg(F.avg("value").alias("m"))
    assert attach(absent, stats, ["key"]).filter("m IS NOT NULL").count() == 60
    assert {r.key for r in exact_quantiles(absent, ["key"], "value", {"p": 0.5}).collect()} == {"a", None}
    back = windowed(absent, ["key"], ["ts", "id"], lambda w: {"p": F.lag("id").over(w)}, before=1, block_rows=4)
    assert {r.id - r.p for r in back.collect() if r.p is not None} == {2} and back.filter("p IS NULL").count() == 2


def test_time_order_writes_nothing(absent, tmp_path, monkeypatch):
    import tidewatch.layout

    def refuse(df):
        raise AssertionError("a table was written")

    monkeypatch.setattr(tidewatch.layout, "settle", refuse)
    assert windowed(absent, ["key"], ["ts"], lambda w: {"p": F.lag("id").over(w)}, before=1).count() == 60


def test_equal_times_are_numbered_alike(spark, absent):
    same = absent.withColumn("ts", F.timestamp_seconds(F.lit(5)))
    number = lambda n: sorted((r.id, r.rn) for r in number_rows(same.repartition(n), ["key"], ["ts"]).collect())
    assert number(1) == number(7)


def test_quantiles_of_mostly_equal_values(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("key"), F.when(F.col("id") % 10 < 9, 5.0).otherwise(F.col("id") / 3.0).alias("value"))
    values = rows.toPandas()["value"]
    got = exact_quantiles(rows, ["key"], "value", {"a": 0.2, "b": 0.93, "c": 0.999}).first()
    assert np.allclose([got.a, got.b, got.c], np.quantile(values, [0.2, 0.93, 0.999]))


def test_small_statistics_do_not_move_the_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).select((F.col("id") % 5).alias("key"), F.rand(1).alias("value")).write.parquet(path)
    rows = spark.read.parquet(path)
    out = attach(rows, rows.groupBy("key").agg(F.avg("value").alias("m")), ["key"])
    out.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
