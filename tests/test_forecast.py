from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import additive, evaluation, linear, seasonal, smoothing
from tidewatch.sources import synthetic

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def seasonal_series(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "series string")
    return synthetic.synthetic(keys, ["series"], 200, synthetic.Shape(30.0, 0.1, ((15.0, 24.0),)), START).drop("step")


def test_line_is_recovered(series):
    frame = series({"up": [(i * 30, 5 + 0.5 * i) for i in range(12)], "flat": [(i, 3) for i in range(12)], "few": [(0, 1), (1, 2)]})
    fits = {r.series: r for r in linear.linear_fit(frame, ["series"]).collect()}
    assert fits["up"].slope == pytest.approx(0.5 / 30) and fits["up"].intercept == pytest.approx(5) and fits["up"].r2 == pytest.approx(1)
    assert fits["flat"].slope == 0 and fits["flat"].r2 == 1
    rows = linear.linear_forecast(frame, ["series"]).filter("series = 'up'").orderBy("ts").collect()
    assert len(rows) == 240 and rows[0].yhat == pytest.approx(10.5) and rows[-1].yhat == pytest.approx(10.5 + 239 * 0.5)
    assert linear.linear_forecast(frame, ["series"]).filter("series = 'few'").isEmpty()
    times = {r.series: r.hours_to_limit for r in linear.time_to_threshold(linear.linear_fit(frame, ["series"]), 20.5).collect()}
    assert times["up"] == pytest.approx(10 / (0.5 / 30) / 3600) and times["flat"] is None


def test_decomposition_of_short_and_long_series(series):
    wave = lambda n, p: [(60 * i, 10 + 0.5 * i + 4 * np.sin(2 * np.pi * i / p)) for i in range(n)]
    frame = series({"long": wave(96, 24), "short": wave(36, 12), "tiny": wave(9, 3)})
    rows = seasonal.seasonal_decompose(frame, ["series"])
    got = {r.series: r for r in seasonal.component_summary(rows, ["series"]).collect()}
    assert set(got) == {"long", "short"} and got["long"].period == 24 and got["short"].period == 12
    for r in got.values():
        assert r.residual_std == pytest.approx(0, abs=1e-9) and 7.5 < r.amplitude <= 8.0001
    assert rows.filter("series = 'short' AND trend IS NULL").count() == 12
    same = seasonal.seasonal_decompose(frame.filter("series = 'long'"), ["series"], period=24, block_rows=30)
    assert same.join(rows, ["series", "ts"]).filter(F.abs(same["seasonal"] - rows["seasonal"]) > 1e-9).isEmpty()


@pytest.mark.parametrize("m,multiplicative", [(1, False), (24, False), (24, True)])
def test_smoothing_follows_the_recurrence(seasonal_series, m, multiplicative):
    y = [r.value for r in seasonal_series.filter("series = 'a'").orderBy("ts").collect()]
    level, trend, season = smoothing.start_state(np.array(y), m, multiplicative)
    season, fitted = list(season), []
    for t, v in enumerate(y):
        s, base = season[t % m], level + trend
        fitted.append(base * s if multiplicative else base + s)
        new = 0.3 * (v / s if multiplicative else v - s) + 0.7 * base
        trend, level = 0.1 * (new - level) + 0.9 * trend, new
        if m > 1:
            season[t % m] = 0.2 * (v / base if multiplicative else v - base) + 0.8 * s
    rows = smoothing.smooth_fixed(seasonal_series, ["series"], 0.3, 0.1, 0.2, m, multiplicative)
    got = [r.fitted for r in rows.filter("series = 'a'").orderBy("ts").collect()]
    assert np.allclose(got, fitted)


def test_fitted_smoothing_beats_fixed_and_forecasts_the_season(seasonal_series):
    fit = smoothing.fit_smoothing(seasonal_series, ["series"], 24)
    best = {r.series: r for r in fit.collect()}
    fixed = smoothing.final_states(seasonal_series, ["series"], 0.45, 0.45, 0.45, 24).first()
    assert best["a"].sse <= fixed.sse and 0 < best["a"].alpha < 1
    rows = smoothing.forecast(fit, ["series"], 48, timedelta(minutes=1), 24).filter("series = 'a'").orderBy("ts").collect()
    want = [30 + 0.1 * t + 15 * np.sin(2 * np.pi * t / 24) for t in range(200, 248)]
    assert rows[0].ts == START + timedelta(minutes=200)
    assert np.mean(np.abs(np.array([r.yhat for r in rows]) - want)) < 2.5


def test_holdout_sizes(seasonal_series):
    train, test = evaluation.holdout(seasonal_series, ["series"])
    assert train.count() == 320 and test.count() == 80
    assert test.agg(F.min("h"), F.max("h")).first()[:] == (1, 40)
    score = evaluation.errors(evaluation.smoothing_holdout(train, test, ["series"], 24), ["series"]).first()
    assert score.n == 40 and score.mape < 10


def test_additive_model_on_noiseless_data(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "series string")
    shape = synthetic.Shape(35.0, 0.02, ((15.0, 288.0), (5.0, 144.0)))
    frame = synthetic.synthetic(keys, ["series"], 2000, shape, START, timedelta(minutes=5))
    late = F.greatest(F.col("step") - 800, F.lit(0)) * F.lit(0.05)
    bent = frame.withColumn("value", F.col("value") + F.when(F.col("series") == "b", late).otherwise(0.0)).drop("step")
    model = additive.fit_additive(bent.repartition(5), ["series"])
    rows = additive.predict_additive(bent, model, ["series"])
    score = {r.series: r for r in evaluation.errors(rows, ["series"]).collect()}
    assert score["a"].mape < 2 and score["b"].mape < 2
    bend = additive.changes(model, ["series"]).filter("series = 'b'").orderBy(F.desc(F.abs("delta"))).first()
    assert bend.delta > 0 and abs((bend.ts - START).total_seconds() / 300 - 800) < 150
    future = additive.predict_additive(additive.history_and_future(bent, ["series"], 10, timedelta(minutes=5)), model, ["series"])
    ahead = future.filter("is_future").orderBy("series", "ts").collect()
    assert len(ahead) == 20 and ahead[9].yhat_upper - ahead[9].yhat_lower >= ahead[0].yhat_upper - ahead[0].yhat_lower
    assert additive.fit_additive(bent.limit(20), ["series"]).isEmpty()


def test_changepoints_of_a_short_series(series):
    frame = series({"a": [(i, i) for i in range(10)]})
    # history of 8 rows: 7 candidates, rows 1..7
    assert [r.ts.second for r in additive.changepoints(frame, ["series"]).orderBy("ts").collect()] == list(range(1, 8))


@pytest.mark.parametrize("m,multiplicative", [(1, False), (24, False), (24, True)])
def test_smoothing_does_not_depend_on_its_blocks(seasonal_series, m, multiplicative):
    """200 steps in one block, and in five of 48 or a hundred of two."""
    params = (["series"], 0.3, 0.1, 0.2, m, multiplicative)
    wanted, cut = (
        [r[1:] for r in smoothing.smooth_fixed(seasonal_series, *params, block_steps=steps).select("ts", "series", "fitted", "level", "trend").orderBy("series", "ts").collect()]
        for steps in (1 << 14, 1)
    )
    assert len(cut) == 400 and [r[0] for r in cut] == [r[0] for r in wanted]
    assert np.allclose([r[1:] for r in cut], [r[1:] for r in wanted], rtol=1e-9)
    whole, parts = (smoothing.final_states(seasonal_series, *params, block_steps=steps).orderBy("series").collect() for steps in (1 << 14, 1))
    for a, b in zip(whole, parts, strict=True):
        assert a.n == b.n and a.last_ts == b.last_ts and np.allclose(a.season, b.season)
        assert np.allclose([a.sse, a.residual_sum, a.level, a.trend], [b.sse, b.residual_sum, b.level, b.trend])


@pytest.mark.parametrize("m,multiplicative", [(1, False), (12, False), (12, True)])
def test_fit_does_not_depend_on_its_blocks(seasonal_series, m, multiplicative):
    """The grids meet at their edges, where a value would otherwise be tried twice."""
    fits = [
        smoothing.fit_smoothing(seasonal_series, ["series"], m, multiplicative, coarse=(0.0, 0.45, 0.9), block_steps=steps).orderBy("series").collect()
        for steps in (1 << 14, 1)
    ]
    for a, b in zip(*fits, strict=True):
        assert (a.n, a.alpha, a.beta, a.gamma) == (b.n, b.alpha, b.beta, b.gamma) and 0 < a.alpha < 1
        assert np.allclose([a.sse, a.level, a.trend, *a.season], [b.sse, b.level, b.trend, *b.season])


def test_smoothing_of_absent_and_short_series(spark):
    """A series without a number, one with gaps and equal times, one that is too short, and none at all."""
    rows = [(None, 10 * i, float(i % 7)) for i in range(40)] + [(2**60 + 1, 10 * (i // 2), None if i == 5 else float(i)) for i in range(9)]
    frame = spark.createDataFrame([*rows, (3, 0, 1.0)], "host bigint, s bigint, value double").select("host", F.timestamp_seconds("s").alias("ts"), "value")
    got = smoothing.smooth_fixed(frame, ["host"], 0.5, 0.5, block_steps=4)
    assert {r["host"]: r["count"] for r in got.groupBy("host").count().collect()} == {None: 40, 2**60 + 1: 8}
    assert {r.host: r.n for r in smoothing.fit_smoothing(frame, ["host"], block_steps=4).collect()} == {None: 40, 2**60 + 1: 8}
    assert smoothing.smooth_fixed(frame.limit(0), ["host"], 0.5, 0.5).isEmpty() and smoothing.fit_smoothing(frame.limit(0), ["host"]).isEmpty()
