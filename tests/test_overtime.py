"""Over-time functions against every frame taken by itself, and how many rows a frame's parts are."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import overtime

SECOND = timedelta(seconds=1)
EPOCH = datetime(1970, 1, 1)


def frames(points, span, step):
    """``{t: [(seconds, value)]}`` of all evaluation times that see a sample."""
    out = {}
    for at, v in points:
        t = -(-at // step) * step
        while t <= at + span:
            out.setdefault(t, []).append((at, v))
            t += step
    return {t: sorted(f) for t, f in out.items()}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    times = lambda n, most, grain: sorted(rng.sample(range(0, most, grain), n))
    dense = [(t, rng.gauss(0, 1)) for t in times(120, 600, 5)]
    return {
        "dense": dense,
        "sparse": [(t, rng.gauss(50, 9)) for t in times(12, 6000, 1)],
        "borders": [(t, float(t % 7)) for t in range(0, 900, 30)],
        "flat": [(t, 1e9) for t in range(0, 400, 10)] + [(400, 1e9 + 3.0), (410, 1e9)],
        "nulls": [(t, None if t % 50 == 0 else float(t)) for t in range(0, 500, 10)],
        "one": [(77, 4.0)],
    }


SHAPES = [(60, 15), (60, 60), (45, 30), (30, 70), (300, 15), (20, 20)]


@pytest.mark.parametrize("span,step", SHAPES)
def test_every_statistic(series, data, span, step):
    stats = ("count", "sum", "avg", "min", "max", "last", "stddev")
    rows = overtime.over_time(series(data), ["series"], span * SECOND, step * SECOND, stats).collect()
    got = {(r.series, (r.eval_ts - EPOCH).total_seconds()): r for r in rows}
    want = {}
    for name, points in data.items():
        for t, frame in frames(points, span, step).items():
            if values := [v for _, v in frame if v is not None]:
                want[name, float(t)] = values
    assert got.keys() == want.keys()
    for key, values in want.items():
        r = got[key]
        assert (r["count"], r["min"], r["max"]) == (len(values), min(values), max(values))
        assert r["sum"] == pytest.approx(sum(values), rel=1e-12, abs=1e-9) and r["avg"] == pytest.approx(np.mean(values), rel=1e-12, abs=1e-9)
        assert r["stddev"] == pytest.approx(np.std(np.array(values) - values[0]), rel=1e-7, abs=1e-9)  # a mean near 1e9 has 1e-7 of absolute error
        if key[0] != "nulls":
            assert r["last"] == values[-1]


@pytest.mark.parametrize("span,step", SHAPES)
def test_lines(series, data, span, step):
    rows = overtime.regress_over_time(series(data), ["series"], span * SECOND, step * SECOND, 60 * SECOND).collect()
    got = {(r.series, (r.eval_ts - EPOCH).total_seconds()): r for r in rows}
    want = {}
    for name, points in data.items():
        for t, frame in frames([p for p in points if p[1] is not None], span, step).items():
            x, y = np.array([a - t for a, _ in frame], float), np.array([v for _, v in frame])
            if len(x) >= 2:
                dx = x - x.mean()
                slope = (dx * (y - y.mean())).sum() / (dx * dx).sum()
                want[name, float(t)] = slope, y.mean() + slope * (60 - x.mean())
    assert got.keys() == want.keys()
    for key, (slope, ahead) in want.items():
        assert got[key].deriv == pytest.approx(slope, rel=1e-7, abs=1e-7) and got[key].predicted == pytest.approx(ahead, rel=1e-7, abs=1e-6)


@pytest.mark.parametrize("span,step", SHAPES)
def test_rises_of_counters(series, span, step):
    rng = random.Random(6)
    data = {}
    for name, grain in (("a", 5), ("b", 35)):
        value, points = 0.0, []
        for t in sorted(rng.sample(range(0, 1500, grain), 30)):
            value = 0.0 if rng.random() < 0.1 else value + rng.randrange(9)
            points.append((t, value))
        data[name] = points
    rows = overtime.counter_over_time(series(data), ["series"], span * SECOND, step * SECOND, mode="plain").collect()
    got = {(r.series, (r.eval_ts - EPOCH).total_seconds()): r.increase for r in rows}
    want = {}
    for name, points in data.items():
        for t, frame in frames(points, span, step).items():
            if len(frame) >= 2:
                values = [v for _, v in frame]
                want[name, float(t)] = sum(b if b < a else b - a for a, b in zip(values, values[1:]))
    assert got == pytest.approx(want)


def test_a_long_frame_makes_three_rows_of_a_sample_at_most(series):
    """15 s samples, 1 h of span, 15 s steps: a copy for each evaluation time would be 240 rows a sample."""
    samples = series({"a": [(15 * i, i % 11) for i in range(4000)]})
    panes = samples.select("series", F.unix_micros("ts").alias("_p"), F.lit(True).alias("_edge"), F.lit(1).cast("bigint").alias("_n"))
    parts = overtime.pieces(panes, ["series"], 3_600_000_000, 15_000_000, None, None, {"_n": F.sum("_n")})
    assert parts.count() <= 3 * (4000 + 240)  # three for each evaluation time that sees a sample
    counts = {r["_n"] for r in parts.groupBy("_t").agg(F.sum("_n").alias("_n")).filter("_t between 3600000000 and 59985000000").collect()}
    assert counts == {241}


def test_start_and_end_cut_the_grid(series, data):
    start, end = EPOCH + 100 * SECOND, EPOCH + 210 * SECOND
    whole = overtime.over_time(series(data), ["series"], 60 * SECOND, 15 * SECOND, ("sum",)).filter(F.col("eval_ts").between(start, end))
    cut = overtime.over_time(series(data), ["series"], 60 * SECOND, 15 * SECOND, ("sum",), start, end)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
