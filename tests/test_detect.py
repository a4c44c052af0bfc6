"""Forest, density clustering and components against brute force and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import trees
from tidewatch.operators import density, forest
from tidewatch.operators.components import components


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(400, 3))
    rows[17] = 8.0
    return spark.createDataFrame([("s", i, *map(float, r)) for i, r in enumerate(rows)], "scope string, id int, a double, b double, c double")


def test_forest_is_the_same_under_any_partitioning(cloud):
    run = lambda n: {r.id: (r.score, r.is_anomaly) for r in forest.detect(cloud.repartition(n), ["scope"], ["id"], ["a", "b", "c"], 50).collect()}
    one = run(1)
    assert one == run(7) and len(one) == 400
    assert min(one, key=lambda i: one[i][0]) == 17
    assert abs(sum(flag for _, flag in one.values()) - 20) <= 1
    assert all(-1 <= score <= 0 for score, _ in one.values())


def test_forest_draws_whole_samples(cloud):
    drawn = forest.tree_samples(cloud, ["scope"], ["id"], ["a"], 10, 42, sample=64).groupBy("tree").count().collect()
    assert [r["count"] for r in drawn] == [64] * 10


def test_sweep_counts_rise(cloud):
    scored = forest.detect(cloud, ["scope"], ["id"], ["a", "b", "c"], 20)
    got = [r.anomalies for r in forest.sweep(scored, ["scope"], [0.01, 0.05, 0.1]).orderBy("contamination").collect()]
    assert got == [4, 20, 40]


@pytest.mark.parametrize("low", [0.0, 1.0, -3.7e9, 1e300, -np.finfo(float).max])
def test_trees_grow_on_neighbouring_values(low):
    """Ranges of one unit in the last place, and the widest there are."""
    high = np.nextafter(low, np.inf) if low > -1e308 else np.finfo(float).max
    rows = np.array([[low, 0.0], [high, 0.0], [low, 0.0], [high, 0.0]])
    for seed in range(2500):
        tree = trees.grow(rows, np.random.default_rng(seed))
        cut = tree["threshold"][0]
        assert low <= cut < high and len(tree["feature"]) == 3
        assert list(trees.depths(tree, rows)) == [2.0] * 4


def test_trees_take_values_that_are_no_numbers():
    rows = np.array([[1.0, np.nan], [2.0, np.inf], [np.nan, -np.inf], [3.0, 5.0]])
    for seed in range(200):
        tree = trees.grow(rows, np.random.default_rng(seed))
        assert np.isfinite(trees.depths(tree, rows)).all() and np.isfinite(tree["threshold"]).all()


def brute(points, eps, least):
    near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label, found = np.full(len(points), -1), 0
    for i in range(len(points)):
        if core[i] and label[i] < 0:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] < 0:
                    label[j] = found
                    todo += [k for k in np.flatnonzero(near[j]) if core[j] and label[k] < 0]
            found += 1
    return core, label


def blobs(kind):
    rng = np.random.default_rng(3)
    if kind == "blobs":  # two dense groups, a thin bridge, noise
        parts = [rng.normal(0, 0.3, (120, 2)), rng.normal(3, 0.3, (80, 2)), np.linspace([0, 0], [3, 3], 12), rng.uniform(-4, 7, (30, 2))]
    elif kind == "copies":  # a third of the rows are equal
        parts = [np.zeros((80, 3)), rng.normal(0, 1.0, (120, 3)), rng.normal(6, 0.5, (40, 3))]
    elif kind == "rings":  # shapes that no box describes
        turn = np.linspace(0, 2 * np.pi, 150, endpoint=False)
        circle = np.column_stack([np.cos(turn), np.sin(turn)])
        parts = [circle, 3 * circle, rng.normal(0, 0.05, (20, 2))]
    else:
        parts = [rng.normal(0, 1, (250, 4))]
    return np.vstack(parts)


@pytest.mark.parametrize("kind,eps,least", [("blobs", 0.5, 5), ("copies", 0.9, 5), ("rings", 0.35, 4), ("flat", 0.9, 5)])
def test_dbscan_equals_brute_force(spark, kind, eps, least):
    points = blobs(kind)
    points = points[np.random.default_rng(1).permutation(len(points))]
    names = [f"f{i}" for i in range(points.shape[1])]
    frame = spark.createDataFrame([("s", i, *map(float, p)) for i, p in enumerate(points)],
                                  "scope string, id int, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    got = {r.id: (r.is_core, r.cluster) for r in density.dbscan(frame, ["scope"], "id", names, eps, least).collect()}
    core, label = brute(points, eps, least)
    assert len(got) == len(points)
    assert [got[i][0] for i in range(len(points))] == core.tolist()
    # noise is the same; core rows get the same clusters; border rows a cluster they touch
    assert [got[i][1] < 0 for i in range(len(points))] == (label < 0).tolist()
    assert [got[i][1] for i in np.flatnonzero(core)] == label[core].tolist()
    near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1) <= eps * eps
    for i in np.flatnonzero(~core & (label >= 0)):
        assert got[i][1] == min(label[j] for j in np.flatnonzero(near[i] & core))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(160, 159), (300, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 161)) and got[301] == 300
    assert len(got) == 40 + 61 + 2
