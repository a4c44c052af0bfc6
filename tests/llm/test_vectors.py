"""Vector operators against brute force."""

import numpy as np
import pytest

from tidewatch.llm import ann, neighbours, vectors

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(700):
        v = centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 == 0 else 0.8)
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(700 + i, rows[0][1]) for i in range(40)]  # copies
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [NAN] + [1.0] * 15), (1003, [INF] + [1.0] * 15), (1004, [None] + [1.0] * 15), (1005, [1.0] * 3), (1006, [])]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), rows


def sound(rows):
    return [(i, np.array(v)) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]


def test_links_equal_brute_force(cloud):
    frame, rows = cloud
    good = sound(rows)
    unit = vectors.unit(np.stack([v for _, v in good]))
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    ids = np.array([i for i, _ in good])
    label = ids.copy()
    for _ in range(len(ids)):
        least = np.minimum(label, np.where(near, label[None, :], 1 << 40).min(1))
        if (least == label).all():
            break
        label = least
    want = {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label)}
    got = {r.vec_id: r for r in neighbours.near_duplicates(frame).collect()}
    assert len(got) == len(rows)
    for i, _ in rows:
        n, c = want.get(i, (0, i))
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, i == c)


def test_large_components_in_blocks(cloud, monkeypatch):
    frame, _ = cloud
    whole = sorted(map(tuple, neighbours.near_duplicates(frame).collect()))
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    assert sorted(map(tuple, neighbours.near_duplicates(frame).collect())) == whole


@pytest.mark.parametrize("size, block", [(20, 1024), (45, 16)])
def test_groups_tighter_than_a_list_are_joined(spark, monkeypatch, size, block):
    """Two groups of over ten vectors each, 0.99 inside and about 0.93 across, and one further off."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    centres = [axes[0], 0.94 * axes[0] + np.sqrt(1 - 0.94**2) * axes[1], axes[2]]
    x = np.concatenate([c + rng.normal(size=(size, 32)) * 0.012 for c in centres])
    unit = vectors.unit(x)
    near = unit @ unit.T >= 0.9
    assert near[: 2 * size, : 2 * size].all() and not near[2 * size :, : 2 * size].any()
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(frame).collect()}
    assert got == {i: (2 * size - 1, 0) if i < 2 * size else (size - 1, 2 * size) for i in range(3 * size)}


def test_poor_lists_end_in_an_exact_comparison(spark, monkeypatch):
    """One cluster that is found and many pairs that are not: the audit sees the pairs, and all are found in the end."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=24)
    singles = rng.normal(size=(40, 24))
    x = np.concatenate([centre + rng.normal(size=(60, 24)) * 0.02, singles, singles + rng.normal(size=(40, 24)) * 0.02])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    everything = neighbours.best_pairs

    def cluster_only(ids, unit, k, floor=None):
        a, b, s = everything(ids, unit, k, floor)
        keep = (a < 60) & (b < 60)
        return a[keep], b[keep], s[keep]

    monkeypatch.setattr(neighbours, "ATTEMPTS", 1)
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    monkeypatch.setattr(neighbours, "best_pairs", cluster_only)
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(frame).collect()}
    assert got == {i: (59, 0) if i < 60 else (1, 60 + (i - 60) % 40) for i in range(140)}


def test_leaves_are_halved_by_place():
    assert [neighbours._depth(n) for n in (100, 1000, 131072, 10_000_000)] == [0, 3, 10, 11]
    x = np.concatenate([np.eye(2).repeat(300, 0)])
    pieces = neighbours.halves(x + np.random.default_rng(0).normal(size=x.shape) * 1e-3, 320, np.random.default_rng(1))
    assert sorted(map(len, pieces)) == [300, 300] and all(p.max() < 300 or p.min() >= 300 for p in pieces)


def test_search_recall_and_order(cloud, monkeypatch):
    frame, rows = cloud
    monkeypatch.setattr(ann, "BLOCK", 100)
    got = {}
    for r in ann.search(frame, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = dict(sound(rows))
    hit = total = 0
    assert set(got) == {i for i in good if i % 10 == 0}
    for q, found in got.items():
        true = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and sorted((s, i) for _, i, s in found) == [(s, i) for _, i, s in found]
        assert all(s == float(np.sqrt(((good[i] - good[q]) ** 2).sum())) for _, i, s in found)
        hit += len({i for _, i in true} & {i for _, i, _ in found})
        total += len(true)
    assert hit >= 0.9 * total


def test_slices_and_partitions_follow_the_count(cloud, monkeypatch):
    """Twice the partitions, blocks and slices of seven rows: the same neighbours, at most a copy per slice of a row's own partition."""
    frame, rows = cloud
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "PART_ROWS", 30)
    assert [ann.partitions(n) for n in (0, 480, 481, 961, 10**9)] == [16, 16, 32, 64, 256]
    copies = {}
    ranked = ann._ranked

    def counted(queries, index, k):
        copies["most"] = index.groupBy("id").count().agg({"count": "max"}).first()[0]
        copies["slices"] = queries.groupBy("cell").agg({"slice": "max"}).agg({"max(slice)": "max"}).first()[0] + 1
        return ranked(queries, index, k)

    monkeypatch.setattr(ann, "_ranked", counted)
    got = {}
    for r in ann.search(frame, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    good = dict(sound(rows))
    hit = 0
    for q, found in got.items():
        true = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        assert sorted(found) == [(n, s, i) for n, (s, i) in enumerate(sorted((s, i) for _, s, i in found), 1)] and len(found) == 10
        hit += len({i for _, i in true} & {i for *_, i in found})
    assert len(got) == 74 and hit >= 0.9 * 740
    assert 1 < copies["most"] <= copies["slices"]


def test_rows_of_one_id_are_the_smallest_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (3, [0.0, 1.0]), (3, [5.0, 5.0]), (4, [0.0, 2.0]), (4, [0.0, 2.0]), (5, None), (5, [9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r["rank"], r.vec_id, round(r.score, 6)) for r in ann.search(frame).orderBy("rank").collect()]
    assert got == [(1, 3, round(1.25**0.5, 6)), (2, 4, round(4.25**0.5, 6)), (3, 5, round((8.5**2 + 81) ** 0.5, 6))]
    assert ann.search(frame.filter("vec_id > 0")).isEmpty()


def test_few_and_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ann.search(none).count() == neighbours.near_duplicates(none).count() == 0
    few = spark.createDataFrame([(100, [1.0, 0.0], "x"), (7, [0.9, 0.1], "y"), (7, [0.9, 0.1], "y"), (None, [1.0, 1.0], "z")], "vec_id bigint, embedding array<float>, links string")
    assert [r.vec_id for r in ann.search(few).collect()] == [7]
    linked = neighbours.near_duplicates(few).collect()
    assert len(linked) == 4 and {r.component_id for r in linked if r.vec_id is not None} == {7}


def test_partitions_are_balanced():
    x = np.random.default_rng(1).normal(size=(512, 8))
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 8), 8)
    assert np.bincount(part).tolist() == [64] * 8


def test_ids_that_repeat_are_judged_by_their_own_vectors(spark):
    rows = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (9, [1.0, 0.01]), (9, None), (11, [0.0, 1.0]), (9, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, neighbours.near_duplicates(frame).select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == sorted([(7, 1, 7, True), (7, 1, 7, True), (9, 1, 7, False), (9, 0, 9, True), (11, 1, 7, False), (9, 0, 9, True)])
