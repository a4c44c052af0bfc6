"""Approximate nearest neighbours with learned partitions.

A bounded sample gives a neighbour graph; the graph is cut into partitions of
equal size with few neighbours apart; a softmax classifier with one hidden layer
learns which partitions hold a vector's neighbours. Every row is indexed in its most probable partition.
A query goes to as many of the most probable ones as an audit against brute force
asks for and is ranked there exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import vectors
from tidewatch.session import settle

SAMPLE = 4096
PARTITIONS = 16
PART_ROWS = 1 << 16
MOST_PARTITIONS = 256
SAMPLE_A_PART = 256
GRAPH_K = 12
BLOCK = 4096
AUDIT = 96
RECALL = 0.95


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of each row."""
    k = min(k, len(x) - 1)
    norm = (x * x).sum(1)
    out = np.zeros((len(x), max(k, 0)), np.int64)
    for i in range(0, len(x), 1024):
        d = norm[None, :] - 2 * x[i : i + 1024] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        if k > 0:
            out[i : i + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Partition number of each node, all parts of equal size.

    Begins with halves along the direction of greatest spread and goes on with
    swaps: nodes ask for the part that most of their neighbours have, and the
    strongest wishes of either side are exchanged in equal numbers.
    """
    n = len(x)
    part = np.zeros(n, np.int64)
    groups, count = [np.arange(n)], 1
    while count < parts:
        halves = []
        for g in groups:
            centred = x[g] - x[g].mean(0)
            axis = np.linalg.svd(centred[:512], full_matrices=False)[2][0] if len(g) > 1 else np.ones(x.shape[1])
            order = g[np.argsort(centred @ axis, kind="stable")]
            halves += [order[: len(g) // 2], order[len(g) // 2 :]]
        groups, count = halves, count * 2
    for p, g in enumerate(groups):
        part[g] = p
    back = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    other = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        near = np.zeros((n, count))
        np.add.at(near, (back, part[other]), 1)
        here = near[np.arange(n), part]
        moved = 0
        for a in range(count):
            for b in range(a + 1, count):
                left, right = np.flatnonzero(part == a), np.flatnonzero(part == b)
                gain_l, gain_r = near[left, b] - here[left], near[right, a] - here[right]
                ol, orr = np.argsort(-gain_l, kind="stable"), np.argsort(-gain_r, kind="stable")
                m = min(len(ol), len(orr))
                swap = int((np.cumsum(gain_l[ol[:m]] + gain_r[orr[:m]] > 0) == np.arange(1, m + 1)).sum())
                part[left[ol[:swap]]], part[right[orr[:swap]]] = b, a
                moved += swap
                here[left[ol[:swap]]], here[right[orr[:swap]]] = near[left[ol[:swap]], b], near[right[orr[:swap]], a]
        if not moved:
            break
    return part


@dataclass
class Router:
    """A small network from a vector to the probability of each partition."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) * self.scale
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    @staticmethod
    def fit(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 10) -> Router:
        rng = np.random.default_rng(seed)
        mean = x.mean(0)
        scale = 1.0 / max(float((x - mean).std()), 1e-12)
        z = (x - mean) * scale
        d, p = x.shape[1], target.shape[1]
        ws = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, p)), np.zeros(p)]
        m, v, t = [np.zeros_like(w) for w in ws], [np.zeros_like(w) for w in ws], 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for k in range(0, len(order), 256):
                some = order[k : k + 256]
                h = np.maximum(z[some] @ ws[0] + ws[1], 0)
                s = h @ ws[2] + ws[3]
                e = np.exp(s - s.max(1, keepdims=True))
                g = (e / e.sum(1, keepdims=True) - target[some]) / len(some)
                gh = (g @ ws[2].T) * (h > 0)
                grads = [z[some].T @ gh + 1e-4 * ws[0], gh.sum(0), h.T @ g + 1e-4 * ws[2], g.sum(0)]
                t += 1
                for j, gr in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * gr
                    v[j] = 0.999 * v[j] + 0.001 * gr * gr
                    ws[j] -= 2e-3 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
        return Router(mean, scale, *ws)


def train(rows: DataFrame, parts: int = PARTITIONS, size: int = SAMPLE, seed: int = 10) -> Router | None:
    """A router of ``parts`` partitions from ``size`` rows at most; None if there is nothing to index."""
    _, x = vectors.sample(rows, size, seed)
    if not len(x):
        return None
    graph = neighbour_graph(x, GRAPH_K)
    part = balanced_parts(x, graph, parts)
    near = np.zeros((len(x), int(part.max()) + 1 if len(part) else 1))
    near[np.arange(len(x)), part] = 1
    if graph.shape[1]:
        np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1)
    return Router.fit(x, near / near.sum(1, keepdims=True))


def _routed(rows: DataFrame, router: Router, probes: int, filled: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``rows`` with ``parts``, the numbers of the ``probes`` most probable partitions.

    Given the rows of each partition (``filled``), as many more as hold ``least`` rows together.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            best = np.argsort(-router.scores(vectors.matrix(batch.column(1))), axis=1, kind="stable") if len(batch) else np.zeros((0, 1), np.int64)
            taken = np.arange(best.shape[1])[None, :] < np.full((len(best), 1), probes)
            if filled is not None and len(best):
                held = np.cumsum(filled[best], axis=1)
                taken |= held - filled[best] < least
            flat = pa.array(best[taken].astype(np.int32))
            ends = pa.array(np.append(0, np.cumsum(taken.sum(1))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, flat)], names=["id", "v", "parts"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("parts", T.ArrayType(T.IntegerType()))]))


def nearest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest of ``x`` to each query, by distance and then id, a query's own id left out."""
    out = []
    scale = float(np.abs(x).max(initial=0)) + float(np.abs(q).max(initial=0)) + 1e-300
    norm = ((x / scale) ** 2).sum(1)
    for i in range(0, len(q), 256):
        some, own = q[i : i + 256], q_ids[i : i + 256]
        d = norm[None, :] - 2 * (some / scale) @ (x / scale).T + ((some / scale) ** 2).sum(1)[:, None]
        d[own[:, None] == ids[None, :]] = np.inf
        for r in range(len(some)):
            row = d[r]
            least = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1]
            close = np.flatnonzero((row <= least + 1e-9) & np.isfinite(row))
            exact = np.sqrt(((x[close] - some[r]) ** 2).sum(1))
            order = np.lexsort((ids[close], exact))[:k]
            out.append(pd.DataFrame({"query_id": own[r], "vec_id": ids[close][order], "score": exact[order]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _ranked(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Exact ranking inside ``cell``, ``block`` and ``slice``; then over all cells of a query."""
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return nearest(left["id"].to_numpy(), vectors.stacked(left["v"]), right["id"].to_numpy(), vectors.stacked(right["v"]), k)

    keys = ["cell", "block", "slice"]
    found = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(table: DataFrame, every: int = 100, k: int = 10, recall: float = RECALL, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query.

    Queries are the rows whose id is divisible by ``every``. There are ``PARTITIONS``
    partitions, and beyond ``PART_ROWS`` rows in each twice as many, up to
    ``MOST_PARTITIONS``; the sample grows with them. A partition is cut into blocks of
    ``BLOCK`` rows and the queries that go to it into slices as large, so a partition
    that holds a third of all rows is many tasks, and a row is copied once per slice
    of its own partition's queries. The number of probes
    is the least that finds ``recall`` of the true neighbours of ``AUDIT`` other
    rows, which are compared with all rows. Ties go to the smaller id; rows
    that are no vectors take no part; rows that share an id are one row, the one with the
    smallest vector; an empty table gives no rows.
    """
    spark = table.sparkSession
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, total = _one_of_each(vectors.valid(table, key, vector))
    parts = partitions(total)
    router = train(rows, parts, max(SAMPLE, parts * SAMPLE_A_PART if parts > PARTITIONS else 0))
    if router is None:
        return none
    probes = audit(rows, router, k, recall)
    placed = _routed(rows, router, 1).withColumn("cell", F.col("parts")[0]).drop("parts")
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    filled = np.array([counts.get(c, 0) for c in range(len(router.b2))])
    asked = _routed(rows.filter(F.col("id") % every == 0), router, probes, filled, k + 1)
    sent = asked.withColumn("cell", F.explode("parts")).drop("parts").filter(F.col("cell").isin(*counts))
    load = {r["cell"]: r["n"] for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    if not load:
        return none
    pieces = lambda held: F.element_at(F.create_map(*[F.lit(x) for c in load for x in (c, -(-held[c] // BLOCK))]), F.col("cell"))
    blocks, slices = pieces(counts), pieces(load)
    index = placed.filter(F.col("cell").isin(*load)).withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    index = index.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    sent = sent.withColumn("slice", F.pmod(F.xxhash64("id"), slices).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return _ranked(sent, index, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def partitions(total: int) -> int:
    """Number of partitions for ``total`` rows, a power of two."""
    parts = PARTITIONS
    while parts < MOST_PARTITIONS and total > parts * PART_ROWS:
        parts *= 2
    return parts


def _one_of_each(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with the smallest vector of each id, and their number.

    Only ids are counted; vectors move only where an id repeats.
    """
    ids = settle(rows.groupBy("id").agg(F.count("*").alias("_n")))
    again = settle(ids.filter(F.col("_n") > 1).select("id"))
    least = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    return rows.join(again, "id", "left_anti").unionByName(least), ids.count()


def audit(rows: DataFrame, router: Router, k: int, recall: float, size: int = AUDIT, seed: int = 11) -> int:
    """The least number of probes with which the audited rows reach ``recall``."""
    ids, x = vectors.sample(rows, size, seed)
    parts = len(router.b2)

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            if len(batch):
                found = nearest(ids, x, batch.column(0).to_numpy(), m := vectors.matrix(batch.column(1)), k)
                cell = dict(zip(batch.column(0).to_pylist(), np.argmax(router.scores(m), axis=1).tolist()))
                found["cell"] = found["vec_id"].map(cell).astype("int32")
                yield pa.RecordBatch.from_pandas(found.astype({"query_id": "int64", "vec_id": "int64"}), preserve_index=False)

    close = rows.mapInArrow(compare, "query_id bigint, vec_id bigint, score double, cell int")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = close.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).toPandas()
    if not len(true):
        return parts
    order = np.argsort(-router.scores(x), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    row = {i: r for r, i in enumerate(ids.tolist())}
    need = np.sort(np.array([place[row[q], c] for q, c in zip(true["query_id"], true["cell"])]))
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) + 1
