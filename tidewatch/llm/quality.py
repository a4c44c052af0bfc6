"""Quality classifier by co-training of two views.

The content view sees what a text says: hashed byte trigrams and words that
repeat the ones before. The metadata view sees what is known about the page
around it: language, source, length and layout counts. Each is a logistic
regression. Over some rounds each labels the unlabelled sample it is surest
about for the other; then both are calibrated on labelled rows kept aside and
their log odds are added.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import textscan

TRAIN_ROWS = 4000
POOL_ROWS = 1500
ROUNDS = 3
SURE = 0.95
A_ROUND = 200
REJECT_BELOW = 0.3
BINS = 1 << 10
LAYOUT = 14
HASHED = 16
PIECE = 1 << 18  # bytes that one step of a task scores and sends on; a step's arrays are many times as large
_TRI = np.random.default_rng(20240103).integers(0, 1 << 63, (3, 256), dtype=np.uint64)


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """``bin, row`` of the content features of some rows."""
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = len(data)
    tri = _TRI[0][data[: n - 2]] ^ _TRI[1][data[1 : n - 1]] ^ _TRI[2][data[2:]] if n > 2 else np.zeros(0, np.uint64)
    inside = row_of[:-2] == row_of[2:] if n > 2 else np.zeros(0, bool)
    bins = (textscan.mixed(tri[inside]) % np.uint64(BINS - 8)).astype(np.int64) + 8
    return bins, row_of[: len(inside)][inside]


def content(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Dense content features: shares of trigram bins (square roots) and of repeated words."""
    rows = len(offsets) - 1
    bins, row = _tokens(data, offsets)
    counts = np.bincount(row * BINS + bins, minlength=rows * BINS).reshape(rows, BINS).astype(np.float32)
    counts /= np.maximum(counts.sum(1, keepdims=True), 1)
    out = np.sqrt(counts)
    again = _repeats(data, offsets)
    out[:, :3] = again
    # a little repetition says as much as a lot: saturating shares of words said twice in a row
    out[:, 3:8] = np.minimum(again[:, :1] * np.array([2.0, 4.0, 8.0, 16.0, 32.0]), 1.0)
    return out


def _repeats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of words equal to the one before, and equal to one 20 to 40 words before; and of rare doubles."""
    start, stop, first = textscan.words(data, offsets)
    h = textscan.word_hashes(data, start, stop)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    words = np.maximum(np.diff(first), 1)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out = np.zeros((rows, 3))
    out[:, 0] = np.bincount(row, same, minlength=rows) / words
    pair = textscan.mixed(h[:-1] ^ (h[1:] >> np.uint64(1))) if len(h) > 1 else np.zeros(0, np.uint64)
    inner = row[1:] == row[:-1]
    key = pair[inner] ^ textscan.mixed(row[1:][inner].astype(np.uint64))
    distinct = np.unique(key, return_index=True)[1]
    kinds = np.bincount(row[1:][inner][distinct], minlength=rows)
    out[:, 1] = 1 - np.where(words > 1, kinds / np.maximum(words - 1, 1), 1)
    key = h ^ textscan.mixed(row.astype(np.uint64))
    kinds = np.bincount(row[np.unique(key, return_index=True)[1]], minlength=rows)
    out[:, 2] = 1 - kinds / words
    return out


def metadata(data: np.ndarray, offsets: np.ndarray, lang: list, source: list, n_chars: list) -> np.ndarray:
    """Record fields and layout counts: bytes of each class, lengths of words and lines."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=rows) / size

    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    space, line = (data == 32), (data == 10)
    comma = (data == 44) | (data == 46)
    symbol = ~(letter | digit | space | line | comma)
    words, lines = share(space | line) * size + 1, share(line) * size + 1
    out = np.zeros((rows, LAYOUT + 2 * HASHED))
    columns = (share(upper), share(digit), share(space), share(line), share(comma), share(symbol), share(letter), share(data == 124), share(data == 33),
               np.minimum(size / words, 40) / 10, np.log1p(size / lines) / 5, np.log1p(size) / 10,
               np.log1p(np.array([max(c, 0) if c is not None else 0 for c in n_chars], np.float64)) / 10,
               np.array([c is None for c in n_chars], np.float64))
    for k, c in enumerate(columns):
        out[:, k] = c
    for k, values in enumerate((lang, source)):
        for r, v in enumerate(values):
            at = int.from_bytes(str(v).encode()[-8:], "little") if v is not None else 0
            out[r, LAYOUT + k * HASHED + (at * 2654435761 >> 7) % HASHED] = 0.2
    return out


@dataclass
class Logistic:
    """Ridge logistic regression; ``odds`` are log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) * self.scale) @ self.weight + self.bias

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 250) -> Logistic:
        mean, scale = x.mean(0), 1 / (x.std(0) + 1e-3)
        z = x - mean
        z *= scale
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        # both classes weigh the same
        each = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(y)
        w, b = np.zeros(x.shape[1]), 0.0
        m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for t in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30)))
            g = np.append(z.T @ (each * (p - y)) + ridge * w, (each * (p - y)).sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
            w, b = w - step[:-1], b - step[-1]
        return Logistic(mean, scale, w, b)

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        """Slope and shift by Platt's method, with its smoothed targets."""
        raw = self.raw(x)
        good, bad = (y > 0.5).sum(), (y <= 0.5).sum()
        target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
        width = float(raw.std()) or 1.0
        z, a, c = raw / width, 1.0, 0.0

        def loss(a: float, c: float) -> float:
            return float(np.mean(np.logaddexp(0, a * z + c) - target * (a * z + c)) + 1e-5 * (a - 1) ** 2)

        # damped Newton steps: halved until the loss falls
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            g = np.array([np.mean((p - target) * z) + 2e-5 * (a - 1), np.mean(p - target)])
            hess = np.array([[np.mean(w * z * z) + 2e-5, np.mean(w * z)], [np.mean(w * z), np.mean(w) + 1e-6]])
            da, dc = np.linalg.solve(hess, g)
            step = 1.0
            while step > 1e-6 and loss(a - step * da, c - step * dc) > loss(a, c):
                step /= 2
            a, c = a - step * da, c - step * dc
            if step * (abs(da) + abs(dc)) < 1e-9 or step <= 1e-6:
                break
        a /= width
        return Logistic(self.mean, self.scale, self.weight, self.bias, max(float(a), 1e-3), float(c))


@dataclass
class CoTrained:
    content: Logistic
    metadata: Logistic
    prior: float

    def odds(self, x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
        """Log odds of both views together; what both know beforehand counts once."""
        return self.content.odds(x1) + self.metadata.odds(x2) - self.prior


def co_train(x1, x2, y, u1, u2, rounds: int = ROUNDS, a_round: int = A_ROUND, sure: float = SURE) -> CoTrained:
    """Train on labelled ``x1, x2, y`` and exchange pseudo-labels of ``u1, u2``. Every fifth labelled row calibrates."""
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[~aside].tolist())) < 2 or len(set(y[aside].tolist())) < 2:
        aside[:] = False
    extra = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(2)]
    views = [(x1, u1), (x2, u2)]
    models: list[Logistic] = []
    share = float(y[~aside].mean())
    for turn in range(rounds + 1):
        models = []
        for (x, u), (index, labels) in zip(views, extra):
            models.append(Logistic.fit(np.concatenate([x[~aside], u[index]]), np.concatenate([y[~aside], labels])))
        if turn == rounds or not len(u1):
            break
        for k in range(2):
            p = 1 / (1 + np.exp(-np.clip(models[k].raw(views[k][1]), -30, 30)))
            known = np.isin(np.arange(len(p)), extra[1 - k][0])
            best, worst = np.argsort(-p, kind="stable"), np.argsort(p, kind="stable")
            good = [i for i in best[: int(a_round * share) + 1] if p[i] > sure and not known[i]]
            bad = [i for i in worst[: int(a_round * (1 - share)) + 1] if p[i] < 1 - sure and not known[i]]
            index, labels = extra[1 - k]
            extra[1 - k] = np.append(index, np.array(good + bad, np.int64)), np.append(labels, [1.0] * len(good) + [0.0] * len(bad))
    check = aside if aside.any() else ~aside
    base = float(np.clip(y[check].mean(), 1e-3, 1 - 1e-3))
    return CoTrained(models[0].calibrated(x1[check], y[check]), models[1].calibrated(x2[check], y[check]), float(np.log(base / (1 - base))))


def _features(batch: pa.RecordBatch, at: dict[str, int]):
    """``first row, content, metadata`` of runs of rows."""
    data, offsets = textscan.column_bytes(batch.column(at["text"]))
    side = [batch.column(at[c]).to_pylist() if c in at else [None] * len(batch) for c in ("lang", "source", "n_chars")]
    for i, j in textscan.groups_of(offsets, PIECE):
        for a in range(i, j, 256):
            b = min(a + 256, j)
            part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            yield content(part, o), metadata(part, o, *(c[a:b] for c in side))


def _views(docs: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    names = ["text", *(c for c in ("lang", "source", "n_chars") if c in docs.columns)]
    return docs.select("doc_id", *names), {c: k + 1 for k, c in enumerate(names)}


def _sample(docs: DataFrame, ids: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Both views of the documents with the given ids, by id. The ids are a bounded sample."""
    rows, at = _views(docs)
    chosen = rows.join(F.broadcast(ids), "doc_id", "left_semi")

    def run(batches):
        for batch in batches:
            start = 0
            for x1, x2 in _features(batch, at):
                n = len(x1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), pa.array([r.tobytes() for r in x1.astype("<f4")]), pa.array([r.tobytes() for r in x2.astype("<f4")])],
                    names=["doc_id", "a", "b"],
                )
                start += n

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(textscan.lean(run), f"doc_id {kind}, a binary, b binary").collect()
    return {r["doc_id"]: (np.frombuffer(r["a"], "<f4"), np.frombuffer(r["b"], "<f4")) for r in sorted(found, key=lambda r: (r["doc_id"], r["a"]))}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, pool: int = POOL_ROWS, seed: int = 9) -> CoTrained | None:
    """A model from at most ``rows`` labelled and ``pool`` unlabelled documents, by seeded hash of the id.

    A document labelled more than once counts as good only if all say so; null
    labels are none. Without labels of both kinds there is no model.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"))
    order = F.xxhash64(F.lit(seed), "doc_id")
    here = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    took = known.join(here, "doc_id", "left_semi").orderBy(order, "doc_id").limit(rows).collect()
    y_of = {r["doc_id"]: float(r["y"]) for r in took}
    if len(set(y_of.values())) < 2:
        return None
    rest = here.join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(pool).collect()
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in (*took, *rest)], f"doc_id {kind}")
    views = _sample(docs, ids)
    lab = [r["doc_id"] for r in took if r["doc_id"] in views]
    free = [r["doc_id"] for r in rest if r["doc_id"] in views]

    def side(some, k):
        return np.stack([views[i][k] for i in some]) if some else np.zeros((0, BINS if k == 0 else LAYOUT + 2 * HASHED), np.float32)

    return co_train(side(lab, 0), side(lab, 1), np.array([y_of[i] for i in lab]), side(free, 0), side(free, 1))


def score(docs: DataFrame, model: CoTrained | None, threshold: float = REJECT_BELOW) -> DataFrame:
    """``docs`` with ``quality_score`` (probability of good) and ``keep``.

    Every row stays, in place. Null and empty texts are scored by their
    metadata; without a model every row is kept with a null score.
    """
    rest = [c for c in docs.columns if c not in ("quality_score", "keep")]
    source = docs.select(*rest)
    if model is None:
        return source.withColumns({"quality_score": F.lit(None).cast("double"), "keep": F.lit(True)})
    at = {c: k for k, c in enumerate(rest)}
    schema = T.StructType([*source.schema, T.StructField("quality_score", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def run(batches):
        for batch in batches:
            start = 0
            for x1, x2 in _features(batch, at):
                p = 1 / (1 + np.exp(-np.clip(model.odds(x1, x2), -500, 500)))
                here = batch.slice(start, len(p))
                yield pa.RecordBatch.from_arrays([*here.columns, pa.array(p), pa.array(p >= threshold)], names=[*rest, "quality_score", "keep"])
                start += len(p)

    return source.mapInArrow(textscan.lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
