"""Isolation trees on at most a few hundred rows each: growing a forest level by level and walking it.

All trees grow together, one level at a time, in array operations. What a node
draws, its feature and its cut, is a hash of the seed, the tree and the node's
place, so a tree does not depend on which others grow beside it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

EULER = 0.5772156649
LARGEST = np.finfo(float).max
WALKED = 1 << 20  # row and tree pairs that are walked at once


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    out = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, out))


def _draws(seed: int, tree: np.ndarray, node: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) by hash."""
    with np.errstate(over="ignore"):
        h = np.uint64(seed & (1 << 64) - 1) ^ tree.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = h + (node.astype(np.uint64) * np.uint64(4) + np.uint64(salt + 1)) * np.uint64(0xD1342543DE82EF95)
        for shift in (30, 27):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)).astype(float) / float(1 << 53)


def grow_all(samples: Sequence[np.ndarray], seed: int, first: int = 0) -> list[dict[str, np.ndarray]]:
    """A tree per sample, numbered from ``first``: random splits until rows are alone, equal, or the depth limit is met.

    A cut lies at or above the least value and below the greatest, also where
    rounding would put it on the greatest, so no side is ever empty. A value that
    is not a number goes right, here and in ``depths``; infinite ones count as
    the largest finite.
    """
    if not len(samples):
        return []
    rows = np.clip(np.concatenate([np.asarray(s, float) for s in samples]), -LARGEST, LARGEST)
    sizes = np.array([len(s) for s in samples])
    limit = np.array([math.ceil(math.log2(max(n, 2))) for n in sizes])
    tree = np.repeat(np.arange(len(samples)), sizes)
    place = np.ones(len(rows), np.int64)  # the root is 1, the children of i are 2i and 2i + 1
    done: list[tuple] = []
    depth = 0
    while len(rows):
        order = np.lexsort((place, tree))
        rows, tree, place = rows[order], tree[order], place[order]
        new = np.ones(len(rows), bool)
        new[1:] = (tree[1:] != tree[:-1]) | (place[1:] != place[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(rows)))
        low, high = np.fmin.reduceat(rows, start), np.fmax.reduceat(rows, start)
        wide = high > low
        choices = wide.sum(axis=1)
        t, at = tree[start], place[start]
        split = (depth < limit[t]) & (count > 1) & (choices > 0)
        pick = np.minimum((_draws(seed, t + first, at, 0) * choices).astype(int), np.maximum(choices - 1, 0))
        feature = np.argmax(np.cumsum(wide, axis=1) == (pick + 1)[:, None], axis=1)
        every = np.arange(len(start))
        a, b = low[every, feature], high[every, feature]
        drawn = _draws(seed, t + first, at, 1)
        with np.errstate(invalid="ignore", over="ignore"):
            cut = a * (1.0 - drawn) + b * drawn  # no difference of the two, which could overflow
            cut = np.minimum(np.maximum(cut, a), np.nextafter(b, a))
        done.append((t, at, np.where(split, feature, -1), np.where(split, cut, 0.0), np.where(split, 0.0, depth + average_path(count))))
        own = np.repeat(every, count)
        stay = split[own]
        own, rows, tree, place = own[stay], rows[stay], tree[stay], place[stay]
        left = rows[np.arange(len(rows)), feature[own]] <= cut[own]
        place = 2 * place + ~left
        depth += 1
    t, at, feature, cut, leaf = (np.concatenate(c) for c in zip(*done))
    order = np.lexsort((at, t))
    t, at, feature, cut, leaf = t[order], at[order], feature[order], cut[order], leaf[order]
    bounds = np.searchsorted(t, np.arange(len(samples) + 1))
    out = []
    for i, j in zip(bounds[:-1], bounds[1:]):
        inner = feature[i:j] >= 0
        child = np.searchsorted(at[i:j], 2 * at[i:j])
        out.append({
            "feature": feature[i:j].astype(np.int32), "threshold": cut[i:j], "left": np.where(inner, child, -1).astype(np.int32),
            "right": np.where(inner, child + 1, -1).astype(np.int32), "depth": leaf[i:j],
        })
    return out


def grow(rows: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree."""
    return grow_all([rows], int(rng.integers(1 << 62)))[0]


def flat(trees: Sequence[dict]) -> dict[str, np.ndarray]:
    """The nodes of all trees in one array each, and where every tree begins."""
    lengths = [len(t["feature"]) for t in trees]
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    joined = {c: np.concatenate([np.asarray(t[c]) for t in trees]) for c in ("feature", "threshold", "depth")}
    for side in ("left", "right"):
        joined[side] = np.concatenate([np.asarray(t[side], np.int64) + b for t, b in zip(trees, begin)])
    return {**joined, "begin": begin}


def _walk(nodes: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Path length of every row in every tree."""
    rows = np.clip(rows, -LARGEST, LARGEST)
    at = np.broadcast_to(nodes["begin"], (len(rows), len(nodes["begin"]))).copy()
    row, tree = np.divmod(np.arange(at.size), max(1, at.shape[1]))
    place = at.ravel()
    while len(row):
        feature = nodes["feature"][place]
        inner = feature >= 0
        at[row[~inner], tree[~inner]] = place[~inner]
        row, tree, place, feature = row[inner], tree[inner], place[inner], feature[inner]
        left = rows[row, feature] <= nodes["threshold"][place]
        place = np.where(left, nodes["left"][place], nodes["right"][place])
    return nodes["depth"][at]


def depths(tree: dict, rows: np.ndarray) -> np.ndarray:
    """Path length of every row, unresolved leaves counted with their mean depth."""
    return _walk(flat([tree]), np.asarray(rows, float))[:, 0]


def score(trees: Sequence[dict] | dict, rows: np.ndarray, sample: int) -> np.ndarray:
    """``-2^(-E[h]/c)``: near -1 for rows that are isolated early. ``trees`` may be ``flat`` already."""
    nodes = trees if isinstance(trees, dict) else flat(trees)
    rows = np.asarray(rows, float)
    step = max(1, WALKED // max(1, len(nodes["begin"])))
    means = [_walk(nodes, rows[i : i + step]).mean(axis=1) for i in range(0, len(rows), step)]
    mean = np.concatenate(means) if means else np.zeros(0)
    return -np.power(2.0, -mean / max(float(average_path(sample)), 1e-12))
