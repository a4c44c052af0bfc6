"""Isolation forest over any number of scopes.

Sampling is by hash of the row key, so the same rows are drawn under any
partitioning. Rows are scored in blocks of bounded size that meet the trees of
their scope in a cogroup; nothing is collected or broadcast. Splits depend only
on the order of values within a feature's range, so scaling would not change
the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.trees import flat, grow_all, score
from tidewatch.layout import attach, exact_quantiles, join_keys
from tidewatch.operators.vectors import topk
from tidewatch.session import settle

SAMPLE = 256
SCORE_ROWS = 1 << 19
TOGETHER = 10  # trees of a scope that are grown in one go


def _share(*columns) -> Column:
    """Hash as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def _sizes(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    return df.groupBy(*scope).agg(F.count("*").alias("_n"))


def tree_samples(
    df: DataFrame, scope: Sequence[str], key: Sequence[str], features: Sequence[str], trees: int, seed: int, sample: int = SAMPLE
) -> DataFrame:
    """``min(sample, n)`` rows per scope and tree, each tree's drawn from all rows.

    The hash of a row is a place on a circle and tree ``t`` looks at an arc of
    it that begins at ``t / trees`` and holds about four samples, so a row is
    copied to the few trees that see it only. Each tree takes the first of its
    arc by a hash of its own.
    """
    rows = attach(df.select(*scope, *key, *features), _sizes(df, scope), scope)
    place = _share(*key, F.lit(seed)) * trees
    arc = F.least(F.lit(float(trees)), F.lit(4.0 * sample * trees) / F.col("_n"))
    rows = rows.withColumns({"_at": F.floor(place), "_seen": F.ceil(arc - (place - F.floor(place))).cast("int")}).filter("_seen > 0")
    tree = F.pmod(F.col("_at") - F.col("_k"), F.lit(trees)).cast("int")
    drawn = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.least("_seen", F.lit(trees)) - 1))).withColumn("tree", tree)
    drawn = drawn.withColumn("_h", _share(*key, "tree", F.lit(seed)))
    order = [F.col("_h"), *[F.col(k) for k in key]]
    return topk(drawn, sample, order, at=[*scope, "tree"]).select(*scope, "tree", "rank", "_n", *features)


def fit_forest(
    df: DataFrame, scope: Sequence[str], key: Sequence[str], features: Sequence[str], trees: int = 100, seed: int = 42,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per scope and tree: its nodes as arrays."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    head = ", ".join(f"`{c}` {types[c]}" for c in scope)
    scope, features = list(scope), list(features)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["tree", "rank"])
        numbers, first = np.unique(part["tree"].to_numpy(), return_index=True)
        samples = np.split(part[features].to_numpy(float), first[1:])
        grown = [grow_all([rows], seed, int(n))[0] for n, rows in zip(numbers, samples)] if len(set(np.diff(numbers))) > 1 else grow_all(samples, seed, int(numbers[0]))
        names = part[scope].iloc[0].tolist()
        return pd.DataFrame([[*names, int(n), len(rows), *tree.values()] for n, rows, tree in zip(numbers, samples, grown)],
                            columns=[*scope, "tree", "rows", *grown[0]])

    # an explicit number of partitions, as the few rows of a tree cost more to grow than to move
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    samples = tree_samples(df, scope, key, features, trees, seed, sample).withColumn("_run", F.floor(F.col("tree") / TOGETHER))
    return samples.repartition(parts, *scope, "_run").groupBy(*scope, "_run").applyInPandas(
        build,
        f"{head}, tree int, rows int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
        "depth array<double>",
    )


def score_rows(
    df: DataFrame, forest: DataFrame, scope: Sequence[str], key: Sequence[str], features: Sequence[str],
    block_rows: int = SCORE_ROWS,
) -> DataFrame:
    """Columns of ``df`` and ``score``; lower is more unusual."""
    scope, features = list(scope), list(features)
    sizes = _sizes(df, scope).withColumn("_blocks", F.ceil(F.col("_n") / F.lit(block_rows))).drop("_n")
    rows = attach(df, sizes, scope).withColumn("_blk", F.pmod(F.xxhash64(*key), F.col("_blocks"))).drop("_blocks")
    copies = join_keys(forest, sizes, scope).withColumn("_blk", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    copies = copies.withColumn("_blk", F.col("_blk").cast("bigint")).drop("_blocks")
    columns = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", score double"

    def apply(part: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame(columns=[*columns, "score"])
        ordered = trees.sort_values("tree").to_dict("records")
        part = part[columns].copy()
        part["score"] = score(flat(ordered), part[features].to_numpy(float), int(ordered[0]["rows"]))
        return part

    by = [*scope, "_blk"]
    return rows.groupBy(*by).cogroup(copies.groupBy(*by)).applyInPandas(apply, schema)


def detect(
    df: DataFrame, scope: Sequence[str], key: Sequence[str], features: Sequence[str], trees: int = 100,
    contamination: float = 0.05, seed: int = 42,
) -> DataFrame:
    """Fit, score and flag: ``decision = score - quantile(score, contamination)``, anomalous below 0."""
    df = settle(df)  # the rows are read four times, and features are often windows over all of them
    forest = fit_forest(df, scope, key, features, trees, seed)
    # scored once, read by the quantile and by the result
    scored = settle(score_rows(df, forest, scope, key, features))
    cut = exact_quantiles(scored, scope, "score", {"_offset": contamination})
    out = attach(scored, cut, scope).withColumn("decision", F.col("score") - F.col("_offset")).drop("_offset")
    return out.withColumn("is_anomaly", F.col("decision") < 0)


def sweep(scored: DataFrame, scope: Sequence[str], levels: Sequence[float]) -> DataFrame:
    """Rows flagged at each contamination, all from one set of scores."""
    names = {f"_q{i}": level for i, level in enumerate(levels)}
    cuts = exact_quantiles(scored, scope, "score", names)
    rows = attach(scored.select(*scope, "score"), cuts, scope)
    counts = rows.groupBy(*scope).agg(*[F.count_if(F.col("score") < F.col(n)).alias(n) for n in names])
    cells = F.array(*[F.struct(F.lit(level).alias("contamination"), F.col(n).alias("anomalies")) for n, level in names.items()])
    return counts.select(*scope, F.explode(cells).alias("_c")).select(*scope, "_c.contamination", "_c.anomalies")
