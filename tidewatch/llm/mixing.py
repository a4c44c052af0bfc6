"""Mixing sources to target weights by fitting each source's budget as a subset sum."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.tables import word_count
from tidewatch.session import settle

WEIGHTS = (5.0, 2.0, 1.0)
GROUP_ROWS = 256
DP_BUDGET = 1 << 16


def fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight; what lies over ``most`` times a size is shared among the rest again."""
    target, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes)], float(total)
    while open_:
        unit = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / unit > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i] / unit
            break
        for i in over:
            target[i] = most * sizes[i]
        left -= sum(target[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return target


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, limit: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each size to take so that their sum comes as near below ``budget`` as it can.

    A proportional share is taken first; then bounded-knapsack dynamic programming
    over the documents left spends what remains, up to ``limit`` words of it.
    """
    taken = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    taken = (counts * (budget / total)).astype(np.int64)
    left = budget - int((taken * sizes).sum())
    # the largest documents first, while more is left than the programme handles
    for i in np.argsort(-sizes, kind="stable"):
        if left <= limit:
            break
        more = min(int(counts[i] - taken[i]), (left - limit) // int(sizes[i]) + 1 if sizes[i] else 0, left // int(sizes[i]) if sizes[i] else 0)
        taken[i] += more
        left -= more * int(sizes[i])
    room = int(min(left, limit))
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    chosen_item, chosen_times = np.full(room + 1, -1, np.int64), np.zeros(room + 1, np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        size, spare = int(sizes[i]), int(counts[i] - taken[i])
        if size <= 0 or size > room or spare <= 0:
            continue
        block = 1
        spare = min(spare, room // size)
        while spare > 0 and not reach[room]:
            times = min(block, spare)
            step = size * times
            fresh = np.flatnonzero(reach[: room + 1 - step] & ~reach[step:]) + step
            chosen_item[fresh], chosen_times[fresh] = i, times
            reach[fresh] = True
            spare -= times
            block *= 2
        if reach[room]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, times = int(chosen_item[at]), int(chosen_times[at])
        taken[i] += times
        at -= times * int(sizes[i])
    return taken


def mix(
    docs: DataFrame, *, source: str = "source", size: str = "size", key: str = "doc_id", weights: Sequence[float] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, seed: int = 8,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` (0, 1 or 2 of each document).

    Sources by code point, null last, get the weights in turn. Documents of a
    source are counted by exact size; ``fit`` says how many of each size are
    taken once more than the whole passes, and a seeded hash of the whole row
    (columns of maps left out) says which, so rows without an id or of one id are
    told apart by the rest; rows equal in all of it are interchangeable. Sizes of
    zero and ties are settled by that hash, the key and a second hash. A size
    that many documents share is first cut by hash into groups of some
    hundreds, so no task ranks a whole size. What the driver sees is one row per
    source. Sizes must not be null; columns with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("source_size", "target", "copies")
    hist = docs.groupBy(source, size).agg(F.count("*").alias("_n"))
    totals = hist.groupBy(source).agg(F.sum(F.col(size) * F.col("_n")).cast("bigint").alias("source_size"))
    # one row per source, ordered by UTF-8 bytes, which is the order of code points
    place = F.row_number().over(Window.orderBy(F.col(source).isNull(), F.col(source).cast("binary")))
    named = [r.asDict() for r in totals.withColumn("_place", place).collect()]
    named.sort(key=lambda r: r["_place"])
    sizes = [r["source_size"] or 0 for r in named]
    targets = fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), most)
    rows = [(r[source], int(s), float(t)) for r, s, t in zip(named, sizes, targets)]
    kind = docs.schema[source].dataType.simpleString()
    goals = spark.createDataFrame(rows, f"_source {kind}, source_size bigint, target double")
    same = F.col(source).eqNullSafe(F.col("_source"))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_size").reset_index(drop=True)
        whole = int(pdf["source_size"].iloc[0])
        budget = round(float(pdf["target"].iloc[0]))
        passes = min(budget // whole, int(most)) if whole else 0
        extra = fit(pdf["_size"].to_numpy(), pdf["_n"].to_numpy(), budget - passes * whole) if passes < most else np.zeros(len(pdf), np.int64)
        return pdf.assign(_passes=passes, _extra=extra)

    group = F.xxhash64(source, F.isnull(source))
    grouped = hist.join(goals, same).select(
        group.alias("_group"), F.col(size).alias("_size"), "_n", "source_size", "target"
    )
    schema = "_group bigint, _size bigint, _n bigint, source_size bigint, target double, _passes bigint, _extra bigint"
    chosen = grouped.groupBy("_group").applyInPandas(plan, schema)
    row = [key, *[f.name for f in docs.schema if f.name != key and not isinstance(f.dataType, T.MapType)]]
    rank = F.pmod(F.xxhash64(F.lit(seed), *row), F.lit(1 << 40))
    bins = F.ceil(F.col("_n") / GROUP_ROWS)
    placed = (
        docs.withColumn("_group", group).withColumn("_size", F.col(size)).withColumn("_rank", rank)
        .join(chosen, ["_group", "_size"])
        .withColumn("_bin", F.floor(F.col("_rank") * bins / (1 << 40)))
    )
    # dealt anew by bin, so that the join before it may split a size that many documents share
    placed = placed.repartition("_group", "_size", "_bin")
    by_size = Window.partitionBy("_group", "_size")
    cuts = placed.groupBy("_group", "_size", "_bin").agg(F.count("*").alias("_here"))
    before = F.sum("_here").over(by_size.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.select("_group", "_size", "_bin", F.coalesce(before, F.lit(0)).alias("_before"))
    order = F.row_number().over(Window.partitionBy("_group", "_size", "_bin").orderBy("_rank", key, F.xxhash64(F.lit(seed + 1), *row)))
    took = placed.withColumn("_order", order).join(cuts, ["_group", "_size", "_bin"])
    copies = F.col("_passes") + (F.col("_before") + F.col("_order") <= F.col("_extra")).cast("bigint")
    return took.withColumn("copies", copies).select(*docs.columns, "source_size", "target", "copies")


def report(docs: DataFrame) -> DataFrame:
    """The mix of ``documents`` by words: ``doc_id, size, source_size, target, taken``.

    Words are counted once; the sizes are written, as the mix reads them four times.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    mixed = mix(settle(sized))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
