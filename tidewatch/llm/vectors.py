"""Vector columns: which rows take part, and their values as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def proper(v: Column) -> Column:
    """Whether a vector is not null, not zero and holds finite numbers only; false or null otherwise."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def valid(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, v``: rows whose vector is not null, not zero and holds finite numbers only.

    Vectors of another length than the most frequent one (the shorter of two as
    frequent) take no part, nor do rows without an id.
    """
    v = F.col(vector)
    rows = table.filter(F.col(key).isNotNull() & proper(v))
    rows = rows.select(F.col(key).cast("bigint").alias("id"), v.alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), "n").limit(1).select("n")
    return rows.join(F.broadcast(usual), F.size("v") == F.col("n")).drop("n")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def stacked(series) -> np.ndarray:
    """A pandas column of lists as a matrix of doubles."""
    return np.stack(series.to_numpy()).astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    # scaled by the largest component first: squares of extreme values stay finite
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def sample(rows: DataFrame, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids, matrix`` of the ``n`` rows with the smallest seeded hash of the id."""
    took = rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(n).toPandas()
    return took["id"].to_numpy(np.int64), stacked(took["v"]) if len(took) else np.zeros((0, 0))
