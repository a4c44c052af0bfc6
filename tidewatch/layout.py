"""Skew-proof building blocks for ordered and per-key work.

A window partitioned by the series alone puts a whole series in one task. The
functions here give the same results with groups of bounded size:

* ``number_rows``   exact row numbers per key from counts per minute
* ``windowed``      row-frame windows over blocks with copied edge rows
* ``attach``        per-key values joined back to rows
* ``exact_quantiles`` order statistics from counted values

Keys are compared as a struct, in which an absent (NULL) label equals itself, so
no join here loses rows whose key is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import settle

BLOCK_ROWS = 1 << 18
BINS = 1024
SALTS = 16


def same_keys(keys: Sequence[str]) -> Column:
    """The keys as one value; NULL fields of it are equal."""
    return F.struct(*[F.col(k) for k in keys])


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by equal keys, NULLs included; the keys come from the left."""
    right = right.withColumn("_key", same_keys(keys)).drop(*keys)
    return left.withColumn("_key", same_keys(keys)).join(right, "_key", how).drop("_key")


def _tie(df: DataFrame, order: Sequence[str]) -> Column:
    """Settles equal order values by the rest of the row, so a repeated task numbers rows alike."""
    rest = [f.name for f in df.schema if f.name not in order and not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*rest) if rest else F.lit(0)


def _bucket(df: DataFrame, column: str) -> Column | None:
    """A coarser value in the same order: the minute of a time. None for other types."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("minute", F.col(column))
    return F.col(column) if isinstance(kind, T.DateType) else None


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], rn: str, n: str | None) -> DataFrame:
    """Row numbers for orders that are not times, from sampled ranges.

    The range bounds come from a sample, so the positions are written to the
    shared folder: every later use sees the same ones, also after an executor
    is lost. ``monotonically_increasing_id`` holds the partition in its upper bits.
    """
    columns = [F.col(c) for c in (*keys, *order)]
    # no explicit number: adaptive execution merges small neighbouring ranges, which keeps their order
    ranges = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    laid = settle(ranges.withColumn("_pos", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_pos", 33))
    counts = laid.groupBy(*keys, "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_cnt"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "_part", (F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_cnt").over(whole).alias("_n"),
    )
    out = join_keys(laid, offsets, [*keys, "_part"]).withColumn(rn, F.col("_pos") + F.col("_shift"))
    return out.withColumn(n, F.col("_n")) if n else out


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rn: str = "rn", n: str | None = None
) -> DataFrame:
    """Add the 1-based row number within ``keys`` (and the key's row count).

    Rows are counted per key and minute on the map side; a minute's first number
    is the sum of the counts before it, and only the rows of one minute are
    ranked together. Nothing is written, and rows move once.
    """
    minute = _bucket(df, order[0])
    if minute is None:
        return _ranged(df, keys, order, rn, n).select(*df.columns, rn, *([n] if n else []))
    rows = df.withColumn("_cell", F.struct(*[F.col(k) for k in keys], minute.alias("_minute")))
    counts = rows.groupBy("_cell").agg(F.count("*").alias("_cnt"))
    whole = Window.partitionBy(*[F.col(f"_cell.{k}") for k in keys])
    earlier = whole.orderBy("_cell._minute").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_cell", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_before"), F.sum("_cnt").over(whole).alias("_n"))
    inside = Window.partitionBy("_cell").orderBy(*order, _tie(df, order))
    out = rows.join(offsets, "_cell").withColumn(rn, F.row_number().over(inside) + F.col("_before"))
    if n:
        out = out.withColumn(n, F.col("_n"))
    return out.select(*df.columns, rn, *([n] if n else []))


def in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """Cut each key's rows into blocks; each block also gets its neighbours' edge rows."""
    size = max(block_rows, before, after, 1)
    rows = number_rows(df, keys, order, n="n_rows")
    index = F.col("rn") - 1
    block = F.floor(index / size)
    offset = F.pmod(index, F.lit(size))
    nothing = F.lit(None)
    copies = F.array_compact(
        F.array(
            block,
            F.when((offset >= size - before) & ((block + 1) * size < F.col("n_rows")), block + 1)
            if before
            else nothing.cast("bigint"),
            F.when((offset < after) & (block > 0), block - 1) if after else nothing.cast("bigint"),
        )
    )
    placed = rows.withColumn("_blk", F.explode(copies)).withColumn("_own", F.col("_blk") == block)
    return placed, Window.partitionBy(*keys, "_blk").orderBy("rn")


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    before: int,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add row-frame window columns, equal to those of one window per key.

    ``before`` and ``after`` are the furthest rows the frames reach. ``rn`` and
    ``n_rows`` are kept.
    """
    placed, window = in_blocks(df, keys, order, before, after, block_rows)
    return placed.withColumns(dict(columns(window))).filter("_own").drop("_blk", "_own")


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join one-row-per-key ``stats`` to the rows of ``df``.

    ``stats`` is written first. Spark then knows its true size when it plans: a
    small one goes to the rows, which stay where they are; beyond the broadcast
    threshold both are shuffled, and adaptive execution splits a hot key.
    """
    return join_keys(df, stats if stats.isStreaming else settle(stats), keys, how)


def _narrowed(counted: DataFrame) -> DataFrame:
    """Cut each ``_key`` group of values into bins and keep the bins that hold a wanted rank.

    ``_base`` rows of the key lie before the group; ``_cell`` names the group.
    """
    span = counted.groupBy("_cell").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    share = F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bins = F.least(F.floor(F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0)) * BINS), F.lit(BINS - 1)).cast("int")
    placed = counted.join(span, "_cell").withColumn("_next", F.struct("_cell", bins.alias("b"))).drop("_lo", "_hi")
    sizes = placed.groupBy("_cell", "_next").agg(F.sum("_c").alias("_size"), F.any_value("_ranks").alias("_ranks"), F.any_value("_base").alias("_base"))
    earlier = Window.partitionBy("_cell").orderBy("_next.b").rowsBetween(Window.unboundedPreceding, -1)
    begun = sizes.withColumn("_start", F.col("_base") + F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    wanted = F.exists("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_size")))
    kept = begun.filter(wanted).select("_next", F.col("_start").alias("_base"))
    return placed.drop("_base").join(kept, "_next").select("_key", F.col("_next").alias("_cell"), "_v", "_c", "_ranks", "_base")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles per key: one output column per entry of ``probs``.

    Equal values are counted first, on the map side. Twice the values are cut
    into bins between their least and greatest, and only bins that hold a wanted
    rank go on, so the values ranked in the end are few however large a key is.
    """
    rows = df.filter(F.col(value).isNotNull()).select(same_keys(keys).alias("_key"), F.col(value).alias("_v"))
    counted = rows.groupBy("_key", "_v").agg(F.count("*").alias("_c"))
    total = rows.groupBy("_key").agg(F.count("*").alias("_n"))
    at = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = F.array_distinct(F.array(*[f(a).cast("bigint") for a in at.values() for f in (F.floor, F.ceil)]))
    start = counted.join(total.withColumn("_ranks", ranks).drop("_n"), "_key")
    start = start.select("_key", F.struct("_key").alias("_cell"), "_v", "_c", "_ranks", F.lit(0).cast("bigint").alias("_base"))
    last = _narrowed(_narrowed(start))
    earlier = Window.partitionBy("_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    begun = last.withColumn("_start", F.col("_base") + F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    ranked = begun.join(total, "_key")
    picks = []
    for name, a in at.items():
        low, high = (
            F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_c")), F.col("_v")))
            for rank in (F.floor(a), F.ceil(a))
        )
        picks.append((low + (high - low) * F.max(a - F.floor(a))).alias(name))
    found = ranked.groupBy("_key").agg(*picks)
    return found.select(*[F.col(f"_key.{k}").alias(k) for k in keys], *probs)
