"""Over-time functions of range vectors, evaluated on a step grid.

Samples are first reduced to panes, whose width divides both span and step, with
map-side partial aggregation. Panes lie in blocks as long as a frame. A frame
``[t - span, t]`` is then the end of one block and the beginning of the next: what
a block holds up to each pane and from each pane on is computed once, by running
aggregates inside the block, and a frame merges two of these. However long the
frame, a pane leads to at most three rows per evaluation time it decides, and a
series that holds most of the samples is still reduced by all tasks.

Frames are closed at both ends: a sample exactly ``span`` old counts. Such
samples sit on a pane border and are kept in a pane of their own (``_edge``), the
third piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import join_keys, windowed
from tidewatch.model import from_micros, micros, point_us, span_us

SECOND = 1_000_000


def _panes(samples: DataFrame, by: Sequence[str], width: int, extra: dict[str, Column]) -> DataFrame:
    """Rows with their pane end ``_p`` and the columns the partials need."""
    us = micros("ts")
    return samples.select(*by, us.alias("_us"), F.col("value"), *[c.alias(n) for n, c in extra.items()]).withColumns(
        {
            "_p": F.col("_us") + F.pmod(-F.col("_us"), F.lit(width)),
            "_edge": F.pmod(F.col("_us"), F.lit(width)) == 0,
        }
    )


def _times(low: Column, high: Column, step: int, start: datetime | None, end: datetime | None) -> Column:
    """The evaluation times from ``low`` to ``high``."""
    first, last = low + F.pmod(-low, F.lit(step)), high - F.pmod(high, F.lit(step))
    if start is not None:
        first = F.greatest(first, F.lit(-(-point_us(start) // step) * step))
    if end is not None:
        last = F.least(last, F.lit(point_us(end) // step * step))
    return F.when(first <= last, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<bigint>"))


def pieces(
    panes: DataFrame,
    by: Sequence[str],
    span: int,
    step: int,
    start: datetime | None,
    end: datetime | None,
    merge: dict[str, Column],
    products: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """The parts of every frame: ``by``, ``_t`` and the columns of ``merge``, aggregates that merge with themselves.

    Of each frame there are at most three: from its first pane to the end of that
    pane's block, from the next block's beginning to its last pane, and samples
    on its open border. ``products`` names centred sums of products ``_c_xy`` that go
    with means ``_m_x`` and counts ``_n``. They are run about the mean of the pane where
    the running begins, which lies in every part summed, so no digits cancel.
    """
    width = gcd(span, step)
    origin = F.col("_p") - width - F.pmod(F.col("_p") - width, F.lit(span))
    rows = panes.withColumn("_blk", origin)
    block = Window.partitionBy(*by, "_blk")
    onward, backward = block.orderBy("_p", "_edge"), block.orderBy(F.col("_p").desc(), F.col("_edge").desc())
    rows = rows.withColumns({"_after": F.lead("_p").over(onward), "_before": F.lag("_p").over(onward)})
    names = sorted({v for pair in products for v in pair})
    whole = onward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if "x" in names:  # x is measured from the pane; from here on from the block
        rows = rows.withColumn("_m_x", F.col("_m_x") + (F.col("_p") - F.col("_blk")) / F.lit(float(SECOND)))
    rows = rows.withColumns({f"_r{way}_{v}": pick(f"_m_{v}", ignorenulls=True).over(whole) for v in names for way, pick in ((0, F.first), (1, F.last))})
    for way, window in enumerate((onward, backward)):
        run = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        off = {v: F.coalesce(F.col(f"_m_{v}") - F.col(f"_r{way}_{v}"), F.lit(0.0)) for v in names}
        sums = {f"_o{way}_{v}": F.sum(F.col("_n") * off[v]).over(run) for v in names}
        sums |= {f"_q{way}_{v}{w}": F.sum(F.coalesce(F.col(f"_c_{v}{w}"), F.lit(0.0)) + F.col("_n") * off[v] * off[w]).over(run) for v, w in products}
        rows = rows.withColumns({f"_w{way}{name}": agg.over(run) for name, agg in merge.items()} | sums)
        count = F.col(f"_w{way}_n") if products else None
        rows = rows.withColumns(
            {f"_w{way}_m_{v}": F.col(f"_r{way}_{v}") + F.try_divide(F.col(f"_o{way}_{v}"), count) for v in names}
            | {f"_w{way}_c_{v}{w}": F.col(f"_q{way}_{v}{w}") - F.coalesce(F.try_divide(F.col(f"_o{way}_{v}") * F.col(f"_o{way}_{w}"), count), F.lit(0.0)) for v, w in products}
        )
    last = F.col("_blk") + span
    ends = _times(F.col("_p"), F.least(F.col("_after") - width, last), step, start, end)
    begins = _times(F.greatest(F.col("_before"), F.col("_blk") + width) + span, F.col("_p") + span - width, step, start, end)
    border = F.col("_p") + span
    borders = F.when(F.col("_edge"), _times(border, border, step, start, end)).otherwise(F.array().cast("array<bigint>"))
    kinds = [F.transform(times, (lambda k: lambda t: F.struct(t.alias("t"), F.lit(k).alias("k")))(k)) for k, times in enumerate((ends, begins, borders))]
    seen = rows.withColumn("_at", F.explode(F.concat(*kinds)))
    kept = [*merge, *[f"_m_{v}" for v in names], *[f"_c_{v}{w}" for v, w in products]]
    part = lambda c: F.when(F.col("_at.k") == 0, F.col(f"_w0{c}")).when(F.col("_at.k") == 1, F.col(f"_w1{c}")).otherwise(F.col(c)).alias(c)
    out = seen.select(*by, F.col("_at.t").alias("_t"), "_blk", *[part(c) for c in kept])
    if "x" in names:  # and at last from the evaluation time
        out = out.withColumn("_m_x", F.col("_m_x") + (F.col("_blk") - F.col("_t")) / F.lit(float(SECOND)))
    return out.drop("_blk")


def _grid(samples, by, span, step, start, end, extra, partials, merge, products=()):
    span, step = span_us(span), span_us(step)
    rows = _panes(samples, by, gcd(span, step), extra)
    panes = rows.groupBy(*by, "_p", "_edge").agg(*[c.alias(n) for n, c in partials.items()])
    return pieces(panes, by, span, step, start, end, merge, products)


def _spread(v: str, w: str) -> Column:
    """The centred sum of products of a frame from its few parts and its means ``_a_v``, ``_a_w``."""
    return F.aggregate(
        "_parts", F.lit(0.0),
        lambda a, p: a + F.when(p["_n"] > 0, p[f"_c_{v}{w}"] + p["_n"] * (p[f"_m_{v}"] - F.col(f"_a_{v}")) * (p[f"_m_{w}"] - F.col(f"_a_{w}"))).otherwise(0.0),
    )


def _finish(rows: DataFrame, by: Sequence[str], **values: Column) -> DataFrame:
    return rows.select(*by, from_micros("_t").alias("eval_ts"), *[c.alias(n) for n, c in values.items()])


def over_time(
    samples: DataFrame,
    by: Sequence[str],
    span: timedelta,
    step: timedelta,
    stats: Sequence[str] = ("avg",),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``avg``, ``max``, ``min``, ``sum``, ``count``, ``stddev`` (population) and ``last`` over time.

    Output: ``by``, ``eval_ts`` and one column per requested statistic.
    """
    partials = {"_n": F.count("value")}
    merge, products = {"_n": F.sum("_n")}, ()
    if {"avg", "sum"} & set(stats):
        partials["_s"], merge["_s"] = F.sum("value"), F.sum("_s")
    if "max" in stats:
        partials["_hi"], merge["_hi"] = F.max("value"), F.max("_hi")
    if "min" in stats:
        partials["_lo"], merge["_lo"] = F.min("value"), F.min("_lo")
    if "last" in stats:
        partials["_lv"], merge["_lv"] = F.max(F.struct("_us", "value")), F.max("_lv")
    if "stddev" in stats:
        partials["_m_y"], partials["_c_yy"] = F.avg("value"), F.var_pop("value") * F.count("value")
        products = (("y", "y"),)
    rows = _grid(samples, by, span, step, start, end, {}, partials, merge, products)

    total = dict(merge)
    if products:
        total["_a_y"] = F.sum(F.col("_n") * F.col("_m_y")) / F.sum("_n")
        total["_parts"] = F.collect_list(F.struct("_n", "_m_y", "_c_yy"))  # three at most
    merged = rows.groupBy(*by, "_t").agg(*[c.alias(n) for n, c in total.items()]).filter("_n > 0")
    given = {"count": "_n", "sum": "_s", "max": "_hi", "min": "_lo"}
    out = {}
    for stat in stats:
        if stat == "avg":
            out[stat] = F.col("_s") / F.col("_n")
        elif stat == "stddev":
            out[stat] = F.sqrt(F.greatest(_spread("y", "y"), F.lit(0.0)) / F.col("_n"))
        else:
            out[stat] = F.col("_lv.value") if stat == "last" else F.col(given[stat])
    return _finish(merged, by, **out)


def regress_over_time(
    samples: DataFrame,
    by: Sequence[str],
    span: timedelta,
    step: timedelta,
    ahead: timedelta | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Least-squares line in each frame: ``deriv`` per second, and ``predicted`` when ``ahead`` is given.

    x is measured from the pane end, then from the block, then from the
    evaluation time, so that no digits are lost to the epoch.
    """
    x, y = (F.col("_us") - F.col("_p")) / F.lit(float(SECOND)), F.col("value")
    partials = {
        "_n": F.count("value"), "_m_x": F.avg(x), "_m_y": F.avg(y),
        "_c_xx": F.var_pop(x) * F.count("value"), "_c_xy": F.covar_pop(x, y) * F.count("value"),
    }
    rows = samples.filter("value IS NOT NULL")
    rows = _grid(rows, by, span, step, start, end, {}, partials, {"_n": F.sum("_n")}, (("x", "x"), ("x", "y")))
    merged = rows.groupBy(*by, "_t").agg(
        F.sum("_n").alias("_n"),
        *[(F.sum(F.col("_n") * F.col(f"_m_{v}")) / F.sum("_n")).alias(f"_a_{v}") for v in "xy"],
        F.collect_list(F.struct("_n", "_m_x", "_m_y", "_c_xx", "_c_xy")).alias("_parts"),
    )
    sxx, sxy = _spread("x", "x"), _spread("x", "y")
    fitted = merged.filter("_n >= 2").withColumn("_slope", F.try_divide(sxy, sxx)).filter("_slope IS NOT NULL")
    out = {"deriv": F.col("_slope")}
    if ahead is not None:
        seconds = span_us(ahead) / SECOND
        out["predicted"] = F.col("_a_y") + F.col("_slope") * (F.lit(seconds) - F.col("_a_x"))
    return _finish(fitted, by, **out)


def counter_deltas(
    samples: DataFrame, by: Sequence[str], tie: Sequence[str] = (), block_rows: int | None = None
) -> DataFrame:
    """Reset-adjusted rise since the previous sample (0 for the first one) in ``delta``."""
    rise = lambda w: {
        "_prev": F.lag("value").over(w),
    }
    extra = {"block_rows": block_rows} if block_rows else {}
    rows = windowed(samples.select(*by, "ts", "value", *tie), by, ["ts", *tie], rise, before=1, **extra)
    delta = F.when(F.col("_prev").isNull(), 0.0).otherwise(
        F.when(F.col("value") < F.col("_prev"), F.col("value")).otherwise(F.col("value") - F.col("_prev"))
    )
    return rows.withColumn("delta", delta).drop("_prev", "rn", "n_rows")


def counter_over_time(
    samples: DataFrame,
    by: Sequence[str],
    span: timedelta,
    step: timedelta,
    mode: str = "extrapolated",
    tie: Sequence[str] = (),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``rate`` (per second) and ``increase`` of counters with resets.

    ``extrapolated`` stretches the rise to the frame's ends as the query server
    does; ``plain`` is rise over the frame's seconds.
    """
    rows = samples if "delta" in samples.columns else counter_deltas(samples, by, tie)
    partials = {
        "_n": F.count("value"),
        "_sum": F.sum("delta"),
        "_fu": F.min("_us"),
        # value and rise of one and the same first sample
        "_first": F.min(F.struct("_us", "value", "delta")),
        "_lu": F.max("_us"),
    }
    merge = {"_n": F.sum("_n"), "_sum": F.sum("_sum"), "_fu": F.min("_fu"), "_first": F.min("_first"), "_lu": F.max("_lu")}
    parts = _grid(rows, by, span, step, start, end, {"delta": F.col("delta")}, partials, merge)
    merged = parts.groupBy(*by, "_t").agg(*[c.alias(n) for n, c in merge.items()]).filter("_n >= 2").withColumns(
        {"_rise": F.col("_sum") - F.col("_first.delta"), "_fv": F.col("_first.value")}
    )
    seconds = span_us(span) / SECOND
    if mode == "plain":
        increase = F.col("_rise")
    else:
        length = (F.col("_lu") - F.col("_fu")) / F.lit(float(SECOND))
        gap = length / (F.col("_n") - 1)
        head = (F.col("_fu") - F.col("_t")) / F.lit(float(SECOND)) + F.lit(seconds)
        tail = (F.col("_t") - F.col("_lu")) / F.lit(float(SECOND))
        to_zero = length * F.try_divide(F.col("_fv"), F.col("_rise"))
        head = F.when((F.col("_rise") > 0) & (F.col("_fv") >= 0), F.least(head, to_zero)).otherwise(head)
        stretched = (
            length
            + F.when(head < gap * 1.1, head).otherwise(gap / 2)
            + F.when(tail < gap * 1.1, tail).otherwise(gap / 2)
        )
        increase = F.col("_rise") * F.try_divide(stretched, length)
    return _finish(merged, by, rate=increase / F.lit(seconds), increase=increase)


def std_band(
    samples: DataFrame,
    by: Sequence[str],
    span: timedelta,
    step: timedelta,
    k: float = 2.0,
    lookback: timedelta = timedelta(minutes=5),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Current value against its own mean and deviation over ``span``.

    ``outside`` marks ``abs(x - avg) > k * stddev``.
    """
    from tidewatch.operators.grid import asof_grid

    now = asof_grid(samples, by, step, lookback, start, end)
    past = over_time(samples, by, span, step, ("avg", "stddev"), start, end)
    return join_keys(now, past, [*by, "eval_ts"]).withColumn(
        "outside", F.abs(F.col("value") - F.col("avg")) > k * F.col("stddev")
    )
