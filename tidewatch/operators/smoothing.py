"""Exponential smoothing: Holt and Holt-Winters with fixed or fitted parameters.

A series on a regular grid is cut into blocks of equal length, a multiple of the
season. A step of the additive form is an affine map of the state, so a whole
block is one too: its matrix follows from the parameters alone and is the same
for every block, its offset is the state that the block reaches from zero. The
offsets of all blocks are computed side by side, a short scan composes them into
the state each block begins with, and the blocks then run side by side again. The
multiplicative form is no such map; its blocks run in order of time and hand
their state on. Either way no task holds more of a series than a batch of blocks.
One pass over a block serves a vector of parameter sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import join_keys, number_rows
from tidewatch.model import from_micros, micros, span_us
from tidewatch.session import settle

COARSE = tuple(round(0.05 + 0.1 * i, 2) for i in range(10))
BLOCK_STEPS = 1 << 14
NUMBERS = pa.list_(pa.float64())


def start_state(y: np.ndarray, m: int, multiplicative: bool):
    """Initial level, trend and season from the first two seasons."""
    if m <= 1:
        return y[0], y[1] - y[0], np.array([1.0 if multiplicative else 0.0])
    first, second = y[:m].mean(), y[m : 2 * m].mean()
    season = y[:m] / first if multiplicative else y[:m] - first
    return first, (second - first) / m, season


def advance(y: np.ndarray, state: np.ndarray, params: np.ndarray, m: int, multiplicative: bool = False, trace: bool = False):
    """State after the values of a block, its summed squared errors, summed errors and, if ``trace``, every step.

    A state has the rows level, trend and the ``m`` places of the season, and a
    column for each of the parameter sets, which are the columns of ``params``.
    """
    alpha, beta, gamma = params
    level, trend, season = state[0], state[1], state[2:].copy()
    error, drift, steps = np.zeros(len(alpha)), np.zeros(len(alpha)), []
    seasonal = m > 1
    for t, value in enumerate(y):
        place = t % m if seasonal else 0
        s, base = season[place], level + trend
        fitted = base * s if multiplicative else base + s
        error += (value - fitted) ** 2
        drift += value - fitted
        level_was = level
        level = alpha * (value / s if multiplicative else value - s) + (1 - alpha) * base
        trend = beta * (level - level_was) + (1 - beta) * trend
        if seasonal:
            season[place] = gamma * (value / base if multiplicative else value - base) + (1 - gamma) * s
        if trace:
            steps.append((fitted[0], level[0], trend[0]))
    return np.vstack([level, trend, season]), error, drift, steps


def block_matrix(params: np.ndarray, m: int, steps: int) -> np.ndarray:
    """What the additive form makes of each state in ``steps`` values of zero: a matrix for each parameter set."""
    d, width = max(m, 1) + 2, params.shape[1]
    units = np.tile(np.eye(d), width)
    one = advance(np.zeros(max(m, 1)), units, np.repeat(params, d, axis=1), m)[0]
    return np.linalg.matrix_power(one.reshape(d, width, d).transpose(1, 0, 2), steps // max(m, 1))


def _blocks(df: DataFrame, by: Sequence[str], minimum: int, m: int, block_steps: int) -> tuple[DataFrame, int | None]:
    """One row per series and block of steps (``_y``, ``_u`` in time order), and the length of a full block if any series has two.

    A block is a whole number of seasons and at least two, so the first one holds
    what the initial state is made of. Written once, as several passes read it.
    """
    season = max(m, 1)
    size = max(2, block_steps // season) * season
    points = df.filter("value IS NOT NULL").select(*by, "ts", "value")
    rows = number_rows(points, by, ["ts", "value"], "_rn", "n").filter(F.col("n") >= minimum)
    rows = rows.withColumn("_blk", F.floor((F.col("_rn") - 1) / size))
    value = F.struct("_rn", micros("ts").alias("u"), F.col("value").alias("v"))
    blocks = rows.groupBy(*by, "_blk").agg(F.array_sort(F.collect_list(value)).alias("_g"), F.max("n").alias("n"))
    blocks = blocks.select(
        *by, "_blk", F.transform("_g", lambda x: x["v"]).alias("_y"), F.transform("_g", lambda x: x["u"]).alias("_u"),
        "n", (F.col("_blk") == F.floor((F.col("n") - 1) / size)).alias("_final"),
    )
    blocks = settle(blocks)
    return blocks, None if blocks.filter(~F.col("_final")).isEmpty() else size


def _begin(y: np.ndarray, m: int, multiplicative: bool, width: int) -> np.ndarray:
    level, trend, season = start_state(y, m, multiplicative)
    return np.repeat(np.concatenate([[level, trend], season])[:, None], width, axis=1)


def _row(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of a row's block (or what it reaches from zero) and its parameter sets."""
    values = batch.column("_y")[i].values.to_numpy(zero_copy_only=False)
    return values, batch.column("_params")[i].values.flatten().to_numpy(zero_copy_only=False).reshape(-1, 3).T


def _mapped(
    df: DataFrame, columns: Sequence[str], fields: Sequence[tuple[str, str, pa.DataType]],
    one: Callable[[pa.RecordBatch, int, int], list],
) -> DataFrame:
    """``columns`` as they are and new ``fields`` from each row: ``one`` gets the batch, the row's place and its block."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for batch in batches:
                blocks = batch.column("_blk").to_pylist()
                found = [one(batch, i, blk) for i, blk in enumerate(blocks)]
                made = [pa.array([row[k] for row in found], kind) for k, (_, _, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], names=[*columns, *(f for f, _, _ in fields)])

    kept = [f"`{c}` {types[c]}" for c in columns]
    return df.mapInArrow(run, ", ".join([*kept, *[f"{name} {ddl}" for name, ddl, _ in fields]]))


def _begun(runs: DataFrame, by: Sequence[str], m: int, size: int) -> DataFrame:
    """``runs`` of the additive form with ``_x``, the state each block begins with; null for first blocks."""
    cell = [*by, "_chunk", "_blk"]
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def offset(batch, i, blk):
        y, params = _row(batch, i)
        width = params.shape[1]
        first = _begin(y, m, False, width) if blk == 0 else np.zeros((max(m, 1) + 2, width))
        return [advance(y, first, params, m)[0].ravel()]

    earlier = runs.filter(~F.col("_final")).select(*cell, "_params", "_y").repartition(parts, *cell)
    ends = _mapped(earlier, [*cell, "_params"], [("_v", "array<double>", NUMBERS)], offset).withColumnRenamed("_v", "_y")
    known: dict = {}

    def compose(batch, i, blk):
        v, params = _row(batch, i)
        v = v.reshape(-1, params.shape[1])
        if blk == 0:
            known["matrix"], known["x"] = block_matrix(params, m, size), v
        else:
            known["x"] = np.einsum("wij,jw->iw", known["matrix"], known["x"]) + v
        return [known["x"].ravel()]

    # the first block of a series comes first and resets what is handed on
    ordered = ends.repartition(parts, *by, "_chunk").sortWithinPartitions(*cell)
    states = _mapped(ordered, cell, [("_x", "array<double>", NUMBERS)], compose).withColumn("_blk", F.col("_blk") + 1)
    return join_keys(runs, states, cell, "left")


def _runs(
    blocks: DataFrame, by: Sequence[str], m: int, multiplicative: bool, size: int | None, columns: Sequence[str],
    fields: Sequence[tuple[str, str, pa.DataType]],
    work: Callable[[pa.RecordBatch, int, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, list]],
) -> DataFrame:
    """``work(batch, i, y, state, params)`` of every block and the state it begins with; it returns the next state and a row.

    ``blocks`` has the parameter sets in ``_params`` and a number for them in ``_chunk``.
    """
    cell = [*by, "_chunk", "_blk"]
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known: dict = {}

    def one(batch, i, blk):
        y, params = _row(batch, i)
        if blk == 0:
            state = _begin(y, m, multiplicative, params.shape[1])
        elif multiplicative:
            state = known["x"]
        else:
            state = batch.column("_x")[i].values.to_numpy(zero_copy_only=False).reshape(-1, params.shape[1])
        known["x"], out = work(batch, i, y, state, params)
        return out

    if multiplicative:
        ready = blocks.repartition(parts, *by, "_chunk").sortWithinPartitions(*cell)
    else:
        # without second blocks there is nothing to compose
        ready = (_begun(blocks, by, m, size) if size else blocks).repartition(parts, *cell)
    return _mapped(ready, columns, fields, one)


def smooth_fixed(
    df: DataFrame, by: Sequence[str], alpha: float, beta: float, gamma: float = 0.0, m: int = 1,
    multiplicative: bool = False, block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Fitted value, level and trend at every step for given parameters.

    The blocks are written when this is called.
    """
    blocks, size = _blocks(df, by, max(2 * m, 2), m, block_steps)
    given = F.array(F.array(F.lit(float(alpha)), F.lit(float(beta)), F.lit(float(gamma))))

    def trace(batch, i, y, state, params):
        after, _, _, steps = advance(y, state, params, m, multiplicative, True)
        return after, list(np.array(steps).T)

    fields = [(name, "array<double>", NUMBERS) for name in ("_f", "_l", "_t")]
    rows = _runs(blocks.withColumns({"_params": given, "_chunk": F.lit(0.0)}), by, m, multiplicative, size, [*by, "_u"], fields, trace)
    steps = rows.select(*by, F.explode(F.arrays_zip("_u", "_f", "_l", "_t")).alias("_s"))
    return steps.select(
        *by, from_micros("_s._u").alias("ts"), F.col("_s._f").alias("fitted"), F.col("_s._l").alias("level"), F.col("_s._t").alias("trend")
    )


def _in_time(c: str) -> Column:
    """The blocks' values of ``c`` added in order of time, so reruns agree to the last bit."""
    return F.aggregate(F.array_sort(F.collect_list(F.struct("_blk", F.col(c).alias("e")))), F.lit(0.0), lambda a, x: a + x["e"])


def _score(blocks: DataFrame, by: Sequence[str], m: int, multiplicative: bool, size: int | None) -> DataFrame:
    """The set of ``_params`` with the least squared error per series, that error and the states after the last step."""
    def errors(batch, i, y, state, params):
        after, error, drift, _ = advance(y, state, params, m, multiplicative)
        error = np.where(np.isfinite(error), error, np.inf)
        last = batch.column("_final")[i].as_py()
        return after, [*params, error, drift, list(after.T) if last else [None] * len(error)]

    names = ["alpha", "beta", "gamma"]
    fields = [(f"_{c}", "array<double>", NUMBERS) for c in (*names, "e", "d")] + [("_s", "array<array<double>>", pa.list_(NUMBERS))]
    runs = _runs(blocks, by, m, multiplicative, size, [*by, "_blk"], fields, errors)
    sets = runs.select(*by, "_blk", F.explode(F.arrays_zip(*[f for f, _, _ in fields])).alias("_p"))
    sets = sets.select(*by, "_blk", *[F.col(f"_p._{c}").alias(c) for c in names], F.col("_p._e").alias("e"), F.col("_p._d").alias("d"), F.col("_p._s").alias("x"))
    summed = sets.groupBy(*by, *names).agg(
        _in_time("e").alias("sse"), _in_time("d").alias("residual_sum"), F.max_by("x", "_blk").alias("_x")
    )
    best = summed.groupBy(*by).agg(F.min_by(F.struct(*names, "sse", "residual_sum", "_x"), F.struct("sse", *names)).alias("_b"))
    return best.select(
        *by, *[F.col(f"_b.{c}") for c in (*names, "sse", "residual_sum")],
        F.get("_b._x", F.lit(0)).alias("level"), F.get("_b._x", F.lit(1)).alias("trend"),
        F.slice("_b._x", 3, F.greatest(F.size("_b._x") - 2, F.lit(0))).alias("season"),
    )


def _spread():
    """Sample deviation of the residuals about their own mean."""
    n = F.col("n")
    return F.sqrt(F.greatest(F.try_divide(F.col("sse") - F.col("residual_sum") * F.col("residual_sum") / n, n - 1), F.lit(0.0)))


def _grid(a, b, g):
    """All combinations of three arrays of parameter values, as an array column."""
    return F.flatten(
        F.transform(a, lambda x: F.flatten(F.transform(b, lambda y: F.transform(g, lambda z: F.array(x, y, z)))))
    )


def _known(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    return blocks.filter("_final").select(*by, "n", from_micros(F.element_at("_u", -1)).alias("last_ts"))


def fit_smoothing(
    df: DataFrame, by: Sequence[str], m: int = 1, multiplicative: bool = False, minimum: int | None = None,
    coarse: Sequence[float] = COARSE, block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Parameters of least squared error from a coarse grid, then a fine one about its best.

    Initial states are those of the first two seasons, not optimised ones, so
    results differ slightly from an optimiser's. Series shorter than two
    seasons are left out. The blocks are written when this is called.
    """
    blocks, size = _blocks(df, by, minimum or max(2 * m, 2), m, block_steps)
    values = F.array(*[F.lit(float(c)) for c in dict.fromkeys(coarse)])
    gammas = values if m > 1 else F.array(F.lit(0.0))
    first = blocks.withColumn("_chunk", F.explode(values)).withColumn("_params", _grid(F.array("_chunk"), values, gammas))
    rough = _score(first, by, m, multiplicative, size).select(*by, F.struct("alpha", "beta", "gamma").alias("_p"))
    step = (coarse[1] - coarse[0]) / 5 if len(coarse) > 1 else 0.02
    near = lambda c: F.array_distinct(F.transform(
        F.array(*[F.lit(d * step) for d in (-2, -1, 0, 1, 2)]),
        lambda d: F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col(c) + d)),
    ))
    third = near("_p.gamma") if m > 1 else F.array(F.lit(0.0))
    # composing reads its input twice
    second = join_keys(blocks, settle(rough) if size else rough, by).withColumn("_chunk", F.explode(near("_p.alpha")))
    second = second.withColumn("_params", _grid(F.array("_chunk"), near("_p.beta"), third)).drop("_p")
    fine = _score(second, by, m, multiplicative, size)
    k = (4 + m + 1) if m > 1 else 4
    out = join_keys(_known(blocks, by), fine, by)
    aic = F.col("n") * F.log(F.when(F.col("sse") > 0, F.col("sse") / F.col("n"))) + 2 * k
    return out.withColumns({"aic": aic, "residual_std": _spread()})


def forecast(
    states: DataFrame, by: Sequence[str], steps: int = 60, every: timedelta = timedelta(minutes=1), m: int = 1,
    multiplicative: bool = False, k: float = 2.0,
) -> DataFrame:
    """``steps`` values ahead with a band of ``k`` residual deviations of constant width."""
    rows = states.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    place = F.pmod(F.col("n") + F.col("h") - 1, F.lit(m)).cast("int")
    season = F.get("season", place)
    line = F.col("level") + F.col("h") * F.col("trend")
    yhat = line * season if multiplicative else line + season
    at = from_micros(micros("last_ts") + F.col("h").cast("bigint") * span_us(every))
    return rows.select(
        *by, at.alias("ts"), "h", yhat.alias("yhat"),
        (yhat - k * F.col("residual_std")).alias("yhat_lower"),
        (yhat + k * F.col("residual_std")).alias("yhat_upper"),
    )


def final_states(
    df: DataFrame, by: Sequence[str], alpha: float, beta: float, gamma: float = 0.0, m: int = 1, multiplicative: bool = False,
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """States after the last step for given parameters, in the form ``forecast`` takes."""
    blocks, size = _blocks(df, by, max(2 * m, 2), m, block_steps)
    params = F.array(F.array(F.lit(float(alpha)), F.lit(float(beta)), F.lit(float(gamma))))
    scored = _score(blocks.withColumns({"_params": params, "_chunk": F.lit(0.0)}), by, m, multiplicative, size)
    return join_keys(_known(blocks, by), scored, by).withColumn("residual_std", _spread())
