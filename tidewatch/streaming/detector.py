"""Live multi-metric detector: a stream with keyed state and the batch job of equal results.

Every tick enters the history of its scope (200 ticks); the model is trained at
tick 30 and then every 50, on the history that holds the current tick; each
tick from then on is scored and explained.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.live import Settings, WindowModel
from tidewatch.layout import number_rows
from tidewatch.operators.stats import reasons

VERDICT = (
    "scope string, tick timestamp, checks bigint, window_rows int, epoch bigint, status string, score double, "
    "is_anomaly boolean, reason string, anomalies bigint"
)
COLLECTING, NORMAL, ANOMALY = "COLLECTING", "NORMAL", "ANOMALY"
MODELS = 32


class _Detector(StatefulProcessor):
    """State per scope: recent history, the last training window, and counters.

    Of a batch's ticks, all that one model judges are scored together. A worker
    keeps the models of the ``models`` scopes it met last; others are grown again
    from the training window in the state, which gives the same model.
    """

    def __init__(self, metrics: Sequence[str], settings: Settings, idle: timedelta | None, models: int):
        self.metrics, self.settings, self.idle, self.most = list(metrics), settings, idle, models
        self.models: OrderedDict[tuple, tuple[int, WindowModel]] = OrderedDict()

    def init(self, handle: StatefulProcessorHandle) -> None:
        kept = {"ttlDurationMs": int(self.idle / timedelta(milliseconds=1))} if self.idle else {}
        self.state = handle.getValueState("history", "recent array<double>, trained array<double>, epoch bigint, checks bigint, anomalies bigint", **kept)

    def _model(self, key, rows: np.ndarray, epoch: int) -> WindowModel:
        held = self.models.pop(key, None)
        if held is None or held[0] != epoch:
            held = (epoch, WindowModel(rows, epoch, self.settings))
        self.models[key] = held
        if len(self.models) > self.most:
            self.models.popitem(last=False)
        return held[1]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        width, conf = len(self.metrics), self.settings
        recent, trained, epoch, checks, anomalies = np.empty((0, width)), np.empty((0, width)), -1, 0, 0
        if self.state.exists():
            recent, trained, epoch, checks, anomalies = self.state.get()
            recent, trained = (np.asarray(x, float).reshape(-1, width) for x in (recent, trained))
        batch = pd.concat(list(rows), ignore_index=True).sort_values("tick")
        values = batch[self.metrics].to_numpy(float)
        known = np.concatenate([recent, values])
        number = checks + 1 + np.arange(len(batch))
        of_epoch = np.where(number >= conf.warmup, (number - conf.warmup) // conf.retrain, -1)
        decision, reason = np.full(len(batch), np.nan), np.full(len(batch), None, object)
        for e in np.unique(of_epoch[of_epoch >= 0]).tolist():
            here = np.flatnonzero(of_epoch == e)
            if e != epoch:
                # the tick that trains is in this batch, and what came before it in the window is still known
                end = len(recent) + e * conf.retrain + conf.warmup - checks
                trained, epoch = known[max(0, end - conf.window) : end], e
            model = self._model(key, trained, e)
            decision[here] = model.decide(values[here])
            for i in here[decision[here] < 0]:
                reason[i] = model.reason(values[i], self.metrics)
        bad, scored = decision < 0, of_epoch >= 0
        total = anomalies + np.cumsum(bad)
        recent = known[-conf.window :]
        self.state.update((recent.ravel().tolist(), trained.ravel().tolist(), int(epoch), int(number[-1]), int(total[-1])))
        yield pd.DataFrame({
            "scope": key[0], "tick": batch["tick"].to_numpy(), "checks": number, "window_rows": np.minimum(number, conf.window).astype(np.int32),
            "epoch": pd.Series(of_epoch, dtype="Int64").where(scored), "status": np.where(scored, np.where(bad, ANOMALY, NORMAL), COLLECTING),
            "score": decision, "is_anomaly": pd.Series(bad, dtype="boolean").where(scored), "reason": reason, "anomalies": total,
        })

    def close(self) -> None:
        pass


def detect_stream(
    ticks: DataFrame, metrics: Sequence[str], settings: Settings = Settings(), idle: timedelta | None = None, models: int = MODELS
) -> DataFrame:
    """Verdict per tick of a streaming frame ``scope, tick, <metrics>``.

    Ticks of a scope must arrive in order between batches (any order inside
    one); a windowed aggregation with watermark in front gives that. Scopes are
    spread over the tasks by key. The state of a scope that has sent nothing for
    ``idle`` of processing time is dropped; it starts anew when it comes back.
    """
    scored = ticks.groupBy("scope").transformWithStateInPandas(
        _Detector(metrics, settings, idle, models), VERDICT, outputMode="append", timeMode="processingTime" if idle else "none"
    )
    # a warm-up tick has no score; pandas has no other null for doubles
    return scored.withColumn("score", F.when(F.col("status") != COLLECTING, F.col("score")))


def epochs(ticks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Tick number in its scope, epoch in force (NULL in warm-up) and its training range."""
    rows = number_rows(ticks, ["scope"], ["tick"], rn="checks", n="_total")
    epoch = F.when(F.col("checks") >= settings.warmup, F.floor((F.col("checks") - settings.warmup) / settings.retrain))
    return rows.withColumns(
        {
            "epoch": epoch,
            "window_rows": F.least(F.col("checks"), F.lit(settings.window)).cast("int"),
            "train_to": epoch * settings.retrain + settings.warmup,
        }
    ).withColumn(
        "train_from", F.when(epoch.isNotNull(), F.greatest(F.col("train_to") - settings.window + 1, F.lit(1)))
    )


def _training_copies(rows: DataFrame, settings: Settings) -> DataFrame:
    """Each tick once for every epoch that trains on it."""
    n, first = F.col("checks"), settings.warmup
    low = F.greatest(F.ceil((n - first) / settings.retrain), F.lit(0))
    high = F.least(
        F.floor((n + settings.window - 1 - first) / settings.retrain),
        F.floor((F.col("_total") - first) / settings.retrain),
    )
    return rows.withColumn("epoch", F.explode(F.when(low <= high, F.sequence(low, high))))


def detect_batch(ticks: DataFrame, metrics: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """The stream's verdicts from a table of ticks, in parallel over epochs.

    A group holds one training window and the ticks scored with it.
    """
    metrics = list(metrics)
    rows = epochs(ticks, settings)
    train = _training_copies(rows, settings).select("scope", "epoch", "checks", "tick", F.lit(True).alias("_train"), "window_rows", *metrics)
    test = rows.filter("epoch IS NOT NULL").select("scope", "epoch", "checks", "tick", F.lit(False).alias("_train"), "window_rows", *metrics)

    def verdicts(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("checks")
        epoch = int(part["epoch"].iloc[0])
        model = WindowModel(part.loc[part["_train"], metrics].to_numpy(float), epoch, settings)
        out = part.loc[~part["_train"], ["scope", "tick", "checks", "window_rows", "epoch"]].copy()
        values = part.loc[~part["_train"], metrics].to_numpy(float)
        out["score"] = model.decide(values)
        out["is_anomaly"] = out["score"] < 0
        out["status"] = np.where(out["is_anomaly"], ANOMALY, NORMAL)
        out["reason"] = [model.reason(v, metrics) if bad else None for v, bad in zip(values, out["is_anomaly"])]
        return out[["scope", "tick", "checks", "window_rows", "epoch", "status", "score", "is_anomaly", "reason"]]

    schema = VERDICT.rsplit(",", 1)[0]
    scored = train.unionByName(test).groupBy("scope", "epoch").applyInPandas(verdicts, schema)
    waiting = rows.filter("epoch IS NULL").select(
        "scope", "tick", "checks", "window_rows", "epoch", F.lit(COLLECTING).alias("status"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("boolean").alias("is_anomaly"), F.lit(None).cast("string").alias("reason"),
    )
    return waiting.unionByName(scored)


def window_stats(ticks: DataFrame, metrics: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """Mean and population deviation of every epoch's training window."""
    rows = _training_copies(epochs(ticks, settings).drop("epoch"), settings)
    return rows.groupBy("scope", "epoch").agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics]
    )


def explain_batch(ticks: DataFrame, metrics: Sequence[str], above: float = 1.5, settings: Settings = Settings()) -> DataFrame:
    """Contributions beyond ``above`` deviations of the training window in force."""
    rows = epochs(ticks, settings).filter("epoch IS NOT NULL").join(window_stats(ticks, metrics, settings), ["scope", "epoch"])
    return rows.withColumn("reason", reasons(metrics, None, above)).select("scope", "tick", "epoch", "reason")
