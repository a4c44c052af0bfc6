"""Alert rules on a stream: state per rule and label set, resolved by event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.model import Rule, span_us
from tidewatch.operators.alerts import _by_rule
from tidewatch.operators.selectors import COMPARE

STATES = "rule string, instance string, eval_ts timestamp, value double, state string, active_since timestamp"


class _Runs(StatefulProcessor):
    """Start and last step of the unbroken run of true steps."""

    def __init__(self, hold_ms: dict[str, int], step_ms: int):
        self.hold_ms, self.step_ms = hold_ms, step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "since bigint, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last = self.run.get() if self.run.exists() else (None, None)
        batch = pd.concat(list(rows), ignore_index=True).sort_values("eval_ms")
        out = []
        for at, value, hit in batch[["eval_ms", "value", "hit"]].itertuples(index=False, name=None):
            if not hit:
                if since is not None:
                    out.append((*key, at, value, "resolved", since))
                since = last = None
                continue
            if since is not None and at - last > self.step_ms:
                out.append((*key, last + self.step_ms, None, "resolved", since))
                since = None
            since, last = (at if since is None else since), at
            firing = at - since >= self.hold_ms[key[0]]
            out.append((*key, at, value, "firing" if firing else "pending", since))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if since is None:
            self.run.clear()
        else:
            self.run.update((int(since), int(last)))
            self.handle.registerTimer(int(last) + 2 * self.step_ms)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No step arrived: the run ended one step after its last."""
        out = []
        if self.run.exists():
            since, last = self.run.get()
            out.append((*key, last + self.step_ms, None, "resolved", since))
            self.run.clear()
        yield self._frame(out)

    @staticmethod
    def _frame(out: list) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["rule", "instance", "eval_ts", "value", "state", "active_since"])
        for c in ("eval_ts", "active_since"):
            frame[c] = pd.to_datetime(frame[c], unit="ms")
        return frame

    def close(self) -> None:
        pass


def alert_stream(vectors: DataFrame, rules: Sequence[Rule], step: timedelta, delay: str | None = None) -> DataFrame:
    """Pending, firing and resolved rows of ``rule, instance, eval_ts, value``.

    The pending and firing rows equal those of the batch definition. Vectors that
    come from a windowed aggregation carry its watermark (keep its
    ``window_time``); give ``delay`` for any other source.
    """
    hit = _by_rule(rules, lambda r: COMPARE[r.op](F.col("value"), F.lit(r.limit)))
    rows = vectors.withColumns(
        {"hit": F.coalesce(hit, F.lit(False)), "eval_ms": F.unix_millis("eval_ts")}
    )
    if delay:
        rows = rows.withWatermark("eval_ts", delay)
    holds = {r.name: span_us(r.hold) // 1000 for r in rules}
    return rows.groupBy("rule", "instance").transformWithStateInPandas(
        _Runs(holds, span_us(step) // 1000), STATES, outputMode="append", timeMode="eventTime"
    )
