"""Alert rules on evaluation grids, notification grouping, silences, routes, target health.

Inputs have one row per label set and evaluation step, so the windows below hold
at most one row per step of the evaluated period, whatever the number of samples.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import humanize_percentage, plain_number, render
from tidewatch.layout import attach
from tidewatch.model import Rule, from_micros, micros, span_us
from tidewatch.operators.selectors import COMPARE

DAY_US = 86_400_000_000


def _by_rule(rules: Sequence[Rule], pick) -> Column:
    out = None
    for r in rules:
        hit = F.col("rule") == r.name
        out = F.when(hit, pick(r)) if out is None else out.when(hit, pick(r))
    return out


def matching(vectors: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of ``rule, …, eval_ts, value`` that meet their rule, with its severity."""
    hit = _by_rule(rules, lambda r: COMPARE[r.op](F.col("value"), F.lit(r.limit)))
    return vectors.filter(hit).withColumn("severity", _by_rule(rules, lambda r: F.lit(r.severity)))


def alert_states(vectors: DataFrame, rules: Sequence[Rule], by: Sequence[str], step: timedelta) -> DataFrame:
    """Pending and firing rows: a run of true steps turns to firing once it lasted the rule's hold.

    A missing or false step ends the run. ``by`` are the labels beside ``rule``.
    """
    active = matching(vectors, rules).withColumn("_u", micros("eval_ts"))
    w = Window.partitionBy("rule", *by).orderBy("_u")
    last = F.lag("_u").over(w)
    starts = active.withColumn("_start", F.when(last.isNull() | (F.col("_u") - last > span_us(step)), F.col("_u")))
    since = F.last("_start", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    hold = _by_rule(rules, lambda r: F.lit(span_us(r.hold)))
    return starts.withColumn("_since", since).select(
        "rule", "severity", *by, "eval_ts", "value",
        F.when(F.col("_u") - F.col("_since") >= hold, "firing").otherwise("pending").alias("state"),
        from_micros("_since").alias("active_since"),
    )


def annotate(alerts: DataFrame, rules: Sequence[Rule], labels: Sequence[str]) -> DataFrame:
    """Summary and description texts filled with labels and value."""
    fields = {c: F.col(c).cast("string") for c in labels}
    fields |= {"value": plain_number(F.col("value")), "percent": humanize_percentage(F.col("value"))}
    for name in ("instance", "job"):
        fields.setdefault(name, F.lit(""))
    return alerts.withColumns(
        {
            "summary": _by_rule(rules, lambda r: render(r.summary, fields)),
            "description": _by_rule(rules, lambda r: render(r.description, fields)),
        }
    )


def active_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter("state = 'firing'").groupBy("eval_ts").agg(F.count("*").alias("value"))


def notifications(
    alerts: DataFrame, labels: Sequence[str], step: timedelta, group_by: Sequence[str] = ("rule", "severity"),
    wait: timedelta = timedelta(seconds=10), interval: timedelta = timedelta(seconds=10),
    repeat: timedelta = timedelta(hours=1), until: datetime | None = None,
) -> DataFrame:
    """Notices per group: at its start, when its set of firing alerts changes, repeats, and when it resolves.

    The set is compared by an order-free fingerprint of its label sets.
    """
    width = span_us(step)
    groups = (
        alerts.filter("state = 'firing'")
        .groupBy(*group_by, micros("eval_ts").alias("_u"))
        .agg(F.count("*").alias("alerts"), F.bit_xor(F.xxhash64(*labels)).alias("_set"))
    )
    w = Window.partitionBy(*group_by).orderBy("_u")
    fresh = F.lag("_u").over(w).isNull() | (F.col("_u") - F.lag("_u").over(w) > width)
    changed = (F.lag("_set").over(w) != F.col("_set")) | (F.lag("alerts").over(w) != F.col("alerts"))
    ends = F.coalesce(F.lead("_u").over(w) - F.col("_u") > width, F.lit(True))
    marked = groups.withColumns({"_fresh": fresh, "_new": fresh | changed, "_closes": ends})
    opened = F.count_if("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    segments = (
        marked.withColumn("_seg", opened)
        .groupBy(*group_by, "_seg")
        .agg(
            F.min("_u").alias("_u"), (F.max("_u") + width).alias("_stop"), F.bool_or("_closes").alias("_closes"),
            F.bool_or("_fresh").alias("_fresh"), F.min_by("alerts", "_u").alias("alerts"),
        )
    )
    first = F.col("_u") + F.when(F.col("_fresh"), span_us(wait)).otherwise(span_us(interval))
    times = F.when(
        first < F.col("_stop"), F.sequence(first, F.col("_stop") - 1, F.lit(span_us(repeat)))
    ).otherwise(F.array(first))
    firing = segments.withColumn("_n", F.explode(times))
    firing = firing.select(
        *group_by, F.col("_n").alias("_at"), "alerts", F.lit("firing").alias("status"), (F.col("_n") > first).alias("is_repeat")
    )
    resolved = segments.filter("_closes").select(
        *group_by, (F.col("_stop") + span_us(interval)).alias("_at"), "alerts", F.lit("resolved").alias("status"),
        F.lit(False).alias("is_repeat"),
    )
    if until is not None:
        resolved = resolved.filter(from_micros("_at") <= F.lit(until))
    return firing.unionByName(resolved).select(
        *group_by, from_micros("_at").alias("sent_at"), "status", "alerts", "is_repeat"
    )


def payloads(notices: DataFrame) -> DataFrame:
    """Notification payload text, one alert entry per alert counted."""
    entry = F.create_map(F.lit("alertname"), F.col("rule"), F.lit("severity"), F.col("severity"))
    body = F.struct(F.col("status"), F.array_repeat(entry, F.col("alerts").cast("int")).alias("alerts"))
    return notices.select(F.to_json(body).alias("value"))


def silence(alerts: DataFrame, silences: DataFrame) -> DataFrame:
    """Alerts outside every silence ``(rule, starts_at, ends_at)``; an end is not part of its silence.

    Silences of a rule that overlap or touch are united, then cut at midnight,
    so an alert meets the few pieces of its rule and day and however many
    silences a rule has, none is held together with the others. A silence that
    lacks a bound or ends before it begins silences nothing.
    """
    real = silences.select("rule", "starts_at", "ends_at").filter("starts_at < ends_at")
    line = Window.partitionBy("rule").orderBy("starts_at", "ends_at")
    so_far = F.max("ends_at").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = so_far.isNull() | (F.col("starts_at") > so_far)
    number = F.count_if("_opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    united = real.withColumn("_opens", opens).withColumn("_no", number)
    united = united.groupBy("rule", "_no").agg(F.min("starts_at").alias("_from"), F.max("ends_at").alias("_to"))
    day = lambda c: F.floor(micros(c) / F.lit(DAY_US))
    last = F.floor((micros("_to") - 1) / F.lit(DAY_US))
    pieces = united.select(F.col("rule").alias("_rule"), "_from", "_to", F.explode(F.sequence(day("_from"), last)).alias("_day"))
    hit = (F.col("rule") == F.col("_rule")) & (day("eval_ts") == F.col("_day")) & (F.col("eval_ts") >= F.col("_from")) & (F.col("eval_ts") < F.col("_to"))
    return alerts.join(pieces, hit, "left_anti")


def deduplicate(alerts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per firing run: its first and last step and the number of steps."""
    return alerts.filter("state = 'firing'").groupBy("rule", "severity", *labels, "active_since").agg(
        F.min("eval_ts").alias("first_ts"), F.max("eval_ts").alias("last_ts"), F.count("*").alias("repeats")
    )


def deduplicate_stream(alerts: DataFrame, labels: Sequence[str], within: str, at: str = "eval_ts") -> DataFrame:
    """First firing row per rule, label set and run; repeats within the watermark are dropped."""
    firing = alerts.filter("state = 'firing'").withWatermark(at, within)
    return firing.dropDuplicatesWithinWatermark(["rule", *labels, "active_since"])


def route(alerts: DataFrame, routes: dict[str, str], default: str = "default") -> DataFrame:
    """Receiver by severity."""
    out = F.lit(default)
    for severity, receiver in routes.items():
        out = F.when(F.col("severity") == severity, receiver).otherwise(out)
    return alerts.withColumn("receiver", out)


def target_health(up: DataFrame, by: Sequence[str], now: datetime, stale: timedelta = timedelta(minutes=5)) -> DataFrame:
    """Last ``up`` value per target, seconds since it was last up, and up / down / stale."""
    seen = up.groupBy(*by).agg(
        F.max_by("value", F.struct("ts", "value")).alias("up"), F.max("ts").alias("last_sample"),
        F.max(F.when(F.col("value") == 1, F.col("ts"))).alias("last_up"),
    )
    age = (micros(F.lit(now)) - micros("last_sample")) / F.lit(1e6)
    health = F.when(age > span_us(stale) / 1e6, "stale").when(F.col("up") == 0, "down").otherwise("up")
    return seen.withColumns({"age_seconds": age, "health": health})
