"""Queries of range-vector functions and row windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidewatch.layout import number_rows
from tidewatch.operators import grid, overtime, rolling
from tidewatch.plans.registry import query
from tidewatch.plans.tables import HOUR, counter_sql

SPAN = timedelta(hours=6)


def at(t) -> dict:
    return {"start": t.start, "end": t.end}

FRAME = """
frame AS (
  SELECT g.series, e.eval_ts, g.ts, g.value,
         (epoch_us(g.ts) - epoch_us(e.eval_ts)) / 1e6 AS x
  FROM gauge g JOIN evals e ON g.ts BETWEEN e.eval_ts - INTERVAL 6 HOUR AND e.eval_ts
)"""


def _simple(stat: str, expr: str):
    sql = f"WITH {FRAME} SELECT series, eval_ts, {expr} AS {stat} FROM frame GROUP BY 1, 2"

    @query(f"{stat}_over_time", sql, uses="gauge evals", doubles=stat)
    def run(t):
        return overtime.over_time(t.gauge(), ["series"], SPAN, HOUR, (stat,), **at(t))


_simple("avg", "avg(value)")
_simple("max", "max(value)")
_simple("stddev", "stddev_pop(value)")

def _counter(t, mode="extrapolated", span=SPAN):
    return overtime.counter_over_time(
        t.daily_counter(), ["series"], span, HOUR, mode=mode, tie=["event_id"], **at(t)
    )


@query(
    "counter_rate",
    f"WITH {counter_sql('daily_counter', 'series', 6)} SELECT series, eval_ts, increase / 21600.0 * 3600 AS rate_per_hour FROM rated",
    uses="daily_counter evals",
    doubles="rate_per_hour",
)
def counter_rate(t):
    return _counter(t).select("series", "eval_ts", (F.col("rate") * 3600).alias("rate_per_hour"))


@query(
    "counter_rate_plain",
    f"WITH {counter_sql('daily_counter', 'series', 6)} SELECT series, eval_ts, rise / 21600.0 * 3600 AS rate_per_hour FROM rated",
    uses="daily_counter evals",
    doubles="rate_per_hour",
)
def counter_rate_plain(t):
    return _counter(t, "plain").select("series", "eval_ts", (F.col("rate") * 3600).alias("rate_per_hour"))


@query(
    "counter_increase",
    f"WITH {counter_sql('daily_counter', 'series', 6)} SELECT series, eval_ts, increase FROM rated",
    uses="daily_counter evals",
    doubles="increase",
)
def counter_increase(t):
    return _counter(t).select("series", "eval_ts", "increase")


@query(
    "deriv",
    f"WITH {FRAME} SELECT series, eval_ts, regr_slope(value, x) * 3600 AS per_hour FROM frame "
    "GROUP BY 1, 2 HAVING count(*) >= 2",
    uses="gauge evals",
    doubles="per_hour",
)
def deriv(t):
    out = overtime.regress_over_time(t.gauge(), ["series"], SPAN, HOUR, **at(t))
    return out.select("series", "eval_ts", (F.col("deriv") * 3600).alias("per_hour"))


@query(
    "predict_linear",
    f"WITH {FRAME} SELECT series, eval_ts, regr_intercept(value, x) + regr_slope(value, x) * 3600 AS predicted "
    "FROM frame GROUP BY 1, 2 HAVING count(*) >= 2",
    uses="gauge evals",
    doubles="predicted",
)
def predict_linear(t):
    out = overtime.regress_over_time(t.gauge(), ["series"], SPAN, HOUR, ahead=HOUR, **at(t))
    return out.select("series", "eval_ts", "predicted")


ASOF = """
at_step AS (
  SELECT s.series, e.eval_ts, g.value
  FROM (SELECT DISTINCT series FROM gauge) s CROSS JOIN evals e
  ASOF JOIN gauge g ON g.series = s.series AND e.eval_ts >= g.ts
  WHERE g.ts > e.eval_ts - INTERVAL {minutes} MINUTE
)"""


@query("asof_grid", f"WITH {ASOF.format(minutes=60)} SELECT * FROM at_step", uses="gauge evals", doubles="value")
def asof(t):
    return grid.asof_grid(t.gauge(), ["series"], HOUR, HOUR, t.start, t.end)


@query(
    "promz_band",
    f"""WITH {FRAME}, {ASOF.format(minutes=60)},
    s AS (SELECT series, eval_ts, avg(value) AS avg, stddev_pop(value) AS stddev FROM frame GROUP BY 1, 2)
    SELECT series, eval_ts, value, avg, stddev, abs(value - avg) > 2 * stddev AS outside
    FROM at_step JOIN s USING (series, eval_ts)""",
    uses="gauge evals",
    doubles="value avg stddev",
)
def promz_band(t):
    return overtime.std_band(t.gauge(), ["series"], SPAN, HOUR, 2.0, HOUR, t.start, t.end)


TRAIL = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@query(
    "rolling_z",
    f"""WITH w AS (SELECT series, event_id, ts, value, avg(value) {TRAIL} AS rolling_mean,
      stddev_samp(value) {TRAIL} AS rolling_std, count(*) {TRAIL} AS c FROM gauge)
    SELECT series, event_id, ts, value, rolling_mean, rolling_std,
      (value - rolling_mean) / nullif(rolling_std, 0) AS z_score,
      coalesce(abs((value - rolling_mean) / nullif(rolling_std, 0)) > 2.5, false) AS is_anomaly FROM w WHERE c = 20""",
    uses="gauge",
    doubles="value rolling_mean rolling_std z_score",
)
def rolling_z(t):
    out = rolling.rolling_zscore(t.gauge(), ["series"], ["ts", "event_id"])
    return out.select("series", "event_id", "ts", "value", "rolling_mean", "rolling_std", "z_score", "is_anomaly")


CENTRED = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)"


@query(
    "dynamic_band",
    f"""WITH w AS (SELECT series, event_id, value, avg(value) {CENTRED} AS m, stddev_samp(value) {CENTRED} AS s,
      count(*) {CENTRED} AS c FROM gauge),
    b AS (SELECT series, event_id, value, CASE WHEN c = 20 THEN m + 2 * s END AS upper,
      CASE WHEN c = 20 THEN m - 2 * s END AS lower FROM w)
    SELECT *, coalesce(value > upper OR value < lower, false) AS is_anomaly FROM b""",
    uses="gauge",
    doubles="value upper lower",
)
def dynamic_band(t):
    out = rolling.centred_band(t.gauge(), ["series"], ["ts", "event_id"])
    return out.select("series", "event_id", "value", "upper", "lower", "is_anomaly")


@query(
    "adaptive_band",
    """WITH s AS (SELECT event_type || '/' || (user_id % 40)::VARCHAR AS series, ts, event_id, value FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS rn,
      least(20, count(*) OVER (PARTITION BY series) // 4) AS width FROM s),
    f AS (SELECT a.event_id, avg(b.value) AS m, stddev_samp(b.value) AS d FROM n a JOIN n b ON a.series IS NOT DISTINCT FROM b.series
      AND b.rn BETWEEN a.rn - (a.width - 1 - (a.width - 1) // 2) AND a.rn + (a.width - 1) // 2
      WHERE a.width > 1 GROUP BY a.event_id, a.width HAVING count(b.value) = a.width)
    SELECT series, event_id, value, width, m + 2 * d AS upper, m - 2 * d AS lower,
      coalesce(value > m + 2 * d OR value < m - 2 * d, false) AS is_anomaly FROM n LEFT JOIN f USING (event_id)""",
    doubles="value upper lower",
)
def adaptive_band(t):
    """Short series, one per event type and group of users: the band's width follows from their length."""
    series = F.concat("event_type", F.lit("/"), (F.col("user_id") % 40).cast("string"))
    rows = t.table("events").select(series.alias("series"), "ts", "event_id", "value")
    out = rolling.adaptive_band(rows, ["series"], ["ts", "event_id"])
    return out.select("series", "event_id", "value", "width", "upper", "lower", "is_anomaly")


Z = """z AS (SELECT series, event_id, ts, value, m AS mean, s AS std, (value - m) / nullif(s, 0) AS z_score FROM gauge
  JOIN (SELECT series, avg(value) AS m, stddev_samp(value) AS s FROM gauge GROUP BY 1) USING (series))"""


@query(
    "zscore",
    f"WITH {Z} SELECT series, event_id, value, z_score, coalesce(abs(z_score) > 2.5, false) AS is_anomaly FROM z",
    uses="gauge",
    doubles="value z_score",
)
def zscore(t):
    return rolling.zscore(t.gauge(), ["series"]).select("series", "event_id", "value", "z_score", "is_anomaly")


@query(
    "band_columns",
    f"WITH {Z} SELECT event_id, mean + 2 * std AS upper_2, mean - 2 * std AS lower_2, "
    "mean + 2.5 * std AS upper_2_5, mean - 2.5 * std AS lower_2_5 FROM z",
    uses="gauge",
    doubles="upper_2 lower_2 upper_2_5 lower_2_5",
)
def band_columns(t):
    out = rolling.bands(rolling.zscore(t.gauge(), ["series"]))
    return out.select("event_id", "upper_2", "lower_2", "upper_2_5", "lower_2_5")


@query(
    "median_mad",
    """WITH m AS (SELECT series, quantile_cont(value, 0.5) AS median FROM gauge GROUP BY 1)
    SELECT series, m.median, quantile_cont(abs(value - m.median), 0.5) AS mad FROM gauge JOIN m USING (series) GROUP BY 1, 2""",
    uses="gauge",
    doubles="median mad",
)
def median_mad(t):
    return rolling.median_mad(t.gauge(), ["series"])


@query(
    "modified_z",
    """WITH m AS (SELECT series, quantile_cont(value, 0.5) AS median FROM gauge GROUP BY 1),
    d AS (SELECT series, m.median, quantile_cont(abs(value - m.median), 0.5) AS mad FROM gauge JOIN m USING (series) GROUP BY 1, 2)
    SELECT event_id, value, 0.6745 * (value - median) / nullif(mad, 0) AS modified_z,
      coalesce(abs(0.6745 * (value - median) / nullif(mad, 0)) > 3.0, false) AS is_anomaly FROM gauge JOIN d USING (series)""",
    uses="gauge",
    doubles="value modified_z",
)
def modified_z(t):
    return rolling.modified_zscore(t.gauge(), ["series"]).select("event_id", "value", "modified_z", "is_anomaly")


@query(
    "contextual_z",
    """WITH s AS (SELECT series, hour(ts) AS h, avg(value) AS m, stddev_samp(value) AS s FROM gauge GROUP BY 1, 2)
    SELECT event_id, h AS hour, (value - m) / nullif(s, 0) AS z_score,
    coalesce(abs((value - m) / nullif(s, 0)) > 2.5, false) AS is_anomaly
    FROM gauge JOIN s ON s.series = gauge.series AND s.h = hour(gauge.ts)""",
    uses="gauge",
    doubles="z_score",
)
def contextual_z(t):
    out = rolling.contextual_zscore(t.gauge(), ["series"], {"hour": F.hour("ts").cast("bigint")})
    return out.select("event_id", "hour", "z_score", "is_anomaly")


@query(
    "difference",
    "SELECT event_id, value - lag(value) OVER (PARTITION BY series ORDER BY ts, event_id) AS difference FROM gauge",
    uses="gauge",
    doubles="difference",
)
def difference(t):
    return rolling.differences(t.gauge(), ["series"], ["ts", "event_id"]).select("event_id", "difference")


@query(
    "volatility",
    f"""WITH w AS (SELECT event_id, stddev_samp(value) {TRAIL} AS volatility, count(*) {TRAIL} AS c FROM gauge)
    SELECT event_id, volatility FROM w WHERE c = 20""",
    uses="gauge",
    doubles="volatility",
)
def volatility(t):
    return rolling.volatility(t.gauge(), ["series"], ["ts", "event_id"]).select("event_id", "volatility")


FLAT = "OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"


@query(
    "flatline",
    f"""WITH w AS (SELECT series, ts, stddev_samp(value) {FLAT} AS s, count(*) {FLAT} AS c FROM hourly_filled)
    SELECT series, ts, s < 1e-9 AS is_flat FROM w WHERE c = 2""",
    uses="hourly_filled",
)
def flatline(t):
    return rolling.volatility(t.hourly_filled(), ["series"], ["ts"], rows=2).select("series", "ts", "is_flat")


ROLL10 = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(
    "iforest_features",
    f"""SELECT event_id, value, hour(ts) AS hour, minute(ts) AS minute,
      coalesce(value - lag(value) OVER (PARTITION BY series ORDER BY ts, event_id), 0) AS rate_of_change,
      avg(value) {ROLL10} AS rolling_mean, value - avg(value) {ROLL10} AS deviation_from_rolling FROM gauge""",
    uses="gauge",
    doubles="value rate_of_change rolling_mean deviation_from_rolling",
)
def iforest_features(t):
    out = rolling.deviation_features(t.gauge(), ["series"], ["ts", "event_id"])
    return out.select(
        "event_id", "value", F.col("hour").cast("bigint"), F.col("minute").cast("bigint"),
        "rate_of_change", "rolling_mean", "deviation_from_rolling",
    )


@query(
    "flapping",
    """WITH s AS (SELECT series, avg(value) + 0.5 * stddev_samp(value) AS threshold FROM gauge GROUP BY 1),
    a AS (SELECT series, threshold, value > threshold AS above,
      lag(value > threshold) OVER (PARTITION BY series ORDER BY ts, event_id) AS was FROM gauge JOIN s USING (series)),
    c AS (SELECT series, max(threshold) AS threshold, count(*) FILTER (was IS NULL OR was <> above) AS crossings FROM a GROUP BY 1)
    SELECT *, crossings // 2 AS alerts_per_hour, crossings // 2 * 24 AS alerts_per_day FROM c""",
    uses="gauge",
    doubles="threshold",
)
def flapping(t):
    return rolling.crossings(t.gauge(), ["series"], ["ts", "event_id"])


@query("regularize_ffill", "SELECT series, ts, value FROM hourly_filled", uses="hourly_filled", doubles="value")
def regularize_ffill(t):
    return grid.regularize(t.hourly(), ["series"], HOUR).select("series", "ts", "value")


# The same functions with a label that a seventh of the users lack: its series is NULL.
ABSENT = "absent AS (SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE event_type END AS series, ts, value, event_id FROM events)"


def absent(t):
    series = F.when(F.col("user_id") % 7 != 0, F.col("event_type"))
    return t.table("events").select(series.alias("series"), "ts", "value", "event_id")


@query(
    "zscore_absent_label",
    f"""WITH {ABSENT}, s AS (SELECT *, avg(value) OVER (PARTITION BY series) AS m, stddev_samp(value) OVER (PARTITION BY series) AS d FROM absent)
    SELECT series, event_id, (value - m) / nullif(d, 0) AS z_score FROM s""",
    doubles="z_score",
)
def zscore_absent_label(t):
    return rolling.zscore(absent(t), ["series"]).select("series", "event_id", "z_score")


@query(
    "rolling_z_absent_label",
    f"""WITH {ABSENT}, s AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS d FROM absent
      WINDOW w AS (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    SELECT series, event_id, (value - m) / nullif(d, 0) AS z_score FROM s WHERE n = 20""",
    doubles="z_score",
)
def rolling_z_absent_label(t):
    return rolling.rolling_zscore(absent(t), ["series"], ["ts", "event_id"]).select("series", "event_id", "z_score")


@query(
    "median_mad_absent_label",
    f"""WITH {ABSENT}, m AS (SELECT *, median(value) OVER (PARTITION BY series) AS med FROM absent)
    SELECT series, any_value(med) AS median, median(abs(value - med)) AS mad FROM m GROUP BY series""",
    doubles="median mad",
)
def median_mad_absent_label(t):
    return rolling.median_mad(absent(t), ["series"])


@query(
    "counter_rate_absent_label",
    f"""WITH {ABSENT}, counts AS (SELECT series, ts, event_id, CAST(row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS DOUBLE) AS value
      FROM absent), {counter_sql('counts', 'series', 6)} SELECT series, eval_ts, increase / 21600.0 * 3600 AS rate_per_hour FROM rated""",
    uses="evals",
    doubles="rate_per_hour",
)
def counter_rate_absent_label(t):
    rows = number_rows(absent(t), ["series"], ["ts", "event_id"]).withColumn("value", F.col("rn").cast("double"))
    rates = overtime.counter_over_time(rows.drop("rn"), ["series"], SPAN, HOUR, tie=["event_id"], **at(t))
    return rates.select("series", "eval_ts", (F.col("rate") * 3600).alias("rate_per_hour"))
