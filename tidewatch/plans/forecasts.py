"""Queries of trend, decomposition, smoothing, additive regression and capacity."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewatch.model import SEASONS, Resource, spec_table
from tidewatch.operators import additive, capacity, evaluation, linear, rolling, seasonal, smoothing
from tidewatch.operators.grid import regularize
from tidewatch.plans.registry import query
from tidewatch.plans.tables import HOUR, KINDS
from tidewatch.sources import synthetic

S = ["series"]


def fit_sql(source: str, name: str = "fit", by: str = "series") -> str:
    return f"""
{name}_x AS (SELECT {by}, ts, value, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY {by})) / 1e6 AS x FROM {source}),
{name} AS (SELECT {by}, count(*) AS n, regr_slope(value, x) AS slope, regr_intercept(value, x) AS intercept,
  regr_r2(value, x) AS r2, arg_max(value, ts) AS last_value, min(ts) AS first_ts, max(ts) AS last_ts FROM {name}_x GROUP BY {by}),
{name}_res AS (SELECT {by}, sqrt(avg(pow(value - intercept - slope * x, 2))) AS rmse
  FROM {name}_x JOIN {name} USING ({by}) GROUP BY {by})"""


@query(
    "linear_fit",
    f"WITH {fit_sql('gauge')} SELECT series, n, slope * 3600 AS per_hour, intercept, r2, rmse, last_value, first_ts, last_ts "
    "FROM fit JOIN fit_res USING (series)",
    uses="gauge",
    doubles="per_hour intercept r2 rmse last_value",
)
def linear_fit(t):
    return linear.linear_fit(t.gauge(), S).select(
        "series", "n", (F.col("slope") * 3600).alias("per_hour"), "intercept", "r2", "rmse", "last_value", "first_ts", "last_ts"
    )


FORECAST = f"""{fit_sql('revenue')},
fc AS (SELECT series, last_ts + to_hours(24 * h) AS ts, intercept + slope * (epoch_us(last_ts + to_hours(24 * h)) - epoch_us(first_ts)) / 1e6 AS yhat, rmse
  FROM fit JOIN fit_res USING (series), (SELECT CAST(unnest(range(240)) AS INT) AS h)),
forecast AS (SELECT series, ts, yhat, yhat - 2 * rmse AS yhat_lower, yhat + 2 * rmse AS yhat_upper FROM fc)"""


def _forecast(t):
    return linear.linear_forecast(t.revenue(), S, timedelta(days=240), timedelta(days=1))


@query("linear_forecast", f"WITH {FORECAST} SELECT * FROM forecast", uses="revenue", doubles="yhat yhat_lower yhat_upper")
def linear_forecast(t):
    return _forecast(t)


@query(
    "time_to_threshold",
    f"""WITH {fit_sql('hourly')}, s AS (SELECT series, last_ts, CASE WHEN slope > 0 AND (500 - last_value) / slope > 0
      THEN (500 - last_value) / slope END AS sec FROM fit)
    SELECT series, sec / 3600 AS hours_to_limit, CASE WHEN epoch_us(last_ts) / 1e6 + sec < 253402300799
      THEN make_timestamp(CAST(floor(epoch_us(last_ts) / 1e6 + sec) AS BIGINT) * 1000000) END AS breach_ts FROM s""",
    uses="hourly",
    doubles="hours_to_limit",
)
def time_to_threshold(t):
    out = linear.time_to_threshold(linear.linear_fit(t.hourly(), S), 500.0)
    return out.select("series", "hours_to_limit", "breach_ts")


@query(
    "fit_quality",
    f"WITH {fit_sql('revenue')} SELECT series, r2, CASE WHEN r2 < 0.3 THEN 'poor' WHEN r2 > 0.8 THEN 'good' ELSE 'fair' END "
    "AS quality FROM fit",
    uses="revenue",
    doubles="r2",
)
def fit_quality(t):
    return linear.fit_quality(linear.linear_fit(t.revenue(), S)).select("series", "r2", "quality")


@query(
    "first_breach",
    f"""WITH {FORECAST}, lim AS (SELECT max(yhat_upper) - 1 AS lim FROM forecast)
    SELECT series, min(ts) FILTER (yhat_upper > 50000) AS breach_ts, max(yhat_upper) AS max_upper,
      (epoch_us(min(ts) FILTER (yhat_upper > 50000)) - min(epoch_us(ts))) / 6e7 AS minutes_until FROM forecast GROUP BY 1""",
    uses="revenue",
    doubles="max_upper minutes_until",
)
def first_breach(t):
    return linear.first_breach(_forecast(t), S, 50000.0)


@query(
    "trend_alert",
    f"""WITH {fit_sql('hourly')} SELECT series, slope * 3600 AS per_hour,
      CASE WHEN slope > 0 AND 500 > last_value THEN (500 - last_value) / slope / 3600 END AS hours_to_limit,
      coalesce(slope > 0 AND 500 > last_value AND (500 - last_value) / slope / 3600 < 24 * 365, false) AS is_degrading FROM fit""",
    uses="hourly",
    doubles="per_hour hours_to_limit",
)
def trend_alert(t):
    out = linear.time_to_threshold(linear.linear_fit(t.hourly(), S), 500.0)
    return out.select(
        "series", (F.col("slope") * 3600).alias("per_hour"), "hours_to_limit",
        F.coalesce(F.col("hours_to_limit") < 24 * 365, F.lit(False)).alias("is_degrading"),
    )


@query(
    "history_future_split",
    f"""WITH {FORECAST} SELECT f.series, f.ts, f.ts > n.now AS is_future FROM forecast f
    JOIN (SELECT series, max(ts) AS now FROM revenue GROUP BY 1) n ON n.series = f.series""",
    uses="revenue",
)
def history_future_split(t):
    return evaluation.split_now(_forecast(t), t.revenue(), S).select("series", "ts", "is_future")


@query(
    "future_grid",
    """SELECT series, ts, false AS is_future FROM hourly UNION ALL
    SELECT series, ts + to_minutes(CAST(h AS INT)), true FROM (SELECT series, max(ts) AS ts FROM hourly GROUP BY 1),
    (SELECT unnest(range(1, 121)) AS h)""",
    uses="hourly",
)
def future_grid(t):
    return additive.history_and_future(t.hourly(), S)


IN_SAMPLE = f"""{fit_sql('hourly')},
ins AS (SELECT x.series, x.ts, x.value, intercept + slope * x AS yhat, rmse FROM fit_x x JOIN fit USING (series) JOIN fit_res USING (series))"""


@query(
    "forecast_actual_join",
    f"WITH {IN_SAMPLE} SELECT series, ts, value, yhat FROM ins",
    uses="hourly",
    doubles="value yhat",
)
def forecast_actual_join(t):
    line = linear.in_sample(t.hourly(), S).select("series", "ts", "yhat")
    return evaluation.with_actuals(line, t.hourly(), S).select("series", "ts", "value", "yhat")


@query(
    "interval_anomaly",
    f"""WITH {IN_SAMPLE} SELECT series, ts, value, yhat - 1.96 * rmse AS yhat_lower, yhat + 1.96 * rmse AS yhat_upper,
    value > yhat + 1.96 * rmse OR value < yhat - 1.96 * rmse AS is_anomaly FROM ins""",
    uses="hourly",
    doubles="value yhat_lower yhat_upper",
)
def interval_anomaly(t):
    return evaluation.interval_anomalies(linear.in_sample(t.hourly(), S)).drop("yhat")


DECOMPOSE = """
p AS (SELECT series, ts, value, row_number() OVER w - 1 AS k,
  CASE WHEN count(*) OVER f = 25 THEN (sum(value) OVER f - (lag(value, 12) OVER w + lead(value, 12) OVER w) / 2) / 24 END AS trend
  FROM hourly_filled WINDOW w AS (PARTITION BY series ORDER BY ts),
  f AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
ph AS (SELECT series, k % 24 AS phase, avg(value - trend) AS raw FROM p GROUP BY 1, 2),
se AS (SELECT series, phase, raw - avg(raw) OVER (PARTITION BY series) AS seasonal FROM ph),
parts AS (SELECT p.series, ts, value, trend, seasonal, value - trend - seasonal AS residual
  FROM p JOIN se ON se.series = p.series AND se.phase = p.k % 24)"""


@query(
    "seasonal_decompose",
    f"WITH {DECOMPOSE} SELECT * FROM parts",
    uses="hourly_filled",
    doubles="value trend seasonal residual",
)
def seasonal_decompose(t):
    out = seasonal.seasonal_decompose(t.hourly_filled(), S)
    return out.select("series", "ts", "value", "trend", "seasonal", "residual")


@query(
    "decompose_summary",
    f"""WITH {DECOMPOSE} SELECT series, min(trend) AS trend_min, max(trend) AS trend_max,
    max(seasonal) - min(seasonal) AS amplitude, stddev_samp(residual) AS residual_std FROM parts GROUP BY 1""",
    uses="hourly_filled",
    doubles="trend_min trend_max amplitude residual_std",
)
def decompose_summary(t):
    return seasonal.component_summary(seasonal.seasonal_decompose(t.hourly_filled(), S), S).drop("period")


def smoothing_sql(source: str, a: float, b: float, g: float, m: int, multiplicative: bool = False, where: str = "true") -> str:
    """Recursive expression ``r``: states of the smoothing after every step k (-1: initial ones)."""
    if m == 1:
        init = "arg_min(value, k) AS l, max(value) FILTER (k = 1) - max(value) FILTER (k = 0) AS b, [%s] AS s" % (
            "1.0" if multiplicative else "0.0"
        )
    else:
        init = (
            f"avg(value) FILTER (k < {m}) AS l, (avg(value) FILTER (k >= {m} AND k < {2 * m}) - avg(value) FILTER (k < {m})) / {m} AS b, "
            f"list(value ORDER BY k) FILTER (k < {m}) AS s"
        )
    if m > 1:
        start = "list_transform(s, lambda v: v / l)" if multiplicative else "list_transform(s, lambda v: v - l)"
    else:
        start = "s"
    op, inv = ("*", "/") if multiplicative else ("+", "-")
    sea = f"s[1:p] || [{g} * (value {inv} base) + {1 - g} * sv] || s[p + 2:{m}]" if m > 1 else "s"
    return f"""
y AS (SELECT * FROM (SELECT series, ts, value, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS k,
  count(*) OVER (PARTITION BY series) AS n FROM {source}) WHERE {where}),
i AS (SELECT series, {init} FROM y GROUP BY series),
r AS (SELECT series, CAST(-1 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS ts, CAST(l AS DOUBLE) AS level, CAST(b AS DOUBLE) AS trend,
    CAST({start} AS DOUBLE[]) AS s, CAST(NULL AS DOUBLE) AS fitted FROM i
  UNION ALL
  SELECT series, k, ts, lv, {b} * (lv - level) + {1 - b} * trend, s2, fitted FROM (
    SELECT *, {a} * (value {inv} sv) + {1 - a} * base AS lv, base {op} sv AS fitted, {sea} AS s2 FROM (
      SELECT r.series, y.k, y.ts, y.value, level, trend, s, y.k % {m} AS p, s[y.k % {m} + 1] AS sv, level + trend AS base
      FROM r JOIN y ON y.series = r.series AND y.k = r.k + 1)))"""


def fitted_sql(source: str, m: int) -> str:
    """Recursive expressions ending in ``best``: the set of least squared error on the coarse, then on the fine grid."""
    coarse = "[" + ", ".join(map(repr, smoothing.COARSE)) + "]"
    step = (smoothing.COARSE[1] - smoothing.COARSE[0]) / 5
    moves = "[" + ", ".join(repr(d * step) for d in (-2, -1, 0, 1, 2)) + "]"
    near = lambda c: f"unnest(list_distinct(list_transform({moves}, lambda d: greatest(0.001, least(0.999, {c} + d)))))"
    season = "s[1:p] || [g * (value - base) + (1 - g) * sv] || s[p + 2:{0}]".format(m) if m > 1 else "s"

    def run(name: str, sets: str) -> str:
        return f"""{name} USING KEY (series, a, b, g) AS (
    SELECT series, a, b, g, CAST(-1 AS BIGINT) AS k, level, trend, s, CAST(0 AS DOUBLE) AS e, CAST(0 AS DOUBLE) AS d
    FROM {sets} JOIN (SELECT series, level, trend, s FROM r WHERE k = -1) USING (series)
  UNION
  SELECT series, a, b, g, k, lv, b * (lv - level) + (1 - b) * trend, s2, e + miss * miss, d + miss FROM (
    SELECT *, a * (value - sv) + (1 - a) * base AS lv, value - (base + sv) AS miss, {season} AS s2 FROM (
      SELECT {name}.series, a, b, g, y.k, y.value, level, trend, s, e, d, y.k % {m} AS p, s[y.k % {m} + 1] AS sv, level + trend AS base
      FROM {name} JOIN y ON y.series = {name}.series AND y.k = {name}.k + 1)))"""

    least = lambda name: f"""SELECT f.* FROM {name} f JOIN (SELECT series, min({{'e': e, 'a': a, 'b': b, 'g': g}}) AS q FROM {name} GROUP BY 1) q
    ON f.series = q.series AND f.a = q.q.a AND f.b = q.q.b AND f.g = q.q.g"""
    gammas = coarse if m > 1 else "[0.0]"
    return f"""{smoothing_sql(source, 0.0, 0.0, 0.0, m, where="n >= 20")},
c0 AS (SELECT series, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(g AS DOUBLE) AS g FROM (SELECT DISTINCT series FROM y),
  (SELECT unnest({coarse}) AS a), (SELECT unnest({coarse}) AS b), (SELECT unnest({gammas}) AS g)),
{run("f0", "c0")},
b0 AS ({least("f0")}),
c1 AS (SELECT series, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(g AS DOUBLE) AS g FROM (
  SELECT series, a, b, {near("g") + " AS g" if m > 1 else "g"} FROM (SELECT series, a, {near("b")} AS b, g FROM (SELECT series, {near("a")} AS a, b, g FROM b0)))),
{run("f1", "c1")},
best AS (SELECT *, sqrt(greatest((sse - residual_sum * residual_sum / n) / (n - 1), 0)) AS residual_std FROM (
  SELECT series, last_ts, n, a AS alpha, b AS beta, g AS gamma, e AS sse, d AS residual_sum, level, trend, s AS season
  FROM ({least("f1")}) JOIN (SELECT series, max(ts) AS last_ts, count(*) AS n FROM y GROUP BY 1) USING (series)))"""


AHEAD = """SELECT series, last_ts + to_hours(CAST(h AS INT)) AS ts, CAST(h AS INT) AS h, yhat, yhat - 2 * residual_std AS yhat_lower,
    yhat + 2 * residual_std AS yhat_upper FROM (SELECT *, level + h * trend + season[(n + h - 1) % {m} + 1] AS yhat
    FROM best, (SELECT unnest(range(1, 61)) AS h))"""


@query(
    "holt_fixed",
    f"WITH RECURSIVE {smoothing_sql('hourly_filled', 0.3, 0.1, 0.0, 1)} SELECT series, ts, fitted, level, trend FROM r WHERE k >= 0",
    uses="hourly_filled",
    doubles="fitted level trend",
)
def holt_fixed(t):
    return smoothing.smooth_fixed(t.hourly_filled(), S, 0.3, 0.1)


@query(
    "hw_fixed_params",
    f"WITH RECURSIVE {smoothing_sql('hourly_filled', 0.3, 0.05, 0.1, 24)} SELECT series, ts, fitted, level, trend FROM r WHERE k >= 0",
    uses="hourly_filled",
    doubles="fitted level trend",
)
def hw_fixed_params(t):
    return smoothing.smooth_fixed(t.hourly_filled(), S, 0.3, 0.05, 0.1, 24)


@query(
    "hw_mult_fixed",
    f"WITH RECURSIVE {smoothing_sql('hourly_filled', 0.1, 0.01, 0.05, 24, True)} SELECT series, ts, fitted, level, trend FROM r WHERE k >= 0",
    uses="hourly_filled",
    doubles="fitted level trend",
)
def hw_mult_fixed(t):
    return smoothing.smooth_fixed(t.hourly_filled(), S, 0.1, 0.01, 0.05, 24, True)


@query(
    "hw_fit",
    f"""WITH RECURSIVE {fitted_sql('hourly_filled', 24)} SELECT series, n, last_ts, alpha, beta, gamma, sse, residual_sum, level, trend,
    n * ln(sse / n) + 2 * (4 + 24 + 1) AS aic, residual_std FROM best""",
    uses="hourly_filled",
    doubles="alpha beta gamma sse residual_sum level trend aic residual_std",
)
def hw_fit(t):
    return smoothing.fit_smoothing(t.hourly_filled(), S, 24).drop("season")


@query(
    "hw_forecast",
    f"WITH RECURSIVE {fitted_sql('hourly_filled', 24)} {AHEAD.format(m=24)}",
    uses="hourly_filled",
    doubles="yhat yhat_lower yhat_upper",
)
def hw_forecast(t):
    return smoothing.forecast(smoothing.fit_smoothing(t.hourly_filled(), S, 24), S, 60, HOUR, 24)


FIXED = (0.3, 0.05, 0.1)


@query(
    "holdout_eval",
    f"""WITH RECURSIVE {smoothing_sql('hourly_filled', 0.3, 0.05, 0.1, 24, where='k < n - n // 5')},
    test AS (SELECT series, ts, value, k, n - n // 5 AS c FROM (SELECT series, ts, value, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS k,
      count(*) OVER (PARTITION BY series) AS n FROM hourly_filled) WHERE k >= n - n // 5),
    {fit_sql('y')},
    lin AS (SELECT 'linear' AS method, test.series, value, intercept + slope * (epoch_us(ts) - epoch_us(first_ts)) / 1e6 AS yhat
      FROM test JOIN fit USING (series)),
    sm AS (SELECT 'smoothing' AS method, test.series, value, level + (test.k - c + 1) * trend + s[test.k % 24 + 1] AS yhat
      FROM test JOIN r ON r.series = test.series AND r.k = c - 1)
    SELECT method, series, count(*) AS n, avg(abs(value - yhat)) AS mae, avg(abs((value - yhat) / value)) * 100 AS mape,
      sqrt(avg(pow(value - yhat, 2))) AS rmse FROM (SELECT * FROM lin UNION ALL SELECT * FROM sm) GROUP BY 1, 2""",
    uses="hourly_filled",
    doubles="mae mape rmse",
)
def holdout_eval(t):
    train, test = evaluation.holdout(t.hourly_filled(), S)
    cols = ["series", "value", "yhat"]
    line = evaluation.linear_holdout(train, test, S).select(F.lit("linear").alias("method"), *cols)
    smooth = evaluation.smoothing_holdout(train, test, S, 24, params=FIXED).select(F.lit("smoothing").alias("method"), *cols)
    return evaluation.errors(line.unionByName(smooth), ["method", "series"])


@query("model_compare")
def model_compare(t):
    train, test = evaluation.holdout(t.hourly_filled(), S)
    cols = ["series", "value", "yhat"]
    tag = lambda df, name: df.select(F.lit(name).alias("method"), *cols)
    model = additive.fit_additive(train, S)
    rows = (
        tag(evaluation.linear_holdout(train, test, S), "linear")
        .unionByName(tag(evaluation.smoothing_holdout(train, test, S), "holt"))
        .unionByName(tag(evaluation.smoothing_holdout(train, test, S, 24), "holt_winters"))
        .unionByName(tag(additive.predict_additive(test.select("series", "ts", "value"), model, S), "additive"))
    )
    return evaluation.best_method(evaluation.errors(rows, ["method", "series"]), S)


def _fourier_sql() -> str:
    out = []
    for s in SEASONS:
        for n in range(1, s.order + 1):
            angle = f"2 * pi() * epoch_us(ts) / 86400000000.0 / {s.period_days} * {n}"
            out += [f"sin({angle}) AS {s.name}_sin{n}", f"cos({angle}) AS {s.name}_cos{n}"]
    return ", ".join(out)


FOURIER = [f"{s.name}_{f}{n}" for s in SEASONS for n in range(1, s.order + 1) for f in ("sin", "cos")]


@query(
    "fourier_features",
    f"SELECT event_id, {_fourier_sql()} FROM events",
    doubles=" ".join(FOURIER),
)
def fourier_features(t):
    us = F.unix_micros("ts")
    cols = [c for s in SEASONS for c in additive.fourier(us, s)]
    return t.table("events").select("event_id", *[c.alias(n) for c, n in zip(cols, FOURIER)])


@query(
    "changepoints",
    """WITH r AS (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS i,
      floor(count(*) OVER (PARTITION BY series) * 0.8) AS h FROM hourly),
    c AS (SELECT DISTINCT series, CAST(round_even(j * (h - 1) / 25.0, 0) AS BIGINT) AS i FROM r, (SELECT unnest(range(1, 26)) AS j))
    SELECT r.series, r.ts FROM r JOIN c ON c.series = r.series AND c.i = r.i""",
    uses="hourly",
)
def changepoints(t):
    return additive.changepoints(t.hourly(), S)


@query("additive_forecast")
def additive_forecast(t):
    model = additive.fit_additive(t.hourly_filled(), S)
    return additive.predict_additive(additive.history_and_future(t.hourly_filled(), S), model, S)


@query("forecast_components")
def forecast_components(t):
    model = additive.fit_additive(t.hourly_filled(), S)
    rows = additive.predict_additive(additive.history_and_future(t.hourly_filled(), S), model, S)
    return additive.component_ranges(rows, S, ["trend", "daily", "weekly", "shift_pattern"])


@query("trend_changes")
def trend_changes(t):
    return additive.changes(additive.fit_additive(t.hourly_filled(), S), S)


RESOURCE_ROWS = tuple(
    Resource(n, m, c, u)
    for n, m, c, u in (
        ("CPU Usage", "click", 100.0, "%"), ("Memory", "error", 512.0, "MB"), ("Queue Depth", "view", 50.0, "items"),
        ("Connections", "signup", 60.0, "conns"), ("Disk", "absent", 10.0, "GB"),
    )
)
RESOURCE_SQL = "(VALUES " + ", ".join(
    f"('{r.name}', '{r.metric}', {r.capacity_limit}, '{r.unit}')" for r in RESOURCE_ROWS
) + ") AS res(name, metric, capacity_limit, unit)"
CAPACITY = f"""{fit_sql('hourly')},
cap AS (SELECT name, unit, capacity_limit, last_value AS current_value, last_value / capacity_limit * 100 AS current_pct,
  slope * 3600 AS growth_rate_per_hour,
  CASE WHEN slope > 0 AND last_value < 0.8 * capacity_limit THEN (0.8 * capacity_limit - last_value) / slope / 3600 END AS time_to_warning_hours,
  CASE WHEN slope > 0 AND last_value < 0.9 * capacity_limit THEN (0.9 * capacity_limit - last_value) / slope / 3600 END AS time_to_critical_hours
  FROM {RESOURCE_SQL} LEFT JOIN fit ON fit.series = res.metric),
capacity AS (SELECT *, CASE WHEN current_value IS NULL THEN 'NO_DATA' WHEN current_pct >= 90 THEN 'CRITICAL' WHEN current_pct >= 80
  THEN 'WARNING' WHEN time_to_critical_hours < 24 THEN 'WATCH' ELSE 'OK' END AS status FROM cap)"""


def _capacity(t):
    return capacity.capacity_status(t.hourly(), spec_table(t.spark, RESOURCE_ROWS), "series")


@query(
    "capacity_status",
    f"WITH {CAPACITY} SELECT * FROM capacity",
    uses="hourly",
    doubles="capacity_limit current_value current_pct growth_rate_per_hour time_to_warning_hours time_to_critical_hours",
)
def capacity_status(t):
    return _capacity(t)


@query(
    "capacity_reco",
    f"""WITH {CAPACITY}, a AS (SELECT name, status, CASE status WHEN 'CRITICAL' THEN name || ': IMMEDIATE action required!'
      WHEN 'WARNING' THEN name || ': Plan expansion within 24h'
      WHEN 'WATCH' THEN name || ': Monitor closely (~' || printf('%.0f', time_to_critical_hours) || 'h to critical)' END AS recommendation FROM capacity)
    SELECT * FROM a WHERE recommendation IS NOT NULL UNION ALL
    SELECT '', 'OK', 'All resources healthy. No action needed.' WHERE NOT EXISTS (SELECT 1 FROM a WHERE recommendation IS NOT NULL)""",
    uses="hourly",
)
def capacity_reco(t):
    return capacity.recommendations(_capacity(t))


@query(
    "capacity_report",
    f"""WITH {CAPACITY} SELECT name, status,
      CASE WHEN status = 'NO_DATA' THEN 'NO DATA AVAILABLE' ELSE printf('%.1f/%.0f %s (%.1f%%)', current_value, capacity_limit, unit, current_pct) END AS headline,
      CASE WHEN abs(growth_rate_per_hour) > 0.01 THEN CASE WHEN growth_rate_per_hour > 0 THEN '↑ ' ELSE '↓ ' END
        || printf('%.2f %s/hour', abs(growth_rate_per_hour), unit) END AS growth,
      CASE WHEN time_to_critical_hours < 24 THEN printf('%.1f hours', time_to_critical_hours)
        WHEN time_to_critical_hours < 168 THEN printf('%.1f days', time_to_critical_hours / 24) END AS critical_in FROM capacity""",
    uses="hourly",
)
def capacity_report(t):
    return capacity.report_lines(_capacity(t)).select("name", "status", "headline", "growth", "critical_in")


@query(
    "capacity_forecast",
    f"WITH RECURSIVE {fitted_sql('hourly_filled', 1)} {AHEAD.format(m=1)}",
    uses="hourly_filled",
    doubles="yhat yhat_lower yhat_upper",
)
def capacity_forecast(t):
    minutes = regularize(t.hourly(), S, timedelta(minutes=60)).drop("k")
    return smoothing.forecast(smoothing.fit_smoothing(minutes, S, 1, minimum=20), S, 60, HOUR)


@query(
    "clean_then_fit",
    """WITH RECURSIVE m AS (SELECT series, quantile_cont(value, 0.5) AS med FROM hourly GROUP BY 1),
    d AS (SELECT series, med, quantile_cont(abs(value - med), 0.5) AS mad FROM hourly JOIN m USING (series) GROUP BY 1, 2),
    c AS (SELECT series, ts, value FROM hourly JOIN d USING (series) WHERE NOT coalesce(abs(0.6745 * (value - med) / nullif(mad, 0)) > 3, false)),
    """ + fit_sql("c") + " SELECT series, n, slope * 3600 AS per_hour, intercept FROM fit",
    uses="hourly",
    doubles="per_hour intercept",
)
def clean_then_fit(t):
    clean = rolling.modified_zscore(t.hourly(), S).filter(~F.col("is_anomaly")).select("series", "ts", "value")
    return linear.linear_fit(clean, S).select("series", "n", (F.col("slope") * 3600).alias("per_hour"), "intercept")


SHAPE = synthetic.Shape(30.0, 0.1, ((15.0, 24.0),), 0.0, bounds=(20.0, 60.0))


@query(
    "synthetic_series",
    """SELECT user_id, TIMESTAMP '2024-01-01' + to_minutes(CAST(step AS INT)) AS ts,
      least(60.0, greatest(20.0, 30 + 0.1 * step + 15 * sin(2 * pi() * step / 24.0))) AS value
    FROM (SELECT DISTINCT user_id FROM events), (SELECT unnest(range(200)) AS step)""",
    doubles="value",
)
def synthetic_series(t):
    users = t.table("events").select("user_id").distinct()
    return synthetic.synthetic(users, ["user_id"], 200, SHAPE, datetime(2024, 1, 1)).drop("step")
