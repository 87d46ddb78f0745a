"""Revenue forecasts for one or many daily series.

The series is delivered revenue per purchase day (days without sales are
absent), optionally split by a column (state, category, seller) into many
series that are fitted in parallel. All data handling (daily and monthly sums,
spreading months over days, horizon rows, rollups, flags, summary) is Spark.
Fits are grouped sums and a small solve per series (seasonal, linear), or a
parameter grid tried in rows that are spread over all tasks (Holt-Winters). No
group gathers the days of a series.

Models, in the order the cascade tries them:

* ``seasonal``: piecewise-linear trend (hinges at regular changepoints over
  the first 80% of history, ridge-shrunk with flexibility 0.05) times
  (1 + yearly Fourier terms + weekly Fourier terms); after Taylor and Letham,
  "Forecasting at Scale" (2018). Band widens with the horizon.
* ``holt_winters``: monthly sums without the last (possibly partial) month,
  additive damped trend and, from 24 months on, additive 12-month season;
  parameters from a grid by least squared one-step error. A month value is
  spread evenly over its days.
* ``linear_trend``: least squares on the day offset, band +-15%.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.scalar import even_round, sql_round
from shopscope.plans.revenue import delivered_lines

# The per-series fit functions are shipped with the task by value, so the
# executors need only numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed settings of the forecast.
HORIZON_DAYS = 90
MIN_HISTORY_DAYS = 30
LINEAR_BAND = (0.85, 1.15)
HW_SEASON = 12
HW_MIN_SEASONAL_MONTHS = 24
HW_BAND_Z = 1.96
SEASONAL_FLEXIBILITY = 0.05
SEASONAL_CHANGEPOINTS = 25
SEASONAL_CHANGEPOINT_RANGE = 0.8
SEASONAL_YEARLY_ORDER = 10
SEASONAL_WEEKLY_ORDER = 3
SEASONAL_BAND_Z = 1.2816  # 80% interval
TOTAL_SERIES = "total"
NO_SERIES = "(none)"  # the series of rows whose series column is null

FORECAST_SCHEMA = ("series_id string, ds date, yhat double, yhat_lower double, "
                   "yhat_upper double, model string")


# ---- F1, F2: the daily series ---------------------------------------------

def daily_revenue(fact: DataFrame, series_col: str | None = None,
                  orders: DataFrame | None = None) -> DataFrame:
    """(series_id, ds, y): delivered revenue per purchase day and series.

    Reads the order summary when it is given and holds the series column
    (customer, state, period); other columns (category, seller) come from the
    lines.
    """
    if orders is not None and (series_col is None or series_col in orders.columns):
        src, value = orders, "rev"
    else:
        src, value = delivered_lines(fact), "revenue"
    src = src.filter(F.col("order_purchase_timestamp").isNotNull())
    sid = F.lit(TOTAL_SERIES) if series_col is None else F.coalesce(F.col(series_col).cast("string"), F.lit(NO_SERIES))
    return (src.groupBy(sid.alias("series_id"), F.to_date("order_purchase_timestamp").alias("ds"))
            .agg(F.sum(value).alias("y")))


def _named(daily: DataFrame) -> DataFrame:
    return daily.withColumn("series_id", F.coalesce("series_id", F.lit(NO_SERIES)))


def with_min_history(daily: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """keep series with at least ``min_days`` days of sales; rows without a
    series are the series ``NO_SERIES``."""
    daily = _named(daily)
    enough = daily.groupBy("series_id").agg(F.count(F.lit(1)).alias("_days")) \
        .filter(F.col("_days") >= min_days).select("series_id")
    return daily.join(enough, "series_id", "left_semi")


def _series_span(daily: DataFrame) -> DataFrame:
    return daily.groupBy("series_id").agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
                                          F.count(F.lit(1)).alias("n_days"))


def _future_days(span: DataFrame, horizon: int) -> DataFrame:
    """(series_id, ds, h) for the ``horizon`` days after each series' last day."""
    return span.select("series_id", "last_ds", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")) \
        .select("series_id", F.date_add("last_ds", F.col("h")).alias("ds"), "h")


# ---- F3: linear trend -----------------------------------------------------

def linear_trend(daily: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """least-squares line on the day offset, history fit plus ``horizon`` days.

    Slope and intercept come from exact sums (decimal revenue, integer
    offsets), so the fit does not depend on the order rows are added in.
    Future values and bounds are kept at 0 or above; history bounds are
    ordered even when the fit is negative.
    """
    daily = _named(daily)
    span = _series_span(daily)
    pts = daily.join(span.select("series_id", "first_ds"), "series_id") \
        .withColumn("t", F.datediff("ds", "first_ds"))
    y = F.col("y").cast("decimal(38,2)")
    t = F.col("t").cast("bigint")
    sums = pts.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(t).alias("st"), F.sum(y).alias("sy"),
        F.sum(t * y).alias("sty"), F.sum(t * t).alias("stt"), F.max(t).alias("last_t"),
        F.max("ds").alias("last_ds"))
    num = (F.col("n") * F.col("sty") - F.col("st") * F.col("sy")).cast("double")
    den = (F.col("n") * F.col("stt") - F.col("st") * F.col("st")).cast("double")
    coef = sums.withColumn("slope", num / F.when(den != 0, den)) \
        .withColumn("intercept", (F.col("sy").cast("double") - F.col("slope") * F.col("st")) / F.col("n"))
    lo, hi = LINEAR_BAND
    fit = F.col("slope") * F.col("t") + F.col("intercept")
    hist = pts.join(coef.select("series_id", "slope", "intercept"), "series_id").select(
        "series_id", "ds", fit.alias("yhat"),
        F.least(fit * lo, fit * hi).alias("yhat_lower"), F.greatest(fit * lo, fit * hi).alias("yhat_upper"))
    fut_fit = F.col("slope") * (F.col("last_t") + F.col("h")) + F.col("intercept")
    future = coef.select("series_id", "slope", "intercept", "last_t", "last_ds",
                         F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")).select(
        "series_id", F.date_add("last_ds", F.col("h")).alias("ds"),
        F.greatest(fut_fit, F.lit(0.0)).alias("yhat"),
        F.greatest(fut_fit * lo, F.lit(0.0)).alias("yhat_lower"),
        F.greatest(fut_fit * hi, F.lit(0.0)).alias("yhat_upper"))
    return hist.unionByName(future).withColumn("model", F.lit("linear_trend"))


# ---- F4: Holt-Winters -----------------------------------------------------

_HW_ALPHA = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
_HW_BETA = (0.01, 0.05, 0.1, 0.2, 0.3)
_HW_PHI = (0.8, 0.9, 0.95, 0.98)
_HW_GAMMA = (0.05, 0.1, 0.2, 0.4)


def _hw_search(ys: pd.Series, seasonal: pd.Series, alpha: pd.Series) -> pd.DataFrame:
    """Least squared one-step error of each row's months over all (beta, phi,
    gamma), for the row's alpha; ties go to the smallest parameters. The
    recursion runs over the months once, with all points side by side."""
    b, p, g = (x.ravel() for x in np.meshgrid(_HW_BETA, _HW_PHI, _HW_GAMMA, indexing="ij"))
    found = []
    for y, season, a in zip(ys, seasonal, alpha):
        y = np.asarray(y, float)
        if season:
            first, second = sum(y[:HW_SEASON].tolist()) / HW_SEASON, sum(y[HW_SEASON:2 * HW_SEASON].tolist()) / HW_SEASON
            level, trend, start = first, (second - first) / HW_SEASON, HW_SEASON
            seas = np.repeat((y[:HW_SEASON] - first)[:, None], len(b), axis=1)
        else:
            level, trend, start, seas = y[0], y[1] - y[0], 1, np.zeros((1, len(b)))
        sse = np.zeros(len(b))
        for i in range(start, len(y)):
            old = seas[i % len(seas)].copy()
            prev = level + p * trend
            err = y[i] - (prev + old)
            sse += err * err
            new_level = a * (y[i] - old) + (1 - a) * prev
            trend = b * (new_level - level) + (1 - b) * p * trend
            if season:
                seas[i % len(seas)] = g * (y[i] - prev) + (1 - g) * old
            level = new_level
        best = int(np.argmin(sse))  # the first of equal ones
        found.append((float(sse[best]), float(a), float(b[best]), float(p[best]), float(g[best])))
    return pd.DataFrame(found, columns=["sse", "a", "b", "p", "g"])


def holt_winters(daily: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Holt-Winters on monthly sums, spread evenly over the days of a month.

    The parameter grid is searched as (series, alpha) rows spread over all
    tasks; ``min_by`` picks each series' best point, and one fold with it gives
    the fitted and forecast months.

    The last month is left out of the fit (it may be partial) and receives the
    one-step forecast; every day keeps one row: history days get their month's
    fitted value (band +-1 sd), the ``horizon`` days after the last actual day
    get the forecast (band +-1.96 sd), all kept at 0 or above.
    """
    daily = _named(daily)
    span = _series_span(daily)
    months = _hw_grid_months(daily, horizon)
    # A series that could not be fitted has no months and gives no rows; any
    # other has one for every day, so nothing is lost in the joins below.
    fitted = months.select("series_id").distinct()
    daily, span = (df.join(fitted, "series_id", "left_semi") for df in (daily, span))
    dim = F.dayofmonth(F.last_day("month")).cast("double")
    per_day = months.withColumn("v", F.col("value") / dim).withColumn("sd", F.col("resid_sd") / dim)
    hist_days = daily.select("series_id", "ds", F.trunc("ds", "month").alias("month"))
    hist = hist_days.join(per_day, ["series_id", "month"], "left").select(
        "series_id", "ds", F.greatest("v", F.lit(0.0)).alias("yhat"),
        F.greatest(F.col("v") - F.col("sd"), F.lit(0.0)).alias("yhat_lower"),
        (F.greatest("v", F.lit(0.0)) + F.col("sd")).alias("yhat_upper"))
    fut_days = _future_days(span, horizon).withColumn("month", F.trunc("ds", "month"))
    # One row per future day: the value of its month, which is a forecast
    # month, or (when no month was held out) the rest of the last fitted month.
    future = fut_days.join(per_day, ["series_id", "month"], "left").select(
        "series_id", "ds", F.greatest("v", F.lit(0.0)).alias("yhat"),
        F.greatest(F.col("v") - HW_BAND_Z * F.col("sd"), F.lit(0.0)).alias("yhat_lower"),
        F.greatest(F.col("v") + HW_BAND_Z * F.col("sd"), F.lit(0.0)).alias("yhat_upper"))
    return hist.unionByName(future).withColumn("model", F.lit("holt_winters"))


# ---- F4 with fixed parameters, as one Spark expression ----------------------

HW_FIXED = {"alpha": 0.5, "beta": 0.1, "phi": 0.9, "gamma": 0.2}


def _forecast_steps(daily: DataFrame, horizon: int) -> DataFrame:
    """(series_id, steps): months from each series' last fitted month to the end
    of its horizon, which a gap in the sales before the last day makes many."""
    last = _held_out_months(daily).groupBy("series_id").agg(F.max("month").alias("last_month"))
    return last.join(_series_span(daily), "series_id").select("series_id", F.greatest(
        F.lit(horizon // 30 + 2),
        F.months_between(F.trunc(F.date_add("last_ds", horizon), "month"), F.col("last_month")).cast("int"))
        .alias("steps"))


def _held_out_months(daily: DataFrame) -> DataFrame:
    """Monthly sums per series without the last month (kept when only 1-2 months)."""
    monthly = daily.groupBy("series_id", F.trunc("ds", "month").alias("month")) \
        .agg(F.sum("y").cast("double").alias("y"))
    per_series = Window.partitionBy("series_id")
    monthly = monthly.withColumn("n_months", F.count(F.lit(1)).over(per_series)) \
        .withColumn("max_month", F.max("month").over(per_series))
    return monthly.filter((F.col("month") < F.col("max_month")) | (F.col("n_months") <= 2)) \
        .select("series_id", "month", "y")


def _month_arrays(daily: DataFrame) -> DataFrame:
    """Per series: its months in order as one array (bounded by the calendar)."""
    return _held_out_months(daily).groupBy("series_id") \
        .agg(F.sort_array(F.collect_list(F.struct("month", "y"))).alias("pts")) \
        .withColumn("ys", F.expr("transform(pts, x -> x.y)")) \
        .withColumn("seasonal", F.size("ys") >= HW_MIN_SEASONAL_MONTHS)


_HW_INIT = """
  CASE WHEN seasonal THEN named_struct(
         'level', aggregate(slice(ys, 1, 12), 0D, (acc, x) -> acc + x) / 12,
         'trend', (aggregate(slice(ys, 13, 12), 0D, (acc, x) -> acc + x) / 12
                   - aggregate(slice(ys, 1, 12), 0D, (acc, x) -> acc + x) / 12) / 12,
         'seas', transform(slice(ys, 1, 12), x -> x - aggregate(slice(ys, 1, 12), 0D, (acc, v) -> acc + v) / 12),
         'fitted', transform(slice(ys, 1, 12), x -> aggregate(slice(ys, 1, 12), 0D, (acc, v) -> acc + v) / 12
                             + (x - aggregate(slice(ys, 1, 12), 0D, (acc, v) -> acc + v) / 12)))
       ELSE named_struct('level', try_element_at(ys, 1),
                         'trend', try_element_at(ys, 2) - try_element_at(ys, 1),
                         'seas', CAST(array() AS array<double>),
                         'fitted', array(try_element_at(ys, 1))) END"""


def _hw_fold(arr: DataFrame, a: str, b: str, p: str, g: str) -> DataFrame:
    """The damped additive Holt-Winters recursion as a left fold over ``ys``.

    ``a``, ``b``, ``p``, ``g`` are SQL expressions for the smoothing
    parameters (literals or columns). The state holds level, trend, the last
    12 season values (a rolling window, so each step costs the same) and the
    fitted values.
    """
    s_old = "IF(size(st.seas) > 0, element_at(st.seas, 1), 0D)"
    prev = f"(st.level + {p} * st.trend)"
    level = f"({a} * (y - {s_old}) + (1D - {a}) * {prev})"
    step = f"""
      named_struct(
        'level', {level},
        'trend', {b} * ({level} - st.level) + (1D - {b}) * {p} * st.trend,
        'seas', IF(size(st.seas) > 0,
                   concat(slice(st.seas, 2, 11), array({g} * (y - {prev}) + (1D - {g}) * {s_old})), st.seas),
        'fitted', concat(st.fitted, array({prev} + {s_old})))"""
    return arr.withColumn("st", F.expr(
        f"aggregate(slice(ys, IF(seasonal, 13, 2), size(ys)), {_HW_INIT}, (st, y) -> {step})"))


def _hw_month_rows(folded: DataFrame, p: str) -> DataFrame:
    """(series_id, month, value, resid_sd, is_future): fitted months, then ``steps`` forecasts."""
    forecast = F.expr(f"""
      transform(sequence(1, steps), h -> st.level + st.trend * ({p} * (1D - pow({p}, h)) / (1D - {p}))
                + IF(size(st.seas) > 0, element_at(st.seas, size(st.seas) - 12 + ((h - 1) % 12) + 1), 0D))""")
    resid = "slice(zip_with(ys, st.fitted, (y, f) -> y - f), IF(seasonal, 13, 2), size(ys))"
    mean_r = f"(aggregate({resid}, 0D, (acc, x) -> acc + x) / size({resid}))"
    sd = F.expr(f"coalesce(sqrt(aggregate({resid}, 0D, (acc, x) -> acc + (x - {mean_r}) * (x - {mean_r}))"
                f" / size({resid})), 0D)")
    folded = folded.withColumn("resid_sd", sd).withColumn("fc", forecast)
    hist = folded.select("series_id", "resid_sd",
                         F.posexplode(F.arrays_zip(F.col("pts.month").alias("month"),
                                                   F.col("st.fitted").alias("value"))).alias("i", "r")) \
        .select("series_id", F.col("r.month").alias("month"), F.col("r.value").alias("value"), "resid_sd",
                F.lit(False).alias("is_future"))
    fut = folded.select("series_id", "resid_sd", F.element_at("pts", -1)["month"].alias("last"),
                        F.posexplode("fc").alias("i", "value")) \
        .select("series_id", F.add_months("last", F.col("i") + 1).alias("month"), "value", "resid_sd",
                F.lit(True).alias("is_future"))
    return hist.unionByName(fut)


def holt_winters_fixed(daily: DataFrame, horizon: int = HORIZON_DAYS, alpha: float = HW_FIXED["alpha"],
                       beta: float = HW_FIXED["beta"], phi: float = HW_FIXED["phi"],
                       gamma: float = HW_FIXED["gamma"]) -> DataFrame:
    """F4 with given smoothing parameters: fitted and forecast month values.

    Each series' months (bounded by the calendar) become one sorted array; the
    damped additive recursion is a left fold (``aggregate``) over it, with the
    season kept as an array in the fold state. From 24 months on the 12-month
    season is used. Rows: series_id, month, value (rounded to cents), is_future.
    """
    a, b, p, g = (repr(float(v)) + "D" for v in (alpha, beta, phi, gamma))
    folded = _hw_fold(_month_arrays(daily).join(_forecast_steps(daily, horizon), "series_id"), a, b, p, g)
    return _hw_month_rows(folded, p).drop("resid_sd") \
        .withColumn("value", even_round("value", 2))


def _hw_grid_months(daily: DataFrame, horizon: int) -> DataFrame:
    """F4 parameter search: every series' months (bounded by the calendar) meet
    every alpha in a row of its own, and the rows are spread over all tasks, so
    neither one series nor many wait on one task; the other parameters are
    tried side by side within the row."""
    finite = F.forall("ys", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    arr = _month_arrays(daily).filter((F.size("ys") >= 2) & finite)
    rows = arr.select("series_id", "ys", "seasonal", F.explode(F.array(*map(F.lit, _HW_ALPHA))).alias("alpha")) \
        .repartition("series_id", "alpha")
    search = F.pandas_udf(_hw_search, "sse double, a double, b double, p double, g double")
    best = rows.select("series_id", search("ys", "seasonal", "alpha").alias("x")).groupBy("series_id") \
        .agg(F.min_by("x", "x").alias("prm"))
    final = _hw_fold(arr.join(best, "series_id").join(_forecast_steps(daily, horizon), "series_id"),
                     "prm.a", "prm.b", "prm.p", "prm.g")
    return _hw_month_rows(final, "prm.p")


# ---- F5: seasonal model ---------------------------------------------------

# Design columns: for the trend 1, t and hinges max(0, t - c); for the season
# sine and cosine of the yearly and weekly multiples.
_HINGES = [SEASONAL_CHANGEPOINT_RANGE * j / SEASONAL_CHANGEPOINTS for j in range(1, SEASONAL_CHANGEPOINTS + 1)]
_TREND_SUMS = ("n", "t", "tt", "v", "tv", "vv")
_SOLVED = "coef array<double>, reason string"


def _trend_columns(t: Column) -> list[Column]:
    return [F.lit(1.0), t, *[F.greatest(t - c, F.lit(0.0)) for c in _HINGES]]


def _season_columns(day: Column) -> list[Column]:
    angles = [2 * np.pi * k / period for period, order in ((365.25, SEASONAL_YEARLY_ORDER), (7.0, SEASONAL_WEEKLY_ORDER))
              for k in range(1, order + 1)]
    return [fn(day * a) for a in angles for fn in (F.sin, F.cos)]


def _times(columns: list[Column], coef: str) -> Column:
    """Design columns times the coefficients in the array column ``coef``."""
    return sum((c * F.col(coef)[i] for i, c in enumerate(columns)), F.lit(0.0))


def _solve(gram: np.ndarray, right: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(gram + np.diag(penalty), right)


def _or_reason(solve, *rows) -> tuple:
    """(coefficients, None), or why there are none: any failed fit falls back."""
    try:
        coef = solve(*rows)
        if np.isfinite(coef).all():
            return coef.tolist(), None
        return None, "fit is not finite"
    except Exception as exc:
        return None, f"{type(exc).__name__}: {exc}"[:300]


def _trend_coefficients(segments) -> np.ndarray:
    """Ridge trend from a series' sums between changepoints.

    A product of two hinges is a sum over the days after the later one of a
    quadratic in t, so sums of 1, t, t^2, v, t v per segment give the whole
    Gram matrix. The penalty is noise variance / prior variance (a Gaussian
    stand-in for the changepoint prior), the noise taken from a nearly
    unpenalised fit.
    """
    sums = np.zeros((len(_HINGES) + 1, len(_TREND_SUMS)))
    for row in segments:
        sums[int(row["seg"])] = [row[c] for c in _TREND_SUMS]
    if not np.isfinite(sums).all():
        raise ValueError("revenue is not finite")
    after = np.cumsum(sums[::-1], axis=0)[::-1]  # sums from a segment on
    # Columns as p + q t from a segment on: 1, t, then t - c of each hinge.
    p = np.array([1.0, 0.0, *[-c for c in _HINGES]])
    q = np.array([0.0, 1.0, *[1.0] * len(_HINGES)])
    begin = np.array([0, 0, *range(1, len(_HINGES) + 1)])
    n, t, tt, v, tv, vv = after[np.maximum.outer(begin, begin)].transpose(2, 0, 1)
    gram = np.outer(p, p) * n + (np.outer(p, q) + np.outer(q, p)) * t + np.outer(q, q) * tt
    right = p * after[begin, 3] + q * after[begin, 4]
    free = _solve(gram, right, np.r_[0.0, 0.0, np.full(len(_HINGES), 1e-6)])
    days, total, squares = after[0, 0], after[0, 3], after[0, 5]
    rest = squares - 2 * free @ right + free @ gram @ free
    noise = max((rest - (total - free @ gram[0]) ** 2 / days) / days, 0.0)
    return _solve(gram, right, np.r_[0.0, 0.0, np.full(len(_HINGES), max(noise, 1e-12) / SEASONAL_FLEXIBILITY ** 2)])


def _season_coefficients(rows) -> np.ndarray:
    """Ridge season from a series' products of (1, season columns, rel)."""
    m = np.zeros((len(rows), len(rows)))
    for row in rows:
        m[int(row["i"])] = row["sums"]
    if not np.isfinite(m).all():
        raise ValueError("fit is not finite")
    days = m[0, 0]
    variance = max(m[-1, -1] / days - (m[0, -1] / days) ** 2, 0.0) if days else 0.0
    inner = slice(1, len(rows) - 1)
    return _solve(m[inner, inner], m[inner, -1], np.full(len(rows) - 2, max(variance, 1e-12) / 100.0))


def _solver(solve):
    """A column function: one small solve per series from its grouped sums."""
    def run(sums: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_or_reason(solve, rows) for rows in sums], columns=["coef", "reason"])
    return F.pandas_udf(run, _SOLVED)


def seasonal(daily: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """trend times (1 + yearly + weekly seasonality), history plus ``horizon`` days.

    A series that cannot be fitted returns no rows (the cascade then falls back).
    """
    return _seasonal_fits(daily, horizon).where("ds is not null")


def _seasonal_fits(daily: DataFrame, horizon: int) -> DataFrame:
    """F5 with one row more, without a day, for each series that failed.

    Two passes of grouped sums over the days, which combine on the map side:
    (series, segment between changepoints) for the trend, (series, design
    column) for the season. What is solved per series is a matrix of fixed
    size; no task needs a series' days together.
    """
    daily = _named(daily).select("series_id", "ds", F.col("y").cast("double").alias("y"))
    span = daily.groupBy("series_id").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.greatest(F.datediff(F.max("ds"), F.min("ds")), F.lit(1)).cast("double").alias("span"),
        F.greatest(F.max(F.abs("y")), F.lit(1.0)).alias("scale"))
    day = F.datediff("ds", "first_ds").cast("double")
    points = daily.join(span, "series_id").withColumn("day", day).withColumn("t", F.col("day") / F.col("span"))

    v, t = F.col("y") / F.col("scale"), F.col("t")
    segment = sum(((t > c).cast("int") for c in _HINGES), F.lit(0))
    # A missing value makes the sums NaN, as one that is not finite does.
    v = F.coalesce(v, F.lit(float("nan")))
    sums = dict(zip(_TREND_SUMS, (F.lit(1.0), t, t * t, v, t * v, v * v)))
    by_segment = points.groupBy("series_id", segment.alias("seg")).agg(*[F.sum(x).alias(c) for c, x in sums.items()])
    trend = by_segment.groupBy("series_id").agg(F.collect_list(F.struct("seg", *_TREND_SUMS)).alias("sums")) \
        .select("series_id", _solver(_trend_coefficients)("sums").alias("trend"))
    points = points.join(trend.select("series_id", F.col("trend.coef").alias("tc")).where("tc IS NOT NULL"),
                         "series_id")

    level = _times(_trend_columns(t), "tc") * F.col("scale")
    z = [F.lit(1.0), *_season_columns(F.col("day")), F.col("rel")]
    usable = points.withColumn("level", level).withColumn("rel", F.col("y") / F.col("level") - 1) \
        .where(F.abs("level") > 1e-9)
    names = [f"z{i}" for i in range(len(z))]
    products = usable.select("series_id", *[c.alias(n) for n, c in zip(names, z)]) \
        .select("*", F.posexplode(F.array(*names)).alias("i", "x")) \
        .groupBy("series_id", "i").agg(*[F.sum(F.col("x") * F.col(n)).alias(n) for n in names]) \
        .select("series_id", "i", F.array(*names).alias("sums"))
    season = products.groupBy("series_id").agg(F.collect_list(F.struct("i", "sums")).alias("rows")) \
        .select("series_id", _solver(_season_coefficients)("rows").alias("season"))

    fits = span.join(trend, "series_id").join(season, "series_id", "left").select(
        "series_id", "first_ds", "last_ds", "span", "scale", F.col("trend.coef").alias("tc"),
        F.col("season.coef").alias("sc"),
        F.coalesce("trend.reason", "season.reason", F.lit("the trend is zero throughout")).alias("reason"))
    days = F.datediff("ds", "first_ds").cast("double")
    yhat = _times(_trend_columns(days / F.col("span")), "tc") * F.col("scale") \
        * (1.0 + _times(_season_columns(days), "sc"))
    good = fits.where("tc IS NOT NULL AND sc IS NOT NULL")
    history = daily.join(good, "series_id").select("series_id", "ds", "y", yhat.alias("yhat"))
    spread = history.groupBy("series_id").agg(F.stddev_pop(F.col("y") - F.col("yhat")).alias("sd"))
    future = good.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")) \
        .withColumn("ds", F.date_add("last_ds", F.col("h"))) \
        .select("series_id", "ds", yhat.alias("yhat"), F.sqrt(1.0 + F.col("h") / 30.0).alias("widen"))
    band = SEASONAL_BAND_Z * F.col("sd") * F.col("widen")
    out = history.select("series_id", "ds", "yhat", F.lit(1.0).alias("widen")).unionByName(future) \
        .join(spread, "series_id")
    failed = fits.where("tc IS NULL OR sc IS NULL").select(
        "series_id", F.lit(None).cast("date").alias("ds"), *[F.lit(None).cast("double").alias(c) for c in
                                                          ("yhat", "yhat_lower", "yhat_upper")],
        F.col("reason").alias("model"))
    return out.select("series_id", "ds", "yhat", (F.col("yhat") - band).alias("yhat_lower"),
                      (F.col("yhat") + band).alias("yhat_upper"), F.lit("seasonal").alias("model")).unionByName(failed)


# ---- F6: cascade ----------------------------------------------------------

def forecast(daily: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """per series the seasonal model, else Holt-Winters, else the line.

    Each fallback runs only on the series the previous model left without
    rows; ``fallback_reason`` says why a series fell back. Results of a stage
    are checkpointed so the later stages do not fit the earlier model again.
    """
    daily = with_min_history(daily).checkpoint(eager=True)  # one row per series and day, read by every pass
    fits = _seasonal_fits(daily, horizon).checkpoint(eager=True)
    failed = fits.where("ds is null").select("series_id", F.concat(F.lit("seasonal: "), "model").alias("why"))
    rest = daily.join(failed.select("series_id"), "series_id", "left_semi")
    second = holt_winters(rest, horizon).checkpoint(eager=True)
    rest2 = rest.join(second.select("series_id").distinct(), "series_id", "left_anti")
    third = linear_trend(rest2, horizon)

    def because(df: DataFrame, more: str) -> DataFrame:
        return df.join(failed, "series_id").withColumn("fallback_reason", F.concat("why", F.lit(more))).drop("why")

    return (fits.where("ds is not null").withColumn("fallback_reason", F.lit(None).cast("string"))
            .unionByName(because(second, ""))
            .unionByName(because(third, "; holt_winters: fewer than two months, or revenue is not finite")))


# ---- F7, F8, F9: publishing ------------------------------------------------

def publishable(forecast_df: DataFrame, daily: DataFrame) -> DataFrame:
    """F8: values rounded half-even to cents, ``is_forecast`` after the last actual day."""
    last = daily.groupBy("series_id").agg(F.max("ds").alias("_last"))
    out = forecast_df.join(last, "series_id").withColumn("is_forecast", F.col("ds") > F.col("_last"))
    return out.select("series_id", "ds", *[even_round(c, 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
                      "model", "is_forecast", *[c for c in forecast_df.columns if c == "fallback_reason"])


def monthly_rollup(forecast_df: DataFrame) -> DataFrame:
    """forecast and bounds summed per month (unrounded days), rounded half-even."""
    g = forecast_df.groupBy("series_id", F.trunc("ds", "month").alias("month")).agg(
        F.sum("yhat").alias("r"), F.sum("yhat_lower").alias("lo"), F.sum("yhat_upper").alias("hi"))
    return g.select("series_id", "month", even_round("r", 2).alias("forecast_revenue"),
                    even_round("lo", 2).alias("forecast_lower"), even_round("hi", 2).alias("forecast_upper"))


def summary(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """per series last month's revenue, next month's forecast and range, growth.

    The last month is the month of the last actual day (``is_partial`` when
    that day is not the month's end); the next month is the first month that
    starts after the last actual day.
    """
    last = daily.groupBy("series_id").agg(F.max("ds").alias("last_ds"))
    last = last.withColumn("last_month", F.trunc("last_ds", "month"))
    actual = daily.withColumn("month", F.trunc("ds", "month")).join(last, "series_id") \
        .filter(F.col("month") == F.col("last_month")) \
        .groupBy("series_id").agg(F.sum("y").alias("last_rev"))
    nxt = monthly.join(last, "series_id").filter(F.col("month") > F.col("last_ds")) \
        .groupBy("series_id").agg(F.min_by(F.struct("month", "forecast_revenue", "forecast_lower",
                                                      "forecast_upper"), F.col("month")).alias("n"))
    lr = F.col("last_rev").cast("double")
    growth = F.when(lr == 0, F.lit(0.0)).otherwise(F.lit(100.0) * (F.col("n.forecast_revenue") - lr) / lr)
    return last.join(actual, "series_id").join(nxt, "series_id").select(
        "series_id", "last_ds", "last_month",
        sql_round(F.col("last_rev"), 2).alias("last_month_revenue"),
        (F.col("last_ds") < F.last_day("last_month")).alias("is_partial"),
        F.col("n.month").alias("next_month"),
        F.col("n.forecast_revenue").alias("next_month_forecast"),
        F.col("n.forecast_lower").alias("next_month_lower"),
        F.col("n.forecast_upper").alias("next_month_upper"),
        sql_round(growth, 1).alias("mom_growth_pct"))
