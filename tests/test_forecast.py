"""Forecast models on series with known shape."""

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopscope.plans import forecast as FC


def daily_frame(spark, values, start=dt.date(2018, 1, 1), series="s"):
    data = [(series, start + dt.timedelta(days=i), Decimal(str(round(v, 2)))) for i, v in enumerate(values)
            if v is not None]
    return spark.createDataFrame(data, "series_id string, ds date, y decimal(18,2)")


def test_linear_recovers_line_and_horizon(spark):
    daily = daily_frame(spark, [1000 + 10 * t for t in range(60)])
    fc = FC.linear_trend(daily).collect()
    assert len(fc) == 60 + FC.HORIZON_DAYS
    by_day = {r["ds"]: r for r in fc}
    assert len(by_day) == len(fc)
    last = by_day[dt.date(2018, 1, 1) + dt.timedelta(days=59 + 90)]
    assert last["yhat"] == pytest.approx(1000 + 10 * 149)
    assert last["yhat_lower"] == pytest.approx(0.85 * last["yhat"])
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in fc)


def test_linear_clips_falling_future_at_zero(spark):
    daily = daily_frame(spark, [500 - 10 * t for t in range(40)])
    fut = [r for r in FC.linear_trend(daily).collect() if r["ds"] > dt.date(2018, 2, 9)]
    assert len(fut) == 90 and min(r["yhat"] for r in fut) == 0.0 and min(r["yhat_lower"] for r in fut) == 0.0


def test_gap_days_and_min_history(spark):
    values = [100.0 if i % 2 == 0 else None for i in range(58)]  # 29 days with sales
    assert FC.with_min_history(daily_frame(spark, values)).count() == 0
    assert FC.with_min_history(daily_frame(spark, values + [100.0])).count() == 30


def _seasonal_month_series(months=36):
    out = []
    day = dt.date(2016, 1, 1)
    while len({(d.year, d.month) for d, _ in out}) < months or day.day != 1:
        if len({(d.year, d.month) for d, _ in out}) >= months and day.day == 1:
            break
        m = (day.year - 2016) * 12 + day.month - 1
        monthly = 30000 + 500 * m + 6000 * math.sin(2 * math.pi * (day.month - 1) / 12)
        out.append((day, monthly / 30))
        day += dt.timedelta(days=1)
    return out


def test_holt_winters_follows_trend_and_season(spark):
    pts = _seasonal_month_series(40)
    data = [("s", d, Decimal(str(round(v, 2)))) for d, v in pts]
    daily = spark.createDataFrame(data, "series_id string, ds date, y decimal(18,2)")
    fc = FC.holt_winters(daily).collect()
    days = [r["ds"] for r in fc]
    assert len(days) == len(set(days)) == len(pts) + FC.HORIZON_DAYS
    assert all(r["model"] == "holt_winters" for r in fc)
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in fc)
    last_day = pts[-1][0]
    future = [r for r in fc if r["ds"] > last_day]
    truth = {d: v for d, v in _seasonal_month_series(44)}
    err = [abs(r["yhat"] - truth[r["ds"]]) / truth[r["ds"]] for r in future if r["ds"] in truth]
    assert err and sum(err) / len(err) < 0.1


def test_seasonal_model_recovers_weekly_pattern(spark):
    values = [1000 + 2 * t + 300 * (1 if (t % 7) in (5, 6) else 0) for t in range(400)]
    daily = daily_frame(spark, values)
    fc = FC.seasonal(daily).collect()
    assert len(fc) == 400 + FC.HORIZON_DAYS
    hist = sorted((r["ds"], r["yhat"]) for r in fc)[:400]
    mape = sum(abs(y - v) / v for (_, y), v in zip(hist, values)) / 400
    assert mape < 0.05
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in fc)


def test_cascade_falls_back_per_series(spark):
    long_s = daily_frame(spark, [1000 + (t % 7) * 10 for t in range(120)], series="long")
    mid_s = daily_frame(spark, [500.0] * 40, series="mid")             # from 30 days on: seasonal
    odd_s = daily_frame(spark, [200.0] * 31, start=dt.date(2018, 3, 1), series="odd")
    daily = long_s.unionByName(mid_s).unionByName(odd_s).withColumn("y", F.col("y").cast("double"))
    # Revenue that is not finite: neither the seasonal nor the Holt-Winters fit works.
    daily = daily.withColumn("y", F.when((F.col("series_id") == "odd") & (F.dayofmonth("ds") == 9), float("inf"))
                             .otherwise(F.col("y")))
    fc = FC.forecast(daily)
    models = {r["series_id"]: (r["model"], r["fallback_reason"])
              for r in fc.select("series_id", "model", "fallback_reason").distinct().collect()}
    assert models["long"] == ("seasonal", None)
    assert models["mid"] == ("seasonal", None)
    assert models["odd"][0] == "linear_trend" and "revenue is not finite" in models["odd"][1]
    pub = FC.publishable(fc, daily)
    assert pub.groupBy("series_id", "ds").count().filter("count > 1").count() == 0
    assert pub.filter("is_forecast").groupBy("series_id").count().filter("count <> 90").count() == 0


def test_monthly_rollup_and_summary(spark):
    daily = daily_frame(spark, [100.0] * 45)  # Jan 1 .. Feb 14
    fc = FC.linear_trend(daily)
    monthly = FC.monthly_rollup(fc)
    jan = monthly.filter(F.col("month") == dt.date(2018, 1, 1)).first()
    assert jan["forecast_revenue"] == pytest.approx(3100.0)
    s = FC.summary(daily, monthly).first()
    assert s["last_month"] == dt.date(2018, 2, 1) and s["is_partial"] is True
    assert s["last_month_revenue"] == 1400.0
    assert s["next_month"] == dt.date(2018, 3, 1)
    assert s["mom_growth_pct"] == pytest.approx(round(100 * (3100 - 1400) / 1400, 1))


# -- Holt-Winters in numpy, one point after the other --

def hw_by_numpy(y: np.ndarray, alpha: float, beta: float, phi: float, gamma: float, season: int):
    """One pass of additive damped Holt-Winters; returns (sse, fitted, state, start)."""
    n = len(y)
    fitted = np.empty(n)
    if season:
        level = y[:season].mean()
        trend = (y[season:2 * season].mean() - level) / season
        seas = list(y[:season] - level)
        start = season
        fitted[:season] = level + np.array(seas)
    else:
        level, trend, seas, start = y[0], y[1] - y[0], [], 1
        fitted[0] = y[0]
    sse = 0.0
    for i in range(start, n):
        s_old = seas[i - season] if season else 0.0
        prev = level + phi * trend
        fitted[i] = prev + s_old
        err = y[i] - fitted[i]
        sse += err * err
        new_level = alpha * (y[i] - s_old) + (1 - alpha) * prev
        trend = beta * (new_level - level) + (1 - beta) * phi * trend
        if season:
            seas.append(gamma * (y[i] - prev) + (1 - gamma) * s_old)
        level = new_level
    return sse, fitted, (level, trend, seas), start


def hw_grid_by_numpy(y: np.ndarray):
    season = FC.HW_SEASON if len(y) >= FC.HW_MIN_SEASONAL_MONTHS else 0
    gammas = FC._HW_GAMMA if season else (0.0,)
    best = None
    for a in FC._HW_ALPHA:
        for b in FC._HW_BETA:
            for p in FC._HW_PHI:
                for g in gammas:
                    run = hw_by_numpy(y, a, b, p, g, season)
                    if best is None or run[0] < best[1][0]:
                        best = ((a, b, p, g), run)
    (_, _, phi, _), (_, fitted, (level, trend, seas), start) = best
    return phi, season, fitted, level, trend, seas, start


def test_grid_search_equals_one_point_after_the_other(spark):
    parts = []
    for name, months in (("long", 40), ("short", 11), ("two", 3)):
        pts = _seasonal_month_series(months)
        if name == "short":
            pts = [(d, v * (1.3 if d.month % 3 == 0 else 1)) for d, v in pts]
        parts += [(name, d, Decimal(str(round(v, 2)))) for d, v in pts]
    daily = spark.createDataFrame(parts, "series_id string, ds date, y decimal(18,2)")
    got = FC._hw_grid_months(daily, 90).where("NOT is_future").orderBy("month").collect()
    for name in ("long", "short", "two"):
        y = FC._held_out_months(daily).where(F.col("series_id") == name).orderBy("month").toPandas()["y"].to_numpy(float)
        _, _, fitted, *_ = hw_grid_by_numpy(y)
        assert [r["value"] for r in got if r["series_id"] == name] == pytest.approx(list(fitted), rel=1e-9)


def test_grid_rows_are_spread(spark):
    daily = daily_frame(spark, [100.0 + i % 9 for i in range(200)])
    plan = FC.holt_winters(daily)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "REPARTITION_BY_COL" in plan


def test_fixed_parameters_reach_past_a_gap(spark):
    daily = daily_frame(spark, [100.0] * 150, start=dt.date(2020, 1, 1)).unionByName(
        daily_frame(spark, [100.0], start=dt.date(2021, 2, 10)))
    got = FC.holt_winters_fixed(daily).agg(F.max("month")).first()[0]
    assert got == dt.date(2021, 5, 1)  # the month of the last day of the horizon


def test_holt_winters_fixed_matches_numpy_recursion(spark):
    pts = _seasonal_month_series(30)
    data = [("s", d, Decimal(str(round(v, 2)))) for d, v in pts]
    daily = spark.createDataFrame(data, "series_id string, ds date, y decimal(18,2)")
    got = [r["value"] for r in FC.holt_winters_fixed(daily).orderBy("month").collect() if True]
    months = FC._held_out_months(daily).orderBy("month").toPandas()["y"].to_numpy(float)
    _, fitted, _, _ = hw_by_numpy(months, 0.5, 0.1, 0.9, 0.2, 12)
    assert got[:len(months)] == pytest.approx([round(v, 2) for v in fitted], abs=0.011)


# -- the seasonal model in numpy, on a whole series --

def _ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    k = np.arange(1, order + 1)
    ang = 2 * np.pi * np.outer(days, k) / period
    return np.hstack([np.sin(ang), np.cos(ang)])


def seasonal_by_numpy(key, pdf):
    pdf = pdf.sort_values("ds")
    ds = pd.to_datetime(pdf["ds"])
    y = pdf["y"].to_numpy(dtype=float)
    horizon = int(pdf["horizon"].iloc[0])
    if not np.isfinite(y).all():
        raise ValueError("revenue is not finite")
    day0 = ds.iloc[0]
    t_days = (ds - day0).dt.days.to_numpy(dtype=float)
    span = max(t_days[-1], 1.0)
    future_ds = pd.date_range(ds.iloc[-1] + pd.Timedelta(days=1), periods=horizon, freq="D")
    all_days = np.concatenate([t_days, (future_ds - day0).days.to_numpy(dtype=float)])
    t_all = all_days / span
    scale = max(np.abs(y).max(), 1.0)
    cps = np.linspace(0, FC.SEASONAL_CHANGEPOINT_RANGE, FC.SEASONAL_CHANGEPOINTS + 1)[1:]

    def trend_design(t):
        return np.column_stack([np.ones_like(t), t] + [np.maximum(0.0, t - c) for c in cps])

    xt = trend_design(t_all)
    n = len(y)
    # Gaussian stand-in for the changepoint prior: penalty = noise variance /
    # prior variance, with the noise taken from a nearly unpenalised fit.
    free = np.r_[0.0, 0.0, np.full(len(cps), 1e-6)]
    noise = float(np.var(y / scale - xt[:n] @ _ridge(xt[:n], y / scale, free)))
    pen = np.r_[0.0, 0.0, np.full(len(cps), max(noise, 1e-12) / FC.SEASONAL_FLEXIBILITY ** 2)]
    beta_t = _ridge(xt[:n], y / scale, pen)
    trend = xt @ beta_t * scale
    safe = np.where(np.abs(trend[:n]) > 1e-9, trend[:n], np.nan)
    rel = y / safe - 1.0
    ok = np.isfinite(rel)
    xs = np.hstack([_fourier(all_days, 365.25, FC.SEASONAL_YEARLY_ORDER),
                    _fourier(all_days, 7.0, FC.SEASONAL_WEEKLY_ORDER)])
    beta_s = _ridge(xs[:n][ok], rel[ok], np.full(xs.shape[1], max(float(np.var(rel[ok])), 1e-12) / 100.0))
    yhat = trend * (1.0 + xs @ beta_s)
    sd = float(np.std(y - yhat[:n]))
    widen = np.r_[np.ones(n), np.sqrt(1.0 + np.arange(1, horizon + 1) / 30.0)]
    band = FC.SEASONAL_BAND_Z * sd * widen
    return pd.DataFrame({
        "series_id": key[0],
        "ds": list(ds.dt.date) + list(future_ds.date),
        "yhat": yhat, "yhat_lower": yhat - band, "yhat_upper": yhat + band,
        "model": "seasonal",
    })


def test_seasonal_sums_equal_the_numpy_fit(spark):
    rng = np.random.default_rng(5)

    def noisy(n, gap):
        return [None if gap and i % gap == 3 else 900 + 3 * i - (5 * max(0, i - n // 2)) + 200 * math.sin(i / 58)
                + 90 * ((i % 7) > 4) + float(rng.normal(0, 40)) for i in range(n)]

    series = {"a": noisy(760, 0), "b": noisy(400, 9), "c": noisy(35, 0), "d": [0.0] * 40}
    daily = None
    for name, values in series.items():
        part = daily_frame(spark, values, series=name)
        daily = part if daily is None else daily.unionByName(part)
    got = {(r["series_id"], r["ds"]): r for r in FC.seasonal(daily).collect()}
    pdf = daily.withColumn("y", F.col("y").cast("double")).withColumn("horizon", F.lit(90)).toPandas()
    want = pd.concat(seasonal_by_numpy((k,), p) for k, p in pdf[pdf["series_id"] != "d"].groupby("series_id"))
    assert len(got) == len(want)
    largest = {k: max(v for v in values if v is not None) for k, values in series.items()}
    for r in want.itertuples():
        row = got[r.series_id, r.ds]
        for c in ("yhat", "yhat_lower", "yhat_upper"):
            assert row[c] == pytest.approx(getattr(r, c), rel=1e-9, abs=1e-9 * largest[r.series_id])


def test_seasonal_fit_gathers_no_series(spark):
    daily = daily_frame(spark, [100.0 + i for i in range(60)])
    plan = FC.seasonal(daily)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" not in plan


def test_seasonal_reasons(spark):
    daily = daily_frame(spark, [10.0, None, 12.0, 9.0], series="ok").withColumn("y", F.col("y").cast("double"))
    one = daily.limit(1).withColumn("series_id", F.lit("one day"))
    null = daily.withColumn("series_id", F.lit("null")).withColumn("y", F.when(F.dayofmonth("ds") != 1, F.col("y")))
    zero = daily.withColumn("series_id", F.lit("zero")).withColumn("y", F.lit(0.0))
    fits = FC._seasonal_fits(daily.unionByName(one).unionByName(null).unionByName(zero), 3)
    reasons = {r["series_id"]: r["model"] for r in fits.where("ds IS NULL").collect()}
    assert reasons.keys() == {"one day", "null", "zero"}
    assert "Singular" in reasons["one day"] and "not finite" in reasons["null"] and "zero" in reasons["zero"]
    assert fits.where("series_id = 'ok' AND yhat IS NOT NULL").count() == 6
