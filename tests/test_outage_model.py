"""Poisson fit against IRLS in numpy; scoring by table equals scoring by model."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest

from meterstone.plans import outage_model as om
from meterstone.settings import Settings
from meterstone.sources.forecast_json import parse_forecast

CFG = Settings(window_start=date(2024, 1, 1), window_end=date(2024, 12, 31), backtest_start=date(2024, 10, 1))
GRID = ("date date, division string, customers_served bigint, max_gust_mph double, precip_in double, cdd double, hdd double, month int, "
        "is_major_event_day boolean, events bigint, customers_out bigint, customer_minutes bigint, band string")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    out = []
    for i in range(366):
        day = date(2024, 1, 1) + timedelta(days=i)
        gust, rain = float(rng.uniform(5, 70)), float(rng.exponential(0.2))
        temp = 55 + 25 * np.sin((i - 100) / 58) + rng.normal(0, 5)
        cdd, hdd = max(temp - 65, 0.0), max(65 - temp, 0.0)
        for division, served in (("N", 80_000), ("S", 150_000)):
            mu = np.exp(0.3 + 0.01 * gust + 0.02 * max(gust - 35, 0) + 0.1 * rain + 0.01 * cdd + np.log(served / 1e5))
            n = int(rng.poisson(mu))
            band = next((b[2] for b in CFG.wind_bands if b[0] <= gust < b[1]), None)
            out.append((day, division, served, gust, rain, float(cdd), float(hdd), day.month, gust > 68, n, n * 40, n * 3000, band))
    return out


def irls(rows):
    x, y, off = [], [], []
    for _, _, served, g, rain, cdd, hdd, month, _, n, *_ in rows:
        x.append([1, g, max(g - 35, 0), max(g - 50, 0), rain, cdd, hdd, float(month in (6, 7, 8))])
        y.append(n)
        off.append(np.log(served / 1e5))
    x, y, off = map(np.array, (x, y, off))
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        eta = x @ beta + off
        mu = np.exp(eta)
        z = eta - off + (y - mu) / mu
        w = x * mu[:, None]
        beta = np.linalg.solve(x.T @ w, w.T @ z)
    mu = np.exp(x @ beta + off)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ (x * mu[:, None]))))
    return beta, se


def test_fit_matches_irls(spark, rows):
    grid = spark.createDataFrame(rows, GRID)
    fit = om.fit(spark, grid)
    beta, se = irls(rows)
    got = fit.coefficients.collect()
    assert [r.term for r in got] == ["intercept", *om.FEATURES]
    np.testing.assert_allclose([r.coefficient for r in got], beta, atol=1e-6)
    np.testing.assert_allclose([r.std_error for r in got], se, atol=1e-6)
    assert fit.deviance < fit.null_deviance
    # the fitted counts of a Poisson model with intercept add up to the actual ones
    assert om.predict(grid, fit.coefficients, "p").agg({"p": "sum"}).first()[0] == pytest.approx(sum(r[9] for r in rows), rel=1e-6)


def test_backtest_tables(spark, rows):
    grid = spark.createDataFrame(rows, GRID)
    bands = om.band_statistics(grid, CFG)
    early, late = om.split_by_day(grid, CFG)
    assert early.count() + late.count() == len(rows) and late.agg({"date": "min"}).first()[0] == CFG.backtest_start
    scored = om.backtest(late, om.fit(spark, early).coefficients, bands)
    table = {r.metric: r.value for r in om.backtest_metrics(scored, grid, om.fit(spark, grid), CFG).collect()}
    assert len(table) == 10 and table["Held-out period"] == "Oct 2024 - Dec 2024" and table["Division-days scored"] == "184"
    pd = scored.toPandas()
    assert float(table["Mean absolute error (outages per division-day)"]) == pytest.approx(
        (pd.events - pd.predicted_events).abs().mean(), abs=0.006)
    daily = pd.groupby("date")[["events", "predicted_events"]].sum()
    assert float(table["Correlation, daily totals (actual vs predicted)"]) == pytest.approx(
        daily.events.corr(daily.predicted_events), abs=0.0006)
    big, flagged = pd.events >= pd.events.quantile(0.95), pd.risk_ratio >= 3
    assert float(table["Worst 5% division-days flagged High/Severe"]) == pytest.approx((big & flagged).sum() / big.sum(), abs=0.0006)


def test_empty_band_inherits(spark, rows):
    calm = [r for r in rows if r[3] < 55]
    got = {r.band: r for r in om.band_statistics(spark.createDataFrame(calm, GRID), CFG).collect()}
    assert len(got) == 5 and got["55+ mph"].division_days == 0 and got["55+ mph"].outages_per_100k is None
    assert got["55+ mph"].customers_per_event == got["45-55 mph"].customers_per_event == 40.0
    assert got["55+ mph"].minutes_per_event == 75.0


def test_constant_term_still_fits(spark, rows):
    flat = [(*r[:5], 0.0, *r[6:]) for r in rows]
    coefficients = om.fit(spark, spark.createDataFrame(flat, GRID)).coefficients.collect()
    assert len(coefficients) == 8


def test_forecast_payload(spark):
    payload = ('[{"daily": {"time": ["2024-07-01", "2024-07-02"], "wind_gusts_10m_max": [20, 60.5], "wind_speed_10m_max": [9, 8], '
               '"precipitation_sum": [null, 0.4], "temperature_2m_max": [90, 60], "temperature_2m_min": [70, 50]}}, '
               '{"daily": {"time": ["2024-07-01"], "wind_gusts_10m_max": [1], "wind_speed_10m_max": [1], '
               '"precipitation_sum": [0], "temperature_2m_max": [65], "temperature_2m_min": [65]}}]')
    divisions = spark.createDataFrame([("South",), ("North",)], "division string")
    rows = parse_forecast(spark.createDataFrame([(payload,)], "payload string"), divisions, datetime(2024, 7, 1)).collect()
    got = sorted((r.division, str(r.forecast_date), r.max_gust_mph, r.precip_in, r.cdd, r.hdd) for r in rows)
    assert got == [("North", "2024-07-01", 20.0, 0.0, 15.0, 0.0), ("North", "2024-07-02", 60.5, 0.4, 0.0, 10.0),
                   ("South", "2024-07-01", 1.0, 0.0, 0.0, 0.0)]
