"""Check SQL for the fitted outage model: the same regression as reweighted least squares in recursive SQL.

A step sums the eight normal equations over the grid and solves them by eliminating one term after another; the recursion
ends after a fixed number of steps, far beyond convergence. Numbers here are written out, not taken from the engine.
"""

from __future__ import annotations

from driver_tables.metric_checks import placed
from driver_tables.model_checks import fitted, fitted_forecast, fitted_tables, forecast_model
from driver_tables.oracle import BLOCKS
from driver_tables.queries import SQL, register
from meterstone.plans import outage_model as om
from meterstone.plans.metrics import column_name
from meterstone.plans.visuals import run_cards, run_visual
from meterstone.session import scratch_path

K = 8
_TERMS = ("intercept", "max_gust_mph", "gust_over_35", "gust_over_50", "precip_in", "cdd", "hdd", "summer")


def _x(g: str, rain: str, c: str, h: str, s: str) -> str:
    return f"[1::double, {g}, greatest({g} - 35, 0), greatest({g} - 50, 0), {rain}, {c}, {h}, {s}]"


def _dot(b: str, x: str) -> str:
    return "(" + " + ".join(f"{b}[{i}] * ({x})[{i}]" for i in range(1, K + 1)) + ")"


def _eliminated(source: str, keep: str) -> str:
    """``source`` has a matrix m; the left square becomes the unit matrix."""
    for p in range(1, K + 1):
        step = (f"list_transform(m, lambda row, i: CASE WHEN i = {p} THEN list_transform(row, lambda v: v / m[{p}][{p}]) "
                f"ELSE list_transform(row, lambda v, j: v - row[{p}] * m[{p}][j] / m[{p}][{p}]) END)")
        source = f"SELECT {keep}{step} AS m FROM ({source})"
    return source


def _equations(right: str) -> str:
    """Rows of the weighted normal equations; ``right`` gives what stands on the right of row i."""
    rows = []
    for i in range(1, K + 1):
        rows.append("[" + ", ".join([f"sum(mu * x[{i}] * x[{j}])" for j in range(1, K + 1)]) + ", " + right.replace("#", str(i)) + "]")
    return "[" + ", ".join(rows) + "]"


def _fit(rows: str) -> str:
    told = f"SELECT k, x, y, {_dot('b', 'x')} AS eta, exp({_dot('b', 'x')} + o) AS mu FROM steps, {rows} WHERE k < 14"
    matrix = f"SELECT k, {_equations('sum((mu * eta + y - mu) * x[#])')} AS m FROM ({told}) GROUP BY k"
    return f"""
        SELECT b FROM (WITH RECURSIVE steps(k, b) AS (
          SELECT 0, [ln(sum(y) / sum(exp(o))), 0, 0, 0, 0, 0, 0, 0]::double[] FROM {rows}
          UNION ALL
          SELECT k + 1, list_transform(m, lambda row: row[9]) FROM ({_eliminated(matrix, 'k, ')}))
        SELECT b FROM steps ORDER BY k DESC LIMIT 1)"""


_INVERSE = "[" + ", ".join(
    "[" + ", ".join([f"sum(mu * x[{i}] * x[{j}])" for j in range(1, K + 1)] + ["1::double" if i == j else "0::double" for j in range(1, K + 1)]) + "]"
    for i in range(1, K + 1)) + "]"
# 1 - erf(t) by the series of positive terms; beyond 8 it is 0 to all digits kept
_TAIL = ("CASE WHEN t > 8 THEN 0 WHEN t = 0 THEN 1 ELSE 1 - exp(-t * t) * list_sum(list_transform(range(0, 240), "
         "lambda n: exp((2 * n + 1) * ln(t) - lgamma(n + 1.5)))) END")
_RATE = lambda b, x, o: f"exp({_dot(b, x)} + {o})"
_EXPOSURE = "ln(customers_served / 100000.0)"
_DEVIANCE = "sum(2 * (if(y > 0, y * ln(y / mu), 0) - (y - mu)))"

BLOCKS |= {
    "m_rows": f"""
        SELECT date, events::double AS y, {_EXPOSURE} AS o, {_x('max_gust_mph', 'precip_in', 'cdd', 'hdd', 'if(month IN (6, 7, 8), 1, 0)')}::double[] AS x
        FROM m_grid WHERE max_gust_mph IS NOT NULL AND precip_in IS NOT NULL AND cdd IS NOT NULL AND hdd IS NOT NULL""",
    "m_rows_early": "SELECT * FROM m_rows WHERE date < date '2001-02-01'",
    "m_fit_full": _fit("m_rows"),
    "m_fit_early": _fit("m_rows_early"),
    "m_spread": f"""
        SELECT list_transform(m, lambda row, i: sqrt(row[8 + i])) AS se
        FROM ({_eliminated(f"SELECT {_INVERSE} AS m FROM (SELECT x, {_RATE('b', 'x', 'o')} AS mu FROM m_rows, m_fit_full)", '')})""",
    "m_coefficients": f"""
        SELECT term, coefficient, std_error, {_TAIL} AS p_value
        FROM (SELECT *, abs(coefficient / std_error) / sqrt(2) AS t FROM (
          SELECT unnest([{', '.join(f"'{t}'" for t in _TERMS)}]) AS term, unnest(b) AS coefficient, unnest(se) AS std_error FROM m_fit_full, m_spread))""",
    "m_backtest": f"""
        SELECT g.*, {_RATE('b', 'x', _EXPOSURE)} AS predicted_events, {_RATE('b', 'calm', _EXPOSURE)} AS baseline, customers_per_event
        FROM (SELECT *, {_x('max_gust_mph', 'precip_in', 'cdd', 'hdd', 'if(month IN (6, 7, 8), 1, 0)')}::double[] AS x,
                     {_x('20', '0', 'cdd', 'hdd', 'if(month IN (6, 7, 8), 1, 0)')}::double[] AS calm
              FROM m_grid WHERE date >= date '2001-02-01' AND max_gust_mph IS NOT NULL AND precip_in IS NOT NULL AND cdd IS NOT NULL AND hdd IS NOT NULL) g
        CROSS JOIN m_fit_early LEFT JOIN (SELECT band, customers_per_event FROM m_bands) USING (band)""",
    "m_backtest_table": """
        SELECT date, division, events AS actual_outages, round(predicted_events, 3) AS predicted_outages, customers_out AS actual_customers_out,
               round(predicted_events * customers_per_event, 3) AS predicted_customers_out, round(max_gust_mph, 3) AS max_gust_mph,
               round(precip_in, 3) AS precip_in, round(predicted_events / baseline, 3) AS risk_ratio FROM m_backtest""",
    "m_backtest_facts": f"""
        SELECT strftime(date '2001-02-01', '%b %Y') || ' - ' || strftime(max(date), '%b %Y') AS period, count(*) AS n,
               avg(abs(events - predicted_events)) AS mae, avg(events) AS mean,
               count(*) FILTER (predicted_events / baseline >= 3 AND events >= p95) AS hits, count(*) FILTER (events >= p95) AS big,
               count(*) FILTER (predicted_events / baseline >= 3) AS flagged, count(DISTINCT date) FILTER (is_major_event_day) AS med,
               (SELECT corr(a, p) FROM (SELECT sum(events) AS a, sum(predicted_events) AS p FROM m_backtest GROUP BY date)) AS link,
               (SELECT count(DISTINCT date) FROM m_grid) AS days,
               (SELECT 1 - {_DEVIANCE} / any_value(null_deviance) FROM (
                  SELECT y, {_RATE('b', 'x', 'o')} AS mu, (SELECT {_DEVIANCE} FROM (SELECT y, exp(o) * (SELECT sum(y) / sum(exp(o)) FROM m_rows) AS mu FROM m_rows)) AS null_deviance
                  FROM m_rows, m_fit_full)) AS explained
        FROM m_backtest, (SELECT quantile_cont(events::double, 0.95) AS p95 FROM m_backtest)""",
    "m_metrics": """
        SELECT unnest(['Held-out period', 'Division-days scored', 'Mean absolute error (outages per division-day)', 'Mean actual outages per division-day',
                       'Correlation, daily totals (actual vs predicted)', 'Worst 5% division-days flagged High/Severe', 'High/Severe flags that were real bad days',
                       'Major event days in held-out period', 'Deviance explained (pseudo R-squared)', 'Training days']) AS metric,
               unnest([period, n::varchar, round(mae, 2)::varchar, round(mean, 2)::varchar, round(link, 3)::varchar, round(hits / big, 3)::varchar,
                       round(hits / greatest(flagged, 1), 3)::varchar, med::varchar, round(explained, 3)::varchar, days::varchar]) AS value,
               unnest(range(1, 11))::int AS metric_order FROM m_backtest_facts""",
    "m_divisions_fitted": f"""
        SELECT c.*, {_RATE('b', _x('20', '0', '0', '5', '0'), _EXPOSURE)} AS baseline_outages FROM m_centers c, m_fit_full""",
    "m_scored_fitted": f"""
        SELECT f.* EXCLUDE (g, x), risk_order, risk_level, wind_band, predicted_outages * customers_per_event AS predicted_customers_out,
               predicted_outages * customers_per_event * minutes_per_event AS predicted_customer_minutes,
               (forecast_date - (SELECT min(forecast_date) FROM m_forecast))::int AS days_ahead
        FROM (SELECT *, predicted_outages / baseline_outages AS risk_ratio
              FROM (SELECT w.*, customers_served, baseline_outages, {_RATE('b', 'x', _EXPOSURE)} AS predicted_outages
                    FROM (SELECT *, coalesce(max_gust_mph, 0) AS g,
                                 {_x('coalesce(max_gust_mph, 0)', 'precip_in', 'cdd', 'hdd', 'if(month(forecast_date) IN (6, 7, 8), 1, 0)')}::double[] AS x FROM m_forecast) w
                    LEFT JOIN m_divisions_fitted USING (division) CROSS JOIN m_fit_full) y) f
        LEFT JOIN m_risks_list ON risk_ratio >= ratio_min AND risk_ratio < ratio_max
        LEFT JOIN (SELECT band AS wind_band, gust_min, gust_max, customers_per_event, minutes_per_event FROM m_bands) b ON g >= b.gust_min AND g < b.gust_max""",
}

register("outage_model_coefficients", lambda w: fitted(w).coefficients, "SELECT * FROM m_coefficients", "coefficient std_error p_value")
register("outage_model_backtest", lambda w: fitted(w).backtest, "SELECT * FROM m_backtest_table",
         "predicted_outages predicted_customers_out max_gust_mph precip_in risk_ratio")
register("outage_model_metrics", lambda w: fitted(w).metrics, "SELECT * FROM m_metrics")
register("visual_v16", lambda w: run_visual(fitted_tables(w), "v16"),
         f"""SELECT date, sum(actual_outages)::bigint AS {column_name('Backtest Actual Outages')}, sum(predicted_outages) AS {column_name('Backtest Predicted Outages')}
             FROM m_backtest_table GROUP BY date""", column_name("Backtest Predicted Outages"))
register("visual_v18", lambda w: run_visual(fitted_tables(w), "v18"), "SELECT metric, value FROM m_metrics")
register("metrics_backtest", lambda w: run_cards(fitted_tables(w), ["Backtest Actual Outages", "Backtest Predicted Outages"], by=["Division.division"]),
         f"""SELECT division, sum(actual_outages)::bigint AS {column_name('Backtest Actual Outages')}, sum(predicted_outages) AS {column_name('Backtest Predicted Outages')}
             FROM m_backtest_table GROUP BY division""", column_name("Backtest Predicted Outages"))
# the visuals of the forecast page in their display order
placed("v14", "forecast_date", forecast_model,
       "SELECT forecast_date, sum(predicted_outages) AS forecast_outages, max(max_gust_mph) AS max_gust_mph FROM m_scored GROUP BY ALL", "forecast_outages max_gust_mph")
placed("v15", "forecast_date, division, max_gust_mph, precip_in, predicted_outages, risk_level", forecast_model,
       "SELECT forecast_date, division, max_gust_mph, precip_in, predicted_outages, risk_level FROM m_scored", "max_gust_mph precip_in predicted_outages")
placed("v16", "date", fitted_tables,
       "SELECT date, sum(actual_outages)::bigint AS backtest_actual_outages, sum(predicted_outages) AS backtest_predicted_outages FROM m_backtest_table GROUP BY date",
       "backtest_predicted_outages")
placed("v17", "(SELECT band_order FROM m_bands_list l WHERE l.band = q.band), band", fitted_tables,
       "SELECT band, outages_per_100k AS historical_outages_per_100k FROM m_bands WHERE outages_per_100k IS NOT NULL", "historical_outages_per_100k")
placed("v18", "metric_order", fitted_tables, "SELECT metric, value, metric_order FROM m_metrics", "")
SQL["visual_v18_placed"] = SQL["visual_v18_placed"].replace("SELECT *, row_number()", "SELECT metric, value, row_number()")
register("forecast_scored_fitted", fitted_forecast, "SELECT * FROM m_scored_fitted",
         "predicted_outages baseline_outages risk_ratio predicted_customers_out predicted_customer_minutes max_gust_mph max_wind_mph precip_in temp_max_f temp_min_f temp_avg_f cdd hdd")
register("outage_model_published", lambda w: om.publish_model(w.spark, fitted(w), scratch_path(w.spark, "model")).select("dataset", "rows", "columns"),
         """SELECT 'outage_model_coefficients' AS dataset, 8::bigint AS rows, 4::int AS columns
            UNION ALL SELECT 'outage_model_bands', count(*), 9 FROM m_bands UNION ALL SELECT 'outage_model_divisions', count(*), 5 FROM m_centers
            UNION ALL SELECT 'outage_model_backtest', count(*), 9 FROM m_backtest_table UNION ALL SELECT 'outage_model_metrics', 10, 3
            UNION ALL SELECT 'outage_model_risk_levels', 4, 4""")
