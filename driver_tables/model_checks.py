"""Outage model and forecast queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from driver_tables.oracle import BLOCKS
from driver_tables.queries import register, reports
from meterstone.operators.positions import quantile
from meterstone.plans import outage_model as om
from meterstone.plans.metrics import MetricModel, model_tables
from meterstone.plans.visuals import run_cards, run_visual
from meterstone.sources.forecast_json import parse_forecast

RETRIEVED = datetime(2001, 7, 31, 6, 30)
# Coefficients for the scoring checks; the fitted model is checked against IRLS in the tests.
GIVEN = {"intercept": 0.4, "max_gust_mph": 0.02, "gust_over_35": 0.03, "gust_over_50": 0.05, "precip_in": 0.2,
         "cdd": 0.01, "hdd": 0.005, "summer": 0.3}


def given_coefficients(spark):
    return spark.createDataFrame(list(GIVEN.items()), "term string, coefficient double")


def grid(w):
    return om.training_grid(w.dim_date, w.dim_geography, w.fact_outage, w.cfg)


def payload(w):
    """The forecast rows packed as an API answer: divisions in request order, parallel arrays."""
    packed = w.src["forecast_rows"].groupBy("division").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("forecast_date").cast("string").alias("t"), "max_gust_mph", "max_wind_mph", "precip_in", "temp_max_f", "temp_min_f",
        ))).alias("d"))
    daily = F.struct(
        F.col("d.t").alias("time"), F.col("d.max_gust_mph").alias("wind_gusts_10m_max"),
        F.col("d.max_wind_mph").alias("wind_speed_10m_max"), F.col("d.precip_in").alias("precipitation_sum"),
        F.col("d.temp_max_f").alias("temperature_2m_max"), F.col("d.temp_min_f").alias("temperature_2m_min"))
    ordered = packed.agg(F.array_sort(F.collect_list(F.struct("division", daily.alias("daily")))).alias("all"))
    return ordered.select(F.to_json(F.transform("all", lambda x: F.struct(x["daily"].alias("daily")))).alias("payload"))


def forecast(w):
    return parse_forecast(payload(w), reports(w).division, RETRIEVED)


def scored(w):
    coef = given_coefficients(w.spark)
    return om.score_forecast(forecast(w), coef, om.division_table(w.dim_geography, coef), om.band_statistics(grid(w), w.cfg), w.cfg)


def fitted(w):
    if "_fitted" not in w.__dict__:
        w.__dict__["_fitted"] = om.train(w.spark, w.dim_date, w.dim_geography, w.fact_outage, w.cfg)
    return w.__dict__["_fitted"]


def forecast_model(w):
    return MetricModel(model_tables(reports(w), {"Weather Forecast": scored(w)}))


def fitted_tables(w):
    m = fitted(w)
    return MetricModel(model_tables(reports(w), {
        "Outage Backtest": m.backtest, "Outage Model Metrics": m.metrics, "Outage Model Bands": m.bands}))


_b = GIVEN
_RATE = (f"{_b['intercept']} + {_b['max_gust_mph']} * g + {_b['gust_over_35']} * greatest(g - 35, 0) + {_b['gust_over_50']} * greatest(g - 50, 0)"
         f" + {_b['precip_in']} * rain + {_b['cdd']} * c + {_b['hdd']} * h + {_b['summer']} * s")
# Fixed values, written out here and not taken from the engine's settings.
_BANDS = """('Under 25 mph', 0::double, 25::double, 1::int), ('25-35 mph', 25, 35, 2), ('35-45 mph', 35, 45, 3), ('45-55 mph', 45, 55, 4), ('55+ mph', 55, 999, 5)"""
_RISKS = """(0::double, 1.5::double, 'Normal', 1::int), (1.5, 3, 'Elevated', 2), (3, 8, 'High', 3), (8, 1e9, 'Severe', 4)"""

BLOCKS |= {
    "m_bands_list": f"SELECT * FROM (VALUES {_BANDS}) t(band, gust_min, gust_max, band_order)",
    "m_risks_list": f"SELECT * FROM (VALUES {_RISKS}) t(ratio_min, ratio_max, risk_level, risk_order)",
    "m_centers": """
        SELECT division, sum(customers_served)::bigint AS customers_served,
               sum(latitude * customers_served) / sum(customers_served) AS latitude,
               sum(longitude * customers_served) / sum(customers_served) AS longitude
        FROM w_geography GROUP BY division""",
    "m_grid": """
        SELECT d.date, g.division, g.customers_served, d.max_gust_mph::double AS max_gust_mph, precip_in,
               cooling_degree_days AS cdd, heating_degree_days AS hdd, d.month_num AS month, d.is_major_event_day,
               coalesce(o.events, 0) AS events, coalesce(o.customers_out, 0) AS customers_out,
               coalesce(o.customer_minutes, 0) AS customer_minutes, b.band
        FROM w_date d CROSS JOIN m_centers g
        LEFT JOIN (SELECT outage_date, division, count(*) AS events, sum(customers_out)::bigint AS customers_out,
                          sum(customer_minutes)::bigint AS customer_minutes FROM w_outage GROUP BY ALL) o
          ON o.outage_date = d.date AND o.division = g.division
        LEFT JOIN m_bands_list b ON d.max_gust_mph >= gust_min AND d.max_gust_mph < gust_max
        WHERE d.is_in_window""",
    "m_bands": """
        SELECT band, gust_min, gust_max, band_order, division_days, days, outages_per_100k,
               last_value(cpe IGNORE NULLS) OVER w AS customers_per_event, last_value(mpe IGNORE NULLS) OVER w AS minutes_per_event
        FROM (SELECT l.*, count(g.date) AS division_days, count(DISTINCT g.date) AS days,
                     round(sum(events)::double / (sum(customers_served)::double / 100000), 3) AS outages_per_100k,
                     if(sum(events) > 0, round(sum(customers_out)::double / nullif(sum(events), 0), 1), NULL) AS cpe,
                     if(sum(events) > 0, round(sum(customer_minutes)::double / nullif(sum(customers_out), 0), 1), NULL) AS mpe
              FROM m_bands_list l LEFT JOIN m_grid g USING (band) GROUP BY ALL) x
        WINDOW w AS (ORDER BY band_order ROWS UNBOUNDED PRECEDING)""",
    "m_divisions": f"""
        SELECT *, exp(({_RATE.replace('greatest(g - 35, 0)', '0').replace('greatest(g - 50, 0)', '0')
                        .replace('* g', '* 20').replace('* rain', '* 0').replace('* c ', '* 0 ').replace('* h ', '* 5 ').replace('* s', '* 0')})
                      + ln(customers_served / 100000)) AS baseline_outages
        FROM m_centers""",
    "m_forecast": f"""
        SELECT division, forecast_date, max_gust_mph, max_wind_mph, coalesce(precip_in, 0) AS precip_in, temp_max_f, temp_min_f,
               (temp_max_f + temp_min_f) / 2 AS temp_avg_f, greatest((temp_max_f + temp_min_f) / 2 - 65, 0) AS cdd,
               greatest(65 - (temp_max_f + temp_min_f) / 2, 0) AS hdd, timestamp '{RETRIEVED}' AS retrieved_at
        FROM forecast_rows""",
    "m_scored": f"""
        SELECT f.* EXCLUDE (g, rain, c, h, s), risk_order, risk_level, wind_band, predicted_outages * customers_per_event AS predicted_customers_out,
               predicted_outages * customers_per_event * minutes_per_event AS predicted_customer_minutes,
               (forecast_date - (SELECT min(forecast_date) FROM m_forecast))::int AS days_ahead
        FROM (SELECT *, predicted_outages / baseline_outages AS risk_ratio
              FROM (SELECT x.*, customers_served, baseline_outages, exp({_RATE} + ln(customers_served / 100000)) AS predicted_outages
                    FROM (SELECT *, coalesce(max_gust_mph, 0) AS g, precip_in AS rain, cdd AS c, hdd AS h, if(month(forecast_date) IN (6, 7, 8), 1, 0) AS s
                          FROM m_forecast) x LEFT JOIN m_divisions USING (division)) y) f
        LEFT JOIN m_risks_list ON risk_ratio >= ratio_min AND risk_ratio < ratio_max
        LEFT JOIN (SELECT band AS wind_band, gust_min, gust_max, customers_per_event, minutes_per_event FROM m_bands) b
          ON coalesce(max_gust_mph, 0) >= b.gust_min AND coalesce(max_gust_mph, 0) < b.gust_max""",
}

_S = "predicted_outages baseline_outages risk_ratio predicted_customers_out predicted_customer_minutes"
_WEATHER = "max_gust_mph max_wind_mph precip_in temp_max_f temp_min_f temp_avg_f cdd hdd"
register("forecast_json", forecast, "SELECT * FROM m_forecast", _WEATHER)
register("forecast_scored", scored, "SELECT * FROM m_scored", f"{_S} {_WEATHER}")
register("training_grid", grid, "SELECT * FROM m_grid", "max_gust_mph precip_in cdd hdd")
register("weighted_centroid", lambda w: om.division_centers(w.dim_geography), "SELECT * FROM m_centers", "latitude longitude")
register("wind_band_stats", lambda w: om.band_statistics(grid(w), w.cfg), "SELECT * FROM m_bands",
         "outages_per_100k customers_per_event minutes_per_event gust_min gust_max")
register("outage_model_divisions", lambda w: om.division_table(w.dim_geography, given_coefficients(w.spark)),
         "SELECT * FROM m_divisions", "latitude longitude baseline_outages")
register("risk_levels_of_forecast", lambda w: scored(w).groupBy("risk_level", "risk_order", "wind_band").count(),
         "SELECT risk_level, risk_order, wind_band, count(*) AS count FROM m_scored GROUP BY ALL")
register("events_quantile_corr",
         lambda w: quantile(grid(w), "events", 0.95).withColumnRenamed("value", "p95").crossJoin(F.broadcast(grid(w).agg(F.corr("events", "customers_out").alias("corr_out")))),
         "SELECT quantile_cont(events::double, 0.95) AS p95, corr(events, customers_out) AS corr_out FROM m_grid", "p95 corr_out")

_F = ["Forecast Outages", "Forecast Customers Out", "7-Day Outages", "7-Day Customers Out", "Max Gust (mph)",
      "Forecast vs Normal", "Peak Risk Level", "Peak Risk Day", "Forecast Retrieved"]
_PARTS = """sum(predicted_outages) AS forecast_outages, sum(predicted_customers_out) AS forecast_customers_out,
       sum(predicted_outages) FILTER (days_ahead < 7) AS "7_day_outages",
       sum(predicted_customers_out) FILTER (days_ahead < 7) AS "7_day_customers_out", max(max_gust_mph) AS max_gust_mph,
       sum(predicted_outages) / sum(baseline_outages) AS forecast_vs_normal, arg_max(risk_level, risk_order) AS peak_risk_level"""
_FD = 'forecast_outages forecast_customers_out "7_day_outages" "7_day_customers_out" max_gust_mph forecast_vs_normal'
register(
    "metrics_forecast", lambda w: run_cards(forecast_model(w), _F),
    f"""SELECT {_PARTS}, (SELECT strftime(forecast_date, '%a %b %-d') FROM m_scored GROUP BY forecast_date
                          ORDER BY sum(predicted_outages) DESC, forecast_date DESC LIMIT 1) AS peak_risk_day,
               max(retrieved_at) AS forecast_retrieved FROM m_scored""", _FD)
register(
    "metrics_forecast_by_division", lambda w: run_cards(forecast_model(w), _F[:7], by=["Division.division"]),
    f"SELECT division, {_PARTS} FROM m_scored GROUP BY division", _FD)
register(
    "visual_v14", lambda w: run_visual(forecast_model(w), "v14"),
    "SELECT forecast_date, sum(predicted_outages) AS forecast_outages, max(max_gust_mph) AS max_gust_mph FROM m_scored GROUP BY ALL",
    "forecast_outages max_gust_mph")
register("visual_v15", lambda w: run_visual(forecast_model(w), "v15"),
         "SELECT forecast_date, division, max_gust_mph, precip_in, predicted_outages, risk_level FROM m_scored",
         "max_gust_mph precip_in predicted_outages")
register(
    "visual_v17",
    lambda w: run_visual(MetricModel(model_tables(reports(w), {"Outage Model Bands": om.band_statistics(grid(w), w.cfg)})), "v17"),
    "SELECT band, outages_per_100k AS historical_outages_per_100k FROM m_bands WHERE outages_per_100k IS NOT NULL",
    "historical_outages_per_100k")


def fitted_forecast(w):
    m = fitted(w)
    return om.score_forecast(forecast(w), m.coefficients, m.divisions, m.bands, w.cfg)

