"""Weather-driven outage model: training grid, Poisson fit, back-test, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.functions.bands import band_field
from meterstone.operators.fill import fill_lookup
from meterstone.operators.poisson import fit_poisson
from meterstone.operators.positions import quantile
from meterstone.operators.statistics import count_where, ratio, weighted_mean
from meterstone.session import scratch_path
from meterstone.settings import Settings
from meterstone.sources.publish import publish

c = F.col

# Model terms and the calm day a forecast is compared with.
FEATURES = ("max_gust_mph", "gust_over_35", "gust_over_50", "precip_in", "cdd", "hdd", "summer")
SUMMER_MONTHS = (6, 7, 8)
PER_CUSTOMERS = 100_000
CALM_BACKTEST = {"max_gust_mph": 20.0, "precip_in": 0.0}
CALM_BASELINE = {"max_gust_mph": 20.0, "precip_in": 0.0, "cdd": 0.0, "hdd": 5.0, "month": 10}


def division_centers(geography: DataFrame) -> DataFrame:
    """Customers served and customer-weighted centroid per division."""
    return geography.groupBy("division").agg(
        F.sum("customers_served").alias("customers_served"),
        weighted_mean("latitude", "customers_served").alias("latitude"),
        weighted_mean("longitude", "customers_served").alias("longitude"),
    )


def training_grid(dates: DataFrame, geography: DataFrame, outages: DataFrame, cfg: Settings) -> DataFrame:
    """Every window day x division with its weather and outage totals (0 when none).

    Days are unfolded per division, so the grid needs no cross join; outages are
    summed per day and division before they meet it.
    """
    span = F.sequence(F.lit(cfg.window_start), F.lit(cfg.window_end), F.expr("interval 1 day"))
    grid = (
        geography.groupBy("division").agg(F.sum("customers_served").alias("customers_served"))
        .withColumn("date", F.explode(span))
    )
    weather = dates.select(
        "date", c("max_gust_mph").cast("double").alias("max_gust_mph"), "precip_in",
        c("cooling_degree_days").alias("cdd"), c("heating_degree_days").alias("hdd"),
        F.month("date").alias("month"), "is_major_event_day",
    )
    hit = outages.groupBy(c("outage_date").alias("date"), "division").agg(
        F.count("outage_id").alias("events"),
        F.sum("customers_out").alias("customers_out"),
        F.sum("customer_minutes").alias("customer_minutes"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return grid.join(weather, "date").join(hit, ["date", "division"], "left").select(
        "date", "division", "customers_served", "max_gust_mph", "precip_in", "cdd", "hdd", "month",
        "is_major_event_day", zero("events"), zero("customers_out"), zero("customer_minutes"),
        F.when(c("max_gust_mph").isNotNull(), band_field(c("max_gust_mph"), cfg.wind_bands, 2, cfg.wind_bands[-1][2]))
        .alias("band"),
    )


def with_features(df: DataFrame) -> DataFrame:
    over = lambda edge: F.greatest(c("max_gust_mph") - F.lit(edge), F.lit(0.0))
    return df.withColumns({
        "gust_over_35": over(35),
        "gust_over_50": over(50),
        "summer": F.when(c("month").isin(*SUMMER_MONTHS), 1.0).otherwise(0.0),
        "exposure": F.ln(c("customers_served") / F.lit(float(PER_CUSTOMERS))),
    })


@dataclass
class OutageFit:
    coefficients: DataFrame  # term, coefficient, std_error, p_value
    deviance: float
    null_deviance: float


def fit(spark: SparkSession, grid: DataFrame) -> OutageFit:
    """Poisson regression with log link and log-customers offset.

    Days without weather cannot be used and are left out.
    """
    known = with_features(grid).dropna(subset=[*FEATURES, "exposure"])
    told = fit_poisson(known, FEATURES, "events", "exposure")
    rows = list(zip(("intercept", *FEATURES), told.coefficients, told.std_errors, told.p_values))
    table = spark.createDataFrame(rows, "term string, coefficient double, std_error double, p_value double")
    return OutageFit(table, told.deviance, told.null_deviance)


def predict(df: DataFrame, coefficients: DataFrame, name: str) -> DataFrame:
    """Expected outages per row from a coefficient table (one broadcast row)."""
    wide = coefficients.agg(*[
        F.max(F.when(c("term") == t, c("coefficient"))).alias(f"_b_{t}") for t in ("intercept", *FEATURES)
    ])
    rate: Column = c("_b_intercept")
    for t in FEATURES:
        rate = rate + c(f"_b_{t}") * c(t)
    ready = with_features(df).crossJoin(F.broadcast(wide))
    return ready.select(*df.columns, F.exp(rate + c("exposure")).alias(name))


def band_statistics(grid: DataFrame, cfg: Settings) -> DataFrame:
    """History per wind band; bands without events take the ratios of the band below."""
    spark = grid.sparkSession
    bands = spark.createDataFrame(
        [(b[2], b[0], b[1], b[3]) for b in cfg.wind_bands],
        "band string, gust_min double, gust_max double, band_order int",
    )
    sums = grid.groupBy("band").agg(
        F.count(F.lit(1)).alias("division_days"),
        F.countDistinct("date").alias("days"),
        F.sum("events").alias("_events"),
        F.sum("customers_out").alias("_out"),
        F.sum("customer_minutes").alias("_minutes"),
        F.sum("customers_served").alias("_served"),
    )
    has_events = c("_events") > 0
    table = bands.join(sums, "band", "left").select(
        "band", "gust_min", "gust_max", "band_order",
        F.coalesce("division_days", F.lit(0)).alias("division_days"),
        F.coalesce("days", F.lit(0)).alias("days"),
        F.round(ratio(c("_events"), c("_served") / F.lit(float(PER_CUSTOMERS))), 3).alias("outages_per_100k"),
        F.when(has_events, F.round(ratio(c("_out"), c("_events")), 1)).alias("customers_per_event"),
        F.when(has_events, F.round(ratio(c("_minutes"), c("_out")), 1)).alias("minutes_per_event"),
    )
    return fill_lookup(table, "band_order", ["customers_per_event", "minutes_per_event"])


def risk_level_table(spark: SparkSession, cfg: Settings) -> DataFrame:
    return spark.createDataFrame(
        list(cfg.risk_levels), "ratio_min double, ratio_max double, risk_level string, risk_order int"
    )


def division_table(geography: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Division centers plus the calm-day baseline of the model."""
    centers = division_centers(geography)
    calm = centers.withColumns({k: F.lit(v) for k, v in CALM_BASELINE.items()})
    return predict(calm, coefficients, "baseline_outages").select(*centers.columns, "baseline_outages")


def split_by_day(grid: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Temporal hold-out: before / from the back-test start."""
    start = F.lit(cfg.backtest_start)
    return grid.filter(c("date") < start), grid.filter(c("date") >= start)


def backtest(test: DataFrame, coefficients: DataFrame, bands: DataFrame) -> DataFrame:
    """Held-out days scored, with the risk ratio against a calm day."""
    per_event = F.broadcast(bands.select("band", "customers_per_event"))
    scored = predict(test, coefficients, "predicted_events").join(per_event, "band", "left")
    calm = scored.withColumns({
        "_gust": c("max_gust_mph"), "_rain": c("precip_in"), **{k: F.lit(v) for k, v in CALM_BACKTEST.items()},
    })
    base = predict(calm, coefficients, "baseline").withColumns({"max_gust_mph": c("_gust"), "precip_in": c("_rain")})
    return base.drop("_gust", "_rain").withColumns({
        "predicted_customers_out": c("predicted_events") * c("customers_per_event"),
        "risk_ratio": ratio(c("predicted_events"), c("baseline")),
    })


def backtest_table(scored: DataFrame) -> DataFrame:
    r3 = lambda name: F.round(name, 3)
    return scored.select(
        "date", "division", c("events").alias("actual_outages"),
        r3("predicted_events").alias("predicted_outages"),
        c("customers_out").alias("actual_customers_out"),
        r3("predicted_customers_out").alias("predicted_customers_out"),
        r3("max_gust_mph").alias("max_gust_mph"), r3("precip_in").alias("precip_in"), r3("risk_ratio").alias("risk_ratio"),
    )


def backtest_metrics(scored: DataFrame, grid: DataFrame, full: OutageFit, cfg: Settings) -> DataFrame:
    """Accuracy figures as (metric, value, metric_order)."""
    high = next(level[0] for level in cfg.risk_levels if level[2] == "High")
    cut = quantile(scored, "events", 0.95).withColumnRenamed("value", "_p95")
    flagged, big = c("risk_ratio") >= F.lit(high), c("events") >= c("_p95")
    main = scored.crossJoin(F.broadcast(cut)).agg(
        F.max("date").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.abs(c("events") - c("predicted_events"))).alias("_mae"),
        F.avg("events").alias("_mean"),
        count_where(flagged & big).alias("_hits"),
        count_where(big).alias("_big"),
        count_where(flagged).alias("_flagged"),
        F.countDistinct(F.when(c("is_major_event_day"), c("date"))).alias("_med"),
    )
    daily = scored.groupBy("date").agg(F.sum("events").alias("_a"), F.sum("predicted_events").alias("_p"))
    link = daily.agg(F.corr("_a", "_p").alias("_corr"))
    train = grid.agg(F.countDistinct("date").alias("_days"))
    one = main.crossJoin(F.broadcast(link)).crossJoin(F.broadcast(train))  # one row each
    text = lambda x, d: F.round(x, d).cast("string")
    start = F.date_format(F.lit(cfg.backtest_start), "MMM yyyy")
    explained = 1 - full.deviance / full.null_deviance
    # Names of the published figures, in order.
    figures = [
        ("Held-out period", F.concat(start, F.lit(" - "), F.date_format("_last", "MMM yyyy"))),
        ("Division-days scored", c("_n").cast("string")),
        ("Mean absolute error (outages per division-day)", text("_mae", 2)),
        ("Mean actual outages per division-day", text("_mean", 2)),
        ("Correlation, daily totals (actual vs predicted)", text("_corr", 3)),
        ("Worst 5% division-days flagged High/Severe", text(ratio(c("_hits"), c("_big")), 3)),
        ("High/Severe flags that were real bad days", text(ratio(c("_hits"), F.greatest("_flagged", F.lit(1))), 3)),
        ("Major event days in held-out period", c("_med").cast("string")),
        ("Deviance explained (pseudo R-squared)", text(F.lit(explained), 3)),
        ("Training days", c("_days").cast("string")),
    ]
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value"), F.lit(i).alias("metric_order"))
        for i, (name, value) in enumerate(figures, start=1)
    ])
    return one.select(F.inline(rows))


def score_forecast(forecast: DataFrame, coefficients: DataFrame, divisions: DataFrame, bands: DataFrame,
                   cfg: Settings) -> DataFrame:
    """Expected outages, risk and customers out per forecast row."""
    known = divisions.select("division", "customers_served", "baseline_outages")
    placed = forecast.join(known, "division", "left").withColumn("month", F.month("forecast_date"))
    placed = placed.withColumns({"_gust": c("max_gust_mph"), "max_gust_mph": F.coalesce("max_gust_mph", F.lit(0.0))})  # a missing gust counts as none
    scored = predict(placed, coefficients, "predicted_outages").drop("month").withColumns({
        "risk_ratio": ratio(c("predicted_outages"), c("baseline_outages")),
        "wind_band": band_field(c("max_gust_mph"), cfg.wind_bands, 2),
    })
    level = c("risk_ratio")  # an unknown ratio has no level
    per_band = F.broadcast(bands.select(c("band").alias("wind_band"), "customers_per_event", "minutes_per_event"))
    first = forecast.agg(F.min("forecast_date").alias("_first"))
    return (
        scored.withColumns({
            "risk_order": band_field(level, cfg.risk_levels, 3), "risk_level": band_field(level, cfg.risk_levels, 2),
        })
        .join(per_band, "wind_band", "left")
        .crossJoin(F.broadcast(first))
        .select(
            *[c("_gust").alias("max_gust_mph") if n == "max_gust_mph" else c(n) for n in forecast.columns], "customers_served", "predicted_outages", "baseline_outages", "risk_ratio", "risk_order",
            "risk_level", "wind_band",
            (c("predicted_outages") * c("customers_per_event")).alias("predicted_customers_out"),
            (c("predicted_outages") * c("customers_per_event") * c("minutes_per_event")).alias("predicted_customer_minutes"),
            F.datediff("forecast_date", "_first").alias("days_ahead"),
        )
    )


@dataclass
class OutageModel:
    """All published model tables."""

    coefficients: DataFrame
    bands: DataFrame
    divisions: DataFrame
    backtest: DataFrame
    metrics: DataFrame
    risk_levels: DataFrame


def train(spark: SparkSession, dates: DataFrame, geography: DataFrame, outages: DataFrame, cfg: Settings) -> OutageModel:
    """Back-test on the held-out days, then fit on the whole window.

    The grid is read in every step of two fits, so it is written to the shared folder once.
    """
    path = scratch_path(spark, "training-grid")
    training_grid(dates, geography, outages, cfg).write.parquet(path)
    grid = spark.read.parquet(path)
    bands = band_statistics(grid, cfg)
    early, late = split_by_day(grid, cfg)
    trial = fit(spark, early)
    scored = backtest(late.dropna(subset=["max_gust_mph", "precip_in", "cdd", "hdd"]), trial.coefficients, bands)
    full = fit(spark, grid)
    return OutageModel(
        coefficients=full.coefficients,
        bands=bands,
        divisions=division_table(geography, full.coefficients),
        backtest=backtest_table(scored),
        metrics=backtest_metrics(scored, grid, full, cfg),
        risk_levels=risk_level_table(spark, cfg),
    )


# Published names of the model tables.
PUBLISHED = {
    "outage_model_coefficients": "coefficients", "outage_model_bands": "bands", "outage_model_divisions": "divisions",
    "outage_model_backtest": "backtest", "outage_model_metrics": "metrics", "outage_model_risk_levels": "risk_levels",
}


def publish_model(spark: SparkSession, model: OutageModel, folder: str) -> DataFrame:
    """All model tables as one publication; the manifest names what it wrote."""
    return publish(spark, {name: getattr(model, attribute) for name, attribute in PUBLISHED.items()}, folder)
