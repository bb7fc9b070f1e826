"""Metric registry: names, filter context, snapshots, year over year."""

from datetime import date

import pytest

from meterstone.plans.metrics import METRICS, RELATIONSHIPS, MetricModel, column_name
from meterstone.plans.visuals import CARDS, VISUALS, Detail


@pytest.fixture(scope="module")
def model(spark):
    months = [(y * 100 + m, y, date(y, m, 1), f"{y}-{m:02d}") for y in (2023, 2024) for m in range(1, 13)]
    period = spark.createDataFrame(months, "period_key int, year int, month_start date, year_month string")
    period = period.selectExpr("*", "last_day(month_start) AS month_end")
    res = spark.createDataFrame([(k, d, float(k % 100 + (10 if k > 202400 else 0)), 2.0) for k, *_ in months for d in ("N", "S")],
                                "period_key int, division string, total_amt double, bills double")
    ar = spark.createDataFrame(
        [(date(2024, 1, 31), "N", True, 1, 5.0), (date(2024, 2, 29), "N", True, 1, 7.0), (date(2024, 2, 29), "N", False, 9, 3.0),
         (date(2024, 1, 31), "S", True, 2, 11.0)],
        "month_end date, division string, is_receivable boolean, bucket_order int, open_amt double")
    division = spark.createDataFrame([("N", 100), ("S", 300)], "division string, customers_served bigint")
    outages = spark.createDataFrame([("N", 50, 5, True), ("S", 150, 10, False)],
                                    "division string, customer_minutes bigint, customers_out bigint, is_major_event_day boolean")
    outages = outages.selectExpr("*", "date'2024-01-05' AS outage_date")
    dates = spark.createDataFrame([(date(2024, 1, 5), 202401, True)], "date date, period_key int, is_major_event_day boolean")
    return MetricModel({"Period": period, "Revenue Residential": res, "AR Aging": ar, "Division": division, "Outages": outages,
                        "Date": dates})


def one(df):
    return tuple(df.first())


def test_registry():
    assert len(METRICS) == 95 and len(VISUALS) == 33 and sum(map(len, CARDS.values())) == 63 and len(RELATIONSHIPS) == 34
    assert len({column_name(n) for n in METRICS}) == 95
    used = {m for v in VISUALS.values() if not isinstance(v, Detail) for m in v.metrics} | {m for c in CARDS.values() for m in c}
    assert used <= set(METRICS)


def test_latest_snapshot(model):
    assert one(model.evaluate(["AR Balance", "Written Off to Date", "AR Past Due"])) == (7.0, 3.0, None)
    got = {r[0]: r[1] for r in model.evaluate(["AR Balance"], ["Division.division"]).collect()}
    assert got == {"N": 7.0, "S": 11.0}  # latest month of each group
    january = [("Period.period_key", lambda k: k == 202401)]
    assert one(model.evaluate(["AR Balance", "AR Past Due"], where=january)) == (16.0, 11.0)


def test_year_over_year(model):
    name = "Residential Revenue YoY %"
    assert one(model.evaluate([name]))[0] == pytest.approx(120 / 78)
    assert one(model.evaluate([name], where=[("Period.year", lambda y: y == 2023)]))[0] is None
    by_month = {r[0]: r[1] for r in model.evaluate([name], ["Period.year_month"]).collect()}
    assert by_month["2024-01"] == pytest.approx(10.0) and "2023-05" not in by_month


def test_ratio_of_sums(model):
    assert one(model.evaluate(["Avg Residential Bill"]))[0] == pytest.approx((2 * 78 + 2 * 198) / 96)


def test_filters_travel_to_the_many_side_only(model):
    names = ["SAIDI (min)", "SAIDI excl. MED (min)"]
    index = {r[0]: tuple(r)[1:] for r in model.evaluate(names, ["Division.division"]).collect()}
    assert index == {"N": (0.5, None), "S": (0.5, 0.5)}
    share = {r[0]: tuple(r)[1:] for r in model.evaluate(names, ["Outages.division"]).collect()}
    assert share == {"N": (0.125, None), "S": (0.375, 0.375)}  # all customers below the line
    assert one(model.evaluate(["Major Event Days", "SAIDI (min)"], where=[("Division.division", lambda d: d == "N")])) == (1, 0.5)


def test_own_filter_replaces_the_grouped_field(model):
    got = {r[0]: r[1] for r in model.evaluate(["SAIDI excl. MED (min)", "Outage Events"], ["Outages.is_major_event_day"]).collect()}
    assert got == {True: 150 / 400, False: 150 / 400}


def test_unrelated_group_is_refused(model):
    with pytest.raises(ValueError):
        model.evaluate(["Customers Served"], ["Outages.division"])
