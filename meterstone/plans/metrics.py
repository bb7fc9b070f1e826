"""Metrics over the report datasets.

A metric is data: leaf aggregates over one table, combined by small column
functions. ``MetricModel.evaluate`` computes any set of metrics for group fields
and filters given as ``"Table.column"``. Relationships run from the many side to
the one side only: a fact sees the fields of the dimensions it points to and
ignores all others. Each fact is aggregated on its own and the aggregates are
put together afterwards; facts are never joined row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.functions import codes
from meterstone.operators.statistics import count_where, ratio

c = F.col

# Fixed values: (many-side table, column, one-side table, column).
RELATIONSHIPS = (
    ("Date", "period_key", "Period", "period_key"),
    ("Revenue Residential", "period_key", "Period", "period_key"),
    ("Revenue Commercial", "period_key", "Period", "period_key"),
    ("Revenue Residential", "division", "Division", "division"),
    ("Revenue Commercial", "division", "Division", "division"),
    ("AR Aging", "month_end", "Period", "month_end"),
    ("AR Aging", "division", "Division", "division"),
    ("AR Top Accounts", "division", "Division", "division"),
    ("Payments", "payment_month", "Period", "month_start"),
    ("Payments", "division", "Division", "division"),
    ("Digital Adoption", "month_end", "Period", "month_end"),
    ("Digital Adoption", "division", "Division", "division"),
    ("AMI Daily", "read_date", "Date", "date"),
    ("AMI Daily", "division", "Division", "division"),
    ("Outages", "outage_date", "Date", "date"),
    ("Outages", "division", "Division", "division"),
    ("Work Orders", "created_month", "Period", "month_start"),
    ("Work Orders", "division", "Division", "division"),
    ("Work Order Backlog", "division", "Division", "division"),
    ("Contact Center", "interaction_date", "Date", "date"),
    ("Collections Orders", "created_month", "Period", "month_start"),
    ("Collections Orders", "division", "Division", "division"),
    ("Payment Plans", "created_month", "Period", "month_start"),
    ("Payment Plans", "division", "Division", "division"),
    ("Billing Exceptions", "bill_month", "Period", "month_start"),
    ("Billing Exceptions", "division", "Division", "division"),
    ("Rebills", "reversal_month", "Period", "month_start"),
    ("Service Orders", "created_month", "Period", "month_start"),
    ("Service Orders", "division", "Division", "division"),
    ("Customer 360", "division", "Division", "division"),
    ("Customer Bills", "customer_id", "Customer 360", "customer_id"),
    ("Weather Forecast", "division", "Division", "division"),
    ("Outage Backtest", "division", "Division", "division"),
    ("Outage Backtest", "date", "Date", "date"),
)

# Column -> companion column its values sort by.
SORT_BY = {
    "AR Aging.aging_bucket": "bucket_order",
    "Date.day_name": "day_of_week",
    "Period.year_month": "period_key",
    "Period.month_name": "month_num",
    "Outage Model Bands.band": "band_order",
    "Outage Risk Levels.risk_level": "risk_order",
    "Weather Forecast.risk_level": "risk_order",
    "Outage Model Metrics.metric": "metric_order",
}

Filter = tuple[str, Callable[[Column], Column]]


# ------------------------------------------------------------------ building blocks
@dataclass(frozen=True)
class Leaf:
    """One aggregate over one table.

    mode: ``plain``; ``latest`` (rows of the latest ``on`` value in context);
    ``current``/``prior`` (months with a prior-year month, and that prior year);
    ``peak`` (the ``on`` value with the largest aggregate, formatted as a day).
    ``replaces`` are context fields a metric's own filter overrides.
    """

    table: str
    agg: Callable[[], Column]
    mode: str = "plain"
    on: str | None = None
    replaces: tuple[str, ...] = ()


@dataclass(frozen=True)
class Calc:
    fn: Callable[..., Column]
    args: tuple


def total(table: str, column: str, where=None, **kw) -> Leaf:
    if where is None:
        return Leaf(table, lambda: F.sum(column), **kw)
    return Leaf(table, lambda: F.sum(F.when(where(), c(column))), **kw)


def rows(table: str, where=None, **kw) -> Leaf:
    if where is None:
        return Leaf(table, lambda: F.count(F.lit(1)), **kw)
    return Leaf(table, lambda: count_where(where()), **kw)


def mean(table: str, column: str) -> Leaf:
    return Leaf(table, lambda: F.avg(c(column).cast("double")))


def highest(table: str, column: str) -> Leaf:
    return Leaf(table, lambda: F.max(column))


def divide(top, bottom, scale: float | None = None) -> Calc:
    """Ratio of sums; empty on a zero or missing denominator."""
    if scale is None:
        return Calc(ratio, (top, bottom))
    return Calc(lambda a, b: ratio(a, b) / F.lit(scale), (top, bottom))


def add(a, b) -> Calc:
    """Empty only when both are."""
    return Calc(lambda x, y: F.coalesce(x + y, x, y), (a, b))


def or_zero(a) -> Calc:
    return Calc(lambda x: F.coalesce(x, F.lit(0)), (a,))


def year_over_year(table: str, column: str) -> Calc:
    """(current - prior) / prior over the months that have a prior-year month; no current amount counts as 0, no prior one gives nothing."""
    current = total(table, column, mode="current")
    prior = total(table, column, mode="prior")
    return Calc(lambda now, was: ratio(F.coalesce(now, F.lit(0)) - was, was), (current, prior))


def snapshot(table: str, column: str, where=None, replaces: tuple[str, ...] = ()) -> Leaf:
    return total(table, column, where, mode="latest", on="month_end", replaces=replaces)


# ------------------------------------------------------------------ the metrics
def _metrics() -> dict[str, object]:
    res, com, ar, pay = "Revenue Residential", "Revenue Commercial", "AR Aging", "Payments"
    ami, out, work, backlog = "AMI Daily", "Outages", "Work Orders", "Work Order Backlog"
    desk, coll, mora, plan = "Contact Center", "Collections Orders", "Moratorium Compliance", "Payment Plans"
    exc, svc, c360, recent, fc = "Billing Exceptions", "Service Orders", "Customer 360", "Customer Bills", "Weather Forecast"
    receivable = lambda: c("is_receivable")
    done = lambda kind: lambda: (c("order_type") == kind) & (c("status") == "Completed")
    kind_status = (f"{coll}.order_type", f"{coll}.status")
    calm = lambda: ~c("is_major_event_day")
    calm_field = (f"{out}.is_major_event_day",)
    assisted, by_assisted = (lambda: c("is_assisted")), (f"{desk}.is_assisted",)
    first_week = lambda: c("days_ahead") < 7
    day_field = (f"{fc}.forecast_date",)
    m: dict[str, object] = {}

    m["Residential Revenue"] = total(res, "total_amt")
    m["Residential kWh"] = total(res, "kwh")
    m["Residential Therms"] = total(res, "therms")
    m["Residential Bills"] = total(res, "bills")
    m["Avg Residential Bill"] = divide(m["Residential Revenue"], m["Residential Bills"])
    m["Residential Revenue YoY %"] = year_over_year(res, "total_amt")
    m["C&I Revenue"] = total(com, "total_amt")
    m["Total Revenue"] = add(m["Residential Revenue"], m["C&I Revenue"])
    m["Residential Share %"] = divide(m["Residential Revenue"], m["Total Revenue"])
    m["C&I kWh"] = total(com, "kwh")
    m["C&I Therms"] = total(com, "therms")
    m["C&I Bills"] = total(com, "bills")
    m["Avg C&I Bill"] = divide(m["C&I Revenue"], m["C&I Bills"])
    m["C&I Revenue YoY %"] = year_over_year(com, "total_amt")

    rec, order = f"{ar}.is_receivable", f"{ar}.bucket_order"
    m["AR Balance"] = snapshot(ar, "open_amt", receivable, (rec,))
    m["AR Past Due"] = snapshot(ar, "open_amt", lambda: receivable() & (c("bucket_order") > 1), (rec, order))
    m["AR % Past Due"] = divide(m["AR Past Due"], m["AR Balance"])
    m["AR 91-180 Days"] = snapshot(ar, "open_amt", lambda: c("bucket_order") == 5, (order,))
    m["Written Off to Date"] = snapshot(ar, "open_amt", lambda: ~receivable(), (rec,))
    m["Top Accounts Past Due"] = total("AR Top Accounts", "past_due_amt")

    channel = (f"{pay}.channel",)
    m["Payments $"] = total(pay, "amount")
    m["Payment Count"] = total(pay, "payments")
    m["Digital Payment %"] = divide(
        total(pay, "amount", lambda: c("channel").isin(*codes.DIGITAL_CHANNELS), replaces=channel), m["Payments $"])
    m["Energy Assistance $"] = total(pay, "amount", lambda: c("channel") == codes.ASSISTANCE_CHANNEL, replaces=channel)

    m["Active Customers"] = snapshot("Digital Adoption", "active_customers")
    m["Autopay %"] = divide(snapshot("Digital Adoption", "autopay_customers"), m["Active Customers"])
    m["Paperless %"] = divide(snapshot("Digital Adoption", "paperless_customers"), m["Active Customers"])

    m["Avg Daily kWh per Meter"] = divide(total(ami, "kwh_valid"), total(ami, "reads_valid"))
    m["Read Success %"] = divide(total(ami, "meters_reporting"), total(ami, "meters_expected"))
    m["Estimated Read %"] = divide(total(ami, "reads_estimated"), total(ami, "meters_expected"))
    m["Spike Reads"] = total(ami, "reads_spike")

    m["Avg Temp (F)"] = mean("Date", "temp_avg_f")
    m["Cooling Degree Days"] = total("Date", "cooling_degree_days")
    m["Heating Degree Days"] = total("Date", "heating_degree_days")
    m["Major Event Days"] = or_zero(rows("Date", lambda: c("is_major_event_day"), replaces=("Date.is_major_event_day",)))
    m["Customers Served"] = total("Division", "customers_served")

    m["Outage Events"] = rows(out)
    m["Customer Minutes"] = total(out, "customer_minutes")
    m["Customer Interruptions"] = total(out, "customers_out")
    m["SAIDI (min)"] = divide(m["Customer Minutes"], m["Customers Served"])
    m["SAIFI"] = divide(m["Customer Interruptions"], m["Customers Served"])
    m["CAIDI (min)"] = divide(m["Customer Minutes"], m["Customer Interruptions"])
    m["SAIDI excl. MED (min)"] = divide(total(out, "customer_minutes", calm, replaces=calm_field), m["Customers Served"])
    m["SAIFI excl. MED"] = divide(total(out, "customers_out", calm, replaces=calm_field), m["Customers Served"])

    m["Work Orders Created"] = total(work, "work_orders")
    m["On-Time Completion %"] = divide(total(work, "finished_on_time"), total(work, "finished"))
    m["Planned Cost"] = total(work, "planned_cost")
    m["Actual Cost"] = total(work, "actual_cost")
    m["Open Backlog"] = rows(backlog)
    m["Overdue Work Orders"] = or_zero(rows(backlog, lambda: c("is_overdue"), replaces=(f"{backlog}.is_overdue",)))
    m["Avg Backlog Age (days)"] = mean(backlog, "open_age_days")

    m["Total Contacts"] = total(desk, "contacts")
    m["ASA (sec)"] = divide(
        total(desk, "wait_sec_total", lambda: c("channel") == codes.AGENT_CHANNEL, replaces=(f"{desk}.channel",)),
        total(desk, "agent_calls"))
    m["Service Level (30s) %"] = divide(total(desk, "answered_within_30s"), total(desk, "agent_calls"))
    m["AHT (min)"] = divide(total(desk, "handle_sec_total", assisted, replaces=by_assisted),
                            total(desk, "contacts", assisted, replaces=by_assisted), 60.0)
    m["FCR %"] = divide(total(desk, "resolved_first_contact"), m["Total Contacts"])
    m["CSAT (avg)"] = divide(total(desk, "csat_total"), total(desk, "csat_responses"))
    m["Self-Service %"] = divide(total(desk, "contacts", lambda: ~c("is_assisted"), replaces=by_assisted), m["Total Contacts"])

    m["Disconnects"] = total(coll, "orders", done("Disconnect for Non-Pay"), replaces=kind_status)
    m["Reconnects"] = total(coll, "orders", done("Reconnect"), replaces=kind_status)
    m["Reconnect Rate %"] = divide(m["Reconnects"], m["Disconnects"])
    m["Reconnect Within 1 Day %"] = divide(
        total(coll, "completed_within_1_day", done("Reconnect"), replaces=kind_status), m["Reconnects"])
    m["Moratorium Exceptions"] = or_zero(total(
        mora, "disconnects_completed", lambda: c("is_winter_moratorium") & (c("segment") == "Residential"),
        replaces=(f"{mora}.is_winter_moratorium", f"{mora}.segment")))
    m["Medical Cert Disconnects"] = or_zero(total(
        mora, "disconnects_completed", lambda: c("has_medical_cert"), replaces=(f"{mora}.has_medical_cert",)))
    m["Payment Plans Created"] = total(plan, "plans")
    status = (f"{plan}.status",)
    m["Plan Default %"] = divide(
        total(plan, "plans", lambda: c("status") == "Defaulted", replaces=status),
        total(plan, "plans", lambda: c("status").isin("Completed", "Defaulted"), replaces=status))

    m["Bills Reviewed"] = total(exc, "bills")
    m["Estimated Bill %"] = divide(total(exc, "elec_estimated"), m["Bills Reviewed"])
    m["Consecutive Estimates"] = total(exc, "consecutive_estimates")
    m["Zero-Usage Bills"] = total(exc, "zero_usage_bills")
    m["High-Variance Bill %"] = divide(total(exc, "high_variance_bills"), m["Bills Reviewed"])
    m["Reversed Bills"] = total("Rebills", "reversed_bills")
    m["Reversed $"] = total("Rebills", "reversed_amt")

    m["Service Orders Created"] = total(svc, "orders")
    m["Avg Cycle Days"] = divide(total(svc, "cycle_days_total"), total(svc, "completed"))
    m["Completion %"] = divide(total(svc, "completed"), m["Service Orders Created"])
    m["Open Service Orders"] = total(svc, "open_orders")
    m["Customers"] = rows(c360)
    m["Open Balance"] = total(c360, "open_amt")
    m["Past Due Balance"] = total(c360, "past_due_amt")
    m["Billed (Last 3 Mo)"] = total(recent, "total_amt")
    m["Paid (Last 3 Mo)"] = total(recent, "paid_amt")

    m["Forecast Outages"] = total(fc, "predicted_outages")
    m["Forecast Customers Out"] = total(fc, "predicted_customers_out")
    m["7-Day Outages"] = total(fc, "predicted_outages", first_week, replaces=day_field)
    m["7-Day Customers Out"] = total(fc, "predicted_customers_out", first_week, replaces=day_field)
    m["Max Gust (mph)"] = highest(fc, "max_gust_mph")
    m["Forecast vs Normal"] = divide(m["Forecast Outages"], total(fc, "baseline_outages"))
    m["Peak Risk Level"] = Leaf(fc, lambda: F.max_by("risk_level", "risk_order"))
    m["Peak Risk Day"] = Leaf(fc, lambda: F.sum("predicted_outages"), mode="peak", on="forecast_date")
    m["Forecast Retrieved"] = highest(fc, "retrieved_at")
    m["Backtest Actual Outages"] = total("Outage Backtest", "actual_outages")
    m["Backtest Predicted Outages"] = total("Outage Backtest", "predicted_outages")
    m["Historical Outages per 100K"] = mean("Outage Model Bands", "outages_per_100k")
    m["Rows Affected"] = total("Data Quality", "rows_affected")
    return m


METRICS = _metrics()


def column_name(metric: str) -> str:
    """Plain column name of a metric: ``Residential Revenue YoY %`` -> ``residential_revenue_yoy_pct``."""
    text = metric.lower().replace("%", " pct ").replace("$", " usd ").replace("&", " and ")
    return "_".join("".join(ch if ch.isalnum() else " " for ch in text).split())


# ------------------------------------------------------------------ evaluation
class MetricModel:
    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def path(self, table: str, target: str) -> list[tuple] | None:
        """Relationships leading from a table to a dimension; None when unrelated."""
        if table == target:
            return []
        for rel in RELATIONSHIPS:
            if rel[0] == table:
                rest = self.path(rel[2], target)
                if rest is not None:
                    return [rel, *rest]
        return None

    def context(self, table: str, fields: Sequence[str]) -> DataFrame:
        """The table with each field added under its full name."""
        df = self.tables[table]
        for target in dict.fromkeys(f.rsplit(".", 1)[0] for f in fields):
            wanted = [f for f in fields if f.rsplit(".", 1)[0] == target]
            names = {f: f.rsplit(".", 1)[1] for f in wanted}
            if target == table:
                df = df.select("*", *[c(col).alias(f) for f, col in names.items()])
                continue
            key, frame = None, None
            for rel in reversed(self.path(table, target)):
                to = self.tables[rel[2]]
                if frame is None:
                    frame = to.select(c(rel[3]).alias("_key"), *[c(col).alias(f) for f, col in names.items()])
                else:
                    step = to.select(c(rel[3]).alias("_key"), c(key).alias("_next"))
                    frame = step.join(frame.withColumnRenamed("_key", "_next"), "_next", "left").drop("_next")
                key = rel[1]
            df = df.withColumn("_key", c(key)).join(frame, "_key", "left").drop("_key")
        return df

    def _related(self, table: str, field: str) -> bool:
        return self.path(table, field.rsplit(".", 1)[0]) is not None

    def _frame(self, key: tuple, leaves: dict[str, Leaf], by: Sequence[str], where: Sequence[Filter]) -> DataFrame:
        table, mode, on, replaces = key
        groups = [f for f in by if self._related(table, f) and f not in replaces]
        tests = [(f, t) for f, t in where if self._related(table, f) and f not in replaces]
        if mode == "year_back":
            return self._year_back(table, leaves, groups, tests)
        df = self.context(table, list(dict.fromkeys([*groups, *[f for f, _ in tests]])))
        for f, test in tests:
            df = df.filter(test(c(f"`{f}`")))
        quoted = [c(f"`{f}`") for f in groups]
        aggs = [leaf.agg().alias(name) for name, leaf in leaves.items()]
        if mode == "plain":
            return df.groupBy(*quoted).agg(*aggs)
        steps = df.groupBy(*quoted, c(on).alias("_on")).agg(*aggs)
        if mode == "latest":
            return steps.groupBy(*quoted).agg(*[F.max_by(n, "_on").alias(n) for n in leaves])
        day = lambda n: F.date_format(F.max(F.struct(c(n), c("_on")))["_on"], "EEE MMM d")
        return steps.groupBy(*quoted).agg(*[day(n).alias(n) for n in leaves])

    def _year_back(self, table, leaves, groups, tests) -> DataFrame:
        """Sums over the context's months that have a prior-year month, and over that prior year.

        The period filter and the period group fields act on the month list; the
        facts are summed per month once, without them. Every listed month stands
        for itself (current) and for the month a year before (prior).
        """
        own = [f for f in groups if not f.startswith("Period.")]
        fact_tests = [(f, t) for f, t in tests if not f.startswith("Period.")]
        df = self.context(table, list(dict.fromkeys([*own, "Period.period_key", *[f for f, _ in fact_tests]])))
        for f, test in fact_tests:
            df = df.filter(test(c(f"`{f}`")))
        monthly = df.groupBy(*[c(f"`{f}`") for f in own], c("`Period.period_key`").alias("_month")).agg(
            *[leaf.agg().alias(n) for n, leaf in leaves.items()]
        )
        period = self.tables["Period"]
        first = period.agg(F.min("period_key").alias("_first"))
        months = period.crossJoin(F.broadcast(first)).filter(c("period_key") - 100 >= c("_first"))
        for f, test in tests:
            if f.startswith("Period."):
                months = months.filter(test(c(f.split(".", 1)[1])))
        role = lambda month, name: F.struct(month.alias("_month"), F.lit(name).alias("_role"))
        roles = F.array(role(c("period_key"), "current"), role(c("period_key") - 100, "prior"))
        calendar_fields = [f for f in groups if f.startswith("Period.")]
        months = months.select(F.inline(roles), *[c(f.split(".", 1)[1]).alias(f) for f in calendar_fields])
        return monthly.join(months, "_month").groupBy(*[c(f"`{f}`") for f in groups]).agg(
            *[F.sum(F.when(c("_role") == leaf.mode, c(n))).alias(n) for n, leaf in leaves.items()]
        )

    def evaluate(self, metrics: Sequence[str], by: Sequence[str] = (), where: Sequence[Filter] = ()) -> DataFrame:
        """One row per group with at least one non-empty metric."""
        leaves: dict[int, tuple[str, Leaf]] = {}

        def collect(node) -> None:
            if isinstance(node, Leaf):
                leaves.setdefault(id(node), (f"_m{len(leaves)}", node))
            else:
                for a in node.args:
                    collect(a)

        for name in metrics:
            collect(METRICS[name])
        plans: dict[tuple, dict[str, Leaf]] = {}
        for alias, leaf in leaves.values():
            mode = "year_back" if leaf.mode in ("current", "prior") else leaf.mode
            # a replaced field matters only where it is grouped or filtered by: other leaves share one aggregate
            replaced = tuple(f for f in leaf.replaces if f in by or any(f == w for w, _ in where))
            plans.setdefault((leaf.table, mode, leaf.on, replaced), {})[alias] = leaf

        whole, partial = [], []
        for key, group in plans.items():
            frame = self._frame(key, group, by, where)
            fields = [f for f in by if f in frame.columns]
            (whole if len(fields) == len(by) else partial).append((fields, frame))
        if not whole:
            raise ValueError(f"no metric of {list(metrics)} is related to all of {list(by)}")
        out = whole[0][1]
        if len(whole) > 1:
            stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f for _, f in whole])
            names = [n for n in stacked.columns if n not in by]
            out = stacked.groupBy(*[c(f"`{f}`") for f in by]).agg(*[F.max(n).alias(n) for n in names])
        for fields, frame in partial:
            if not fields:
                out = out.crossJoin(F.broadcast(frame))  # a global aggregate: one row
                continue
            right = frame.select(*[c(f"`{f}`").alias(f"_r_{f}") if f in fields else c(f"`{f}`") for f in frame.columns])
            same = reduce(lambda a, b: a & b, [c(f"`{f}`").eqNullSafe(c(f"`_r_{f}`")) for f in fields])
            out = out.join(right, same, "left").drop(*[f"_r_{f}" for f in fields])

        def value(node) -> Column:
            return c(leaves[id(node)][0]) if isinstance(node, Leaf) else node.fn(*[value(a) for a in node.args])

        result = out.select(*[c(f"`{f}`") for f in by], *[value(METRICS[n]).alias(n) for n in metrics])
        some = reduce(lambda a, b: a | b, [c(f"`{n}`").isNotNull() for n in metrics])
        return result.filter(some) if by else result


def model_tables(reports, forecast: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Table name of the metric model -> report dataset (built on first use)."""
    names = {
        "Period": "dim_period",
        "Date": "date_daily",
        "Division": "division",
        "Revenue Residential": "revenue_residential_monthly",
        "Revenue Commercial": "revenue_commercial_monthly",
        "AR Aging": "ar_aging_monthly",
        "AR Top Accounts": "ar_top_accounts",
        "Payments": "payments_monthly",
        "Digital Adoption": "digital_adoption_monthly",
        "AMI Daily": "ami_daily_profile",
        "Outages": "reliability_events",
        "Work Orders": "work_orders_monthly",
        "Work Order Backlog": "work_order_backlog",
        "Contact Center": "contact_center_daily",
        "Collections Orders": "collections_orders_monthly",
        "Moratorium Compliance": "moratorium_compliance",
        "Payment Plans": "payment_plans_monthly",
        "Billing Exceptions": "billing_exceptions_monthly",
        "Rebills": "rebills_monthly",
        "Service Orders": "service_orders_monthly",
        "Customer 360": "customer_360",
        "Customer Bills": "customer_bills_recent",
        "Data Quality": "data_quality",
    }

    class Tables(dict):
        def __missing__(self, name):
            self[name] = getattr(reports, names[name])
            return self[name]

    return Tables(forecast or {})
