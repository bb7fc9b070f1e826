"""The grouped and detail queries of the report pages, as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.operators.positions import with_positions
from meterstone.plans.metrics import SORT_BY, Filter, MetricModel, column_name

c = F.col


@dataclass(frozen=True)
class Visual:
    page: str
    by: tuple[str, ...]
    metrics: tuple[str, ...] = ()
    order: str | None = None  # field or metric
    descending: bool = False


@dataclass(frozen=True)
class Detail:
    page: str
    table: str
    columns: tuple[str, ...]
    order: str
    descending: bool = False


MONTH, DAY = "Period.year_month", "Date.date"
# The saved reports, their fields and order.
VISUALS: dict[str, Visual | Detail] = {
    "v01": Visual("Revenue & Billing", (MONTH,), ("Residential Revenue", "C&I Revenue"), MONTH),
    "v02": Visual("Revenue & Billing", ("Revenue Residential.elec_rate_code",), ("Residential Revenue",)),
    "v03": Visual("Revenue & Billing", ("Revenue Commercial.elec_rate_code",), ("C&I Revenue",)),
    "v04": Visual("AR Aging", (MONTH, "AR Aging.aging_bucket"), ("AR Balance",), MONTH),
    "v05": Detail("AR Aging", "AR Top Accounts",
                  ("customer_name", "segment", "division", "past_due_amt", "oldest_days_past_due"), "past_due_amt", True),
    "v06": Visual("Payments & Digital", (MONTH,), ("Autopay %", "Paperless %"), MONTH),
    "v07": Visual("Payments & Digital", ("Payments.channel",), ("Payments $",), "Payments $", True),
    "v08": Visual("Usage & AMI", (DAY,), ("Avg Daily kWh per Meter", "Avg Temp (F)"), DAY),
    "v09": Visual("Usage & AMI", ("Date.day_name",), ("Avg Daily kWh per Meter",), "Date.day_name"),
    "v10": Visual("Usage & AMI", ("AMI Daily.elec_rate_code",), ("Avg Daily kWh per Meter",)),
    "v11": Visual("Outage & Reliability", ("Outages.division",), ("SAIDI excl. MED (min)", "SAIDI (min)")),
    "v12": Visual("Outage & Reliability", ("Outages.cause",), ("Customer Minutes",), "Customer Minutes", True),
    "v13": Visual("Outage & Reliability", ("Outages.circuit_id", "Outages.division"),
                  ("Outage Events", "Customer Interruptions", "Customer Minutes"), "Customer Minutes", True),
    "v14": Visual("Outage Forecast", ("Weather Forecast.forecast_date",), ("Forecast Outages", "Max Gust (mph)"),
                  "Weather Forecast.forecast_date"),
    "v15": Detail("Outage Forecast", "Weather Forecast",
                  ("forecast_date", "division", "max_gust_mph", "precip_in", "predicted_outages", "risk_level"), "forecast_date"),
    "v16": Visual("Outage Forecast", ("Outage Backtest.date",), ("Backtest Actual Outages", "Backtest Predicted Outages"),
                  "Outage Backtest.date"),
    "v17": Visual("Outage Forecast", ("Outage Model Bands.band",), ("Historical Outages per 100K",), "Outage Model Bands.band"),
    "v18": Detail("Outage Forecast", "Outage Model Metrics", ("metric", "value"), "metric_order"),
    "v19": Visual("Work Order Backlog", (MONTH, "Work Orders.order_type"), ("Work Orders Created",), MONTH),
    "v20": Visual("Work Order Backlog", ("Work Order Backlog.asset_class",), ("Open Backlog", "Overdue Work Orders"),
                  "Open Backlog", True),
    "v21": Visual("Contact Center", (DAY,), ("Total Contacts",), DAY),
    "v22": Visual("Contact Center", ("Contact Center.reason",), ("Total Contacts",), "Total Contacts", True),
    "v23": Visual("Contact Center", ("Contact Center.channel",), ("Total Contacts",), "Total Contacts", True),
    "v24": Visual("Credit & Collections", (MONTH,), ("Disconnects", "Reconnects"), MONTH),
    "v25": Visual("Credit & Collections", ("Payment Plans.plan_type", "Payment Plans.status"), ("Payment Plans Created",)),
    "v26": Visual("Meter-to-Cash Exceptions", (MONTH,), ("Estimated Bill %", "High-Variance Bill %"), MONTH),
    "v27": Visual("Meter-to-Cash Exceptions", ("Billing Exceptions.elec_rate_code",),
                  ("Bills Reviewed", "Estimated Bill %", "High-Variance Bill %")),
    "v28": Visual("Service Orders", ("Service Orders.order_type",), ("Avg Cycle Days",), "Avg Cycle Days", True),
    "v29": Visual("Service Orders", (MONTH, "Service Orders.order_type"), ("Service Orders Created",), MONTH),
    "v30": Detail("Customer 360", "Customer 360",
                  ("customer_id", "customer_name", "segment", "address_line", "city", "elec_rate_code", "is_autopay",
                   "is_low_income", "open_amt", "past_due_amt"), "past_due_amt", True),
    "v31": Detail("Customer 360", "Customer Bills",
                  ("bill_date", "bill_type", "kwh", "therms", "total_amt", "paid_amt", "due_date"), "bill_date", True),
    "v32": Detail("Data Quality", "Data Quality",
                  ("source_table", "dq_check", "action_taken", "rows_checked", "rows_affected", "pct_affected"), "check_order"),
    "v33": Visual("Data Quality", ("Data Quality.dq_check",), ("Rows Affected",), "Rows Affected", True),
}

# Single-number cards per page.
CARDS = {
    "Revenue & Billing": ("Residential Revenue", "C&I Revenue", "Avg Residential Bill", "Residential Revenue YoY %",
                          "C&I Revenue YoY %"),
    "AR Aging": ("AR Balance", "AR Past Due", "AR % Past Due", "AR 91-180 Days", "Written Off to Date"),
    "Payments & Digital": ("Payments $", "Payment Count", "Digital Payment %", "Autopay %", "Paperless %"),
    "Usage & AMI": ("Avg Daily kWh per Meter", "Read Success %", "Estimated Read %", "Spike Reads", "Avg Temp (F)"),
    "Outage & Reliability": ("SAIDI excl. MED (min)", "SAIFI excl. MED", "CAIDI (min)", "SAIDI (min)", "Major Event Days"),
    "Outage Forecast": ("7-Day Outages", "7-Day Customers Out", "Max Gust (mph)", "Peak Risk Level", "Peak Risk Day",
                        "Forecast Retrieved"),
    "Work Order Backlog": ("Open Backlog", "Overdue Work Orders", "Avg Backlog Age (days)", "On-Time Completion %", "Actual Cost"),
    "Contact Center": ("Total Contacts", "ASA (sec)", "Service Level (30s) %", "AHT (min)", "FCR %", "CSAT (avg)"),
    "Credit & Collections": ("Disconnects", "Reconnect Rate %", "Reconnect Within 1 Day %", "Moratorium Exceptions",
                             "Medical Cert Disconnects", "Plan Default %"),
    "Meter-to-Cash Exceptions": ("Bills Reviewed", "Estimated Bill %", "Consecutive Estimates", "Zero-Usage Bills",
                                 "High-Variance Bill %", "Reversed Bills"),
    "Service Orders": ("Service Orders Created", "Completion %", "Avg Cycle Days", "Open Service Orders"),
    "Customer 360": ("Customers", "Open Balance", "Past Due Balance", "Billed (Last 3 Mo)", "Paid (Last 3 Mo)"),
}


def _lead(column, descending: bool):
    return column.desc_nulls_last() if descending else column.asc_nulls_last()


def _rows(model: MetricModel, v: Visual | Detail, where: Sequence[Filter]) -> tuple[DataFrame, list[str], str | None, list[str]]:
    """Rows of a visual with plain column names, its columns, the column it is ordered by and those that break ties."""
    if isinstance(v, Detail):
        tests = [(f, t) for f, t in where if model.path(v.table, f.rsplit(".", 1)[0]) is not None]
        df = model.context(v.table, [f for f, _ in tests])
        for f, test in tests:
            df = df.filter(test(c(f"`{f}`")))
        keep = list(v.columns) + ([v.order] if v.order not in v.columns else [])
        return df.select(*keep), list(v.columns), v.order, [x for x in v.columns if x != v.order]
    companion = SORT_BY.get(v.order or "")
    extra = f"{v.order.rsplit('.', 1)[0]}.{companion}" if companion else None
    by = [*v.by, extra] if extra else list(v.by)
    df = model.evaluate(v.metrics, by, where)
    plain = {f: f.rsplit(".", 1)[1] for f in by} | {m: column_name(m) for m in v.metrics}
    df = df.select(*[c(f"`{old}`").alias(new) for old, new in plain.items()])
    return df, [*[plain[f] for f in v.by], *[column_name(m) for m in v.metrics]], plain[extra or v.order] if v.order else None, [plain[f] for f in v.by]


def run_visual(model: MetricModel, name: str, where: Sequence[Filter] = ()) -> DataFrame:
    """Rows of one visual in display order, with plain column names.

    Slicers are filters on ``Table.column`` fields. Ties are broken by the
    remaining columns.
    """
    v = VISUALS[name]
    df, columns, order, ties = _rows(model, v, where)
    if order:
        df = df.orderBy(_lead(c(order), v.descending), *[c(t).asc_nulls_last() for t in ties])
    return df.select(*columns)


def placed_visual(model: MetricModel, name: str, where: Sequence[Filter] = ()) -> DataFrame:
    """Rows of one visual that has an order, each with its ``position`` in it: the order survives storage and later steps."""
    v = VISUALS[name]
    df, columns, order, ties = _rows(model, v, where)
    if not order:
        raise ValueError(f"{name} has no order")
    return with_positions(df, [_lead(c(order), v.descending)], "position", ties).select(*columns, "position")


def run_cards(model: MetricModel, metrics: Sequence[str], where: Sequence[Filter] = (), by: Sequence[str] = ()) -> DataFrame:
    """Metrics as one row (or one row per group) with plain column names."""
    df = model.evaluate(metrics, by, where)
    return df.select(
        *[c(f"`{f}`").alias(f.rsplit(".", 1)[1]) for f in by], *[c(f"`{m}`").alias(column_name(m)) for m in metrics]
    )
