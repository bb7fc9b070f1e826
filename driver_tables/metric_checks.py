"""Metric and visual queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_tables.queries import register, reports
from meterstone.plans.metrics import MetricModel, column_name, model_tables
from meterstone.plans.visuals import placed_visual, run_cards, run_visual

YEAR = 2000
DIVISION, PERIOD_YEAR = "Division.division", "Period.year"


def model(w) -> MetricModel:
    if "_model" not in w.__dict__:
        w.__dict__["_model"] = MetricModel(model_tables(reports(w)))
    return w.__dict__["_model"]


def q(top: str, bottom: str, scale: str = "") -> tuple[str, bool]:
    return f"({top})::double / nullif({bottom}, 0){scale}", True


def big(x: str) -> tuple[str, bool]:
    return f"({x})::bigint", False


def usd(x: str) -> tuple[str, bool]:
    return f"({x})::decimal(38,2)", False


def dbl(x: str) -> tuple[str, bool]:
    return x, True


def f(x: str, test: str) -> str:
    return f"{x} FILTER ({test})"


RES, COM = "customer_class LIKE 'Res%'", "customer_class LIKE 'Com%'"
HEADINGS = {
    # key: (source with {part} and {test}, year of a row, {metric: (sql, is_double)}, division column or None)
    "revenue": ("(SELECT * FROM r_revenue WHERE {test})", "period_key // 100", {
        "Residential Revenue": usd(f("sum(total_amt)", RES)), "Residential kWh": dbl(f("sum(kwh)", RES)),
        "Residential Therms": dbl(f("sum(therms)", RES)), "Residential Bills": big(f("sum(bills)", RES)),
        "Avg Residential Bill": q(f("sum(total_amt)", RES), f("sum(bills)", RES)),
        "C&I Revenue": usd(f("sum(total_amt)", COM)), "Total Revenue": usd("sum(total_amt)"),
        "Residential Share %": q(f("sum(total_amt)", RES), "sum(total_amt)"),
        "C&I kWh": dbl(f("sum(kwh)", COM)), "C&I Therms": dbl(f("sum(therms)", COM)),
        "C&I Bills": big(f("sum(bills)", COM)), "Avg C&I Bill": q(f("sum(total_amt)", COM), f("sum(bills)", COM)),
    }, "division"),
    "receivables": ("(SELECT *, month_end = max(month_end) OVER ({part}) AS z FROM w_ar_monthly WHERE {test})", "year(month_end)", {
        "AR Balance": usd(f("sum(open_amt)", "z AND is_receivable")),
        "AR Past Due": usd(f("sum(open_amt)", "z AND is_receivable AND bucket_order > 1")),
        "AR % Past Due": q(f("sum(open_amt)", "z AND is_receivable AND bucket_order > 1"), f("sum(open_amt)", "z AND is_receivable")),
        "AR 91-180 Days": usd(f("sum(open_amt)", "z AND aging_bucket = '91-180'")),
        "Written Off to Date": usd(f("sum(open_amt)", "z AND NOT is_receivable")),
    }, "division"),
    "payments": ("(SELECT * FROM r_payments WHERE {test})", "year(payment_month)", {
        "Payments $": usd("sum(amount)"), "Payment Count": big("sum(payments)"),
        "Digital Payment %": q(f("sum(amount)", "channel IN ('Autopay (ACH)', 'Online', 'Mobile App')"), "sum(amount)"),
        "Energy Assistance $": usd(f("sum(amount)", "channel = 'Energy Assistance'")),
    }, "division"),
    "adoption": ("(SELECT *, month_end = max(month_end) OVER ({part}) AS z FROM r_adoption WHERE {test})", "year(month_end)", {
        "Active Customers": big(f("sum(active_customers)", "z")),
        "Autopay %": q(f("sum(autopay_customers)", "z"), f("sum(active_customers)", "z")),
        "Paperless %": q(f("sum(paperless_customers)", "z"), f("sum(active_customers)", "z")),
    }, "division"),
    "usage": ("(SELECT * FROM r_ami WHERE {test})", "year(read_date)", {
        "Avg Daily kWh per Meter": q("sum(kwh_valid)", "sum(reads_valid)"),
        "Read Success %": q("sum(meters_reporting)", "sum(meters_expected)"),
        "Estimated Read %": q("sum(reads_estimated)", "sum(meters_expected)"), "Spike Reads": big("sum(reads_spike)"),
    }, "division"),
    "calendar": ("(SELECT *, year AS y FROM r_date WHERE {test})", "year", {
        "Avg Temp (F)": dbl("avg(temp_avg_f)"), "Cooling Degree Days": dbl("sum(cooling_degree_days)"),
        "Heating Degree Days": dbl("sum(heating_degree_days)"), "Major Event Days": big("count(*) FILTER (is_major_event_day)"),
    }, None),
    "reliability": (
        "(SELECT o.*, d.customers_served AS own, sum(d.customers_served) OVER () AS x FROM r_outages o JOIN r_division d USING (division) WHERE {test})",
        "year(outage_date)", {}, "division"),
    "work_orders": ("(SELECT * FROM r_work_orders WHERE {test})",
                    "year(created_month)", {
        "Work Orders Created": big("sum(work_orders)"), "On-Time Completion %": q("sum(finished_on_time)", "sum(finished)"),
        "Planned Cost": usd("sum(planned_cost)"), "Actual Cost": usd("sum(actual_cost)"),
    }, "division"),
    "backlog": ("(SELECT *, 2000 AS y FROM r_backlog WHERE {test})", "2000", {
        "Open Backlog": big("count(*)"), "Overdue Work Orders": big("count(*) FILTER (is_overdue)"),
        "Avg Backlog Age (days)": dbl("avg(open_age_days)"),
    }, "division"),
    "contacts": ("(SELECT * FROM r_contacts WHERE {test})", "year(interaction_date)", {
        "Total Contacts": big("sum(contacts)"),
        "ASA (sec)": q(f("sum(wait_sec_total)", "channel = 'Phone - Agent'"), "sum(agent_calls)"),
        "Service Level (30s) %": q("sum(answered_within_30s)", "sum(agent_calls)"),
        "AHT (min)": q(f("sum(handle_sec_total)", "is_assisted"), f("sum(contacts)", "is_assisted"), " / 60"),
        "FCR %": q("sum(resolved_first_contact)", "sum(contacts)"), "CSAT (avg)": q("sum(csat_total)", "sum(csat_responses)"),
        "Self-Service %": q(f("sum(contacts)", "NOT is_assisted"), "sum(contacts)"),
    }, None),
    "collections": ("(SELECT * FROM r_collections WHERE {test})", "year(created_month)", {
        "Disconnects": big(f("sum(orders)", "order_type LIKE 'Disc%' AND status = 'Completed'")),
        "Reconnects": big(f("sum(orders)", "order_type = 'Reconnect' AND status = 'Completed'")),
        "Reconnect Rate %": q(f("sum(orders)", "order_type = 'Reconnect' AND status = 'Completed'"),
                              f("sum(orders)", "order_type LIKE 'Disc%' AND status = 'Completed'")),
        "Reconnect Within 1 Day %": q(f("sum(completed_within_1_day)", "order_type = 'Reconnect' AND status = 'Completed'"),
                                      f("sum(orders)", "order_type = 'Reconnect' AND status = 'Completed'")),
    }, "division"),
    "moratorium": ("(SELECT * FROM r_moratorium WHERE {test})", "2000", {
        "Moratorium Exceptions": big("coalesce(sum(disconnects_completed) FILTER (is_winter_moratorium AND segment = 'Residential'), 0)"),
        "Medical Cert Disconnects": big("coalesce(sum(disconnects_completed) FILTER (has_medical_cert), 0)"),
    }, None),
    "plans": ("(SELECT * FROM r_plans WHERE {test})", "year(created_month)", {
        "Payment Plans Created": big("sum(plans)"),
        "Plan Default %": q(f("sum(plans)", "status = 'Defaulted'"), f("sum(plans)", "status IN ('Completed', 'Defaulted')")),
    }, "division"),
    "exceptions": ("(SELECT * FROM r_exceptions WHERE {test})", "year(bill_month)", {
        "Bills Reviewed": big("sum(bills)"), "Estimated Bill %": q("sum(elec_estimated)", "sum(bills)"),
        "Consecutive Estimates": big("sum(consecutive_estimates)"), "Zero-Usage Bills": big("sum(zero_usage_bills)"),
        "High-Variance Bill %": q("sum(high_variance_bills)", "sum(bills)"),
    }, "division"),
    "rebills": ("(SELECT * FROM r_rebills WHERE {test})", "year(reversal_month)", {
        "Reversed Bills": big("sum(reversed_bills)"), "Reversed $": usd("sum(reversed_amt)"),
    }, None),
    "service_orders": ("(SELECT * FROM r_service WHERE {test})", "year(created_month)", {
        "Service Orders Created": big("sum(orders)"), "Avg Cycle Days": q("sum(cycle_days_total)", "sum(completed)"),
        "Completion %": q("sum(completed)", "sum(orders)"), "Open Service Orders": big("sum(open_orders)"),
    }, "division"),
    "customers": ("(SELECT * FROM r_customer_360 WHERE {test})", "2000", {
        "Customers": big("count(*)"), "Open Balance": usd("sum(open_amt)"), "Past Due Balance": usd("sum(past_due_amt)"),
    }, "division"),
    "recent_bills": ("(SELECT b.*, division FROM r_bills_recent b LEFT JOIN w_customer c USING (customer_id) WHERE {test})", "2000", {
        "Billed (Last 3 Mo)": usd("sum(total_amt)"), "Paid (Last 3 Mo)": usd("sum(paid_amt)"),
    }, "division"),
    "top_accounts": ("(SELECT * FROM r_ar_top WHERE {test})", "2000", {"Top Accounts Past Due": usd("sum(past_due_amt)")}, "division"),
    "quality": ("(SELECT * FROM r_dq WHERE {test})", "2000", {"Rows Affected": big("sum(rows_affected)")}, None),
}
_R = "customer_minutes", "customers_out"


def _reliability(served: str) -> dict[str, tuple[str, bool]]:
    calm = "NOT is_major_event_day"
    return {
        "Outage Events": big("count(*)"), "Customer Minutes": big("sum(customer_minutes)"),
        "Customer Interruptions": big("sum(customers_out)"), "Customers Served": big(served),
        "SAIDI (min)": q("sum(customer_minutes)", served), "SAIFI": q("sum(customers_out)", served),
        "CAIDI (min)": q("sum(customer_minutes)", "sum(customers_out)"),
        "SAIDI excl. MED (min)": q(f("sum(customer_minutes)", calm), served),
        "SAIFI excl. MED": q(f("sum(customers_out)", calm), served),
    }


def _heading(key: str) -> None:
    source, year, exprs, division = HEADINGS[key]
    card = exprs or _reliability("(SELECT sum(customers_served) FROM r_division)")
    grouped = exprs or _reliability("any_value(own)")
    names = list(card)

    def select(items) -> str:
        return ", ".join(f"{e} AS {column_name(n)}" for n, (e, _) in items.items())

    doubles = " ".join(column_name(n) for n, (_, is_double) in card.items() if is_double)
    register(f"metrics_{key}", lambda w: run_cards(model(w), names),
             f"SELECT {select(card)} FROM {source.format(part='', test='true')} t", doubles)
    if division:
        test = f"{year} = {YEAR}"
        sql = lambda test: f"SELECT division, {select(grouped)} FROM {source.format(part='PARTITION BY division', test=test)} t GROUP BY division"
        register(f"metrics_{key}_by_division", lambda w: run_cards(model(w), names, by=[DIVISION]), sql("true"), doubles)
        if year != "2000":
            register(f"metrics_{key}_by_division_of_year",
                     lambda w: run_cards(model(w), names, [(PERIOD_YEAR, lambda y: y == YEAR)], [DIVISION]), sql(test), doubles)


for _key in HEADINGS:
    _heading(_key)

# metrics whose own filter replaces the grouped field: shares of the whole
register(
    "metrics_contacts_by_channel",
    lambda w: run_cards(model(w), ["Total Contacts", "ASA (sec)", "Self-Service %"], by=["Contact Center.channel"]),
    """SELECT channel, sum(contacts)::bigint AS total_contacts,
              (SELECT sum(wait_sec_total) FROM r_contacts WHERE channel = 'Phone - Agent')::double / nullif(sum(agent_calls), 0) AS asa_sec,
              sum(contacts) FILTER (NOT is_assisted)::double / sum(contacts) AS self_service_pct
       FROM r_contacts GROUP BY channel""", "asa_sec self_service_pct")
register(
    "metrics_digital_by_channel",
    lambda w: run_cards(model(w), ["Payments $", "Digital Payment %"], by=["Payments.channel"]),
    """SELECT channel, sum(amount)::decimal(38,2) AS payments_usd,
              (SELECT sum(amount) FROM r_payments WHERE channel IN ('Autopay (ACH)', 'Online', 'Mobile App'))::double / sum(amount) AS digital_payment_pct
       FROM r_payments GROUP BY channel""", "digital_payment_pct")
register(
    "metrics_calendar_by_year",
    lambda w: run_cards(model(w), list(HEADINGS["calendar"][2]), by=[PERIOD_YEAR]),
    """SELECT year, avg(temp_avg_f) AS avg_temp_f, sum(cooling_degree_days) AS cooling_degree_days,
              sum(heating_degree_days) AS heating_degree_days, count(*) FILTER (is_major_event_day) AS major_event_days
       FROM r_date GROUP BY year""", "avg_temp_f cooling_degree_days heating_degree_days")

_YOY = ["Residential Revenue YoY %", "C&I Revenue YoY %"]


def _yoy_sql(months: str, group: str = "") -> str:
    part = lambda cls: (f"(coalesce(sum(total_amt) FILTER ({cls} AND period_key IN {months}), 0) - sum(total_amt) FILTER ({cls} AND period_key + 100 IN {months}))::double"
                        f" / sum(total_amt) FILTER ({cls} AND period_key + 100 IN {months})")
    lead, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"SELECT {lead}{part(RES)} AS residential_revenue_yoy_pct, {part(COM)} AS c_and_i_revenue_yoy_pct FROM r_revenue{tail}"


_D = "residential_revenue_yoy_pct c_and_i_revenue_yoy_pct"
_ALL = "(SELECT period_key FROM r_period WHERE period_key - 100 >= (SELECT min(period_key) FROM r_period))"
register("metrics_revenue_yoy", lambda w: run_cards(model(w), _YOY), _yoy_sql(_ALL), _D)
register("metrics_revenue_yoy_by_division", lambda w: run_cards(model(w), _YOY, by=[DIVISION]), _yoy_sql(_ALL, "division"), _D)
for _class in ("Residential", "Commercial"):
    _cls, _name = (RES, "residential_revenue_yoy_pct") if _class == "Residential" else (COM, "c_and_i_revenue_yoy_pct")
    register(f"metrics_revenue_yoy_{_class.lower()}_by_rate",
             lambda w, n=_class: run_cards(model(w), [_YOY[n == "Commercial"]], by=[f"Revenue {n}.elec_rate_code"]),
             f"""SELECT elec_rate_code, (coalesce(sum(total_amt) FILTER (period_key IN {_ALL}), 0) - sum(total_amt) FILTER (period_key + 100 IN {_ALL}))::double
                 / nullif(sum(total_amt) FILTER (period_key + 100 IN {_ALL}), 0) AS {_name} FROM r_revenue WHERE {_cls} GROUP BY ALL HAVING {_name} IS NOT NULL""", _name)
register("metrics_revenue_yoy_of_year",
         lambda w: run_cards(model(w), _YOY, [(PERIOD_YEAR, lambda y: y == 2001)]),
         _yoy_sql(_ALL[:-1] + " AND year = 2001)"), _D)
register(
    "metrics_revenue_yoy_by_year", lambda w: run_cards(model(w), _YOY, by=[PERIOD_YEAR]),
    f"""SELECT year, (coalesce(sum(a) FILTER ({RES}), 0) - sum(b) FILTER ({RES}))::double / sum(b) FILTER ({RES}) AS residential_revenue_yoy_pct,
               (coalesce(sum(a) FILTER ({COM}), 0) - sum(b) FILTER ({COM}))::double / sum(b) FILTER ({COM}) AS c_and_i_revenue_yoy_pct
        FROM (SELECT year, customer_class, total_amt AS a, NULL AS b FROM r_period JOIN r_revenue USING (period_key)
              WHERE period_key IN {_ALL}
              UNION ALL SELECT p.year, customer_class, NULL, total_amt FROM r_period p JOIN r_revenue r ON r.period_key = p.period_key - 100
              WHERE p.period_key IN {_ALL}) u GROUP BY year""", _D)

# ------------------------------------------------------------------ visuals
_MIN = "sum(customer_minutes)"
_SERVED = "(SELECT sum(customers_served) FROM r_division)"
VISUAL_SQL = {
    "v01": (f"""SELECT year_month, {usd(f('sum(total_amt)', RES))[0]} AS residential_revenue, {usd(f('sum(total_amt)', COM))[0]} AS c_and_i_revenue
                FROM r_revenue LEFT JOIN r_period USING (period_key) GROUP BY year_month""", ""),
    "v02": ("SELECT elec_rate_code, sum(total_amt)::decimal(38,2) AS residential_revenue FROM r_revenue_res GROUP BY ALL", ""),
    "v03": ("SELECT elec_rate_code, sum(total_amt)::decimal(38,2) AS c_and_i_revenue FROM r_revenue_com GROUP BY ALL", ""),
    "v04": ("""SELECT year_month, aging_bucket, sum(open_amt)::decimal(38,2) AS ar_balance
               FROM w_ar_monthly JOIN r_period USING (month_end) WHERE is_receivable GROUP BY ALL""", ""),
    "v05": ("SELECT customer_name, segment, division, past_due_amt, oldest_days_past_due FROM r_ar_top", ""),
    "v06": ("""SELECT year_month, sum(autopay_customers)::double / sum(active_customers) AS autopay_pct,
                      sum(paperless_customers)::double / sum(active_customers) AS paperless_pct
               FROM r_adoption JOIN r_period USING (month_end) GROUP BY ALL""", "autopay_pct paperless_pct"),
    "v07": ("SELECT channel, sum(amount)::decimal(38,2) AS payments_usd FROM r_payments GROUP BY ALL", ""),
    "v08": ("""SELECT date, kwh AS avg_daily_kwh_per_meter, temp_avg_f AS avg_temp_f
               FROM r_date LEFT JOIN (SELECT read_date AS date, sum(kwh_valid) / nullif(sum(reads_valid), 0) AS kwh FROM r_ami GROUP BY ALL) a USING (date)
               WHERE kwh IS NOT NULL OR temp_avg_f IS NOT NULL""", "avg_daily_kwh_per_meter avg_temp_f"),
    "v09": ("""SELECT day_name, sum(kwh_valid) / nullif(sum(reads_valid), 0) AS avg_daily_kwh_per_meter
               FROM r_ami JOIN r_date ON date = read_date GROUP BY ALL""", "avg_daily_kwh_per_meter"),
    "v10": ("SELECT elec_rate_code, sum(kwh_valid) / nullif(sum(reads_valid), 0) AS avg_daily_kwh_per_meter FROM r_ami GROUP BY ALL",
            "avg_daily_kwh_per_meter"),
    "v11": (f"""SELECT division, {_MIN} FILTER (NOT is_major_event_day)::double / {_SERVED} AS saidi_excl_med_min,
                       {_MIN}::double / {_SERVED} AS saidi_min FROM r_outages GROUP BY division""", "saidi_excl_med_min saidi_min"),
    "v12": (f"SELECT cause, {_MIN}::bigint AS customer_minutes FROM r_outages GROUP BY ALL", ""),
    "v13": (f"""SELECT circuit_id, division, count(*) AS outage_events, sum(customers_out)::bigint AS customer_interruptions,
                       {_MIN}::bigint AS customer_minutes FROM r_outages GROUP BY ALL""", ""),
    "v19": ("""SELECT year_month, order_type, sum(work_orders)::bigint AS work_orders_created
               FROM r_work_orders LEFT JOIN r_period ON month_start = created_month GROUP BY ALL""", ""),
    "v20": ("""SELECT asset_class, count(*) AS open_backlog, count(*) FILTER (is_overdue) AS overdue_work_orders
               FROM r_backlog GROUP BY ALL""", ""),
    "v21": ("SELECT interaction_date AS date, sum(contacts)::bigint AS total_contacts FROM r_contacts GROUP BY ALL", ""),
    "v22": ("SELECT reason, sum(contacts)::bigint AS total_contacts FROM r_contacts GROUP BY ALL", ""),
    "v23": ("SELECT channel, sum(contacts)::bigint AS total_contacts FROM r_contacts GROUP BY ALL", ""),
    "v24": ("""SELECT * FROM (SELECT year_month, sum(orders) FILTER (order_type LIKE 'Disc%' AND status = 'Completed')::bigint AS disconnects,
                      sum(orders) FILTER (order_type = 'Reconnect' AND status = 'Completed')::bigint AS reconnects
               FROM r_collections LEFT JOIN r_period ON month_start = created_month GROUP BY ALL)
               WHERE disconnects IS NOT NULL OR reconnects IS NOT NULL""", ""),
    "v25": ("SELECT plan_type, status, sum(plans)::bigint AS payment_plans_created FROM r_plans GROUP BY ALL", ""),
    "v26": ("""SELECT year_month, sum(elec_estimated)::double / sum(bills) AS estimated_bill_pct,
                      sum(high_variance_bills)::double / sum(bills) AS high_variance_bill_pct
               FROM r_exceptions LEFT JOIN r_period ON month_start = bill_month GROUP BY ALL""", "estimated_bill_pct high_variance_bill_pct"),
    "v27": ("""SELECT elec_rate_code, sum(bills)::bigint AS bills_reviewed, sum(elec_estimated)::double / sum(bills) AS estimated_bill_pct,
                      sum(high_variance_bills)::double / sum(bills) AS high_variance_bill_pct
               FROM r_exceptions GROUP BY ALL""", "estimated_bill_pct high_variance_bill_pct"),
    "v28": ("""SELECT order_type, sum(cycle_days_total)::double / sum(completed) AS avg_cycle_days FROM r_service
               GROUP BY ALL HAVING sum(completed) > 0""", "avg_cycle_days"),
    "v29": ("""SELECT year_month, order_type, sum(orders)::bigint AS service_orders_created
               FROM r_service LEFT JOIN r_period ON month_start = created_month GROUP BY ALL""", ""),
    "v30": ("""SELECT customer_id, customer_name, segment, address_line, city, elec_rate_code, is_autopay, is_low_income, open_amt,
                      past_due_amt FROM r_customer_360""", ""),
    "v31": ("""SELECT bill_date, bill_type, kwh, therms, total_amt, paid_amt, due_date FROM r_bills_recent
               LEFT JOIN r_customer_360 USING (customer_id) WHERE {test}""", "kwh therms"),
    "v32": ("SELECT source_table, dq_check, action_taken, rows_checked, rows_affected, pct_affected FROM r_dq", ""),
    "v33": ("SELECT dq_check, rows_affected FROM r_dq", ""),
}


def _visual(name: str) -> None:
    sql, doubles = VISUAL_SQL[name]
    register(f"visual_{name}", lambda w: run_visual(model(w), name), sql.replace("{test}", "true"), doubles)


for _name in VISUAL_SQL:
    _visual(_name)

# The display order of each saved visual that has one, written out.
_MONTH = "(SELECT any_value(p.period_key) FROM r_period p WHERE p.year_month = q.year_month), year_month"
PLACES = {
    "v01": _MONTH, "v04": f"{_MONTH}, aging_bucket", "v06": _MONTH, "v19": f"{_MONTH}, order_type", "v24": _MONTH, "v26": _MONTH,
    "v29": f"{_MONTH}, order_type", "v05": "past_due_amt DESC NULLS LAST, customer_name, segment, division, oldest_days_past_due",
    "v07": "payments_usd DESC NULLS LAST, channel", "v08": "date",
    "v09": "(SELECT any_value(d.day_of_week) FROM r_date d WHERE d.day_name = q.day_name), day_name",
    "v12": "customer_minutes DESC NULLS LAST, cause", "v13": "customer_minutes DESC NULLS LAST, circuit_id, division",
    "v20": "open_backlog DESC NULLS LAST, asset_class", "v21": "date", "v22": "total_contacts DESC NULLS LAST, reason",
    "v23": "total_contacts DESC NULLS LAST, channel", "v28": "avg_cycle_days DESC NULLS LAST, order_type",
    "v30": "past_due_amt DESC NULLS LAST, customer_id, customer_name, segment, address_line, city, elec_rate_code, is_autopay, is_low_income, open_amt",
    "v31": "bill_date DESC NULLS LAST, bill_type, kwh, therms, total_amt, paid_amt, due_date",
    "v32": "(SELECT any_value(d.check_order) FROM r_dq d WHERE d.dq_check = q.dq_check), source_table, dq_check",
    "v33": "rows_affected DESC NULLS LAST, dq_check",
}


def placed(name: str, order: str, model_of, sql: str, doubles: str) -> None:
    register(f"visual_{name}_placed", lambda w: placed_visual(model_of(w), name), f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql}) q", doubles)


for _name, _order in PLACES.items():
    placed(_name, _order, model, VISUAL_SQL[_name][0].replace("{test}", "true"), VISUAL_SQL[_name][1])

# the customer page: a name or an id is searched; every report on the page and its cards take the filter
_NAME = [("Customer 360.customer_name", lambda n: F.lower(n).contains("pat1"))]
_FOUND = "lower(customer_name) LIKE '%pat1%'"
register("visual_v30_search", lambda w: run_visual(model(w), "v30", _NAME), VISUAL_SQL["v30"][0] + f" WHERE {_FOUND}")
register("visual_v31_search", lambda w: run_visual(model(w), "v31", _NAME), VISUAL_SQL["v31"][0].replace("{test}", _FOUND), "kwh therms")
for _key in ("customers", "recent_bills"):
    _names, _expr = list(HEADINGS[_key][2]), ", ".join(f"{e} AS {column_name(n)}" for n, (e, _) in HEADINGS[_key][2].items())
    _from = "r_customer_360" if _key == "customers" else "r_bills_recent LEFT JOIN r_customer_360 USING (customer_id)"
    register(f"metrics_{_key}_search", lambda w, n=_names: run_cards(model(w), n, _NAME), f"SELECT {_expr} FROM {_from} WHERE {_FOUND}")

# the per-division index, next to the saved report's contribution (v11)
register(
    "reliability_index_by_division",
    lambda w: run_cards(model(w), ["SAIDI (min)", "SAIFI", "CAIDI (min)"], by=[DIVISION]),
    """SELECT division, sum(customer_minutes)::double / any_value(customers_served) AS saidi_min,
              sum(customers_out)::double / any_value(customers_served) AS saifi,
              sum(customer_minutes)::double / sum(customers_out) AS caidi_min
       FROM r_outages JOIN r_division USING (division) GROUP BY division""", "saidi_min saifi caidi_min")
