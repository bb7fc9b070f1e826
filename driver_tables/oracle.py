"""Check SQL: named building blocks for DuckDB and a composer.

Blocks ``s_*`` are staging, ``w_*`` warehouse, ``r_*`` report datasets. They are
written for DuckDB (as-of joins, FILTER, inequality joins) and independently of
how the Spark side computes the same rows. ``compose`` prefixes a query with
the blocks it mentions.
"""

from __future__ import annotations

import re

from driver_tables.extracts import EXTRACTS, TABLES
from meterstone.functions import codes
from meterstone.plans.quality import CHECKS

# Fixed values of the check, written out here and not taken from the engine's settings.
AS_OF = "date '2001-07-31'"
FROM_DAY = "date '1999-08-01'"
TO_DAY = "date '2001-07-31'"


def decode(column: str, table: dict[str, str], default: str | None = None) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    other = "NULL" if default is None else f"'{default}'"
    return f"CASE upper(rtrim({column})) {whens} ELSE {other} END"


def flag(column: str, value: str) -> str:
    return f"coalesce(upper(rtrim({column})) = '{value}', false)"


_CAPS = "coalesce(NAME_LAST = upper(NAME_LAST) AND length(rtrim(NAME_LAST)) > 1, false)"

BLOCKS: dict[str, str] = {name: text.format(**{t: t for t in TABLES}) for name, text in EXTRACTS.items()}

BLOCKS |= {
    # ---- staging
    "s_customer": f"""
        SELECT PARTNER AS customer_id, VKONT AS account_id,
               if(TYPE = '1', 'Person', 'Organization') AS customer_type, BU_GROUP AS segment_code,
               {decode("BU_GROUP", codes.SEGMENTS)} AS segment,
               if(TYPE = '1', NAME_FIRST || ' ' || if({_CAPS}, upper(NAME_LAST[1]) || lower(NAME_LAST[2:]), NAME_LAST),
                  NAME_ORG1) AS customer_name,
               CRDAT AS created_date, if(rtrim(SMTP_ADDR) = '', NULL, SMTP_ADDR) AS email, phone,
               coalesce(rtrim(SMTP_ADDR) <> '', false) AS has_email, phone IS NOT NULL AS has_phone,
               {flag("EZAWE", "D")} AS is_autopay, ZAUTOPAY_DATE AS autopay_date,
               {flag("ZEBILL", "X")} AS is_paperless, ZEBILL_DATE AS paperless_date,
               {flag("ZBUDGET_BILL", "X")} AS is_budget_billing, {flag("ZLOW_INCOME", "X")} AS is_low_income,
               {flag("ZMED_CERT", "X")} AS has_medical_cert, {_CAPS} AS dq_name_fixed,
               coalesce(NOT regexp_full_match(rtrim(TEL_NUMBER), '\\([0-9]{{3}}\\) [0-9]{{3}}-[0-9]{{4}}'), false) AS dq_phone_reformatted
        FROM (SELECT *, regexp_replace(coalesce(TEL_NUMBER, ''), '[-()+ ]', '', 'g') AS n,
                     CASE WHEN length(n) = 10 THEN n WHEN length(n) = 11 AND n[1] = '1' THEN n[2:] END AS phone
              FROM BUT000) p JOIN FKKVKP ON GPART = PARTNER""",
    "s_premise": """
        SELECT VSTELLE AS premise_id, VBSART AS premise_type,
               coalesce(HOUSE_NUM1::varchar, '') || ' ' || coalesce(STREET, '') || coalesce(' ' || HOUSE_NUM2, '') AS address_line,
               t.CITY AS city, t.ZIP AS zip, t.COUNTY AS county, t.DIVISION AS division,
               GEO_LAT AS latitude, GEO_LON AS longitude,
               length(rtrim(POST_CODE1)) < 5 AS dq_zip_fixed, CITY1 <> t.CITY AS dq_city_fixed
        FROM EVBS JOIN ADRC USING (ADDRNUMBER) JOIN towns t ON t.ZIP = right('00000' || trim(POST_CODE1), 5)""",
    "s_installation": f"""
        SELECT i.ANLAGE AS installation_id, VSTELLE AS premise_id, {decode("i.SPARTE", codes.COMMODITIES)} AS commodity,
               TARIFTYP AS rate_code, ABLEINH AS read_route, AKLASSE AS rate_class, EQUNR AS meter_id,
               HERST AS meter_manufacturer, ZMETER_TECH AS meter_technology, INBDT AS meter_install_date
        FROM EANL i LEFT JOIN EQUI m ON i.ANLAGE = m.ANLAGE""",
    "s_contract": f"""
        SELECT VERTRAG AS contract_id, ANLAGE AS installation_id, VKONTO AS account_id, EINZDAT AS move_in_date,
               if(AUSZDAT >= date '9999-12-31', NULL, AUSZDAT) AS move_out_date, AUSZDAT >= date '9999-12-31' AS is_active,
               {decode("ZSUPPLIER", codes.SUPPLIERS, codes.OTHER_SUPPLIER)} AS supplier
        FROM EVER""",
    "s_bill": f"""
        SELECT BELNR AS bill_id, VKONT AS account_id, GPART AS customer_id, VSTELLE AS premise_id,
               {decode("ABRVORG", codes.BILL_TYPES)} AS bill_type, BUDAT AS bill_date, BEGABRPE AS period_start,
               ENDABRPE AS period_end, (ENDABRPE - BEGABRPE)::int AS billing_days, FAEDN AS due_date,
               STORNODAT AS reversal_date, STORNODAT IS NOT NULL AS is_reversed, ELEC_TARIF AS elec_rate_code, KWH AS kwh,
               {flag("ELEC_EST", "X")} AS elec_estimated,
               {decode("ELEC_SUPPLIER", codes.SUPPLIERS, codes.OTHER_SUPPLIER)} AS elec_supplier,
               if(rtrim(GAS_TARIF) = '', NULL, GAS_TARIF) AS gas_rate_code, THERMS AS therms,
               {flag("GAS_EST", "X")} AS gas_estimated, ELEC_DELIV_AMT AS elec_delivery_amt,
               ELEC_SUPPLY_AMT AS elec_supply_amt, GAS_DELIV_AMT AS gas_delivery_amt, GAS_SUPPLY_AMT AS gas_supply_amt,
               TAX_AMT AS tax_amt, TOTAL_AMT AS total_amt
        FROM ERCH""",
    "s_payment": f"""
        SELECT PAYMENT_ID AS payment_id, VKONT AS account_id, BELNR AS bill_id, BUDAT AS payment_date, BETRZ AS amount,
               PAY_CHANNEL AS channel_code, {decode("PAY_CHANNEL", codes.PAYMENT_CHANNELS)} AS channel, copies AS dup_rows
        FROM (SELECT *, count(*) OVER (PARTITION BY PAYMENT_ID) AS copies FROM DFKKZP
              QUALIFY row_number() OVER (PARTITION BY PAYMENT_ID ORDER BY VKONT, BELNR, BUDAT, BETRZ, PAY_CHANNEL) = 1) z""",
    "s_payment_plan": f"""
        SELECT PLAN_ID AS plan_id, VKONT AS account_id,
               {decode("PLAN_TYPE", codes.PLAN_TYPES, codes.OTHER_PLAN_TYPE)} AS plan_type, ERDAT AS created_date,
               TOTAL_AMT AS total_amt, DOWN_PAYMENT AS down_payment, NUM_INSTALLMENTS AS num_installments,
               {decode("STATUS", codes.PLAN_STATUSES)} AS status
        FROM ZINSTPLAN""",
    "s_service_order": f"""
        SELECT ORDER_ID AS order_id, ORDER_TYPE AS order_type_code,
               {decode("ORDER_TYPE", codes.SERVICE_ORDER_TYPES)} AS order_type, VSTELLE AS premise_id, VKONT AS account_id,
               ERDAT::timestamp + to_seconds(ERZEIT) AS created_at, ERDAT AS created_date, SCHED_DATE AS scheduled_date,
               COMPL_DATE AS completed_date, {decode("STATUS", codes.SERVICE_ORDER_STATUSES)} AS status,
               WORK_CENTER AS work_center, (COMPL_DATE - ERDAT)::int AS cycle_days
        FROM ZSRVORD""",
    "s_work_order": f"""
        SELECT AUFNR AS work_order_id, AUART AS order_type_code, {decode("AUART", codes.WORK_ORDER_TYPES)} AS order_type,
               KTEXT AS description, ASSET_CLASS AS asset_class, if(TPLNR ILIKE 'g-%', 'Gas', 'Electric') AS commodity,
               TPLNR AS functional_location, ARBPL AS work_center, PRIOK::int AS priority, ERDAT AS created_date,
               GSTRP AS planned_start, GLTRP AS planned_finish, GETRI AS actual_finish,
               {decode("STAT", codes.WORK_ORDER_STATUSES)} AS status, STAT IN ('CRTD', 'REL') AS is_open,
               PLAN_COST AS planned_cost, ACT_COST AS actual_cost, ZDIVISION AS division, ZMUNI AS municipality
        FROM AUFK""",
    "s_outage": """
        SELECT EVENT_ID AS outage_id, EVENT_START AS outage_start, RESTORE_TIME AS restore_time,
               EVENT_START::date AS outage_date, date_diff('minute', EVENT_START, RESTORE_TIME)::int AS duration_min,
               RESTORE_TIME IS NULL AS is_open, DIVISION AS division, MUNICIPALITY AS municipality,
               CIRCUIT_ID AS circuit_id, DEVICE_TYPE AS device_type, CAUSE AS cause, CUSTOMERS_OUT AS customers_out,
               CUSTOMER_MINUTES AS customer_minutes
        FROM outage_events""",
    "s_interaction": """
        SELECT INTERACTION_ID AS interaction_id, CREATED_TS AS created_at, CREATED_TS::date AS interaction_date,
               hour(CREATED_TS)::int AS interaction_hour, CHANNEL AS channel,
               CHANNEL IN ('Phone - Agent', 'Chat', 'Email') AS is_assisted, REASON AS reason, BP_ID AS customer_id,
               BP_ID IS NOT NULL AS is_identified, WAIT_SEC AS wait_sec, HANDLE_SEC AS handle_sec,
               coalesce(FCR = 'Y', false) AS first_contact_resolved, coalesce(TRANSFERRED = 'Y', false) AS transferred,
               CSAT::int AS csat, nullif(AGENT_ID, '') AS agent_id, nullif(SITE, '') AS site
        FROM interactions""",
    "s_ami_read": """
        SELECT METER_ID AS meter_id, READ_DATE AS read_date, KWH AS kwh, PEAK_KW AS peak_kw,
               READ_QUALITY AS read_quality, READ_QUALITY = 'MISSING' AS is_missing
        FROM daily_reads""",
    "s_weather": """
        SELECT OBS_DATE AS weather_date, TAVG_F AS temp_avg_f, TMAX_F AS temp_max_f, TMIN_F AS temp_min_f,
               PRECIP_IN AS precip_in, MAX_GUST_MPH AS max_gust_mph, HDD AS heating_degree_days, CDD AS cooling_degree_days
        FROM daily_weather""",
    "s_rate": f"""
        SELECT RATE_CODE AS rate_code, COMMODITY AS commodity, {decode("RATE_CLASS", codes.RATE_CLASSES)} AS rate_class,
               DESCRIPTION AS rate_description, UNIT AS unit, CUSTOMER_CHARGE AS customer_charge,
               DELIVERY_PER_UNIT AS delivery_per_unit, SUPPLY_PER_UNIT AS supply_per_unit
        FROM rate_schedules""",
    # ---- warehouse
    "w_calendar": f"""
        SELECT d AS date, year(d)::int AS year, quarter(d)::int AS quarter, month(d)::int AS month_num,
               monthname(d) AS month_name, monthname(d)[:3] AS month_short, strftime(d, '%Y-%m') AS year_month,
               date_trunc('month', d)::date AS month_start, last_day(d) AS month_end, isodow(d)::int AS day_of_week,
               dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend,
               strftime(d, '%m%d') >= '1115' OR strftime(d, '%m%d') <= '0315' AS is_winter_moratorium,
               d >= {FROM_DAY} AND d <= {TO_DAY} AS is_in_window
        FROM (SELECT unnest(generate_series(date '1994-01-01', date '2002-12-31', interval 1 day))::date AS d) x""",
    "w_premise": """
        SELECT p.* EXCLUDE (dq_zip_fixed, dq_city_fixed), e.rate_code AS elec_rate_code, e.read_route,
               e.meter_id AS elec_meter_id, e.meter_manufacturer AS elec_meter_manufacturer,
               e.meter_technology AS elec_meter_technology, g.premise_id IS NOT NULL AS has_gas,
               g.rate_code AS gas_rate_code, g.meter_technology AS gas_meter_technology, dq_zip_fixed, dq_city_fixed
        FROM s_premise p
        JOIN (FROM s_installation WHERE commodity = 'Electric') e USING (premise_id)
        LEFT JOIN (FROM s_installation WHERE commodity = 'Gas') g USING (premise_id)""",
    "w_geography": """
        SELECT t.CITY AS city, t.ZIP AS zip, t.COUNTY AS county, t.DIVISION AS division, LAT AS latitude, LON AS longitude,
               count(premise_id) AS customers_served, count(premise_id) FILTER (has_gas) AS gas_customers_served
        FROM towns t LEFT JOIN w_premise p ON p.city = t.CITY GROUP BY ALL""",
    "w_customer": f"""
        SELECT c.customer_id, c.account_id, customer_name, customer_type, segment_code, segment, created_date, email, phone,
               has_email, has_phone, is_autopay, autopay_date, is_paperless, paperless_date, is_budget_billing,
               is_low_income, has_medical_cert, premise_id, city, division, move_in_date, move_out_date, is_active,
               supplier AS elec_supplier,
               round((coalesce(move_out_date, {AS_OF}) - move_in_date) / 365.25, 1)::decimal(5,1) AS tenure_years,
               dq_name_fixed, dq_phone_reformatted
        FROM s_customer c JOIN s_contract k USING (account_id)
        JOIN s_installation i ON i.installation_id = k.installation_id AND i.commodity = 'Electric'
        JOIN w_premise USING (premise_id)""",
    "w_bill": "SELECT *, date_trunc('month', bill_date)::date AS bill_month FROM s_bill",
    "w_payment": """
        SELECT payment_id, customer_id, account_id, bill_id, payment_date,
               date_trunc('month', payment_date)::date AS payment_month, amount, channel_code, channel
        FROM s_payment JOIN w_customer USING (account_id)""",
    "w_steps": """
        SELECT bill_id, me, sum(paid) OVER (PARTITION BY bill_id ORDER BY me) AS cum_paid
        FROM (SELECT bill_id, last_day(payment_date) AS me, sum(amount) AS paid FROM w_payment GROUP BY ALL) p""",
    "w_paid": """
        SELECT bill_id, min(me) AS paid_me FROM w_steps JOIN w_bill USING (bill_id)
        WHERE cum_paid >= total_amt - 0.005 GROUP BY bill_id""",
    "w_month_ends": "SELECT DISTINCT month_end AS me FROM w_calendar WHERE is_in_window",
    "w_open": """
        SELECT o.me, o.bill_id, o.customer_id, o.due_date, o.total_amt - coalesce(s.cum_paid, 0) AS open_amt,
               (o.me - o.due_date)::int AS days_past_due
        FROM (SELECT m.me, b.bill_id, b.customer_id, b.due_date, b.total_amt
              FROM w_bill b LEFT JOIN w_paid p USING (bill_id)
              JOIN w_month_ends m ON m.me >= last_day(b.bill_date) AND (p.paid_me IS NULL OR m.me < p.paid_me)
              WHERE NOT b.is_reversed AND b.total_amt > 0) o
        ASOF LEFT JOIN w_steps s ON s.bill_id = o.bill_id AND s.me <= o.me""",
    "w_ar_monthly": """
        SELECT me AS month_end, segment, division, names[bucket_order] AS aging_bucket, bucket_order,
               bucket_order < 9 AS is_receivable, sum(open_amt)::decimal(38,2) AS open_amt, count(*) AS open_bills,
               count(DISTINCT customer_id) AS open_accounts
        FROM (SELECT *, CASE WHEN days_past_due > 180 THEN 9 WHEN days_past_due > 90 THEN 5 WHEN days_past_due > 60 THEN 4
                             WHEN days_past_due > 30 THEN 3 WHEN days_past_due > 0 THEN 2 ELSE 1 END::int AS bucket_order,
                     ['Current', '1-30', '31-60', '61-90', '91-180', '', '', '', 'Written Off'] AS names FROM w_open) o
        JOIN w_customer USING (customer_id) GROUP BY me, segment, division, names, bucket_order""",
    "w_ar_customer": f"""
        SELECT customer_id,
               coalesce(sum(open_amt) FILTER (a <= 180), 0)::decimal(38,2) AS open_amt,
               coalesce(sum(open_amt) FILTER (a > 0 AND a <= 180), 0)::decimal(38,2) AS past_due_amt,
               coalesce(sum(open_amt) FILTER (a <= 0), 0)::decimal(38,2) AS current_amt,
               coalesce(sum(open_amt) FILTER (a > 0 AND a <= 30), 0)::decimal(38,2) AS past_due_1_30,
               coalesce(sum(open_amt) FILTER (a > 30 AND a <= 60), 0)::decimal(38,2) AS past_due_31_60,
               coalesce(sum(open_amt) FILTER (a > 60 AND a <= 90), 0)::decimal(38,2) AS past_due_61_90,
               coalesce(sum(open_amt) FILTER (a > 90 AND a <= 180), 0)::decimal(38,2) AS past_due_91_180,
               coalesce(sum(open_amt) FILTER (a > 180), 0)::decimal(38,2) AS written_off_amt,
               max(a) FILTER (a <= 180) AS oldest_days_past_due, count(*) FILTER (a <= 180) AS open_bills
        FROM (SELECT *, days_past_due AS a FROM w_open WHERE me = {AS_OF}) o GROUP BY customer_id""",
    "w_event_days": f"""
        WITH day AS (SELECT outage_date, sum(customer_minutes)::double / (SELECT sum(customers_served)::double FROM w_geography) AS saidi
                     FROM s_outage WHERE customer_minutes > 0 GROUP BY outage_date)
        SELECT outage_date, saidi, t AS threshold, saidi::decimal(10,4) AS daily_saidi_min, saidi > t AS is_major_event_day
        FROM day, (SELECT exp(avg(ln(saidi)) + 2.5 * stddev_samp(ln(saidi))) AS t FROM day) l""",
    "w_date": """
        SELECT c.*, w.* EXCLUDE (weather_date), coalesce(e.is_major_event_day, false) AS is_major_event_day, e.daily_saidi_min
        FROM w_calendar c LEFT JOIN s_weather w ON w.weather_date = c.date LEFT JOIN w_event_days e ON e.outage_date = c.date""",
    "w_outage": "SELECT o.*, d.is_major_event_day FROM s_outage o JOIN w_date d ON d.date = o.outage_date",
    "w_ami": f"""
        SELECT r.meter_id, premise_id, read_date, kwh, peak_kw, read_quality, is_missing,
               coalesce(kwh > 15 * avg(kwh) OVER (PARTITION BY r.meter_id), false) AS is_spike
        FROM s_ami_read r JOIN w_premise p ON p.elec_meter_id = r.meter_id""",
    "w_work_order": f"""
        SELECT *, if(is_open, ({AS_OF} - created_date)::int, NULL) AS open_age_days,
               (actual_finish - planned_finish)::int AS finish_variance_days,
               coalesce(actual_finish <= planned_finish, false) AS finished_on_time,
               is_open AND coalesce(planned_finish < {AS_OF}, false) AS is_overdue
        FROM s_work_order""",
    "w_service_order": f"""
        SELECT s.*, division, city, if(status = 'Open', ({AS_OF} - created_date)::int, NULL) AS open_age_days
        FROM s_service_order s JOIN w_premise USING (premise_id)""",
    "w_payment_plan": """
        SELECT p.*, customer_id, segment, division, is_low_income FROM s_payment_plan p JOIN w_customer USING (account_id)""",
    "w_dq": "SELECT n.check_order, source_table, dq_check, action_taken, rows_checked, rows_affected FROM (\n"
    + "\nUNION ALL ".join([
        "SELECT 1::int AS check_order, count(*) AS rows_checked, count(*) FILTER (dq_zip_fixed) AS rows_affected FROM w_premise",
        "SELECT 2, count(*), count(*) FILTER (dq_city_fixed) FROM w_premise",
        "SELECT 3, count(*), count(*) FILTER (dq_name_fixed) FROM w_customer",
        "SELECT 4, count(*), count(*) FILTER (dq_phone_reformatted) FROM w_customer",
        "SELECT 5, count(*), count(*) FILTER (NOT has_email) FROM w_customer",
        "SELECT 6, (SELECT count(*) FROM DFKKZP), (SELECT count(*) FROM DFKKZP) - (SELECT count(*) FROM w_payment)",
        "SELECT 7, count(*), count(*) FILTER (is_reversed) FROM w_bill",
        "SELECT 8, count(*), count(*) FILTER (is_missing) FROM w_ami",
        "SELECT 9, count(*), count(*) FILTER (is_spike) FROM w_ami",
        "SELECT 10, count(*), count(*) FILTER (NOT is_identified) FROM s_interaction",
        "SELECT 11, count(*), count(*) FILTER (is_open) FROM w_outage",
    ])
    + ") n JOIN (VALUES "
    + ", ".join(f"({k}, '{v[0]}', '{v[1].replace("{spike_factor:g}", "15")}', '{v[2]}')" for k, v in CHECKS.items())
    + ") t(check_order, source_table, dq_check, action_taken) USING (check_order)",
    # ---- reports
    "r_period": """
        SELECT DISTINCT (year * 100 + month_num)::int AS period_key, month_start, month_end, year, quarter, month_num,
               month_name, month_short, year_month FROM w_date WHERE is_in_window""",
    "r_date": """
        SELECT date, (year * 100 + month_num)::int AS period_key, month_start, year_month, year, month_short, day_of_week,
               day_name, is_weekend, is_winter_moratorium, is_major_event_day, daily_saidi_min, temp_avg_f, temp_max_f,
               temp_min_f, precip_in, max_gust_mph, heating_degree_days, cooling_degree_days
        FROM w_date WHERE is_in_window""",
    "r_division": """
        SELECT division, sum(customers_served)::bigint AS customers_served,
               sum(gas_customers_served)::bigint AS gas_customers_served, count(*) AS towns
        FROM w_geography GROUP BY division""",
    "r_revenue": """
        SELECT (year(bill_month) * 100 + month(bill_month))::int AS period_key, bill_month,
               if(upper(rtrim(segment_code)) IN ('RES', 'GOV'), 'Residential & Non-Commercial', 'Commercial & Industrial') AS customer_class,
               division, segment, elec_rate_code, coalesce(gas_rate_code, 'None') AS gas_rate_code, b.elec_supplier,
               count(*) AS bills, count(DISTINCT customer_id) AS customers_billed, sum(kwh) AS kwh, sum(therms) AS therms,
               sum(elec_delivery_amt) AS elec_delivery_amt, sum(elec_supply_amt) AS elec_supply_amt,
               sum(gas_delivery_amt) AS gas_delivery_amt, sum(gas_supply_amt) AS gas_supply_amt,
               sum(tax_amt) AS tax_amt, sum(total_amt) AS total_amt
        FROM w_bill b JOIN w_customer c USING (customer_id) WHERE reversal_date IS NULL
        GROUP BY bill_month, upper(rtrim(segment_code)), division, segment, elec_rate_code, coalesce(gas_rate_code, 'None'), b.elec_supplier""",
    "r_revenue_res": "SELECT * FROM r_revenue WHERE customer_class = 'Residential & Non-Commercial'",
    "r_revenue_com": "SELECT * FROM r_revenue WHERE customer_class = 'Commercial & Industrial'",
    "r_ar_top": f"""
        SELECT customer_id, account_id, customer_name, segment, division, city, is_low_income, has_medical_cert, is_active,
               open_amt, past_due_amt, past_due_1_30, past_due_31_60, past_due_61_90, past_due_91_180, written_off_amt,
               oldest_days_past_due, open_bills
        FROM w_customer JOIN w_ar_customer USING (customer_id)
        QUALIFY row_number() OVER (ORDER BY past_due_amt DESC, customer_id) <= 2000""",
    "r_payments": """
        SELECT payment_month, channel, segment, division, count(*) AS payments, sum(amount)::decimal(24,2) AS amount
        FROM w_payment JOIN w_customer USING (customer_id) GROUP BY ALL""",
    "r_adoption": """
        SELECT m.me AS month_end, segment, division, count(*) AS active_customers,
               count(*) FILTER (is_autopay AND autopay_date <= m.me) AS autopay_customers,
               count(*) FILTER (is_paperless AND paperless_date <= m.me) AS paperless_customers
        FROM w_month_ends m JOIN w_customer c ON move_in_date <= m.me AND coalesce(move_out_date, date '9999-12-31') > m.me
        GROUP BY ALL""",
    "r_ami": """
        SELECT read_date, division, elec_rate_code, count(*) AS meters_expected,
               count(*) FILTER (NOT is_missing) AS meters_reporting,
               count(*) FILTER (read_quality = 'ESTIMATED') AS reads_estimated, count(*) FILTER (is_spike) AS reads_spike,
               coalesce(sum(kwh) FILTER (NOT is_missing AND NOT is_spike), 0) AS kwh_valid,
               count(*) FILTER (NOT is_missing AND NOT is_spike) AS reads_valid,
               max(peak_kw) FILTER (NOT is_spike) AS max_peak_kw
        FROM w_ami JOIN w_premise USING (premise_id) GROUP BY ALL""",
    "r_outages": """
        SELECT outage_id, outage_start, restore_time, outage_date, duration_min, is_open, division, municipality, circuit_id,
               device_type, cause, customers_out, customer_minutes, is_major_event_day FROM w_outage""",
    "r_work_orders": """
        SELECT date_trunc('month', created_date)::date AS created_month, order_type, commodity, asset_class, division,
               priority, status, count(*) AS work_orders, count(*) FILTER (finished_on_time) AS finished_on_time,
               count(actual_finish) AS finished, sum(planned_cost)::decimal(24,2) AS planned_cost,
               sum(actual_cost)::decimal(24,2) AS actual_cost
        FROM w_work_order WHERE status <> 'Deleted' GROUP BY ALL""",
    "r_backlog": """
        SELECT work_order_id, order_type, description, asset_class, commodity, functional_location, work_center, priority,
               created_date, planned_start, planned_finish, status, planned_cost, actual_cost, division, municipality,
               open_age_days, is_overdue FROM w_work_order WHERE is_open""",
    "r_contacts": """
        SELECT interaction_date, channel, reason, site, is_assisted, count(*) AS contacts, count(customer_id) AS identified_contacts,
               sum(wait_sec)::bigint AS wait_sec_total,
               count(*) FILTER (channel = 'Phone - Agent' AND wait_sec <= 30) AS answered_within_30s,
               count(*) FILTER (channel = 'Phone - Agent') AS agent_calls, sum(handle_sec)::bigint AS handle_sec_total,
               count(*) FILTER (first_contact_resolved) AS resolved_first_contact, count(*) FILTER (transferred) AS transferred,
               count(csat) AS csat_responses, sum(csat)::bigint AS csat_total, count(*) FILTER (csat > 3) AS csat_satisfied
        FROM s_interaction GROUP BY ALL""",
    "r_collections": """
        SELECT date_trunc('month', s.created_date)::date AS created_month, order_type, status, s.division, segment, is_low_income,
               count(*) AS orders, count(*) FILTER (cycle_days <= 1) AS completed_within_1_day, avg(cycle_days) AS avg_cycle_days
        FROM w_service_order s JOIN w_customer c USING (account_id)
        WHERE order_type IN ('Disconnect for Non-Pay', 'Reconnect') GROUP BY ALL""",
    "r_moratorium": """
        SELECT is_winter_moratorium, segment, has_medical_cert, count(*) AS disconnects_completed
        FROM w_service_order s JOIN w_customer c USING (account_id) JOIN w_calendar d ON d.date = s.completed_date
        WHERE order_type = 'Disconnect for Non-Pay' AND status = 'Completed' GROUP BY ALL""",
    "r_plans": """
        SELECT date_trunc('month', created_date)::date AS created_month, plan_type, status, segment, division, is_low_income,
               count(*) AS plans, sum(total_amt)::decimal(24,2) AS total_amt, sum(down_payment)::decimal(24,2) AS down_payment,
               avg(num_installments) AS avg_installments
        FROM w_payment_plan GROUP BY ALL""",
    "r_exceptions": """
        SELECT bill_month, division, segment, elec_rate_code, count(*) AS bills,
               count(*) FILTER (elec_estimated) AS elec_estimated, count(*) FILTER (gas_estimated) AS gas_estimated,
               count(*) FILTER (elec_estimated AND was_estimated) AS consecutive_estimates,
               count(*) FILTER (kwh = 0 AND bill_type = 'Regular' AND billing_days >= 20) AS zero_usage_bills,
               count(*) FILTER (was > 0 AND (kwh > 1.5 * was OR kwh < 0.5 * was)) AS high_variance_bills
        FROM (SELECT *, lag(kwh) OVER w AS was, lag(elec_estimated) OVER w AS was_estimated
              FROM w_bill WHERE reversal_date IS NULL AND bill_type <> 'Rebill'
              WINDOW w AS (PARTITION BY customer_id ORDER BY bill_date, bill_id)) b
        JOIN w_customer USING (customer_id) GROUP BY ALL""",
    "r_rebills": """
        SELECT date_trunc('month', reversal_date)::date AS reversal_month, count(*) AS reversed_bills,
               sum(total_amt)::decimal(24,2) AS reversed_amt
        FROM w_bill WHERE reversal_date IS NOT NULL GROUP BY ALL""",
    "r_service": """
        SELECT date_trunc('month', created_date)::date AS created_month, order_type, status, division, work_center,
               count(*) AS orders, count(*) FILTER (status = 'Completed') AS completed,
               coalesce(sum(cycle_days) FILTER (status = 'Completed'), 0)::bigint AS cycle_days_total,
               count(*) FILTER (status = 'Open') AS open_orders, max(open_age_days) AS max_open_age_days
        FROM w_service_order GROUP BY ALL""",
    "r_customer_360": """
        SELECT c.customer_id, account_id, customer_name, customer_type, segment, c.division, c.city, address_line, zip, latitude,
               longitude, premise_type, elec_rate_code, gas_rate_code, elec_meter_technology, elec_supplier, move_in_date,
               move_out_date, is_active, tenure_years, has_email, has_phone, is_autopay, is_paperless, is_budget_billing,
               is_low_income, has_medical_cert, coalesce(a.open_amt, 0)::decimal(38,2) AS open_amt,
               coalesce(a.past_due_amt, 0)::decimal(38,2) AS past_due_amt,
               coalesce(a.written_off_amt, 0)::decimal(38,2) AS written_off_amt, oldest_days_past_due
        FROM w_customer c JOIN w_premise p USING (premise_id) LEFT JOIN w_ar_customer a USING (customer_id)""",
    "r_bills_recent": f"""
        SELECT bill_id, customer_id, bill_date, due_date, period_start, period_end, bill_type, is_reversed, kwh, therms,
               elec_estimated, gas_estimated, total_amt, coalesce(paid, 0)::decimal(24,2) AS paid_amt
        FROM w_bill LEFT JOIN (SELECT bill_id, sum(amount) AS paid FROM w_payment GROUP BY bill_id) p USING (bill_id)
        WHERE bill_date > {AS_OF} - interval 3 month""",
    "r_dq": """
        SELECT *, if(rows_checked = 0, NULL, round(rows_affected * 100.0 / rows_checked, 2))::decimal(6,2) AS pct_affected FROM w_dq""",
}


def compose(query: str) -> str:
    """WITH clause of every block the query needs, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[A-Za-z_0-9]+\b", text)):
            if word in BLOCKS and word not in order and word not in active:
                active.append(word)
                visit(BLOCKS[word])
                active.remove(word)
                order.append(word)

    active: list[str] = []
    visit(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in order) + "\n" + query
