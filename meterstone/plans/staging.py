"""Staging datasets: rename, decode and clean the typed extracts. All lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.functions import codes
from meterstone.functions import dates as D
from meterstone.functions import text as T
from meterstone.functions.dates import OPEN_END
from meterstone.operators.dedup import keep_one_per_key

c = F.col


def customer(but000: DataFrame, fkkvkp: DataFrame) -> DataFrame:
    """Business partner with its contract account."""
    person = T.same_text(c("TYPE"), "1")
    full_name = F.concat(c("NAME_FIRST"), F.lit(" "), T.proper_surname(c("NAME_LAST")))
    joined = but000.join(fkkvkp, but000["PARTNER"] == fkkvkp["GPART"])
    return joined.select(
        c("PARTNER").alias("customer_id"),
        c("VKONT").alias("account_id"),
        F.when(person, "Person").otherwise("Organization").alias("customer_type"),
        c("BU_GROUP").alias("segment_code"),
        T.label(c("BU_GROUP"), codes.SEGMENTS).alias("segment"),
        F.when(person, full_name).otherwise(c("NAME_ORG1")).alias("customer_name"),
        c("CRDAT").alias("created_date"),
        T.blank_to_null(c("SMTP_ADDR")).alias("email"),
        T.phone10(c("TEL_NUMBER")).alias("phone"),
        T.blank_to_null(c("SMTP_ADDR")).isNotNull().alias("has_email"),
        T.phone10(c("TEL_NUMBER")).isNotNull().alias("has_phone"),
        T.same_text(c("EZAWE"), "D").alias("is_autopay"),
        c("ZAUTOPAY_DATE").alias("autopay_date"),
        T.same_text(c("ZEBILL"), "X").alias("is_paperless"),
        c("ZEBILL_DATE").alias("paperless_date"),
        T.same_text(c("ZBUDGET_BILL"), "X").alias("is_budget_billing"),
        T.same_text(c("ZLOW_INCOME"), "X").alias("is_low_income"),
        T.same_text(c("ZMED_CERT"), "X").alias("has_medical_cert"),
        T.is_all_caps(c("NAME_LAST")).alias("dq_name_fixed"),
        T.phone_needs_format(c("TEL_NUMBER")).alias("dq_phone_reformatted"),
    )


def premise(evbs: DataFrame, adrc: DataFrame, towns: DataFrame) -> DataFrame:
    """Premise with canonical town. Addresses with an unknown ZIP drop out."""
    town = towns.select(
        F.rtrim("ZIP").alias("_zip"), c("CITY").alias("city"), c("ZIP").alias("zip"),
        c("COUNTY").alias("county"), c("DIVISION").alias("division"),
    )
    address = adrc.drop("COUNTY").withColumn("_zip", T.zip5(c("POST_CODE1")))
    return (
        evbs.join(address, "ADDRNUMBER")
        .join(town, "_zip")
        .select(
            c("VSTELLE").alias("premise_id"),
            c("VBSART").alias("premise_type"),
            F.concat(
                F.coalesce(c("HOUSE_NUM1").cast("string"), F.lit("")), F.lit(" "),
                F.coalesce(c("STREET"), F.lit("")), T.optional_suffix(c("HOUSE_NUM2")),
            ).alias("address_line"),
            "city", "zip", "county", "division",
            c("GEO_LAT").alias("latitude"),
            c("GEO_LON").alias("longitude"),
            F.coalesce(T.visible_length(c("POST_CODE1")) < 5, F.lit(False)).alias("dq_zip_fixed"),
            F.coalesce(c("CITY1") != c("city"), F.lit(False)).alias("dq_city_fixed"),
        )
    )


def installation(eanl: DataFrame, equi: DataFrame) -> DataFrame:
    meter = equi.select(
        "ANLAGE", c("EQUNR").alias("meter_id"), c("HERST").alias("meter_manufacturer"),
        c("ZMETER_TECH").alias("meter_technology"), c("INBDT").alias("meter_install_date"),
    )
    return eanl.join(meter, "ANLAGE", "left").select(
        c("ANLAGE").alias("installation_id"),
        c("VSTELLE").alias("premise_id"),
        T.label(c("SPARTE"), codes.COMMODITIES).alias("commodity"),
        c("TARIFTYP").alias("rate_code"),
        c("ABLEINH").alias("read_route"),
        c("AKLASSE").alias("rate_class"),
        "meter_id", "meter_manufacturer", "meter_technology", "meter_install_date",
    )


def contract(ever: DataFrame) -> DataFrame:
    no_end = F.lit(OPEN_END)
    return ever.select(
        c("VERTRAG").alias("contract_id"),
        c("ANLAGE").alias("installation_id"),
        c("VKONTO").alias("account_id"),
        c("EINZDAT").alias("move_in_date"),
        F.nullif(c("AUSZDAT"), no_end).alias("move_out_date"),
        F.coalesce(c("AUSZDAT") == no_end, F.lit(False)).alias("is_active"),
        T.label(c("ZSUPPLIER"), codes.SUPPLIERS, codes.OTHER_SUPPLIER).alias("supplier"),
    )


def bill(erch: DataFrame) -> DataFrame:
    return erch.select(
        c("BELNR").alias("bill_id"),
        c("VKONT").alias("account_id"),
        c("GPART").alias("customer_id"),
        c("VSTELLE").alias("premise_id"),
        T.label(c("ABRVORG"), codes.BILL_TYPES).alias("bill_type"),
        c("BUDAT").alias("bill_date"),
        c("BEGABRPE").alias("period_start"),
        c("ENDABRPE").alias("period_end"),
        F.datediff("ENDABRPE", "BEGABRPE").alias("billing_days"),
        c("FAEDN").alias("due_date"),
        c("STORNODAT").alias("reversal_date"),
        c("STORNODAT").isNotNull().alias("is_reversed"),
        c("ELEC_TARIF").alias("elec_rate_code"),
        c("KWH").alias("kwh"),
        T.same_text(c("ELEC_EST"), "X").alias("elec_estimated"),
        T.label(c("ELEC_SUPPLIER"), codes.SUPPLIERS, codes.OTHER_SUPPLIER).alias("elec_supplier"),
        T.blank_to_null(c("GAS_TARIF")).alias("gas_rate_code"),
        c("THERMS").alias("therms"),
        T.same_text(c("GAS_EST"), "X").alias("gas_estimated"),
        c("ELEC_DELIV_AMT").alias("elec_delivery_amt"),
        c("ELEC_SUPPLY_AMT").alias("elec_supply_amt"),
        c("GAS_DELIV_AMT").alias("gas_delivery_amt"),
        c("GAS_SUPPLY_AMT").alias("gas_supply_amt"),
        c("TAX_AMT").alias("tax_amt"),
        c("TOTAL_AMT").alias("total_amt"),
    )


def payment(dfkkzp: DataFrame) -> DataFrame:
    """One row per payment id; re-extracted copies are counted and dropped."""
    named = dfkkzp.select(
        c("PAYMENT_ID").alias("payment_id"), c("VKONT").alias("account_id"), c("BELNR").alias("bill_id"),
        c("BUDAT").alias("payment_date"), c("BETRZ").alias("amount"), c("PAY_CHANNEL").alias("channel_code"),
    )
    one = keep_one_per_key(named, ["payment_id"], "dup_rows")
    return one.select(
        "payment_id", "account_id", "bill_id", "payment_date", "amount", "channel_code",
        T.label(c("channel_code"), codes.PAYMENT_CHANNELS).alias("channel"), "dup_rows",
    )


def payment_plan(zinstplan: DataFrame) -> DataFrame:
    return zinstplan.select(
        c("PLAN_ID").alias("plan_id"),
        c("VKONT").alias("account_id"),
        T.label(c("PLAN_TYPE"), codes.PLAN_TYPES, codes.OTHER_PLAN_TYPE).alias("plan_type"),
        c("ERDAT").alias("created_date"),
        c("TOTAL_AMT").alias("total_amt"),
        c("DOWN_PAYMENT").alias("down_payment"),
        c("NUM_INSTALLMENTS").alias("num_installments"),
        T.label(c("STATUS"), codes.PLAN_STATUSES).alias("status"),
    )


def service_order(zsrvord: DataFrame) -> DataFrame:
    return zsrvord.select(
        c("ORDER_ID").alias("order_id"),
        c("ORDER_TYPE").alias("order_type_code"),
        T.label(c("ORDER_TYPE"), codes.SERVICE_ORDER_TYPES).alias("order_type"),
        c("VSTELLE").alias("premise_id"),
        c("VKONT").alias("account_id"),
        D.at_second_of_day(c("ERDAT"), c("ERZEIT")).alias("created_at"),
        c("ERDAT").alias("created_date"),
        c("SCHED_DATE").alias("scheduled_date"),
        c("COMPL_DATE").alias("completed_date"),
        T.label(c("STATUS"), codes.SERVICE_ORDER_STATUSES).alias("status"),
        c("WORK_CENTER").alias("work_center"),
        F.datediff("COMPL_DATE", "ERDAT").alias("cycle_days"),
    )


def work_order(aufk: DataFrame) -> DataFrame:
    is_gas = F.coalesce(F.upper("TPLNR").startswith("G-"), F.lit(False))
    return aufk.select(
        c("AUFNR").alias("work_order_id"),
        c("AUART").alias("order_type_code"),
        T.label(c("AUART"), codes.WORK_ORDER_TYPES).alias("order_type"),
        c("KTEXT").alias("description"),
        c("ASSET_CLASS").alias("asset_class"),
        F.when(is_gas, "Gas").otherwise("Electric").alias("commodity"),
        c("TPLNR").alias("functional_location"),
        c("ARBPL").alias("work_center"),
        T.blank_to_null(c("PRIOK")).cast("int").alias("priority"),
        c("ERDAT").alias("created_date"),
        c("GSTRP").alias("planned_start"),
        c("GLTRP").alias("planned_finish"),
        c("GETRI").alias("actual_finish"),
        T.label(c("STAT"), codes.WORK_ORDER_STATUSES).alias("status"),
        T.one_of(c("STAT"), codes.OPEN_WORK_ORDER_CODES).alias("is_open"),
        c("PLAN_COST").alias("planned_cost"),
        c("ACT_COST").alias("actual_cost"),
        c("ZDIVISION").alias("division"),
        c("ZMUNI").alias("municipality"),
    )


def outage(outage_events: DataFrame) -> DataFrame:
    return outage_events.select(
        c("EVENT_ID").alias("outage_id"),
        c("EVENT_START").alias("outage_start"),
        c("RESTORE_TIME").alias("restore_time"),
        c("EVENT_START").cast("date").alias("outage_date"),
        D.minute_marks_between(c("EVENT_START"), c("RESTORE_TIME")).alias("duration_min"),
        c("RESTORE_TIME").isNull().alias("is_open"),
        c("DIVISION").alias("division"),
        c("MUNICIPALITY").alias("municipality"),
        c("CIRCUIT_ID").alias("circuit_id"),
        c("DEVICE_TYPE").alias("device_type"),
        c("CAUSE").alias("cause"),
        c("CUSTOMERS_OUT").alias("customers_out"),
        c("CUSTOMER_MINUTES").alias("customer_minutes"),
    )


def interaction(interactions: DataFrame) -> DataFrame:
    return interactions.select(
        c("INTERACTION_ID").alias("interaction_id"),
        c("CREATED_TS").alias("created_at"),
        c("CREATED_TS").cast("date").alias("interaction_date"),
        F.hour("CREATED_TS").alias("interaction_hour"),
        c("CHANNEL").alias("channel"),
        T.one_of(c("CHANNEL"), codes.ASSISTED_CHANNELS).alias("is_assisted"),
        c("REASON").alias("reason"),
        c("BP_ID").alias("customer_id"),
        c("BP_ID").isNotNull().alias("is_identified"),
        c("WAIT_SEC").alias("wait_sec"),
        c("HANDLE_SEC").alias("handle_sec"),
        T.same_text(c("FCR"), "Y").alias("first_contact_resolved"),
        T.same_text(c("TRANSFERRED"), "Y").alias("transferred"),
        c("CSAT").cast("int").alias("csat"),
        T.blank_to_null(c("AGENT_ID")).alias("agent_id"),
        T.blank_to_null(c("SITE")).alias("site"),
    )


def ami_read(daily_reads: DataFrame) -> DataFrame:
    return daily_reads.select(
        c("METER_ID").alias("meter_id"),
        c("READ_DATE").alias("read_date"),
        c("KWH").alias("kwh"),
        c("PEAK_KW").alias("peak_kw"),
        c("READ_QUALITY").alias("read_quality"),
        T.same_text(c("READ_QUALITY"), "MISSING").alias("is_missing"),
    )


def weather(daily_weather: DataFrame) -> DataFrame:
    return daily_weather.select(
        c("OBS_DATE").alias("weather_date"),
        c("TAVG_F").alias("temp_avg_f"),
        c("TMAX_F").alias("temp_max_f"),
        c("TMIN_F").alias("temp_min_f"),
        c("PRECIP_IN").alias("precip_in"),
        c("MAX_GUST_MPH").alias("max_gust_mph"),
        c("HDD").alias("heating_degree_days"),
        c("CDD").alias("cooling_degree_days"),
    )


def rate(rate_schedules: DataFrame) -> DataFrame:
    return rate_schedules.select(
        c("RATE_CODE").alias("rate_code"),
        c("COMMODITY").alias("commodity"),
        T.label(c("RATE_CLASS"), codes.RATE_CLASSES).alias("rate_class"),
        c("DESCRIPTION").alias("rate_description"),
        c("UNIT").alias("unit"),
        c("CUSTOMER_CHARGE").alias("customer_charge"),
        c("DELIVERY_PER_UNIT").alias("delivery_per_unit"),
        c("SUPPLY_PER_UNIT").alias("supply_per_unit"),
    )
