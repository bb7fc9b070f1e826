"""Column types of the source extracts, by column name."""

from __future__ import annotations

# The 18 extracts, their columns in file order and whether they come in month folders.
EXTRACTS = {
    "sap_isu/BUT000": ((
        "PARTNER", "TYPE", "BU_GROUP", "NAME_FIRST", "NAME_LAST", "NAME_ORG1", "CRDAT", "SMTP_ADDR",
        "TEL_NUMBER"), False),
    "sap_isu/FKKVKP": ((
        "VKONT", "GPART", "EZAWE", "ZAUTOPAY_DATE", "ZEBILL", "ZEBILL_DATE", "ZBUDGET_BILL", "ZLOW_INCOME",
        "ZMED_CERT"), False),
    "sap_isu/ADRC": ((
        "ADDRNUMBER", "HOUSE_NUM1", "HOUSE_NUM2", "STREET", "CITY1", "POST_CODE1", "COUNTY", "REGION",
        "COUNTRY", "GEO_LAT", "GEO_LON"), False),
    "sap_isu/EVBS": (("VSTELLE", "HAUS", "VBSART", "ADDRNUMBER"), False),
    "sap_isu/EANL": (("ANLAGE", "VSTELLE", "SPARTE", "TARIFTYP", "ABLEINH", "AKLASSE"), False),
    "sap_isu/EQUI": (("EQUNR", "ANLAGE", "SPARTE", "HERST", "TYPBZ", "ZMETER_TECH", "INBDT", "BAUJJ"), False),
    "sap_isu/EVER": (("VERTRAG", "ANLAGE", "VKONTO", "EINZDAT", "AUSZDAT", "ZSUPPLIER"), False),
    "sap_isu/ERCH": ((
        "BELNR", "VKONT", "GPART", "VSTELLE", "ABRVORG", "BUDAT", "BEGABRPE", "ENDABRPE", "FAEDN",
        "STORNODAT", "ELEC_TARIF", "KWH", "ELEC_EST", "ELEC_SUPPLIER", "GAS_TARIF", "THERMS", "GAS_EST",
        "ELEC_DELIV_AMT", "ELEC_SUPPLY_AMT", "GAS_DELIV_AMT", "GAS_SUPPLY_AMT", "TAX_AMT", "TOTAL_AMT",
        "WAERS"), True),
    "sap_isu/DFKKZP": (("PAYMENT_ID", "VKONT", "BELNR", "BUDAT", "BETRZ", "PAY_CHANNEL"), True),
    "sap_isu/ZINSTPLAN": (("PLAN_ID", "VKONT", "PLAN_TYPE", "ERDAT", "TOTAL_AMT", "DOWN_PAYMENT", "NUM_INSTALLMENTS", "STATUS"), False),
    "sap_isu/ZSRVORD": ((
        "ORDER_ID", "ORDER_TYPE", "VSTELLE", "VKONT", "ERDAT", "ERZEIT", "SCHED_DATE", "COMPL_DATE", "STATUS",
        "WORK_CENTER"), False),
    "sap_pm/AUFK": ((
        "AUFNR", "AUART", "KTEXT", "ASSET_CLASS", "TPLNR", "ARBPL", "PRIOK", "ERDAT", "GSTRP", "GLTRP",
        "GETRI", "STAT", "PLAN_COST", "ACT_COST", "ZDIVISION", "ZMUNI"), True),
    "oms/outage_events": ((
        "EVENT_ID", "EVENT_START", "RESTORE_TIME", "DIVISION", "MUNICIPALITY", "CIRCUIT_ID", "DEVICE_TYPE",
        "CAUSE", "CUSTOMERS_OUT", "CUSTOMER_MINUTES"), False),
    "crm/interactions": ((
        "INTERACTION_ID", "CREATED_TS", "CHANNEL", "REASON", "BP_ID", "WAIT_SEC", "HANDLE_SEC", "FCR",
        "TRANSFERRED", "CSAT", "AGENT_ID", "SITE"), True),
    "ami/daily_reads": (("METER_ID", "READ_DATE", "KWH", "PEAK_KW", "READ_QUALITY"), True),
    "weather/daily_weather": (("STATION", "OBS_DATE", "TAVG_F", "TMAX_F", "TMIN_F", "PRECIP_IN", "MAX_GUST_MPH", "HDD", "CDD"), False),
    "reference/towns": (("CITY", "COUNTY", "ZIP", "DIVISION", "LAT", "LON"), False),
    "reference/rate_schedules": ((
        "RATE_CODE", "COMMODITY", "RATE_CLASS", "DESCRIPTION", "CUSTOMER_CHARGE", "DELIVERY_PER_UNIT",
        "SUPPLY_PER_UNIT", "UNIT"), False),
}

# Type of a column by its name; every other column stays text.
TYPE_RULES = {
    "sap_date": (
        "CRDAT", "ZAUTOPAY_DATE", "ZEBILL_DATE", "EINZDAT", "AUSZDAT", "INBDT", "BUDAT", "BEGABRPE",
        "ENDABRPE", "FAEDN", "STORNODAT", "ERDAT", "SCHED_DATE", "COMPL_DATE", "GSTRP", "GLTRP", "GETRI"),
    "sap_time": ("ERZEIT",),
    "bigint": (
        "PARTNER", "VKONT", "GPART", "VSTELLE", "HAUS", "ADDRNUMBER", "ANLAGE", "VERTRAG", "VKONTO", "EQUNR",
        "BELNR", "PAYMENT_ID", "PLAN_ID", "ORDER_ID", "AUFNR", "EVENT_ID", "INTERACTION_ID", "BP_ID",
        "METER_ID", "HOUSE_NUM1", "BAUJJ", "NUM_INSTALLMENTS", "CUSTOMERS_OUT", "CUSTOMER_MINUTES",
        "WAIT_SEC", "HANDLE_SEC", "CSAT", "MAX_GUST_MPH"),
    "decimal(14,2)": (
        "ELEC_DELIV_AMT", "ELEC_SUPPLY_AMT", "GAS_DELIV_AMT", "GAS_SUPPLY_AMT", "TAX_AMT", "TOTAL_AMT",
        "BETRZ", "PLAN_COST", "ACT_COST", "DOWN_PAYMENT", "CUSTOMER_CHARGE"),
    "double": (
        "KWH", "THERMS", "PEAK_KW", "GEO_LAT", "GEO_LON", "LAT", "LON", "TAVG_F", "TMAX_F", "TMIN_F",
        "PRECIP_IN", "HDD", "CDD", "DELIVERY_PER_UNIT", "SUPPLY_PER_UNIT"),
    "timestamp_ntz": ("EVENT_START", "RESTORE_TIME", "CREATED_TS"),
    "date": ("READ_DATE", "OBS_DATE"),
}
RULE_OF = {name: rule for rule, names in TYPE_RULES.items() for name in names}
MONTH_FOLDER = "year_month"


def columns_of(extract: str) -> list[str]:
    return list(EXTRACTS[extract][0])


def has_months(extract: str) -> bool:
    return EXTRACTS[extract][1]
