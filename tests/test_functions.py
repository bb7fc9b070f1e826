"""Hand-made cases for the column expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterstone.functions import bands, codes
from meterstone.functions import dates as D
from meterstone.functions import text as T
from meterstone.settings import RISK_LEVELS, WIND_BANDS
from meterstone.sources.typing import apply_types, malformed_rows


def values(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_phone(spark):
    given = ["(973) 555-0101", "973-555-0101", "9735550101", "+1 973 555 0101", "555-0101", None, ""]
    assert values(spark, "string", given, T.phone10) == ["9735550101"] * 4 + [None] * 3
    assert values(spark, "string", given, T.phone_needs_format) == [False, True, True, True, True, False, True]


def test_surname(spark):
    given = ["SMITH", "Smith", "X", "VAN DYKE", None, "O "]
    assert values(spark, "string", given, T.proper_surname) == ["Smith", "Smith", "X", "Van dyke", None, "O "]
    assert values(spark, "string", given, T.is_all_caps) == [True, False, False, True, False, False]


def test_zip(spark):
    given = ["7102", "07102", " 7102 "]
    assert values(spark, "string", given, T.zip5) == ["07102"] * 3
    assert values(spark, "string", given, lambda v: T.visible_length(v) < 5) == [True, False, False]


def test_codes_ignore_case_and_trailing_blanks(spark):
    given = ["RES", "res ", "??", None]
    assert values(spark, "string", given, lambda v: T.label(v, codes.SEGMENTS)) == ["Residential", "Residential", None, None]
    assert values(spark, "string", given, lambda v: T.label(v, codes.SEGMENTS, "Other"))[2:] == ["Other", "Other"]
    assert values(spark, "string", ["X", "x ", "", None], lambda v: T.same_text(v, "X")) == [True, True, False, False]
    assert values(spark, "string", ["a", "  ", "", None], T.blank_to_null) == ["a", None, None, None]


def test_sap_dates(spark):
    given = ["20241001", "0", "", "99991231", None]
    assert values(spark, "string", given, D.sap_date) == [date(2024, 10, 1), None, None, date(9999, 12, 31), None]
    assert values(spark, "string", ["20240230"], lambda v: D.sap_date(v, strict=False)) == [None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|20240230"):
        values(spark, "string", ["20240230"], D.sap_date)


def test_sap_time(spark):
    assert values(spark, "string", ["63005", "190000", "5"], D.sap_seconds) == [23405, 68400, 5]
    at = values(spark, "int", [23405], lambda v: D.at_second_of_day(F.lit(date(2024, 1, 2)), v))
    assert at == [datetime(2024, 1, 2, 6, 30, 5)]


def test_minute_marks(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:59' a, timestamp_ntz'2024-01-01 00:01:01' b, cast(NULL AS timestamp_ntz) n")
    row = df.select(D.minute_marks_between(F.col("a"), F.col("b")), D.minute_marks_between(F.col("a"), F.col("n"))).first()
    assert tuple(row) == (1, None)


def test_moratorium_and_weekday(spark):
    days = [date(2024, 11, 14), date(2024, 11, 15), date(2025, 2, 28), date(2025, 3, 15), date(2025, 3, 16)]
    assert values(spark, "date", days, D.in_winter_moratorium) == [False, True, True, True, False]
    assert values(spark, "date", [date(2024, 9, 30), date(2024, 10, 1), date(2024, 10, 6)], D.weekday_number) == [1, 2, 7]


def test_aging_bounds(spark):
    ages = [0, 1, 30, 31, 60, 61, 90, 91, 180, 181]
    got = values(spark, "int", ages, lambda v: bands.aging_bucket(bands.aging_order(v)))
    assert got == ["Current", "1-30", "1-30", "31-60", "31-60", "61-90", "61-90", "91-180", "91-180", "Written Off"]


def test_wind_and_risk_bounds(spark):
    got = values(spark, "double", [24.9, 25.0, 35.0, 45.0, 55.0, 1000.0],
                 lambda v: bands.band_field(v, WIND_BANDS, 2, WIND_BANDS[-1][2]))
    assert got == ["Under 25 mph", "25-35 mph", "35-45 mph", "45-55 mph", "55+ mph", "55+ mph"]
    got = values(spark, "double", [1.49, 1.5, 3.0, 8.0], lambda v: bands.band_field(v, RISK_LEVELS, 2))
    assert got == ["Normal", "Elevated", "High", "Severe"]


def test_type_rules(spark):
    df = spark.createDataFrame(
        [("1", "20241001", "63005", "12.345", "", "2024-01-01 05:06:07", "07102 "), ("", "0", "", "", "1.5", "", "")],
        "BP_ID string, BUDAT string, ERZEIT string, BETRZ string, KWH string, CREATED_TS string, ZIP string",
    )
    typed = apply_types(df)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == [
        "bigint", "date", "int", "decimal(14,2)", "double", "timestamp_ntz", "string"]
    a, b = typed.collect()
    assert (a.BP_ID, a.BUDAT, a.ERZEIT, str(a.BETRZ), a.KWH, a.CREATED_TS, a.ZIP) == (
        1, date(2024, 10, 1), 23405, "12.35", None, datetime(2024, 1, 1, 5, 6, 7), "07102 ")
    assert tuple(b) == (None, None, None, None, 1.5, None, "")


def test_quarantine(spark):
    df = spark.createDataFrame([("1", "20241001"), ("x", "0"), ("2", "20240230"), ("", "")], "BP_ID string, BUDAT string")
    assert sorted(r.BUDAT for r in malformed_rows(df).collect()) == ["0", "20240230"]
    assert apply_types(df, strict=False).filter("BUDAT is null").count() == 3
    with pytest.raises(Exception, match="malformed ERZEIT"):
        apply_types(spark.createDataFrame([("993000",)], "ERZEIT string")).collect()
