from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode import functions as fn


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("  o'neil st-paul 3rd nation_0 ", "O'Neil St-Paul 3rd Nation_0"),
        ("SÃO paulo", "São Paulo"),
        ("", ""),
        (None, None),
    ],
)
def test_capitalize_words(spark, text, expected):
    assert one(spark, fn.capitalize_words(F.trim("s")), "s STRING", text) == expected


def test_blank_to_null(spark):
    assert one(spark, fn.blank_to_null(F.col("s")), "s STRING", "   ") is None
    assert one(spark, fn.blank_to_null(F.col("s")), "s STRING", " UPS ") == "UPS"


def fields(ddl):
    return T.StructType.fromDDL(ddl).fields


def test_row_hash_trims_and_marks_nulls(spark):
    ddl = "a STRING, b STRING, n INT"
    value = one(spark, fn.row_hash(fields(ddl)), ddl, "\t x \n", None, 7)
    assert value == hashlib.md5(b"x||NULL||7").hexdigest()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_row_hash_equals_python_strip(spark, values):
    values = [v for v in values if not any(0xD800 <= ord(c) <= 0xDFFF for c in v)]
    if not values:
        return
    frame = spark.createDataFrame([(v,) for v in values], "s STRING")
    got = [r[0] for r in frame.select(fn.row_hash(frame.schema)).collect()]
    assert got == [hashlib.md5(v.strip().encode()).hexdigest() for v in values]


def test_joined_hash_keeps_blanks(spark):
    value = one(spark, fn.joined_hash(["a", "b"]), "a STRING, b STRING", " x ", None)
    assert value == hashlib.md5(b" x ||NULL").hexdigest()


@pytest.mark.parametrize(
    "value, text",
    [
        (10.0, "10"), (1.5, "1.5"), (12345678.5, "12345678.5"), (0.0001, "0.0001"), (0.0, "0"), (-3.25, "-3.25"),
        (-0.0, "0"), (1e-19, "0." + "0" * 18 + "1"), (-2.5e-19, "-0." + "0" * 18 + "25"), (1e25, "1" + "0" * 25),
        (1.5e7, "15000000"), (0.0012345678901234567, "0.0012345678901234567"), (float("inf"), "Infinity"),
    ],
)
def test_number_text(spark, value, text):
    assert one(spark, fn.number_text(F.col("x")), "x DOUBLE", value) == text


def test_run_together_hash_is_null_when_a_part_is_null(spark):
    column = fn.run_together_hash([(F.col("a"), T.IntegerType()), (F.col("x"), T.DoubleType())])
    assert one(spark, column, "a INT, x DOUBLE", None, 1.0) is None
    assert one(spark, column, "a INT, x DOUBLE", 1, 2.0) == hashlib.md5(b"12").hexdigest()


def test_ratio_rounds_half_away_and_guards_zero(spark):
    column = fn.ratio(F.col("n"), F.col("d"), 2, "decimal(12,2)")
    assert one(spark, column, "n DECIMAL(14,2), d BIGINT", Decimal("0.01"), 2) == Decimal("0.01")
    assert one(spark, column, "n DECIMAL(14,2), d BIGINT", Decimal("-0.01"), 2) == Decimal("-0.01")
    assert one(spark, column, "n DECIMAL(14,2), d BIGINT", Decimal("5"), 0) is None


def test_rounded_double_is_not_fooled_by_binary_noise(spark):
    assert one(spark, fn.rounded_double(F.col("x"), 2), "x DOUBLE", 1.005) == Decimal("1.01")
    assert one(spark, fn.rounded_double(F.col("x"), 2), "x DOUBLE", 0.0049999999) == Decimal("0.00")
    assert one(spark, fn.rounded_double(F.col("x"), 2), "x DOUBLE", 1e13) == Decimal("1e13")
    assert one(spark, fn.rounded_double(F.col("x"), 2), "x DOUBLE", 1e40) is None


def test_elapsed_seconds_keeps_fractions(spark):
    column = fn.elapsed_seconds(F.col("a"), F.col("b"))
    value = one(
        spark, column, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
        datetime(2024, 3, 10, 1, 0), datetime(2024, 3, 11, 1, 0, 0, 250000),
    )
    assert value == Decimal("86400.250000")


def test_calendar_parts_iso(spark):
    parts = fn.calendar_parts(F.col("d"))
    row = spark.createDataFrame([(date(2023, 1, 1),)], "d DATE").select(
        *[c.alias(n) for n, c in parts.items()]
    ).first()
    assert (row.week_of_year, row.day_of_week, row.is_weekend) == (52, 7, True)
    assert (row.month_name, row.day_name, row.quarter) == ("January", "Sunday", 1)
    padded = fn.calendar_parts(F.col("d"), padded=True)["day_name"]
    assert one(spark, padded, "d DATE", date(2023, 1, 1)) == "Sunday   "


@pytest.mark.parametrize(
    "text, dtype, expected",
    [
        ("58.0", T.IntegerType(), 58),
        ("2.5", T.IntegerType(), 2),
        ("n/a", T.IntegerType(), None),
        ("99999999999", T.IntegerType(), None),
        ("12.345", T.DecimalType(12, 2), Decimal("12.35")),
        ("True", T.BooleanType(), True),
        ("2024-02-30", T.DateType(), None),
        ("2024-02-29 10:00:00", T.TimestampNTZType(), datetime(2024, 2, 29, 10)),
        (" x ", T.StringType(), " x "),
    ],
)
def test_lenient_cast(spark, text, dtype, expected):
    assert one(spark, fn.lenient_cast(F.col("s"), dtype), "s STRING", text) == expected
