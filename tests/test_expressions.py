from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright.functions import expressions as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [
    ("  a b ", "a b"), ("\t\n a\r\n", "a"), (" 　a ", "a"), ("", ""), (None, None),
])
def test_strip_removes_all_white_space(spark, text, expected):
    assert value(spark, X.strip(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text, expected", [
    ("success", "Success"), ("SUCCESS", "Success"), ("a b", "A b"), ("", ""), (None, None),
])
def test_capitalize(spark, text, expected):
    assert value(spark, X.capitalize(F.lit(text).cast("string"))) == expected


def test_title_label(spark):
    assert value(spark, X.title_label(F.lit("net_banking"))) == "Net Banking"


@pytest.mark.parametrize("length, expected", [(30, "x" * 30), (31, "x" * 30 + "...")])
def test_shorten(spark, length, expected):
    assert value(spark, X.shorten(F.lit("x" * length), 30)) == expected


@pytest.mark.parametrize("number, expected", [
    (-1, 0), (0, 0), (5, 5), (10, 10), (11, 10), (None, None),
])
def test_clip_keeps_null(spark, number, expected):
    assert value(spark, X.clip(F.lit(number).cast("int"), 0, 10)) == expected


@pytest.mark.parametrize("total, expected", [
    ("500.00", "New"), ("500.01", "Regular"), ("2000.00", "Regular"), ("2000.01", "Premium"),
    ("5000.00", "Premium"), ("5000.01", "VIP"),
])
def test_segment_bounds_are_strict(spark, total, expected):
    assert value(spark, X.segment(F.lit(Decimal(total)))) == expected


@pytest.mark.parametrize("days, expected", [
    (30, "Active"), (31, "Inactive"), (90, "Inactive"), (91, "At Risk"),
])
def test_activity_bounds_are_strict(spark, days, expected):
    assert value(spark, X.activity(F.lit(days))) == expected


def test_interval_parts_are_components(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    end = F.lit("2024-01-02 06:00:05").cast("timestamp")
    assert value(spark, X.interval_part("DAY", end, start)) == 1
    assert value(spark, X.interval_part("HOUR", end, start)) == 6
    assert value(spark, X.interval_part("SECOND", end, start)) == 5
    assert value(spark, X.interval_part("DAY", start, end)) == -1


def test_seconds_between_keeps_the_fraction(spark):
    start = F.lit("2024-01-01 00:00:00.25").cast("timestamp")
    end = F.lit("2024-01-02 00:00:01").cast("timestamp")
    assert value(spark, X.seconds_between(end, start)) == 86400.75


@pytest.mark.parametrize("text, expected", [
    ("2024-01-05 10:00:00", True), ("", False), ("garbage", False), (None, False),
])
def test_lenient_timestamp(spark, text, expected):
    parsed = value(spark, X.lenient_timestamp(F.lit(text).cast("string")))
    assert (parsed is not None) is expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_timestamp_fails_with_any_setting(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a timestamp: garbage"):
            value(spark, X.strict_timestamp(F.lit("garbage")))
        assert value(spark, X.strict_timestamp(F.lit(None).cast("string"))) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_mean_rounds_once(spark):
    """1.0049996 is 1.00; rounding to 6 digits on the way would make it 1.01."""
    total, count = F.lit(Decimal("2512499.00")), F.lit(2500000)
    assert value(spark, X.mean2(total, count)) == Decimal("1.00")


def test_mean_ties(spark):
    total, count = F.lit(Decimal("24.69")), F.lit(2)
    assert value(spark, X.mean2(total, count)) == Decimal("12.35")
    assert value(spark, X.mean2_half_even(total, count)) == Decimal("12.34")


def test_ratios_without_a_whole_are_null(spark):
    zero = F.lit(0)
    for ratio in (X.mean2, X.percent2, X.mean, X.percent):
        assert value(spark, ratio(F.lit(1), zero)) is None
