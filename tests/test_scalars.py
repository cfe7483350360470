"""Scalar helpers: strict booleans, ISO / Unix conversions, display time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).collect()[0].r


def test_strict_bool(spark):
    assert one(spark, S.strict_bool("v"), " Yes ") is True
    assert one(spark, S.strict_bool("v"), "off") is False
    assert one(spark, S.strict_bool("v", on_error="null"), "maybe") is None
    with pytest.raises(Exception):
        one(spark, S.strict_bool("v"), "maybe")


def test_iso_to_timestamp_and_unix(spark):
    assert one(spark, S.iso_to_timestamp("v"), "2025-01-01T08:00:00+08:00") == dt.datetime(2025, 1, 1)
    assert one(spark, S.iso_to_unix("v"), "1970-01-01T00:00:01.5Z") == 1.5
    assert one(spark, S.iso_to_timestamp("v"), None) is None
    with pytest.raises(Exception):
        one(spark, S.iso_to_timestamp("v"), "not a date")


@pytest.mark.parametrize(
    "value,expected",
    [
        (1700000000123456789.0, "2023-11-14T22:13:20.123456768Z"),  # ns (double precision)
        (1700000000123456.0, "2023-11-14T22:13:20.123456Z"),  # us
        (1700000000123.0, "2023-11-14T22:13:20.123Z"),  # ms
        (1700000000.5, "2023-11-14T22:13:20.500Z"),  # s
    ],
)
def test_unix_to_iso_precision_by_magnitude(spark, value, expected):
    assert one(spark, S.unix_to_iso("v"), value, "v double") == expected


def test_epoch_to_timestamp_units(spark):
    t = dt.datetime(2023, 11, 14, 22, 13, 20)
    for v in (1700000000.0, 1700000000000.0, 1700000000000000.0, 1700000000000000000.0):
        assert one(spark, S.epoch_to_timestamp("v"), v, "v double") == t


def test_tw_time_and_truncation(spark):
    t = dt.datetime(2025, 1, 1, 23, 59, 59, 999999)
    assert one(spark, S.tw_time("v"), t, "v timestamp_ntz") == "2025-01-02 07:59:59"
    assert one(spark, S.truncate_second("v"), t, "v timestamp_ntz") == dt.datetime(2025, 1, 1, 23, 59, 59)
