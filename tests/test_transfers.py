"""Signed transfer sums over a look-back window."""

import datetime as dt

import pytest

from tidemark.operators.transfers import transfer_adjustment

AS_OF = dt.datetime(2024, 2, 29, 23, 59, 30)
RECORDS = "portfolio string, ts_ms string, to_account string, amount string"


def at(seconds_before):
    since = AS_OF - dt.timedelta(seconds=seconds_before) - dt.datetime(1970, 1, 1)
    return str(int(since.total_seconds() * 1000))


def result(spark, rows, minutes, rule):
    return {r.portfolio: r for r in transfer_adjustment(spark.createDataFrame(rows, RECORDS), AS_OF, minutes, rule).collect()}


def test_unified_signs_and_window_edge(spark):
    rows = [
        ("a", at(5), "UNIFIED", "12.5"),
        ("a", at(20), "fund", "40"),
        ("a", at(120), "fund", "7"),  # exactly at the cut-off: outside
        ("a", at(-60), "unified", "1"),  # later than as_of: inside
        ("b", at(500), "fund", "3"),
    ]
    got = result(spark, rows, 2, "unified")
    assert got["a"].adjustment == pytest.approx(40 - 12.5 - 1) and got["a"].ok
    assert got["b"].adjustment == 0 and got["b"].ok


def test_codes_count_absolute_amounts(spark):
    rows = [("a", at(1), "18", "-30"), ("a", at(2), "6", "-4.5"), ("a", at(3), "7", "junk"), ("a", at(400), "18", "1000")]
    got = result(spark, rows, 1, "18/6")["a"]
    assert got.adjustment == pytest.approx(-25.5) and got.ok


@pytest.mark.parametrize("rule,value", [("unified", 0.0), ("18/6", None)])
def test_unreadable_records(spark, rule, value):
    rows = [("a", at(1), "6", "2"), ("a", at(1), "6", "x1"), ("b", "yesterday", "6", "2"), ("c", at(1), "6", "2")]
    got = result(spark, rows, 1, rule)
    assert (got["a"].adjustment, got["a"].ok, got["b"].ok, got["c"].ok) == (value, False, False, True)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        result(spark, [("a", at(1), "6", "2")], 1, "other")
