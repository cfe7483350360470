"""Signed transfer sums over a look-back window.

Records: ``portfolio, ts_ms (epoch ms as string), to_account, amount``.
A record counts when ``ts > as_of - interval`` (strict, no upper bound).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import ts_lit

# Account codes of the 18/6 rule ("18" = trading, "6" = funding).
TRADING_CODE = "18"
FUNDING_CODE = "6"
UNIFIED = "unified"


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a naive-UTC timestamp, independent of the
    session time zone."""
    return F.timestamp_diff(
        "MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz")
    )


def _cutoff_ms(as_of: Any, interval_minutes: float) -> Column:
    """Epoch ms of ``as_of - interval`` (as_of is naive UTC)."""
    return epoch_ms(ts_lit(as_of)) - F.lit(int(round(float(interval_minutes) * 60_000)))


def _signed(rule: str) -> tuple[Column, Column]:
    """(signed amount, whether a record inside the window cannot be read) by rule."""
    amt, to = F.col("amount").try_cast("double"), F.col("to_account")
    if rule == "unified":
        sign = F.when(F.lower(to) == UNIFIED, F.lit(-1.0)).otherwise(F.lit(1.0))
        return sign * amt, amt.isNull() | to.isNull()
    if rule == "18/6":
        value = F.when(to == TRADING_CODE, -F.abs(amt)).when(to == FUNDING_CODE, F.abs(amt)).otherwise(F.lit(0.0))
        return value, to.isin(TRADING_CODE, FUNDING_CODE) & amt.isNull()
    raise ValueError("rule must be 'unified' or '18/6'")


def _summed(records: DataFrame, keys: list[str], in_win: Column, value: Column, bad: Column, rule: str) -> DataFrame:
    agg = records.groupBy(*keys).agg(F.coalesce(F.sum(F.when(in_win, value)), F.lit(0.0)).alias("_sum"), F.max(bad.cast("int")).alias("_bad"))
    ok = F.coalesce(F.col("_bad"), F.lit(0)) == 0
    adj = F.when(ok, F.col("_sum"))
    return agg.select(*keys, (F.coalesce(adj, F.lit(0.0)) if rule == "unified" else adj).alias("adjustment"), ok.alias("ok"))


def transfer_adjustment(records: DataFrame, as_of: Any, interval_minutes: float, rule: str = "unified", *, every_portfolio: bool = True) -> DataFrame:
    """Per portfolio: ``adjustment`` (double) and ``ok`` (False when a record in
    the window could not be parsed).

    ``unified``: ``lower(to) == 'unified'`` subtracts the amount, anything
    else adds it; the reference returns 0 for the whole portfolio on any
    parse error. ``18/6``: ``to == '18'`` subtracts ``|amount|``, ``'6'`` adds
    it, other codes are ignored; a parse error fails the portfolio.

    Without ``every_portfolio`` only records of the window (and those without a
    readable time) reach the aggregate, and portfolios without any have no row.
    """
    ts = F.col("ts_ms").try_cast("long")
    value, unreadable = _signed(rule)
    in_win = ts > _cutoff_ms(as_of, interval_minutes)
    if not every_portfolio:
        records = records.filter(ts.isNull() | in_win)
    return _summed(records, ["portfolio"], in_win, value, ts.isNull() | (in_win & unreadable), rule)


def poll_adjustments(records: DataFrame, polls: DataFrame, interval_minutes: float, rule: str = "unified") -> DataFrame:
    """``transfer_adjustment`` of several polls (portfolio, current_time) of an
    account at once: each counts the records of its own window up to itself, the
    newest poll of an account also later ones. Polls without records have no row."""
    ts = F.col("ts_ms").try_cast("long")
    value, unreadable = _signed(rule)
    at = epoch_ms(F.col("current_time"))
    newest = polls.groupBy("portfolio").agg(F.max("current_time").alias("_newest"), F.min("current_time").alias("_oldest"))
    width = F.lit(int(round(float(interval_minutes) * 60_000)))
    # records that no poll can count stay out of the join
    records = records.join(newest, "portfolio").filter(ts.isNull() | (ts > epoch_ms(F.col("_oldest")) - width))
    joined = records.join(polls, "portfolio")
    in_win = (ts > at - width) & ((ts <= at) | (F.col("current_time") == F.col("_newest")))
    joined = joined.filter(ts.isNull() | in_win)
    return _summed(joined, ["portfolio", "current_time"], in_win, value, ts.isNull() | (in_win & unreadable), rule)
