"""Role views over the driver's TPC-H-like tables.

The driver's tables have no portfolio data, so each role of the engine
(portfolio dimension, account summaries, refill series, payloads, transfers,
job events) is a projection of a driver table. Each role is written once as
``(alias, expression)`` pairs in the SQL subset Spark and DuckDB share; the
Spark side runs them through ``selectExpr`` (Catalyst still prunes and pushes
filters into the Parquet scan), the DuckDB oracle inlines the same text as a
CTE, so both sides see identical inputs. Where the dialects differ, a pair
carries a Spark and a DuckDB spelling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping.
EXCHANGES = ["binance", "bingx", "bitmart", "bitmex", "bybit", "okx", "zoomex"]
AS_OF = "2002-01-01 00:00:00"  # run time of the live marts: after every order date


@dataclass(frozen=True)
class Col:
    alias: str
    expr: str
    spark: str | None = None  # Spark spelling when it differs from ``expr``

    def spark_expr(self) -> str:
        return f"{self.spark or self.expr} AS `{self.alias}`"

    def duck_expr(self) -> str:
        return f'{self.expr} AS "{self.alias}"'


def _exchange_of(col: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(EXCHANGES))
    return f"CASE CAST({col} % {len(EXCHANGES)} AS INT) {whens} END"


def _tw(col: str) -> Col:
    return Col(
        "tw_time",
        f"strftime({col} + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')",
        f"date_format({col} + INTERVAL 8 HOURS, 'yyyy-MM-dd HH:mm:ss')",
    )


def _trunc(unit: str, col: str) -> tuple[str, str]:
    return (f"date_trunc('{unit}', {col})", f"CAST(date_trunc('{unit.upper()}', {col}) AS TIMESTAMP_NTZ)")


@dataclass(frozen=True)
class Role:
    name: str
    table: str
    columns: tuple[Col, ...]
    group_by: tuple[str, ...] = ()  # aggregated roles: group keys (aliases)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        src = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if not self.group_by:
            return src.selectExpr(*[c.spark_expr() for c in self.columns])
        keys = [c for c in self.columns if c.alias in self.group_by]
        aggs = [c for c in self.columns if c.alias not in self.group_by]
        return src.groupBy(*[F.expr(c.spark or c.expr).alias(c.alias) for c in keys]).agg(
            *[F.expr(c.spark or c.expr).alias(c.alias) for c in aggs]
        )

    def sql(self) -> str:
        sel = ", ".join(c.duck_expr() for c in self.columns)
        if not self.group_by:
            return f"SELECT {sel} FROM {self.table}"
        pos = [str(i + 1) for i, c in enumerate(self.columns) if c.alias in self.group_by]
        return f"SELECT {sel} FROM {self.table} GROUP BY {', '.join(pos)}"


# portfolio dimension <- customer -------------------------------------------
PORTFOLIO = Role(
    "portfolio",
    "customer",
    (
        Col("portfolio", "CAST(c_custkey AS STRING)"),
        Col("exchange", _exchange_of("c_custkey")),
        Col("status", "CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END"),
        Col("master_portfolio", "CASE WHEN c_nationkey = 24 THEN NULL ELSE 'M' || CAST(c_nationkey AS STRING) END"),
        Col(
            "composite",
            "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'MACHINERY' THEN '' ELSE 'C-' || c_mktsegment END",
        ),
        Col(
            "position_threshold",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CAST(NULL AS DOUBLE) "
            "WHEN 'FURNITURE' THEN CAST(0 AS DOUBLE) ELSE CAST(FLOOR(c_acctbal) AS DOUBLE) * 40 END",
        ),
    ),
)

_ADJ_ORDERS = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN -(o_totalprice / 20) "
    "WHEN '2-HIGH' THEN o_totalprice / 50 ELSE CAST(0 AS DOUBLE) END"
)

# account_summary_1_minute <- orders (one snapshot per order) ---------------
ACCOUNT_SUMMARY = Role(
    "account_summary",
    "orders",
    (
        Col("id", "o_orderkey"),
        Col("portfolio", "CAST(o_custkey AS STRING)"),
        Col("exchange", _exchange_of("o_custkey")),
        Col("total_usd_value", "o_totalprice"),
        Col("transfer_adjustment", _ADJ_ORDERS),
        Col("current_time", "o_orderdate"),
        _tw("o_orderdate"),
    ),
)

# monthly account summaries <- orders (master-level refill) -----------------
_MONTH = _trunc("month", "o_orderdate")
MONTHLY_SUMMARY = Role(
    "monthly_summary",
    "orders",
    (
        Col("portfolio", "CAST(o_custkey AS STRING)"),
        Col("total_usd_value", "o_totalprice"),
        Col("transfer_adjustment", _ADJ_ORDERS),
        Col("current_time", *_MONTH),
        Col(
            "tw_time",
            f"strftime({_MONTH[0]} + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')",
            f"date_format({_MONTH[1]} + INTERVAL 8 HOURS, 'yyyy-MM-dd HH:mm:ss')",
        ),
    ),
)

# daily account summaries <- events by (user, day) (portfolio-level refill) --
_DAY = _trunc("day", "ts")
DAILY_SUMMARY = Role(
    "daily_summary",
    "events",
    (
        Col("portfolio", "CAST(user_id AS STRING)"),
        Col("current_time", *_DAY),
        Col(
            "tw_time",
            f"strftime({_DAY[0]} + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')",
            f"date_format({_DAY[1]} + INTERVAL 8 HOURS, 'yyyy-MM-dd HH:mm:ss')",
        ),
        Col("total_usd_value", "SUM(CASE WHEN event_type IN ('purchase', 'click') THEN value ELSE CAST(0 AS DOUBLE) END)"),
        Col(
            "transfer_adjustment",
            "SUM(CASE event_type WHEN 'signup' THEN value WHEN 'error' THEN -value ELSE CAST(0 AS DOUBLE) END)",
        ),
    ),
    group_by=("portfolio", "current_time", "tw_time"),
)

# transfer records <- events (A7: unified rule, A8: 18/6 rule) ---------------
TRANSFERS = Role(
    "transfers",
    "events",
    (
        Col("portfolio", "CAST(user_id AS STRING)"),
        Col(
            "ts_ms",
            "CAST(epoch_us(ts) // 1000 AS STRING)",
            "CAST(timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS STRING)",
        ),
        Col(
            "to_account",
            "CASE event_type WHEN 'signup' THEN 'UNIFIED' WHEN 'purchase' THEN 'unified' "
            "WHEN 'click' THEN '18' WHEN 'view' THEN '6' ELSE 'FUND' END",
        ),
        Col("amount", "CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS STRING)"),
    ),
)

# job telemetry events <- events --------------------------------------------
JOB_EVENTS = Role(
    "job_events",
    "events",
    (
        Col("event_id", "event_id"),
        Col("job_id", "'job-' || CAST(user_id AS STRING)"),
        Col(
            "event",
            "CASE event_type WHEN 'signup' THEN 'submitted' WHEN 'view' THEN 'missed' "
            "WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'success' ELSE 'error' END",
        ),
        Col("recorded_at", "ts"),
        Col("scheduled_at", "date_trunc('minute', ts)", "CAST(date_trunc('MINUTE', ts) AS TIMESTAMP_NTZ)"),
        Col("message", "CASE WHEN event_type = 'error' THEN 'RuntimeError: ' || props ELSE NULL END"),
    ),
)

# scalar-function inputs <- events ---------------------------------------------
_EPOCH_US = ("epoch_us(ts)", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
_OFFSET = "CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'Z' WHEN 1 THEN '+08:00' ELSE '-0530' END"
SCALAR_INPUTS = Role(
    "scalar_inputs",
    "events",
    (
        Col("event_id", "event_id"),
        Col("ts", "ts"),
        Col(
            "iso",
            f"strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || {_OFFSET}",
            f"date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || {_OFFSET}",
        ),
        Col(
            "epoch",
            "CAST(CASE CAST(event_id % 4 AS INT) WHEN 0 THEN {u} / 1e6 WHEN 1 THEN floor({u} / 1000) "
            "WHEN 2 THEN {u} ELSE {u} * 1000 END AS DOUBLE)".format(u=_EPOCH_US[0]),
            "CAST(CASE CAST(event_id % 4 AS INT) WHEN 0 THEN {u} / 1e6 WHEN 1 THEN floor({u} / 1000) "
            "WHEN 2 THEN {u} ELSE {u} * 1000 END AS DOUBLE)".format(u=_EPOCH_US[1]),
        ),
        Col(
            "word",
            "CASE event_type WHEN 'click' THEN ' Yes ' WHEN 'view' THEN 'off' WHEN 'purchase' THEN 'T' "
            "WHEN 'signup' THEN '0' ELSE 'maybe' END",
        ),
    ),
)

ROLES = {
    r.name: r
    for r in (PORTFOLIO, ACCOUNT_SUMMARY, MONTHLY_SUMMARY, DAILY_SUMMARY, TRANSFERS, JOB_EVENTS, SCALAR_INPUTS)
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ROLES[name].spark(spark, sf_dir)


def cte(*names: str) -> str:
    """``WITH`` clause defining the given roles as DuckDB CTEs."""
    return "WITH " + ",\n".join(f"{n} AS ({ROLES[n].sql()})" for n in names)
