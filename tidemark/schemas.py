"""Fixed schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

D = T.DoubleType()
S = T.StringType()
TS = T.TimestampNTZType()  # naive UTC, second precision

BALANCE = T.StructType(
    [
        T.StructField("total", D),
        T.StructField("available", D),
        T.StructField("notional", D),
        T.StructField("liability", D),
        T.StructField("interest", D),
    ]
)

PORTFOLIO = T.StructType(
    [
        T.StructField("portfolio", S),
        T.StructField("exchange", S),
        T.StructField("status", S),
        T.StructField("master_portfolio", S),
        T.StructField("composite", S),
        T.StructField("position_threshold", D),
    ]
)

ACCOUNT_SUMMARY = T.StructType(
    [
        T.StructField("portfolio", S),
        T.StructField("exchange", S),
        T.StructField("total_usd_value", D),
        T.StructField("balances", T.MapType(S, BALANCE)),
        T.StructField("transfer_adjustment", D),
        T.StructField("current_time", TS),
        T.StructField("tw_time", S),
    ]
)

PERFORMANCE_METRICS = ["total_usd_value", "history_high", "nav", "current_return", "crr", "cd", "mdd"]


def performance_schema(key: str) -> T.StructType:
    return T.StructType(
        [T.StructField(key, S)]
        + [T.StructField(c, D) for c in PERFORMANCE_METRICS]
        + [T.StructField("current_time", TS), T.StructField("tw_time", S)]
    )


PORTFOLIO_PERFORMANCE = performance_schema("portfolio")
MASTER_PERFORMANCE = performance_schema("master_portfolio")

JOB_EVENT = T.StructType(
    [
        T.StructField("job_id", S),
        T.StructField("event", S),
        T.StructField("recorded_at", TS),
        T.StructField("scheduled_at", TS),
        T.StructField("duration_ms", D),
        T.StructField("message", S),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("portfolio", S),
        T.StructField("exchange", S),
        T.StructField("payload", S),
    ]
)
