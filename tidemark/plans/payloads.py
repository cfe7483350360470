"""Raw exchange payloads and exchange lookups derived from lineitem / part.

Role: one payload per order (portfolio = order key, assets = its lines, at
most seven), packed to the exchange's JSON format by Spark so the
normalisers parse real JSON. Numbers are written as strings like the
exchanges do; some lines carry junk (``'n/a'``) where a number is required,
and some orders name an exchange the engine does not support, so the
quarantine path (X8) is exercised. The DuckDB oracle computes the same
results from the numeric columns directly.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.snapshot import Lookups
from tidemark.plans.fixtures import EXCHANGES

# Line-level expressions shared by the Spark builder and the DuckDB oracle.
JUNK = "(l_partkey % 97 = 0)"
QTY = "CAST(CAST(l_quantity AS BIGINT) AS STRING)"
ASSET = (
    "CASE CAST(l_partkey % 50 AS INT) WHEN 0 THEN 'USDT' WHEN 1 THEN 'USDC' WHEN 2 THEN 'BUSD' "
    "WHEN 3 THEN 'XBT' ELSE 'A' || CAST(l_partkey AS STRING) END"
)
EXCHANGE = (
    "CASE WHEN l_orderkey % 101 = 0 THEN 'kraken' ELSE CASE CAST(l_orderkey % 7 AS INT) "
    + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(EXCHANGES))
    + " END END"
)
PAYLOAD_AS_OF = "2024-01-20 00:00:00"
PAYLOAD_NEXT = "2024-01-20 00:00:10"  # the next poll
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

LINE_FIELDS = {
    "asset": ASSET,
    # binance
    "b_free": f"CASE WHEN {JUNK} THEN 'n/a' WHEN l_discount = 0 THEN '0' ELSE {QTY} END",
    "b_locked": "CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END",
    # bingx
    "g_balance": f"CASE WHEN {JUNK} THEN 'n/a' ELSE {QTY} END",
    "g_avail": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(CAST(l_quantity AS BIGINT) - 1 AS STRING) END",
    "g_equity": "CAST(l_extendedprice AS STRING)",
    "g_rp": f"CASE WHEN l_returnflag = 'A' THEN {QTY} END",
    # bitmart
    "m_avail": f"CASE WHEN {JUNK} THEN 'n/a' ELSE {QTY} END",
    "m_frozen": "CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END",
    # bitmex
    "x_mb": "CAST(l_quantity AS BIGINT) * 1000000",
    # bybit
    "y_wb": QTY,
    "y_eq": f"CASE WHEN {JUNK} THEN 'n/a' ELSE {QTY} END",
    "y_usd": "CAST(l_extendedprice AS STRING)",
    "y_pnl": "CAST(l_tax AS STRING)",
    "y_ai": "CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(l_discount AS STRING) END",
    # okx
    "o_eq": f"CASE WHEN {JUNK} THEN 'n/a' ELSE {QTY} END",
    "o_avail": "CASE WHEN l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) - 1 AS STRING) END",
    "o_usd": "CAST(l_extendedprice AS STRING)",
    "o_liab": "CASE WHEN l_returnflag = 'R' THEN CAST(l_tax AS STRING) ELSE '' END",
    "o_int": "CASE WHEN l_returnflag = 'A' THEN CAST(l_discount AS STRING) ELSE '' END",
    # zoomex
    "z_wb": f"CASE WHEN {JUNK} THEN 'n/a' ELSE {QTY} END",
    "z_eq": QTY,
    "z_usd": "CASE WHEN l_returnflag = 'R' THEN '' WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_extendedprice AS STRING) END",
    "z_pnl": "CAST(l_tax AS STRING)",
    "z_ai": "CASE WHEN l_linestatus = 'O' THEN '' ELSE CAST(l_discount AS STRING) END",
}


#: What a payload's array is made from, in its order: (linenumber, partkey, suppkey, quantity, price) is unique per line.
LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _arr(*pairs: tuple[str, str]) -> F.Column:
    """The lines with the fields ``(name, key of LINE_FIELDS)`` of an exchange, made
    after the shuffle, which so carries plain columns only."""
    fields = ", ".join(f"'{name}', " + re.sub(r"\bl_[a-z]+", r"x.\g<0>", LINE_FIELDS[src]) for name, src in pairs)
    return F.expr(f"transform(lines, x -> named_struct({fields}))")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = li.select("l_orderkey", F.expr(EXCHANGE).alias("exchange"), F.struct(*LINE_COLUMNS).alias("line"), "l_extendedprice")
    per_order = lines.groupBy("l_orderkey", "exchange").agg(
        F.sort_array(F.collect_list("line")).alias("lines"),
        F.sum("l_extendedprice").cast("string").alias("total_eq"),
    )
    body = {
        "binance": F.struct(_arr(("asset", "asset"), ("free", "b_free"), ("locked", "b_locked")).alias("balances")),
        "bingx": F.struct(
            _arr(
                ("asset", "asset"),
                ("balance", "g_balance"),
                ("availableMargin", "g_avail"),
                ("equity", "g_equity"),
                ("realisedProfit", "g_rp"),
            ).alias("data")
        ),
        "bitmart": F.struct(
            _arr(("currency", "asset"), ("available_balance", "m_avail"), ("frozen_balance", "m_frozen")).alias("data")
        ),
        "bitmex": _arr(("currency", "asset"), ("marginBalance", "x_mb")),
        "bybit": F.struct(
            F.array(
                F.struct(
                    F.col("total_eq").alias("totalEquity"),
                    _arr(
                        ("coin", "asset"),
                        ("walletBalance", "y_wb"),
                        ("equity", "y_eq"),
                        ("usdValue", "y_usd"),
                        ("cumRealisedPnl", "y_pnl"),
                        ("accruedInterest", "y_ai"),
                    ).alias("coin"),
                )
            ).alias("data")
        ),
        "okx": F.struct(
            F.array(
                F.struct(
                    F.col("total_eq").alias("totalEq"),
                    _arr(
                        ("ccy", "asset"),
                        ("eq", "o_eq"),
                        ("availEq", "o_avail"),
                        ("eqUsd", "o_usd"),
                        ("liab", "o_liab"),
                        ("interest", "o_int"),
                    ).alias("details"),
                )
            ).alias("data")
        ),
        "zoomex": F.struct(
            F.struct(
                F.array(
                    F.struct(
                        _arr(
                            ("coin", "asset"),
                            ("walletBalance", "z_wb"),
                            ("equity", "z_eq"),
                            ("usdValue", "z_usd"),
                            ("cumRealisedPnl", "z_pnl"),
                            ("accruedInterest", "z_ai"),
                        ).alias("coin")
                    )
                ).alias("list")
            ).alias("result")
        ),
    }
    payload = F.lit(None).cast("string")
    for ex, b in body.items():
        payload = F.when(F.col("exchange") == ex, F.to_json(b)).otherwise(payload)
    payload = F.when(F.col("exchange") == "kraken", F.to_json(body["binance"])).otherwise(payload)
    return per_order.select(F.col("l_orderkey").cast("string").alias("portfolio"), "exchange", payload.alias("payload"))


def polled(payloads: DataFrame, *times: str) -> DataFrame:
    """Every payload as polled at each of ``times``."""
    return payloads.withColumn("fetched_at", F.explode(F.array(*[F.lit(t).cast("timestamp_ntz") for t in times])))


# Lookup tables (exchange-wide reference data) --------------------------------
PRICES_SQL = "SELECT 'A' || CAST(p_partkey AS STRING) || 'USDT' AS symbol, CAST(p_retailprice AS STRING) AS price FROM part WHERE p_size > 10"
PAIRS_SQL = (
    "SELECT p_partkey * 2 AS pos, 'A' || CAST(p_partkey AS STRING) AS base_currency, "
    "'A' || CAST(p_partkey AS STRING) || '_USDT' AS symbol, "
    "CASE WHEN p_size > 5 THEN 'trading' ELSE 'halted' END AS trade_status FROM part "
    "UNION ALL SELECT p_partkey * 2 + 1, 'A' || CAST(p_partkey AS STRING), 'A' || CAST(p_partkey AS STRING) || '_USDC', "
    "CASE WHEN p_size > 2 THEN 'trading' ELSE 'halted' END FROM part"
)
TICKERS_SQL = (
    "SELECT 'A' || CAST(p_partkey AS STRING) || '-USDT-SPOT' AS product_symbol, CAST(p_retailprice AS STRING) AS last FROM part "
    "UNION ALL SELECT 'A' || CAST(p_partkey AS STRING) || '-USDC-SPOT', CAST(p_retailprice + 1 AS STRING) FROM part"
)
INSTRUMENTS_SQL = (
    "SELECT p_partkey AS pos, CASE WHEN p_size % 3 = 0 THEN 'FFWCSX' ELSE 'IFXXXP' END AS typ, "
    "'a' || CAST(p_partkey AS STRING) || '_usdt' AS symbol, p_retailprice AS \"lastPrice\" FROM part "
    "UNION ALL SELECT p_partkey + 1000000, 'IFXXXP', 'A' || CAST(p_partkey AS STRING) || '_USDT', p_retailprice * 2 FROM part"
)


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")

    def q(sql: str) -> DataFrame:
        return spark.sql(sql.replace("FROM part", "FROM {part}").replace('"lastPrice"', "`lastPrice`"), part=part)

    return Lookups(prices=q(PRICES_SQL), pairs=q(PAIRS_SQL), tickers=q(TICKERS_SQL), instruments=q(INSTRUMENTS_SQL))
