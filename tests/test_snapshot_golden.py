"""Exchange normalisers on hand-made accounts; expected values worked out from
the valuation rules of each exchange."""

import json

import pytest

from tidemark.operators.snapshot import Lookups, normalise_bybit, normalise_okx, snapshot

AS_OF = "2024-06-30 16:45:10"
PAYLOADS = "portfolio string, exchange string, payload string"


def frame(spark, *rows):
    return spark.createDataFrame([(p, x, body if body is None or isinstance(body, str) else json.dumps(body)) for p, x, body in rows], PAYLOADS)


def only(spark, exchange, body, **lookups):
    snap = snapshot(frame(spark, ("acct", exchange, body)), Lookups(**lookups), AS_OF, exchanges=[exchange])
    assert snap.quarantine.count() == 0
    (row,) = snap.summaries.collect()
    return row


def test_binance_prices_stables_and_unlisted(spark):
    prices = spark.createDataFrame([("ETHUSDT", "2500"), ("SOLUSDT", "140.5")], "symbol string, price string")
    body = {"balances": [
        {"asset": "ETH", "free": "1.25", "locked": "0.75"},
        {"asset": "SOL", "free": "0", "locked": "0"},
        {"asset": "BUSD", "free": "40.4", "locked": "0.6"},
        {"asset": "NOPE", "free": "17", "locked": "0"},
    ]}
    r = only(spark, "binance", body, prices=prices)
    assert r.total_usd_value == pytest.approx(2 * 2500 + 41)
    assert set(r.balances) == {"ETH", "BUSD"}  # an empty holding and one without a price are left out
    assert (r.balances["ETH"].total, r.balances["ETH"].notional) == (2.0, 5000.0)
    assert r.tw_time == "2024-07-01 00:45:10"


def test_binance_duplicate_price_takes_the_last(spark):
    prices = spark.createDataFrame([(0, "ETHUSDT", "1"), (1, "ETHUSDT", "3")], "pos long, symbol string, price string")
    r = only(spark, "binance", {"balances": [{"asset": "ETH", "free": "7", "locked": "0"}]}, prices=prices)
    assert r.total_usd_value == pytest.approx(21)


def test_bingx_available_falls_back_to_equity(spark):
    r = only(spark, "bingx", {"data": [{"asset": "USDC", "balance": "33", "equity": "35.5"}, {"asset": "VST", "balance": "2", "availableMargin": "1.5", "equity": "2.5", "realisedProfit": "-4"}]})
    assert r.total_usd_value == pytest.approx(38)
    assert r.balances["USDC"].available == 35.5 and r.balances["USDC"].liability == 0
    assert r.balances["VST"].available == 1.5 and r.balances["VST"].liability == -4


def test_bitmart_halted_pair_and_currency_without_pair(spark):
    pairs = spark.createDataFrame([(0, "ADA", "ADA_BTC", "pre-trade"), (1, "ADA", "ADA_USDT", "trading"), (2, "ADA", "ADA_USDC", "trading")], "pos long, base_currency string, symbol string, trade_status string")
    tickers = spark.createDataFrame([("ADA-USDT-SPOT", "0.4"), ("ADA-USDC-SPOT", "9")], "product_symbol string, last string")
    body = {"data": [{"currency": "ADA", "available_balance": "50", "frozen_balance": "25"}, {"currency": "USDT", "available_balance": "8", "frozen_balance": "3"}]}
    r = only(spark, "bitmart", body, pairs=pairs, tickers=tickers)
    assert r.total_usd_value == pytest.approx(50 * 0.4 + 8)
    assert r.balances["ADA"].notional == pytest.approx(30) and r.balances["USDT"].notional == pytest.approx(11)


def test_bitmart_pair_without_ticker_fails(spark):
    pairs = spark.createDataFrame([(0, "ADA", "ADA_USDT", "trading")], "pos long, base_currency string, symbol string, trade_status string")
    tickers = spark.createDataFrame([], "product_symbol string, last string")
    snap = snapshot(frame(spark, ("a", "bitmart", {"data": [{"currency": "ADA", "available_balance": "1", "frozen_balance": "0"}]})), Lookups(pairs=pairs, tickers=tickers), AS_OF, exchanges=["bitmart"])
    assert snap.summaries.count() == 0 and snap.quarantine.count() == 1


def test_bitmex_units_and_unpriced(spark):
    inst = spark.createDataFrame([(0, "FFWCSX", "ETH_USDT", 1.0), (1, "IFXXXP", "ETH_USDT", 2000.0), (2, "IFXXXP", "ETH_USDT", 9.0)], "pos long, typ string, symbol string, lastPrice double")
    body = [{"currency": "ETH", "marginBalance": 1_500_000}, {"currency": "usdc", "marginBalance": 12_000_000}, {"currency": "WBTC", "marginBalance": 300_000_000}]
    r = only(spark, "bitmex", body, instruments=inst)
    assert r.total_usd_value == pytest.approx(1.5 * 2000 + 12)
    assert r.balances["WBTC"].total == pytest.approx(3)  # no price: in the map, worth nothing


def test_bybit_total_is_the_payloads(spark):
    body = {"data": [{"totalEquity": "812.5", "coin": [
        {"coin": "MNT", "walletBalance": "400", "equity": "410", "usdValue": "307.5", "cumRealisedPnl": "-12", "accruedInterest": ""},
        {"coin": "USDT", "walletBalance": "505", "equity": "505", "usdValue": "505", "cumRealisedPnl": "6", "accruedInterest": "0.125"},
    ]}]}
    moved = spark.createDataFrame([("acct", -70.0, True)], "portfolio string, adjustment double, ok boolean")
    (r,) = normalise_bybit(frame(spark, ("acct", "bybit", body)), Lookups(), moved).collect()
    assert (r.total_usd_value, r.transfer_adjustment) == (812.5, -70.0)
    assert r.balances["MNT"].available == 410 and r.balances["MNT"].interest == 0 and r.balances["USDT"].interest == 0.125


def test_okx_empty_strings_are_zero(spark):
    body = {"data": [{"totalEq": "66.6", "details": [{"ccy": "DOT", "eq": "8", "availEq": "", "eqUsd": "44.4", "liab": "", "interest": "0.3"}]}]}
    moved = spark.createDataFrame([("acct", 11.0, True)], "portfolio string, adjustment double, ok boolean")
    (r,) = normalise_okx(frame(spark, ("acct", "okx", body)), Lookups(), moved).collect()
    assert (r.total_usd_value, r.transfer_adjustment) == (66.6, 11.0)
    assert r.balances["DOT"].available == 0 and r.balances["DOT"].notional == 44.4 and r.balances["DOT"].interest == 0.3


def test_zoomex_value_falls_back_for_stables(spark):
    body = {"result": {"list": [{"coin": [
        {"coin": "USDD", "walletBalance": "9", "equity": "9.5", "usdValue": "", "cumRealisedPnl": "1", "accruedInterest": ""},
        {"coin": "XRP", "walletBalance": "100", "equity": "100", "usdValue": "52", "cumRealisedPnl": "0", "accruedInterest": "0.75"},
        {"coin": "LTC", "walletBalance": "2", "equity": "2", "usdValue": "null", "cumRealisedPnl": "0", "accruedInterest": ""},
    ]}]}}
    snap = snapshot(frame(spark, ("acct", "zoomex", body)), Lookups(), AS_OF, exchanges=["zoomex"])
    (r,) = snap.summaries.collect()
    assert r.total_usd_value == pytest.approx(61.5) and r.balances["XRP"].interest == 0.75 and "LTC" in r.balances
    assert [(m.coin, m.available) for m in snap.missing_prices.collect()] == [("LTC", 2.0)]


def lookups(spark):
    return Lookups(
        prices=spark.createDataFrame([], "symbol string, price string"),
        pairs=spark.createDataFrame([], "pos long, base_currency string, symbol string, trade_status string"),
        tickers=spark.createDataFrame([], "product_symbol string, last string"),
        instruments=spark.createDataFrame([], "pos long, typ string, symbol string, lastPrice double"),
    )


EXCHANGES = ["binance", "bingx", "bitmart", "bitmex", "bybit", "okx", "zoomex"]


@pytest.mark.parametrize("body", [None, "<html>502 Bad Gateway</html>", '{"code": 500}', "", '"text"'])
def test_broken_bodies_are_quarantined(spark, body):
    snap = snapshot(frame(spark, *[(x, x, body) for x in EXCHANGES]), lookups(spark), AS_OF)
    fails = set(EXCHANGES) - ({"binance"} if body == '{"code": 500}' else set())  # an object without balances is an empty account there
    assert {r.portfolio for r in snap.quarantine.collect()} == fails
    assert {r.portfolio: r.total_usd_value for r in snap.summaries.collect()} == {x: 0.0 for x in set(EXCHANGES) - fails}


def test_one_bad_account_does_not_touch_the_others(spark):
    rows = frame(spark, ("ok", "bingx", {"data": [{"asset": "USDC", "balance": "4", "equity": "4"}]}), ("bad", "bingx", {"data": [{"asset": "USDC", "balance": "4", "equity": "--"}]}), ("none", "bingx", {"data": []}), ("far", "elsewhere", "{}"))
    snap = snapshot(rows, Lookups(), AS_OF, exchanges=["bingx"])
    assert {r.portfolio: r.total_usd_value for r in snap.summaries.collect()} == {"ok": 4.0, "none": 0.0}
    assert {r.portfolio: r.reason for r in snap.quarantine.collect()} == {"bad": "unparsable payload", "far": "unsupported exchange"}


def test_repeated_asset_last_entry_in_the_map_every_row_in_the_sum(spark):
    r = only(spark, "bingx", {"data": [{"asset": "VST", "balance": "5", "equity": "6"}, {"asset": "VST", "balance": "7", "equity": "9"}]})
    assert r.balances["VST"].total == 7 and r.total_usd_value == pytest.approx(15)


def test_every_fetch_is_a_summary_and_inactive_accounts_are_none(spark):
    body = lambda x: json.dumps({"data": [{"asset": "VST", "balance": x, "equity": x}]})
    polls = [("a", "100", "16:45:00"), ("a", "110", "16:45:10.2"), ("a", "111", "16:45:10.7"), ("z", "5", "16:45:10"), ("a", "oops", "16:45:20")]
    rows = spark.createDataFrame([(p, "bingx", body(x), f"2024-06-30 {t}") for p, x, t in polls], PAYLOADS + ", fetched_at string")
    accounts = spark.createDataFrame([("a", "active", 105.0), ("z", "inactive", None)], "portfolio string, status string, position_threshold double")
    snap = snapshot(rows, Lookups(), AS_OF, exchanges=["bingx"], portfolios=accounts)
    # two fetches of one second: the newer
    assert sorted((r.portfolio, r.total_usd_value, str(r.current_time)) for r in snap.summaries.collect()) == [("a", 100.0, "2024-06-30 16:45:00"), ("a", 111.0, "2024-06-30 16:45:10")]
    assert [(r.key, r.total_usd_value) for r in snap.alerts.collect()] == [("usd_under:a", 100.0)]
    assert [(r.portfolio, str(r.current_time)) for r in snap.quarantine.collect()] == [("a", "2024-06-30 16:45:20")]


def test_repeated_payload_without_time_is_not_added_up(spark):
    body = {"data": [{"asset": "VST", "balance": "100", "equity": "100"}]}
    snap = snapshot(frame(spark, ("a", "bingx", body), ("a", "bingx", body)), Lookups(), AS_OF, exchanges=["bingx"])
    assert [r.total_usd_value for r in snap.summaries.collect()] == [100.0, 100.0]


def test_polls_count_the_transfers_of_their_own_window(spark):
    at = lambda s: 1719765900_000 + s * 1000  # noqa: E731  2024-06-30 16:45:00 UTC
    records = spark.createDataFrame([("a", str(at(s)), "FUND", x) for s, x in [(-40, "1"), (-20, "2"), (5, "4"), (25, "8"), (90, "16")]], "portfolio string, ts_ms string, to_account string, amount string")
    body = json.dumps({"data": [{"totalEquity": "1", "coin": []}]})
    rows = spark.createDataFrame([("a", "bybit", body, f"2024-06-30 16:45:{s:02d}") for s in (0, 10, 40)], PAYLOADS + ", fetched_at string")
    snap = snapshot(rows, Lookups(), AS_OF, transfers=records, exchanges=["bybit"])
    assert {r.current_time.second: r.transfer_adjustment for r in snap.summaries.collect()} == {0: 2.0, 10: 4.0, 40: 24.0}


def test_payloads_are_scanned_once_without_a_shuffle(spark):
    body = {"data": [{"asset": "VST", "balance": "1", "equity": "1"}]}
    path = f"{__import__('tidemark.session').session.checkpoint_root(spark)}/payload-plan"
    frame(spark, ("a", "bingx", body)).write.mode("overwrite").parquet(path)
    plan = snapshot(spark.read.parquet(path), lookups(spark), AS_OF).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_price_lists_beyond_a_constant_are_joined(spark, monkeypatch):
    from tidemark.operators import snapshot as module

    prices = spark.createDataFrame([(f"A{k}USDT", str(k)) for k in range(30)], "symbol string, price string")
    pairs = spark.createDataFrame([(0, "ADA", "ADA_USDT", "trading")], "pos long, base_currency string, symbol string, trade_status string")
    tickers = spark.createDataFrame([("ADA-USDT-SPOT", "0.4")], "product_symbol string, last string")
    inst = spark.createDataFrame([(1, "IFXXXP", "ETH_USDT", 2000.0)], "pos long, typ string, symbol string, lastPrice double")
    listed = Lookups(prices=prices, pairs=pairs, tickers=tickers, instruments=inst)
    rows = frame(
        spark,
        ("b", "binance", {"balances": [{"asset": "A7", "free": "2", "locked": "0"}, {"asset": "ZZ", "free": "2", "locked": "0"}]}),
        ("m", "bitmart", {"data": [{"currency": "ADA", "available_balance": "50", "frozen_balance": "25"}, {"currency": "X", "available_balance": "1", "frozen_balance": "0"}]}),
        ("x", "bitmex", [{"currency": "ETH", "marginBalance": 1_500_000}, {"currency": "QQ", "marginBalance": 5}]),
        ("y", "binance", None),
        ("g", "bingx", {"data": [{"asset": "VST", "balance": "1", "equity": "1"}]}),
    )
    result = lambda: sorted((r.portfolio, r.total_usd_value, sorted(r.balances)) for r in snapshot(rows, listed, AS_OF).summaries.collect())
    constant = result()
    monkeypatch.setattr(module, "LOOKUP_ROWS", 0)
    assert result() == constant == [("b", 14.0, ["A7"]), ("g", 1.0, ["VST"]), ("m", 21.0, ["ADA", "X"]), ("x", 3000.0, ["ETH", "QQ"])]


def test_payloads_are_valued_once_and_shuffled_as_text(spark, monkeypatch):
    """A filter on the outcome values no payload again, and with transfers, polls and
    long price lists the payload rows are shuffled once, before they are valued."""
    from pyspark.sql import functions as F

    from tidemark.operators import snapshot as module
    from tidemark.session import checkpoint_root

    monkeypatch.setattr(module, "LOOKUP_ROWS", 0)
    path = f"{checkpoint_root(spark)}/payload-once"
    body = {"balances": [{"asset": "BTC", "free": "2", "locked": "0"}]}
    rows = frame(spark, ("a", "binance", body), (None, "binance", body)).withColumn("fetched_at", F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"))
    rows.write.mode("overwrite").parquet(path)
    transfers = spark.createDataFrame([("a", "1704067201000", "unified", "5")], "portfolio string, ts_ms string, to_account string, amount string")
    prices = spark.createDataFrame([("BTCUSDT", "10")], "symbol string, price string")
    snap = snapshot(spark.read.parquet(path), Lookups(prices=prices), AS_OF, transfers=transfers)
    balances = snap.summaries.select("portfolio", "total_usd_value", F.explode("balances").alias("asset", "b"))
    assert sorted((r.portfolio or "", r.total_usd_value, r.asset) for r in balances.collect()) == [("", 20.0, "BTC"), ("a", 20.0, "BTC")]
    plan = balances._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("from_json(StructField(balances") for line in plan.splitlines()) == 2  # the symbols it asks for, and its value
    text = [line for line in plan.splitlines() if "RepartitionByExpression" in line]
    assert len(text) == 1


def test_balances_are_folded_once(spark):
    """Exploding them brings no filter on their size below the valuing, which would fold each payload twice."""
    from conftest import SF_SMALL

    from tidemark.plans.queries import registry

    rows = registry()["snapshot_balances"](spark, SF_SMALL)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("map_from_entries(transform(") for line in plan.splitlines()) == 1
    assert rows.filter("asset is null").isEmpty() and not rows.isEmpty()
