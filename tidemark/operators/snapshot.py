"""Snapshot normalisers: raw exchange payloads -> one account-summary row per
portfolio (X0-X8, J5-J8, A6, F6-F8, F12-F14, T4).

Input is a payload table ``portfolio, exchange, payload`` (the JSON body an
exchange returns for one account). A payload is read once, parsed once with its
exchange's schema (``from_json``), and stays one row: its asset array is valued by
``transform`` and folded by ``aggregate`` into a total and a ``balances`` map, so
nothing is exploded or shuffled and two payloads of an account are two results.
Exchange-wide price lists of a checked size become a constant hash table in the
plan; longer ones are joined. An account whose payload cannot be
parsed where the reference would raise is quarantined (X8); the others are
unaffected.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import truncate_second, ts_lit, tw_time
from tidemark.operators.alerts import low_value_alerts
from tidemark.operators.rollup import active_portfolios, latest_per_key
from tidemark.operators.transfers import poll_adjustments, transfer_adjustment

# --------------------------------------------------------------------------- fixed values
# Payload formats of the exchanges' balance endpoints (numbers arrive as strings).
PAYLOAD_DDL = {
    "binance": "balances ARRAY<STRUCT<asset: STRING, free: STRING, locked: STRING>>",
    "bingx": "data ARRAY<STRUCT<asset: STRING, balance: STRING, availableMargin: STRING, equity: STRING, realisedProfit: STRING>>",
    "bitmart": "data ARRAY<STRUCT<currency: STRING, available_balance: STRING, frozen_balance: STRING>>",
    "bitmex": "ARRAY<STRUCT<currency: STRING, marginBalance: BIGINT>>",  # a top-level JSON array
    "bybit": "data ARRAY<STRUCT<totalEquity: STRING, coin: ARRAY<STRUCT<coin: STRING, walletBalance: STRING, "
    "equity: STRING, usdValue: STRING, cumRealisedPnl: STRING, accruedInterest: STRING>>>>",
    "okx": "data ARRAY<STRUCT<totalEq: STRING, details: ARRAY<STRUCT<ccy: STRING, eq: STRING, availEq: STRING, "
    "eqUsd: STRING, liab: STRING, interest: STRING>>>>",
    "zoomex": "result STRUCT<list: ARRAY<STRUCT<coin: ARRAY<STRUCT<coin: STRING, walletBalance: STRING, "
    "equity: STRING, usdValue: STRING, cumRealisedPnl: STRING, accruedInterest: STRING>>>>>",
}
EXCHANGES = list(PAYLOAD_DDL)
BINANCE_STABLES = ["USDT", "BUSD", "USDC"]
BITMEX_SATOSHI_ASSETS = ["XBT", "BTC", "WBTC"]  # balances in 1e-8 units, others 1e-6
BITMEX_STABLES = ["USDT", "USD", "USDC"]
BITMEX_INSTRUMENT_TYPE = "IFXXXP"
ZOOMEX_STABLES = ["USD", "USDT", "USDC", "FDUSD", "BUSD", "TUSD", "DAI", "USDe", "USDD"]
OKX_TRANSFER_WINDOW_MIN = 0.5  # OKX ignores the configured interval
#: Listed symbols of one exchange that are held as a constant, and the slots of its hash table.
LOOKUP_ROWS, LOOKUP_SLOTS = 100_000, 4096
#: Hash of the account: rows that meet others are partitioned by it once.
AT = "_at"
SUMMARY_COLUMNS = ["portfolio", "exchange", "total_usd_value", "balances", "transfer_adjustment", "current_time", "tw_time"]


@dataclass
class Lookups:
    """Exchange-wide reference data (small: one row per listed symbol)."""

    prices: DataFrame | None = None  # binance: symbol, price (strings)
    pairs: DataFrame | None = None  # bitmart: pos, base_currency, symbol, trade_status
    tickers: DataFrame | None = None  # bitmart: product_symbol, last
    instruments: DataFrame | None = None  # bitmex: pos, typ, symbol, lastPrice


@dataclass
class Snapshot:
    """The outcome of one pass. ``rows`` has every polled account, with the reason
    why it failed or NULL; ``summaries`` and ``quarantine`` are its two parts."""

    rows: DataFrame
    missing_prices: DataFrame | None = None
    alerts: DataFrame | None = None

    @property
    def summaries(self) -> DataFrame:
        return summaries_of(self.rows)

    @property
    def quarantine(self) -> DataFrame:
        return quarantine_of(self.rows)


def summaries_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()).select(*SUMMARY_COLUMNS)


def quarantine_of(rows: DataFrame) -> DataFrame:
    """portfolio, exchange, reason; with the poll's time if there are several."""
    times = ["current_time"] if "fetched_at" in rows.columns else []
    return rows.filter(F.col("reason").isNotNull()).select("portfolio", "exchange", "reason", *times)


# --------------------------------------------------------------------------- helpers
def num(c: Column) -> Column:
    """Python ``float(x)``: NULL when x is NULL, empty or junk."""
    return c.try_cast("double")


def fails(c: Column) -> Column:
    """``float(x)`` would raise: missing, empty or not a number."""
    return num(c).isNull()


def zero_if_empty(c: Column) -> Column:
    """``float(x) if x != "" else 0`` (NULL still raises -> flagged by caller)."""
    return F.when(c == "", F.lit(0.0)).otherwise(num(c))


def balance(total: Column, available: Column, notional: Column, liability: Column, interest: Column) -> Column:
    return F.struct(
        total.cast("double").alias("total"),
        available.cast("double").alias("available"),
        notional.cast("double").alias("notional"),
        liability.cast("double").alias("liability"),
        interest.cast("double").alias("interest"),
    )


def _asset(x: Column, *, asset: Column, bal: Column, usd: Column, error: Column, keep: Column | None = None) -> Column:
    """A valued asset in the common shape that every exchange folds from."""
    here = x.isNotNull()
    return F.struct(
        asset.alias("asset"),
        bal.alias("bal"),
        F.coalesce(usd.cast("double"), F.lit(0.0)).alias("usd"),
        F.coalesce(here if keep is None else here & keep, F.lit(False)).alias("keep"),
        F.coalesce(here & error, F.lit(True)).alias("err"),
    )


# --------------------------------------------------------------------------- reference prices
def _last_wins(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key: the last listed (by ``pos``) where a key is listed twice,
    as in a dictionary; without positions the largest value."""
    last = F.max_by(value, "pos") if "pos" in lookup.columns else F.max(value)
    return lookup.groupBy(key).agg(last.alias(value))


def first_trading_pairs(pairs: DataFrame) -> DataFrame:
    """The first pair (array order) per base currency that trades."""
    return (
        pairs.filter(F.col("trade_status") == "trading")
        .groupBy("base_currency")
        .agg(F.min_by("symbol", "pos").alias("_pair"))
    )


LISTS = {"binance": ("prices",), "bitmart": ("pairs", "tickers"), "bitmex": ("instruments",)}


def reference_prices(lookups: Lookups, exchange: str) -> DataFrame | None:
    """(key, price) of an exchange's listed symbols; a NULL price is a symbol
    without one. None for exchanges that report values themselves.

    binance: ``symbol``. bitmart: base currency -> last of the first trading
    pair's ticker. bitmex: upper-cased symbol -> lastPrice of the first IFXXXP
    instrument."""
    if exchange == "binance":
        return _last_wins(lookups.prices, "symbol", "price").select(F.col("symbol").alias("key"), num(F.col("price")).alias("price"))
    if exchange == "bitmart":
        parts = F.split(F.col("_pair"), "_")
        pairs = first_trading_pairs(lookups.pairs).withColumn("product_symbol", F.concat_ws("-", F.get(parts, 0), F.get(parts, 1), F.lit("SPOT")))
        tickers = _last_wins(lookups.tickers, "product_symbol", "last")
        return pairs.join(tickers, "product_symbol", "left").select(F.col("base_currency").alias("key"), num(F.col("last")).alias("price"))
    if exchange == "bitmex":
        listed = lookups.instruments.filter(F.col("typ") == BITMEX_INSTRUMENT_TYPE)
        return listed.groupBy(F.upper("symbol").alias("key")).agg(F.min_by("lastPrice", "pos").cast("double").alias("price"))
    return None


class Prices:
    """A price lookup inside the row: ``listed(key)`` and ``price(key)``."""

    def __init__(self, find: Callable[[Column], Column]):
        self._find = find  # the map that holds the key, if any does

    def listed(self, key: Column) -> Column:
        return F.coalesce(F.map_contains_key(self._find(key), key), F.lit(False))

    def price(self, key: Column) -> Column:
        return F.try_element_at(self._find(key), key)


def _constant(prices: DataFrame) -> Prices | None:
    """Up to ``LOOKUP_ROWS`` symbols as a constant of the plan: a hash table, an
    array of ``LOOKUP_SLOTS`` small maps. None if there are more."""
    slot = F.pmod(F.xxhash64("key"), F.lit(LOOKUP_SLOTS)).cast("int")
    some = prices.filter("key is not null").limit(LOOKUP_ROWS + 1)
    # the driver gets this one bounded row
    held = some.agg(F.count("*").alias("n"), F.to_json(F.collect_list(F.struct(slot.alias("s"), F.col("key").alias("k"), F.col("price").alias("p")))).alias("rows")).first()
    if held.n > LOOKUP_ROWS:
        return None
    slots: list[dict] = [{} for _ in range(LOOKUP_SLOTS)]
    for r in json.loads(held.rows):
        slots[r["s"]][r["k"]] = r.get("p")
    table = F.from_json(F.lit(json.dumps(slots)), "ARRAY<MAP<STRING, DOUBLE>>")
    return Prices(lambda key: F.get(table, F.pmod(F.xxhash64(key), F.lit(LOOKUP_SLOTS)).cast("int")))


def _asked(payloads: DataFrame, exchanges: list[str]) -> DataFrame:
    """(at, exchange, key): the symbols that the payloads of ``exchanges`` ask for."""
    keys = None
    for ex in exchanges:
        own, asked = F.col("exchange") == ex, F.array_distinct(SPECS[ex].keys(F.from_json("payload", PAYLOAD_DDL[ex])))
        keys = F.when(own, asked) if keys is None else keys.when(own, asked)
    return payloads.filter(F.col("exchange").isin(exchanges)).select(_at().alias(AT), "exchange", F.explode(keys).alias("key")).filter("key is not null")


def _joined(payloads: DataFrame, asking: DataFrame, listed: dict[str, DataFrame]) -> DataFrame:
    """More symbols than a constant should hold: the keys that an account's payloads
    ask for, joined to their prices, come back to its rows as a map ``_px`` per exchange.
    Only keys and prices are shuffled, and the rows once, by ``AT``. Accounts that share
    a hash share a map, which holds more than each needs but the same price per key."""
    prices = None
    for ex, p in listed.items():
        p = p.select(F.lit(ex).alias("exchange"), "key", "price")
        prices = p if prices is None else prices.unionByName(p)
    found = _asked(asking, [*listed]).join(prices, ["exchange", "key"])
    entry = F.struct("key", "price")
    maps = found.groupBy(AT).agg(*[F.map_from_entries(F.collect_set(F.when(F.col("exchange") == ex, entry))).alias(f"_px_{ex}") for ex in listed])
    return payloads.join(maps, AT, "left")


# --------------------------------------------------------------------------- exchanges
@dataclass(frozen=True)
class Spec:
    """How an exchange's payload is valued: ``parts`` gives (assets, other faults,
    total or None) of a parsed payload, ``value`` a valued asset, ``keys`` the
    symbols that need a price."""

    parts: Callable[[Column], tuple[Column, Column, Column | None]]
    value: Callable[[Column, Prices | None], Column]
    keys: Callable[[Column], Column] | None = None


def _first(p: Column, *path: str) -> Column:
    for step in path:
        p = F.get(p.getField(step[:-3]), 0) if step.endswith("[0]") else p.getField(step)
    return p


def _value_binance(x: Column, px: Prices) -> Column:
    """amount = free + locked, zero skipped; stables at 1, others priced by
    ``asset || 'USDT'`` or skipped; map values rounded (6 / 2), total not."""
    amount = num(x.free) + num(x.locked)
    price = F.when(x.asset.isin(BINANCE_STABLES), F.lit(1.0)).otherwise(px.price(F.concat(x.asset, F.lit("USDT"))))
    usd = amount * price
    bal = balance(F.bround(amount, 6), F.bround(amount, 6), F.bround(usd, 2), F.lit(0.0), F.lit(0.0))
    error = fails(x.free) | fails(x.locked) | x.asset.isNull()
    return _asset(x, asset=x.asset, bal=bal, usd=usd, keep=(amount != 0) & price.isNotNull(), error=error)


def _value_bingx(x: Column, px: Prices | None) -> Column:
    available = F.coalesce(x.availableMargin, x.equity, F.lit("0"))
    liability = F.coalesce(x.realisedProfit, F.lit("0"))
    error = fails(x.balance) | fails(available) | fails(x.equity) | fails(liability) | x.asset.isNull()
    bal = balance(num(x.balance), num(available), num(x.equity), num(liability), F.lit(0.0))
    return _asset(x, asset=x.asset, bal=bal, usd=num(x.equity), error=error)


def _value_bitmart(x: Column, px: Prices) -> Column:
    """With a trading pair: total = available x last, notional = (available +
    frozen) x last; without: price 1. A pair without a ticker fails."""
    paired, last = px.listed(x.currency), px.price(x.currency)
    available, frozen = num(x.available_balance), num(x.frozen_balance)
    total = F.when(paired, available * last).otherwise(available)
    notional = F.when(paired, (available + frozen) * last).otherwise(available + frozen)
    error = fails(x.available_balance) | fails(x.frozen_balance) | (paired & last.isNull()) | x.currency.isNull()
    return _asset(x, asset=x.currency, bal=balance(total, available, notional, F.lit(0.0), F.lit(0.0)), usd=total, error=error)


def _value_bitmex(x: Column, px: Prices) -> Column:
    """XBT/BTC/WBTC / 1e8, others / 1e6; stables at par, else x lastPrice of
    ``<CCY>_USDT``; unpriced assets stay in the map and add 0."""
    name = F.upper(x.currency)
    raw = F.coalesce(x.marginBalance, F.lit(0)).cast("double")
    amount = F.when(name.isin(BITMEX_SATOSHI_ASSETS), raw / 1e8).otherwise(raw / 1e6)
    usd = F.when(name.isin(BITMEX_STABLES), amount).otherwise(amount * px.price(F.concat(name, F.lit("_USDT"))))
    error = x.currency.isNull() | x.marginBalance.isNull()
    return _asset(x, asset=x.currency, bal=balance(amount, amount, amount, F.lit(0.0), F.lit(0.0)), usd=usd, error=error)


def _value_bybit(x: Column, px: Prices | None) -> Column:
    interest = F.when(x.accruedInterest == "", F.lit(0.0)).otherwise(num(x.accruedInterest))
    error = fails(x.equity) | fails(x.usdValue) | fails(x.cumRealisedPnl) | interest.isNull() | x.coin.isNull()
    bal = balance(num(x.walletBalance), num(x.equity), num(x.usdValue), num(x.cumRealisedPnl), interest)
    return _asset(x, asset=x.coin, bal=bal, usd=F.lit(0.0), error=error)


def _value_okx(x: Column, px: Prices | None) -> Column:
    """"" -> 0 on the five fields."""
    f = [zero_if_empty(x.getField(k)) for k in ("eq", "availEq", "eqUsd", "liab", "interest")]
    error = x.ccy.isNull()
    for v in f:
        error = error | v.isNull()
    return _asset(x, asset=x.ccy, bal=balance(*f), usd=F.lit(0.0), error=error)


def _zoomex_priced(x: Column) -> Column:
    return x.usdValue.isNotNull() & ~x.usdValue.isin("", "null")


def _value_zoomex(x: Column, px: Prices | None) -> Column:
    """usdValue when present, else equity for stables, else 0 (and listed as
    missing a price)."""
    priced, available = _zoomex_priced(x), num(x.equity)
    notional = F.when(priced, num(x.usdValue)).when(x.coin.isin(ZOOMEX_STABLES), available).otherwise(F.lit(0.0))
    interest = F.when(x.accruedInterest.isNull() | (x.accruedInterest == ""), F.lit(0.0)).otherwise(num(x.accruedInterest))
    error = fails(x.walletBalance) | fails(x.equity) | fails(x.cumRealisedPnl) | interest.isNull() | (priced & fails(x.usdValue))
    bal = balance(num(x.walletBalance), available, notional, num(x.cumRealisedPnl), interest)
    return _asset(x, asset=x.coin, bal=bal, usd=notional, error=error)


def _reported(p: Column, total: str, coins: str) -> tuple[Column, Column, Column]:
    """data[0] holds the account's total and its coins."""
    first = _first(p, "data[0]")
    assets, whole = first.getField(coins), first.getField(total)
    return assets, assets.isNull() | fails(whole), num(whole)


def _plain(*path: str) -> Callable[[Column], tuple[Column, Column, None]]:
    """The array of assets lies at ``path`` and must be there; an empty one is an account worth 0."""
    return lambda p: ((assets := _first(p, *path)), assets.isNull(), None)


SPECS = {
    # an object without balances is an empty account there; anything but an object is broken
    "binance": Spec(lambda p: (p.balances, ~F.ltrim(F.col("_json")).startswith("{"), None), _value_binance, lambda p: F.transform(p.balances, lambda x: F.concat(x.asset, F.lit("USDT")))),
    "bingx": Spec(_plain("data"), _value_bingx),
    "bitmart": Spec(_plain("data"), _value_bitmart, lambda p: F.transform(p.data, lambda x: x.currency)),
    "bitmex": Spec(_plain(), _value_bitmex, lambda p: F.transform(p, lambda x: F.concat(F.upper(x.currency), F.lit("_USDT")))),
    # total = the payload's; adjustment from the unified-rule transfer sum
    "bybit": Spec(lambda p: _reported(p, "totalEquity", "coin"), _value_bybit),
    # adjustment from the 18/6 transfer sum (A8) over a fixed 0.5-minute window
    "okx": Spec(lambda p: _reported(p, "totalEq", "details"), _value_okx),
    "zoomex": Spec(_plain("result", "list[0]", "coin"), _value_zoomex),
}


def _parsed(payloads: DataFrame, exchange: str) -> Column:
    return F.when(F.col("exchange") == exchange, F.from_json("payload", PAYLOAD_DDL[exchange])).alias(f"_{exchange}")


def _at() -> Column:
    return F.xxhash64("portfolio")


def _column(name: str) -> Callable[[Column], Column]:
    return lambda key: F.col(name)


def _by(spec: Spec, prices: Prices | None) -> Callable[[Column], Column]:
    return lambda x: spec.value(x, prices)


def valued(payloads: DataFrame, lookups: Lookups, exchanges: list[str], asking: DataFrame | None = None) -> DataFrame:
    """X1-X7 inside the row: the columns of ``payloads`` with ``balances``,
    ``total_usd_value`` and ``_bad``. Each payload is read and parsed once, by its
    exchange's schema; assets are valued and folded as arrays, without a shuffle.
    ``asking``: the same payloads before they were shuffled, where they were."""
    columns = payloads.columns
    lookup: dict[str, Prices | None] = {}
    long: dict[str, DataFrame] = {}
    for ex in exchanges:
        if any(getattr(lookups, name) is None for name in LISTS.get(ex, ())):
            lookup[ex] = Prices(lambda key: F.create_map().cast("map<string, double>"))  # nothing is listed
            continue
        prices = reference_prices(lookups, ex)
        lookup[ex] = None if prices is None else _constant(prices)
        if prices is not None and lookup[ex] is None:
            long[ex] = prices
            lookup[ex] = Prices(_column(f"_px_{ex}"))
    if long:
        payloads = _joined(payloads if AT in columns else payloads.withColumn(AT, _at()), payloads if asking is None else asking, long)
    json_ = F.when(F.col("exchange") == "binance", F.get_json_object("payload", "$")).alias("_json")
    rows = payloads.select("*", json_, *[_parsed(payloads, ex) for ex in exchanges])
    assets = faults = total = reports = None
    for ex in exchanges:
        spec, own = SPECS[ex], F.col("exchange") == ex
        array, fault, whole = spec.parts(F.col(f"_{ex}"))
        array = F.transform(array, _by(spec, lookup[ex]))
        assets = F.when(own, array) if assets is None else assets.when(own, array)
        faults = F.when(own, fault) if faults is None else faults.when(own, fault)
        if whole is not None:
            total = F.when(own, whole) if total is None else total.when(own, whole)
            reports = own if reports is None else reports | own
    # one row each; unlike a projection's columns, what comes out is never computed again inside a later filter
    once = F.struct(assets.alias("_assets"), faults.alias("_faults"), *([total.alias("_total")] if total is not None else []))
    rows = rows.select(*columns, F.inline_outer(F.array(once)))
    return _folded(rows, reports)


def _folded(rows: DataFrame, reports: Column | None) -> DataFrame:
    """A6 + F12: ``balances`` keeps the last kept entry per asset (a Python dict is
    last-wins); ``total_usd_value`` sums every kept entry, or is the payload's own
    total where the exchange reports one."""
    rows = rows.withColumn("_kept", F.coalesce(F.filter("_assets", lambda x: x["keep"]), F.array().cast(rows.schema["_assets"].dataType)))
    kept = F.col("_kept")
    last_only = F.filter(kept, lambda x, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda y: y["asset"] == x["asset"]))
    balances = F.map_from_entries(F.transform(last_only, lambda x: F.struct(x["asset"], x["bal"])))
    summed = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x["usd"])
    bad = F.coalesce(F.col("_faults"), F.lit(True)) | F.coalesce(F.exists("_assets", lambda x: x["err"]), F.lit(False))
    total = F.when(reports, F.col("_total")).otherwise(summed) if reports is not None else summed
    # a failed account may have entries that make no map
    rows = rows.withColumn("_bad", bad)
    out = rows.withColumn("balances", F.when(~F.col("_bad"), balances)).withColumn("total_usd_value", total)
    return out.drop("_assets", "_faults", "_total", "_kept")


def _normaliser(exchange: str):
    def public(payloads: DataFrame, lookups: Lookups, adjustments: DataFrame | None = None) -> DataFrame:
        rows = valued(payloads.filter(F.col("exchange") == exchange), lookups, [exchange])
        return _with_adjustment(rows.select("portfolio", "exchange", "balances", "total_usd_value", "_bad"), adjustments)

    public.__name__ = f"normalise_{exchange}"
    public.__doc__ = SPECS[exchange].value.__doc__
    return public


NORMALISERS = {ex: _normaliser(ex) for ex in EXCHANGES}
normalise_binance, normalise_bingx, normalise_bitmart, normalise_bitmex, normalise_bybit, normalise_okx, normalise_zoomex = (NORMALISERS[ex] for ex in EXCHANGES)


def zoomex_missing_prices(payloads: DataFrame) -> DataFrame:
    """Side output of X7: (portfolio, coin, available) without a price."""
    coins = _first(F.from_json("payload", PAYLOAD_DDL["zoomex"]), "result", "list[0]", "coin")
    rows = payloads.filter(F.col("exchange") == "zoomex").select("portfolio", F.explode(coins).alias("e")).filter("e is not null")
    e = F.col("e")
    return rows.filter(~_zoomex_priced(e) & ~e.coin.isin(ZOOMEX_STABLES)).select("portfolio", e.coin.alias("coin"), num(e.equity).alias("available"))


def _with_adjustment(out: DataFrame, adjustments: DataFrame | None) -> DataFrame:
    """``transfer_adjustment``, per poll where there are several: an account's
    adjustments come to its rows as one map, by ``AT``."""
    if adjustments is None:
        return out.withColumn("transfer_adjustment", F.lit(0.0))
    keys = [k for k in ("portfolio", "exchange", "current_time") if k in adjustments.columns]
    adj = adjustments.filter(F.col("portfolio").isNotNull())
    maps = adj.groupBy(_at().alias(AT)).agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), F.struct("adjustment", "ok")))).alias("_adjs"))
    found = F.try_element_at("_adjs", F.struct(*keys))
    rows = out if AT in out.columns else out.withColumn(AT, _at())
    return (
        rows.join(maps, AT, "left")
        .withColumn("_bad", F.col("_bad") | ~F.coalesce(found.getField("ok"), F.lit(True)))
        .withColumn("transfer_adjustment", F.coalesce(found.getField("adjustment"), F.lit(0.0)))
        .drop("_adjs", *([] if AT in out.columns else [AT]))
    )


# --------------------------------------------------------------------------- X0 / X8
def snapshot(
    payloads: DataFrame,
    lookups: Lookups,
    as_of: Any,
    *,
    transfers: DataFrame | None = None,
    bybit_interval_minutes: float = 0.5,
    exchanges: list[str] | None = None,
    portfolios: DataFrame | None = None,
) -> Snapshot:
    """Value every payload by its exchange and stamp it; unknown exchanges
    and failed accounts have a ``reason`` (X8). With a ``portfolios`` frame only
    active accounts are valued (S1) and the low-value alerts (L1) of the pass are in
    ``alerts``.

    Without ``fetched_at`` all payloads are of ``as_of``. With it every poll of an
    account is a summary of its own, at its own second (``as_of`` where NULL); of two
    polls in one second the newer counts, of two at one instant that with the
    greater payload hash. Of an account's polls each counts the transfers up to itself, the
    newest also later ones, as a single run does."""
    todo = exchanges or EXCHANGES
    active = None
    if portfolios is not None:
        active = active_portfolios(portfolios)
        payloads = payloads.join(active.select("portfolio").distinct(), "portfolio", "left_semi")
    polled = "fetched_at" in payloads.columns
    time = ts_lit(as_of)
    if polled:
        payloads = payloads.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
        time = F.coalesce(truncate_second("fetched_at"), time)
    rows = payloads.withColumn("current_time", time)
    if polled or transfers is not None:
        # payloads meet their accounts' other polls, prices and transfers in one place, before they grow by being valued
        rows = rows.withColumn(AT, _at()).repartition(AT)
    if polled:
        rows = latest_per_key(rows, [AT, "portfolio", "exchange", "current_time"], "fetched_at", [F.xxhash64("payload")])
    # the join is last: below it, a filter on its outcome would value every payload twice
    adjustments = None if transfers is None else _adjustments(payloads, transfers, time, as_of, bybit_interval_minutes, todo)
    rows = _with_adjustment(valued(rows, lookups, todo, payloads).drop("payload"), adjustments).drop(AT)
    unknown = ~F.col("exchange").isin(EXCHANGES) | F.col("exchange").isNull()
    skipped = F.col("exchange").isin([ex for ex in EXCHANGES if ex not in todo])
    reason = F.when(unknown, F.lit("unsupported exchange")).when(F.col("_bad"), F.lit("unparsable payload"))
    rows = rows.filter(unknown | ~skipped).withColumns({"tw_time": tw_time(F.col("current_time")), "reason": reason}).drop("_bad")
    alerts = low_value_alerts(summaries_of(rows), active) if active is not None else None
    return Snapshot(rows, zoomex_missing_prices(payloads), alerts)


def _adjustments(payloads: DataFrame, transfers: DataFrame, time: Column, as_of: Any, bybit_minutes: float, todo: list[str]) -> DataFrame | None:
    """A7 / A8 per account, and per poll where there are several."""
    out = None
    for ex, (minutes, rule) in {"bybit": (bybit_minutes, "unified"), "okx": (OKX_TRANSFER_WINDOW_MIN, "18/6")}.items():
        if ex not in todo:
            continue
        if "fetched_at" in payloads.columns:
            polls = payloads.filter(F.col("exchange") == ex).select("portfolio", time.alias("current_time")).distinct()
            a = poll_adjustments(transfers, polls, minutes, rule)
        else:
            a = transfer_adjustment(transfers, as_of, minutes, rule, every_portfolio=False)
        a = a.withColumn("exchange", F.lit(ex))
        out = a if out is None else out.unionByName(a)
    return out
