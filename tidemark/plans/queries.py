"""Named queries over the driver's tables (the driver contract).

Every query reads whole tables through the role views of
``tidemark.plans.fixtures`` and runs the library's operators; ``finish``
only rounds doubles (6 places) so engine-order float noise cannot break the
value hash against the DuckDB oracle in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.performance import batch_index, prior_snapshot
from tidemark.operators.rollup import (
    active_portfolios,
    composite_refill,
    join_latest,
    master_rollup,
    match_condition,
    refill_base,
)
from tidemark.functions import scalars as S
from tidemark.operators import alerts as AL
from tidemark.operators import cooldown as CD
from tidemark.operators import maintenance as M
from tidemark.operators import telemetry as TM
from tidemark.operators import snapshot as SN
from tidemark.operators.transfers import transfer_adjustment
from tidemark.plans import jobs
from tidemark.plans import payloads as P
from tidemark.plans.fixtures import AS_OF, load
from tidemark.session import cut_lineage, spooled

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed parameters of the fixture queries.
RANGE_START, RANGE_END = "1996-01-01 00:00:00", "1997-12-31 23:59:59"
PREV_AS_OF = "1999-01-01 00:00:00"  # the earlier live run for perf_step_prev
DAILY_SPLIT = "2024-01-08 00:00:00"  # refill start over the daily (events) series
MONTHLY_SPLIT = "1998-01-01 00:00:00"  # refill start over the monthly (orders) series


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _p(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "portfolio")


def _s(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "account_summary")


# --------------------------------------------------------------------------- scans
@query
def active_scan(spark: SparkSession, d: str) -> DataFrame:
    """S1 + P1 + P11."""
    return finish(active_portfolios(_p(spark, d)).drop("status"))


@query
def range_scan(spark: SparkSession, d: str) -> DataFrame:
    """S2 + P10: dict match plus an inclusive time range that overrides the
    dict's condition on the same field."""
    cond = match_condition(
        {"exchange": {"$in": ["okx", "bybit", "binance"]}, "current_time": {"$gte": "2100-01-01"}},
        time_col="current_time",
        start=RANGE_START,
        end=RANGE_END,
    )
    return finish(_s(spark, d).filter(cond).select("id", "portfolio", "exchange", "total_usd_value", "current_time"))


# --------------------------------------------------------------------------- A4 / J1 / A1-A3
@query
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return finish(jobs.latest_summaries(_s(spark, d)))


@query
def active_join(spark: SparkSession, d: str) -> DataFrame:
    return finish(join_latest(active_portfolios(_p(spark, d)), jobs.latest_summaries(_s(spark, d))))


@query
def master_rollup_q(spark: SparkSession, d: str) -> DataFrame:
    joined = join_latest(active_portfolios(_p(spark, d)), jobs.latest_summaries(_s(spark, d)))
    return finish(master_rollup(joined, AS_OF))


@query
def composite_live(spark: SparkSession, d: str) -> DataFrame:
    return finish(jobs.master_totals(_p(spark, d), _s(spark, d), AS_OF))


@query
def composite_refill_q(spark: SparkSession, d: str) -> DataFrame:
    return finish(composite_refill(refill_base(_p(spark, d), load(spark, d, "monthly_summary"))))


# --------------------------------------------------------------------------- W1
@query
def perf_step_empty(spark: SparkSession, d: str) -> DataFrame:
    """Master mart against an empty mart: only the smallest key is seeded."""
    return finish(jobs.master_mart(_p(spark, d), _s(spark, d), None, AS_OF))


@query
def perf_step_prev(spark: SparkSession, d: str) -> DataFrame:
    """Two live runs: the mart as of PREV_AS_OF (from the summaries known
    then) is the previous state of the run at AS_OF."""
    p, s = _p(spark, d), _s(spark, d)
    earlier = jobs.master_mart(p, s.filter(F.col("current_time") < F.lit(PREV_AS_OF).cast("timestamp_ntz")), None, PREV_AS_OF)
    earlier = cut_lineage(earlier)  # the mart table the first run wrote
    return finish(jobs.master_mart(p, s, earlier, AS_OF))


@query
def portfolio_mart(spark: SparkSession, d: str) -> DataFrame:
    p, s = _p(spark, d), _s(spark, d)
    earlier = jobs.portfolio_mart(p, s.filter(F.col("current_time") < F.lit(PREV_AS_OF).cast("timestamp_ntz")), None, PREV_AS_OF)
    earlier = cut_lineage(earlier)  # the mart table the first run wrote
    return finish(jobs.portfolio_mart(p, s, earlier, AS_OF))


# --------------------------------------------------------------------------- W2-W4 / J9
def _daily_history(spark: SparkSession, d: str, gap_policy: str = "reset") -> tuple[DataFrame, DataFrame]:
    """Refill of the daily series before DAILY_SPLIT (no seed), then the
    refill from DAILY_SPLIT seeded from it."""
    p, s = _p(spark, d), load(spark, d, "daily_summary")
    end_before = F.lit(DAILY_SPLIT).cast("timestamp_ntz")
    history = jobs.refill(p, s.filter(F.col("current_time") < end_before), None, level="portfolio", gap_policy=gap_policy)
    history = cut_lineage(history)  # the performance table the first refill wrote
    recent = jobs.refill(p, s, history, level="portfolio", start=DAILY_SPLIT, gap_policy=gap_policy)
    return history, recent


@query
def batch_index_q(spark: SparkSession, d: str) -> DataFrame:
    series = jobs.refill_series(_p(spark, d), load(spark, d, "daily_summary"), "portfolio")
    return finish(batch_index(series))


@query
def prior_snapshot_q(spark: SparkSession, d: str) -> DataFrame:
    history, _ = _daily_history(spark, d)
    return finish(prior_snapshot(history, DAILY_SPLIT, "portfolio"))


@query
def refill_portfolio(spark: SparkSession, d: str) -> DataFrame:
    history, recent = _daily_history(spark, d)
    return finish(history.unionByName(recent))


@query
def refill_gap_carry(spark: SparkSession, d: str) -> DataFrame:
    history, recent = _daily_history(spark, d, gap_policy="carry")
    return finish(history.unionByName(recent))


@query
def refill_master(spark: SparkSession, d: str) -> DataFrame:
    p, s = _p(spark, d), load(spark, d, "monthly_summary")
    history = jobs.refill(
        p, s.filter(F.col("current_time") < F.lit(MONTHLY_SPLIT).cast("timestamp_ntz")), None, level="master"
    )
    history = cut_lineage(history)  # the performance table the first refill wrote
    recent = jobs.refill(p, s, history, level="master", start=MONTHLY_SPLIT)
    return finish(history.unionByName(recent))


# --------------------------------------------------------------------------- dedup / merge / update
DEDUP_A = dict(group_fields=["portfolio", "current_time"], time_field="current_time", sort_tiebreak=[("total_usd_value", -1)])
DEDUP_B = dict(
    group_fields=["portfolio"],
    time_field="current_time",
    start=RANGE_START,
    end="1998-12-31 23:59:59",
    extra_match={"exchange": {"$in": ["okx", "bybit", "bitmex"]}},
    sort_tiebreak=[("id", -1)],
)
MERGE_TARGET_BEFORE = "1999-01-01 00:00:00"
MERGE_SOURCE_FROM = "1998-07-01 00:00:00"
MERGE_KEYS = ["portfolio", "current_time"]
MERGE_VARIANTS = {
    "set": dict(strategy="set", upsert=True),
    "set_no_null": dict(strategy="set", upsert=True, null_keeps_target=True),
    "replace": dict(strategy="replace", upsert=True),
    "no_upsert": dict(strategy="set", upsert=False),
}
UPDATE_OPS = [
    {"filter": {"portfolio": "7"}, "update": {"$set": {"exchange": "okx-migrated"}}},
    {
        "filter": {"exchange": "bybit", "current_time": {"$gte": datetime.datetime(1998, 1, 1)}},
        "update": {"$inc": {"total_usd_value": 100.0}},
    },
    {
        "filter": {"portfolio": "no-such-portfolio"},
        "update": {"$set": {"total_usd_value": 1.0, "exchange": "okx"}},
        "upsert": True,
    },
    {"filter": {"id": 5}, "update": {"$unset": ["tw_time"]}},
]


@query
def dedup_keep(spark: SparkSession, d: str) -> DataFrame:
    return finish(M.dedup(_s(spark, d), **DEDUP_A).table)


@query
def dedup_removed(spark: SparkSession, d: str) -> DataFrame:
    return finish(M.dedup(_s(spark, d), **DEDUP_B).removed)


@query
def dedup_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _s(spark, d)
    a = M.dedup(s, **DEDUP_A).summary.withColumn("variant", F.lit("A"))
    b = M.dedup(s, **DEDUP_B).summary.withColumn("variant", F.lit("B"))
    return a.unionByName(b)


def _merge_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    kept = M.dedup(_s(spark, d), **DEDUP_A).table
    ct = F.col("current_time")
    target = kept.filter(ct < F.lit(MERGE_TARGET_BEFORE).cast("timestamp_ntz"))
    source = kept.filter(ct >= F.lit(MERGE_SOURCE_FROM).cast("timestamp_ntz")).select(
        "portfolio",
        "current_time",
        F.when(F.col("exchange") == "okx", F.col("total_usd_value"))
        .otherwise(F.col("total_usd_value") * 2)
        .alias("total_usd_value"),
        F.when(F.col("exchange").isin("bybit", "binance"), F.lit(None).cast("double"))
        .otherwise(F.col("transfer_adjustment"))
        .alias("transfer_adjustment"),
        F.lit("merged").alias("note"),
    )
    return target, source


def _merge(variant: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        target, source = _merge_inputs(spark, d)
        return finish(M.merge(target, source, MERGE_KEYS, **MERGE_VARIANTS[variant]).table)

    run.__name__ = f"merge_{variant}"
    return run


for _v in MERGE_VARIANTS:
    query(_merge(_v))


@query
def merge_summary(spark: SparkSession, d: str) -> DataFrame:
    target, source = _merge_inputs(spark, d)
    parts = [
        M.merge(target, source, MERGE_KEYS, **kw).summary.withColumn("variant", F.lit(v))
        for v, kw in MERGE_VARIANTS.items()
    ]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@query
def append_rows(spark: SparkSession, d: str) -> DataFrame:
    """K1: daily summaries derived from events appended to the summaries."""
    docs = load(spark, d, "daily_summary")
    return finish(M.append(_s(spark, d), docs).table)


UPDATE_SEQUENCE = [
    {"filter": {"portfolio": "7"}, "update": {"$set": {"exchange": "moved"}}},
    {"filter": {"portfolio": "7"}, "update": {"$inc": {"total_usd_value": 1000.0}}},  # the row just moved
    {"filter": {"exchange": "moved"}, "update": {"$mul": {"total_usd_value": 2}}},  # matches since the first update
    {"filter": {"portfolio": "new"}, "update": {"$set": {"total_usd_value": 5.0}}, "upsert": True},
    {"filter": {"portfolio": "new"}, "update": {"$inc": {"total_usd_value": 1.5}}, "upsert": True},  # the row just made
    {"filter": {"exchange": "okx"}, "update": {"$set": {"exchange": "bybit"}}},
    {"filter": {"exchange": "okx"}, "update": {"$set": {"exchange": "bybit"}}},  # the next one
]
ARRAY_UPDATES = [
    {"filter": {"id": {"$gte": 100}}, "update": {"$mul": {"items.$[e].price": 2}}, "array_filters": [{"e.quantity": {"$gte": 20}}]},
    {"filter": {"id": {"$gte": 5000}}, "update": {"$set": {"items.$[].quantity": 1}}},
    {"filter": {"id": {"$gte": 100}}, "update": {"$inc": {"items.$[e].price": 1.5}}, "array_filters": [{"e.quantity": {"$lt": 20}}]},
]


@query
def update_sequence(spark: SparkSession, d: str) -> DataFrame:
    """K5: updates that see what earlier ones did."""
    return finish(M.update_where(spark, _s(spark, d), UPDATE_SEQUENCE).table)


@query
def update_array_filters(spark: SparkSession, d: str) -> DataFrame:
    """K5 on a table with an array per row (an order's lines); one row per element comes back."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    by = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    items = F.sort_array(F.collect_list(F.struct(*by)))
    item = lambda x: F.struct(x["l_partkey"].alias("part"), x["l_quantity"].cast("double").alias("quantity"), x["l_extendedprice"].cast("double").alias("price"))
    orders = lines.groupBy(F.col("l_orderkey").cast("long").alias("id")).agg(F.transform(items, item).alias("items"))
    table = M.update_where(spark, orders, ARRAY_UPDATES).table
    return finish(table.select("id", F.posexplode("items").alias("pos", "e")).select("id", "pos", "e.*"))


@query
def update_where(spark: SparkSession, d: str) -> DataFrame:
    return finish(M.update_where(spark, _s(spark, d), UPDATE_OPS).table)


@query
def update_summary(spark: SparkSession, d: str) -> DataFrame:
    return M.update_where(spark, _s(spark, d), UPDATE_OPS).summary


# --------------------------------------------------------------------------- snapshots / transfers
TRANSFER_AS_OF = "2024-01-20 00:00:00"
TRANSFER_WINDOW_MIN = 3 * 24 * 60
BYBIT_INTERVAL_MIN = 0.5  # the snapshot job's interval


def _snapshot(spark: SparkSession, d: str) -> SN.Snapshot:
    # the fixture payloads are derived (lineitem -> JSON); materialise them
    # once, like the payload files they stand for.
    return SN.snapshot(
        spooled(P.payloads(spark, d), "payloads"),
        P.lookups(spark, d),
        P.PAYLOAD_AS_OF,
        transfers=load(spark, d, "transfers"),
        bybit_interval_minutes=BYBIT_INTERVAL_MIN,
    )


def _summary_rows(df: DataFrame) -> DataFrame:
    return finish(df.withColumn("n_assets", F.size("balances").cast("long")).drop("balances"))


def _snapshot_ex(ex: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _summary_rows(_snapshot(spark, d).summaries.filter(F.col("exchange") == ex))

    run.__name__ = f"snapshot_{ex}"
    return run


for _ex in SN.EXCHANGES:
    query(_snapshot_ex(_ex))


@query
def snapshot_all(spark: SparkSession, d: str) -> DataFrame:
    return _summary_rows(_snapshot(spark, d).summaries)


@query
def snapshot_balances(spark: SparkSession, d: str) -> DataFrame:
    s = _snapshot(spark, d).summaries
    # outer: else the planner tests size(balances) > 0 below the generator and folds each payload twice for it
    exploded = s.select("portfolio", F.explode_outer("balances").alias("asset", "b")).filter("asset is not null")
    return finish(exploded.select("portfolio", "asset", "b.*"))


@query
def snapshot_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return _snapshot(spark, d).quarantine


@query
def snapshot_two_fetches(spark: SparkSession, d: str) -> DataFrame:
    """Every account polled twice, ten seconds apart: two summaries each."""
    snap = SN.snapshot(
        P.polled(spooled(P.payloads(spark, d), "payloads"), P.PAYLOAD_AS_OF, P.PAYLOAD_NEXT),
        P.lookups(spark, d),
        P.PAYLOAD_NEXT,
        transfers=load(spark, d, "transfers"),
        bybit_interval_minutes=BYBIT_INTERVAL_MIN,
    )
    return _summary_rows(snap.summaries)


@query
def zoomex_missing_prices(spark: SparkSession, d: str) -> DataFrame:
    return finish(SN.zoomex_missing_prices(P.payloads(spark, d)))


@query
def transfer_unified(spark: SparkSession, d: str) -> DataFrame:
    return finish(transfer_adjustment(load(spark, d, "transfers"), TRANSFER_AS_OF, TRANSFER_WINDOW_MIN, "unified"))


@query
def transfer_18_6(spark: SparkSession, d: str) -> DataFrame:
    return finish(transfer_adjustment(load(spark, d, "transfers"), TRANSFER_AS_OF, TRANSFER_WINDOW_MIN, "18/6"))


# --------------------------------------------------------------------------- scalar functions
@query
def tw_time_q(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "scalar_inputs")
    return e.select("event_id", "ts", S.tw_time("ts").alias("tw_time"))


@query
def ts_truncate(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "scalar_inputs")
    return e.select("event_id", S.truncate_second("ts").alias("ts_second"), S.truncate_milli("ts").alias("ts_milli"))


@query
def iso_normalise(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "scalar_inputs")
    return e.select("event_id", "iso", S.iso_to_timestamp("iso").alias("parsed"), S.iso_to_unix("iso").alias("unix"))


@query
def epoch_normalise(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "scalar_inputs")
    t = S.epoch_to_timestamp("epoch")
    return e.select(
        "event_id", "epoch", t.alias("parsed"), S.timestamp_to_iso(t).alias("iso"), S.unix_to_iso("epoch").alias("iso_exact")
    )


@query
def strict_bool_q(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "scalar_inputs")
    return e.select("event_id", "word", S.strict_bool("word", on_error="null").alias("flag"))


# --------------------------------------------------------------------------- alerts / telemetry
@query
def low_value_alert(spark: SparkSession, d: str) -> DataFrame:
    latest = jobs.latest_summaries(_s(spark, d))
    return finish(AL.low_value_alerts(latest, active_portfolios(_p(spark, d))))


COOLDOWN_SEC = 30 * 24 * 3600  # 30 days: daily alerts of one key fall within it


def cooldown_input(spark: SparkSession, d: str) -> DataFrame:
    """Every summary at or under its portfolio's threshold is an alert; the
    message carries the threshold and a 100k value band, so dedupe lets a
    changed band through inside the cooldown."""
    j = _s(spark, d).join(active_portfolios(_p(spark, d)).select("portfolio", "position_threshold"), "portfolio")
    th = F.col("position_threshold")
    j = j.filter(th.isNotNull() & (th != 0) & (F.col("total_usd_value") <= th))
    msg = F.concat(
        F.lit("Total_Usd_Value Under "), th.cast("string"), F.lit(" band "),
        F.floor(F.col("total_usd_value") / 100000).cast("string"),
    )
    return j.select(F.concat(F.lit("usd_under:"), F.col("portfolio")).alias("key"), "id", F.col("current_time").alias("ts"), msg.alias("message"))


@query
def alert_cooldown(spark: SparkSession, d: str) -> DataFrame:
    return CD.cooldown(cooldown_input(spark, d), COOLDOWN_SEC, dedupe=True)


@query
def job_stats(spark: SparkSession, d: str) -> DataFrame:
    return finish(TM.job_stats(load(spark, d, "job_events")))


@query
def job_durations(spark: SparkSession, d: str) -> DataFrame:
    return finish(TM.job_durations(load(spark, d, "job_events")))


@query
def job_history(spark: SparkSession, d: str) -> DataFrame:
    return finish(TM.job_history(load(spark, d, "job_events")))


# Registry names without the ``_q`` suffix used to avoid clashing with the
# operator names imported above.
def registry() -> dict[str, Query]:
    from tidemark.plans import streams  # noqa: F401  (registers the streaming queries)

    return {name[:-2] if name.endswith("_q") else name: fn for name, fn in REGISTRY.items()}


__all__ = ["registry", "finish"]
