"""Streaming micro-batches are replay-safe: running a batch again for the
same epoch leaves the same tables (executor or driver loss mid-batch)."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans.fixtures import load
from tidemark.session import checkpoint_root
from tidemark.sources.tables import read_upserted, write_epoch
from tidemark.streaming.jobs import mart_batch


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_mart_batch_replay_is_idempotent(spark):
    root = f"{checkpoint_root(spark)}/replay-{uuid.uuid4().hex[:8]}"
    summaries = load(spark, SF_SMALL, "account_summary")
    portfolios = load(spark, SF_SMALL, "portfolio")
    y = F.year("current_time")
    args = (f"{root}/summary", portfolios, f"{root}/mart", f"{root}/state")
    mart_batch(spark, summaries.filter(y <= 1997), 0, *args)
    mart_batch(spark, summaries.filter(y == 1998), 1, *args)
    first = _rows(read_upserted(spark, f"{root}/mart", ["master_portfolio", "current_time"]))
    mart_batch(spark, summaries.filter(y == 1998), 1, *args)  # replay of epoch 1
    assert _rows(read_upserted(spark, f"{root}/mart", ["master_portfolio", "current_time"])) == first
    assert len({r[-2] for r in first}) == 2


def _latest(spark, root, epoch):
    return {r.master_portfolio: r for r in spark.read.parquet(f"{root}/state/latest_mart/epoch={epoch:012d}").collect()}


def test_late_batch_is_a_run_of_its_own(spark):
    """A batch older than the last mart run steps from the state at a new run
    time; nothing that was written is stepped from itself or written over."""
    root = f"{checkpoint_root(spark)}/late-{uuid.uuid4().hex[:8]}"
    summaries, portfolios = load(spark, SF_SMALL, "account_summary"), load(spark, SF_SMALL, "portfolio")
    y = F.year("current_time")
    args = (f"{root}/summary", portfolios, f"{root}/mart", f"{root}/state")
    mart_batch(spark, summaries.filter(y <= 1996), 0, *args)
    mart_batch(spark, summaries.filter(y == 1998), 1, *args)
    before, written = _latest(spark, root, 1), _rows(read_upserted(spark, f"{root}/mart", ["master_portfolio", "current_time"]))
    mart_batch(spark, summaries.filter(y == 1997), 2, *args)
    after = _latest(spark, root, 2)
    assert set(after) == set(before)
    chained = [k for k, r in after.items() if r.current_return is not None and before[k].nav is not None]
    assert chained and all(abs(after[k].nav - before[k].nav * (1 + after[k].current_return)) < 1e-9 * abs(after[k].nav) for k in chained)
    (new,), (old,) = {r.current_time for r in after.values()}, {r.current_time for r in before.values()}
    assert (new - old).total_seconds() == 1
    now = _rows(read_upserted(spark, f"{root}/mart", ["master_portfolio", "current_time"]))
    assert set(written) < set(now) and len(now) == len(written) + len(after)


def test_late_batch_without_news_changes_nothing(spark):
    """M1 stands at 110 on day 3; its summary of day 2 arrives afterwards."""
    root = f"{checkpoint_root(spark)}/late-{uuid.uuid4().hex[:8]}"
    portfolios = spark.createDataFrame([("a", "active", "M1", None)], "portfolio string, status string, master_portfolio string, composite string")
    day = lambda d, total, adj: spark.createDataFrame([("a", total, adj, f"2025-01-0{d} 00:00:00", "t")], "portfolio string, total_usd_value double, transfer_adjustment double, time string, tw_time string").withColumn("current_time", F.col("time").cast("timestamp_ntz")).drop("time")
    args = (f"{root}/summary", portfolios, f"{root}/mart", f"{root}/state")
    for epoch, batch in enumerate([day(1, 100.0, 0.0), day(3, 120.0, -10.0), day(2, 105.0, 0.0)]):
        mart_batch(spark, batch, epoch, *args)
    rows = {str(r.current_time)[:10]: r.nav for r in read_upserted(spark, f"{root}/mart", ["master_portfolio", "current_time"]).collect()}
    assert rows == {"2025-01-01": 100.0, "2025-01-03": 110.00000000000001} or abs(rows["2025-01-03"] - 110) < 1e-9 and set(rows) == {"2025-01-01", "2025-01-03"}
    assert read_upserted(spark, f"{root}/summary", ["portfolio", "current_time"]).count() == 3  # the history has it


def test_null_keeps_the_stored_value(spark):
    root = f"{checkpoint_root(spark)}/keep-{uuid.uuid4().hex[:8]}"
    for epoch, rows in enumerate([[("a", 0.5, 1.0), ("b", 2.0, 2.0)], [("a", None, 3.0)]]):
        write_epoch(spark.createDataFrame(rows, "k string, x double, y double"), root, epoch)
    got = {r.k: (r.x, r.y) for r in read_upserted(spark, root, ["k"], null_keeps=True).collect()}
    assert got == {"a": (0.5, 3.0), "b": (2.0, 2.0)}
