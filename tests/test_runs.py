"""Job runners with table I/O: reruns are idempotent, the refill reads one
namespace and writes another."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.snapshot import Lookups
from tidemark.plans import runs
from tidemark.plans.fixtures import load
from tidemark.session import checkpoint_root
from tidemark.sources import live


@pytest.fixture()
def ns(spark):
    root = f"{checkpoint_root(spark)}/ns-{uuid.uuid4().hex[:10]}"
    data = runs.Namespace(f"{root}/data")
    data.replace(runs.PORTFOLIO, load(spark, SF_SMALL, "portfolio"))
    runs.load_summaries(spark, data, load(spark, SF_SMALL, "account_summary"))
    return root, data


def test_master_mart_rerun_is_idempotent(spark, ns):
    root, data = ns
    mart = runs.Namespace(f"{root}/mart")
    runs.run_master_mart(spark, data, mart, "2001-01-01 00:00:00")
    runs.run_master_mart(spark, data, mart, "2002-01-01 00:00:00")
    def rows():
        # distributed sums may differ in the last bits between runs
        hist = mart.history(spark, runs.MASTER_PERF)
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in hist.collect())

    first = rows()
    runs.run_master_mart(spark, data, mart, "2002-01-01 00:00:00")
    assert rows() == first
    assert len({r[-2] for r in first}) == 2  # two run times


def test_refill_between_namespaces(spark, ns):
    root, data = ns
    mart = runs.Namespace(f"{root}/mart")
    runs.run_master_mart(spark, data, data, "1997-01-01 00:00:00")  # a seed snapshot in the source namespace
    out = runs.run_refill(spark, data, mart, is_master=True, start="1997-01-01 00:00:00", end="1997-12-31 23:59:59")
    n = out.count()
    again = runs.run_refill(spark, data, mart, is_master=True, start="1997-01-01 00:00:00", end="1997-12-31 23:59:59")
    hist = mart.history(spark, runs.MASTER_PERF)
    assert hist.count() == n == again.count()
    assert data.history(spark, runs.MASTER_PERF).count() > 0


def test_refill_quarantines_null_amounts(spark):
    root = f"{checkpoint_root(spark)}/ns-{uuid.uuid4().hex[:10]}"
    data, target = runs.Namespace(f"{root}/data"), runs.Namespace(f"{root}/refilled")
    portfolios = "portfolio string, master_portfolio string, composite string, active boolean"
    data.replace(runs.PORTFOLIO, spark.createDataFrame([("a", "m", None, True), ("b", "m", None, True)], portfolios))
    times = ["1997-01-01 00:00:00", "1997-01-01 00:01:00", "1997-01-01 00:02:00"]
    amounts = {("a", times[0]): (None, 1.0), ("a", times[1]): (2.0, None), ("b", times[2]): (None, None)}
    rows = [(p, t, *amounts.get((p, t), (100.0, 0.0))) for p in "ab" for t in times]
    summaries = spark.createDataFrame(rows, "portfolio string, time string, total_usd_value double, transfer_adjustment double")
    at = F.col("time").cast("timestamp_ntz")
    runs.load_summaries(spark, data, summaries.withColumns({"current_time": at, "tw_time": at}).drop("time"))
    for is_master in (False, False, True):
        out = runs.run_refill(spark, data, target, is_master=is_master, start=times[0], end=times[2])
        if not is_master:
            assert {(r.portfolio, str(r.current_time)) for r in out.collect()} == {(p, t) for p, t, *_ in rows} - set(amounts)
    got = [(r.level, r.portfolio, str(r.current_time), r.n) for r in target.read(spark, "refill_quarantine").collect()]
    assert sorted(got) == sorted((level, *w, 1) for level in ("portfolio", "portfolio", "master") for w in amounts)  # a rerun appends


def files(spark, path):
    return {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}


def test_one_table_from_snapshot_to_mart(spark):
    """Snapshot, dedup, insert, update, merge and mart work on the same live table,
    and only the days with changed rows are written anew."""
    root = f"{checkpoint_root(spark)}/ns-{uuid.uuid4().hex[:10]}"
    data = runs.Namespace(root)
    accounts = [(p, "bingx", "active" if p != "z" else "inactive", "M", None, 150.0) for p in "abz"]
    data.replace(runs.PORTFOLIO, spark.createDataFrame(accounts, "portfolio string, exchange string, status string, master_portfolio string, composite string, position_threshold double"))
    body = lambda x: json.dumps({"data": [{"asset": "VST", "balance": x, "equity": x}]})
    payloads = lambda a, b: spark.createDataFrame([("a", "bingx", body(a)), ("b", "bingx", body(b)), ("z", "bingx", body("1"))], "portfolio string, exchange string, payload string")
    for k, (a, b) in enumerate([("100", "200"), ("110", "210"), ("120", "oops")]):
        runs.run_snapshot(spark, payloads(a, b), data, Lookups(), f"2025-03-0{k + 1} 10:00:00")
    runs.run_snapshot(spark, payloads("111", "210"), data, Lookups(), "2025-03-02 10:00:00")  # a rerun sets the same rows
    path = data.path(runs.ACCOUNT_SUMMARY)
    table = lambda: sorted((r.portfolio, str(r.current_time)[8:10], r.total_usd_value) for r in data.history(spark, runs.ACCOUNT_SUMMARY).collect())
    assert table() == [("a", "01", 100.0), ("a", "02", 111.0), ("a", "03", 120.0), ("b", "01", 200.0), ("b", "02", 210.0)]
    assert [r.portfolio for r in data.read(spark, runs.SNAPSHOT_QUARANTINE).collect()] == ["b"]
    # alerts: a is under its threshold in each run, a day apart; the rerun of the second is no news of the same message
    assert sorted((r.portfolio, r.total_usd_value, r.emitted) for r in data.read(spark, runs.ALERTS).collect()) == [("a", 100.0, True), ("a", 110.0, True), ("a", 111.0, True), ("a", 120.0, True)]

    before = files(spark, path)
    extra = data.history(spark, runs.ACCOUNT_SUMMARY, start="2025-03-02 00:00:00", end="2025-03-02 23:59:59").filter("portfolio = 'a'")
    assert runs.run_insert_data(spark, data, runs.ACCOUNT_SUMMARY, mode="insert", documents=extra.withColumn("total_usd_value", F.lit(5.0))).first().inserted == 1
    assert before < files(spark, path) and len(table()) == 6  # appended, nothing rewritten
    s = runs.run_dedup(spark, data, runs.ACCOUNT_SUMMARY, group_fields=["portfolio", "current_time"], time_field="current_time", sort_tiebreak=[("total_usd_value", -1)]).first()
    assert (s.matched_groups, s.deleted_ids) == (5, 1) and ("a", "02", 111.0) in table() and len(table()) == 5
    other_days = {f for f in before if "2025-03-02" not in f}
    assert other_days < files(spark, path)
    ops = [{"filter": {"portfolio": "a", "total_usd_value": {"$gte": 115}}, "update": {"$set": {"total_usd_value": 130.0}}}, {"filter": {"total_usd_value": 130.0}, "update": {"$inc": {"total_usd_value": 1}}}]
    assert tuple(runs.run_insert_data(spark, data, runs.ACCOUNT_SUMMARY, mode="update", update_ops=ops).first()) == (2, 2, 0)
    inline = [{"portfolio": "b", "current_time": dt.datetime(2025, 3, 3, 10), "total_usd_value": 220.0, "transfer_adjustment": 0.0}, {"portfolio": "a", "current_time": dt.datetime(2025, 3, 1, 10), "total_usd_value": 101.0, "transfer_adjustment": 0.0}]
    m = runs.run_insert_data(spark, data, runs.ACCOUNT_SUMMARY, mode="merge", documents=inline, key_fields=["portfolio", "current_time"])
    assert tuple(m.first()) == (1, 1, 1)
    assert table() == [("a", "01", 101.0), ("a", "02", 111.0), ("a", "03", 131.0), ("b", "01", 200.0), ("b", "02", 210.0), ("b", "03", 220.0)]
    mart = runs.run_portfolio_mart(spark, data, data, "2025-03-04 00:00:00")  # reads the state that maintenance left
    assert {r.portfolio: r.total_usd_value for r in mart.collect()} == {"a": 131.0, "b": 220.0}
    # a day left without rows goes, and the state falls back to the day before
    assert runs.run_dedup(spark, data, runs.ACCOUNT_SUMMARY, group_fields=["portfolio"], time_field="current_time", sort_tiebreak=[("current_time", 1)]).first().deleted_ids == 4
    assert table() == [("a", "01", 101.0), ("b", "01", 200.0)]
    assert {r.portfolio: r.total_usd_value for r in data.state(spark, runs.ACCOUNT_SUMMARY).collect()} == {"a": 101.0, "b": 200.0}
    with pytest.raises(ValueError):
        runs.run_insert_data(spark, data, runs.ACCOUNT_SUMMARY, mode="upsert")


def test_maintenance_of_loaded_summaries(spark, ns):
    root, data = ns
    n = data.read(spark, runs.ACCOUNT_SUMMARY).count()
    s = runs.run_dedup(spark, data, runs.ACCOUNT_SUMMARY, group_fields=["portfolio", "current_time"], time_field="current_time")
    assert (s.first().matched_groups, s.first().deleted_ids) == (n, 0)  # loading sets rows by key


def test_rerun_with_a_new_value_reaches_the_state(spark):
    data = runs.Namespace(f"{checkpoint_root(spark)}/ns-{uuid.uuid4().hex[:10]}/data")
    for value in (100.0, 250.0):
        row = spark.createDataFrame([("a", value)], "portfolio string, total_usd_value double").withColumn("current_time", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
        data.append(spark, runs.ACCOUNT_SUMMARY, row.select("portfolio", "current_time", "total_usd_value"), "portfolio")
    assert data.state(spark, runs.ACCOUNT_SUMMARY).first().total_usd_value == 250.0
    assert data.history(spark, runs.ACCOUNT_SUMMARY).first().total_usd_value == 250.0


def test_compact_a_day(spark):
    root = f"{checkpoint_root(spark)}/compact-{uuid.uuid4().hex[:8]}"
    for k in range(4):
        live.insert(spark.createDataFrame([("a", dt.datetime(2025, 1, 1, k), float(k)), ("a", dt.datetime(2025, 1, 2, k), float(k))], "portfolio string, current_time timestamp_ntz, v double"), root)
    rows, before = sorted(map(tuple, live.read(spark, root).collect())), files(spark, root)
    live.compact(spark, root, [dt.date(2025, 1, 1)])
    after = files(spark, root)
    assert sorted(map(tuple, live.read(spark, root).collect())) == rows
    assert len([f for f in after if "2025-01-01" in f]) == 1 and {f for f in before if "2025-01-02" in f} < after
