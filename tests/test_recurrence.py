"""The windowed closed form (W2/W3) against literal batch-by-batch stepping,
and the live step (W1)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.performance import performance_step, refill_performance

T0 = dt.datetime(2025, 1, 1)


def stepping(rows, seed, carry=False):
    """Plain-Python replay of the refill: batches in time order, each row
    advanced from the state handed over by the previous batch (only that
    batch's keys unless ``carry``)."""
    state = {s["k"]: s for s in seed}
    out = {}
    for t in sorted({r["t"] for r in rows}):
        nxt = dict(state) if carry else {}
        for r in (x for x in rows if x["t"] == t):
            st = state.get(r["k"]) if r["k"] is not None else None
            g = lambda f, d: d if (st is None or st.get(f) is None) else st[f]
            net = r["total"] + r["adj"]
            prev = g("total", net)
            ret = (net - prev) / prev if prev != 0 else 0.0
            crr = (1 + g("crr", 0.0)) * (1 + ret) - 1
            nav = g("nav", 100.0) * (1 + ret)
            hh = max(nav, g("hh", 100.0))
            cd = nav / hh - 1 if hh != 0 else 0.0
            mdd = min(cd, g("mdd", 0.0))
            out[(r["k"], t)] = dict(nav=nav, crr=crr, hh=hh, cd=cd, mdd=mdd, ret=ret)
            nxt[r["k"]] = dict(k=r["k"], total=r["total"], nav=nav, crr=crr, hh=hh, mdd=mdd)
        state = nxt
    return out


def random_case(seed):
    rnd = random.Random(seed)
    keys = [f"k{i}" for i in range(5)] + ["hot"]
    rows = []
    for step in range(25):
        t = T0 + dt.timedelta(minutes=step)
        for k in keys:
            if k == "hot" or rnd.random() < 0.7:
                total = rnd.choice([0.0, rnd.uniform(-50, 500), rnd.uniform(50, 150)])
                adj = rnd.choice([0.0, 0.0, rnd.uniform(-20, 20)])
                rows.append(dict(k=k, t=t, total=total, adj=adj))
    first_keys = {r["k"] for r in rows if r["t"] == min(x["t"] for x in rows)}
    seeds = [
        dict(k=k, total=rnd.uniform(50, 150), nav=rnd.uniform(80, 120), hh=rnd.uniform(100, 130), crr=rnd.uniform(-0.2, 0.2), mdd=rnd.uniform(-0.3, 0))
        for k in keys
        if rnd.random() < 0.8 and (k in first_keys or rnd.random() < 0.5)
    ]
    return rows, seeds


def to_frames(spark, rows, seeds):
    series = spark.createDataFrame(
        [(r["k"], r["t"], r["t"].isoformat(), r["total"], r["adj"]) for r in rows],
        "portfolio string, current_time timestamp_ntz, tw_time string, total_usd_value double, transfer_adjustment double",
    )
    seed = spark.createDataFrame(
        [(s["k"], s["total"], s["hh"], s["nav"], 0.0, s["crr"], 0.0, s["mdd"]) for s in seeds],
        "portfolio string, total_usd_value double, history_high double, nav double, current_return double, crr double, cd double, mdd double",
    )
    return series, seed


@pytest.mark.parametrize("case,chunk", [(1, 4096), (2, 4096), (3, 1), (4, 3), (5, 7)])
@pytest.mark.parametrize("policy", ["reset", "carry"])
def test_closed_form_equals_stepping(spark, case, chunk, policy):
    """``chunk`` < number of batches splits every key's history into slices
    that are stitched back together by the piece-level prefix state."""
    rows, seeds = random_case(case)
    series, seed = to_frames(spark, rows, seeds)
    got = {
        (r.portfolio, r.current_time): r
        for r in refill_performance(series, "portfolio", seed, gap_policy=policy, chunk_batches=chunk).collect()
    }
    want = stepping(rows, seeds, carry=(policy == "carry"))
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        for f_got, f_want in (("nav", "nav"), ("crr", "crr"), ("history_high", "hh"), ("cd", "cd"), ("mdd", "mdd"), ("current_return", "ret")):
            assert math.isclose(getattr(g, f_got), w[f_want], rel_tol=1e-9, abs_tol=1e-9), (k, f_got)


@pytest.mark.parametrize("policy", ["reset", "carry"])
def test_positive_series_take_one_pass(spark, policy, monkeypatch):
    """Without negative totals the drawdown comes from the pieces' summaries; with gaps inside
    chunks, across chunks and at their borders."""
    from tidemark.operators import performance

    cuts = []
    plain = performance.cut_lineage
    monkeypatch.setattr(performance, "cut_lineage", lambda df: cuts.append(1) or plain(df))
    rnd = random.Random(8)
    rows = []
    for step in range(60):
        t = T0 + dt.timedelta(minutes=step)
        rows += [dict(k=k, t=t, total=rnd.uniform(20, 300), adj=rnd.choice([0.0, rnd.uniform(-9, 9)])) for k in ("a", "b", "c", "hot") if k == "hot" or rnd.random() < 0.6]
    series, seed = to_frames(spark, rows, [dict(k="hot", total=90.0, nav=105.0, hh=130.0, crr=0.1, mdd=-0.1), dict(k="a", total=50.0, nav=99.0, hh=101.0, crr=0.0, mdd=0.0)])
    seeds = [r.asDict() for r in seed.collect()]
    seeds = [dict(k=s["portfolio"], total=s["total_usd_value"], nav=s["nav"], hh=s["history_high"], crr=s["crr"], mdd=s["mdd"]) for s in seeds]
    got = {(r.portfolio, r.current_time): r for r in refill_performance(series, "portfolio", seed, gap_policy=policy, chunk_batches=7).collect()}
    assert len(cuts) == 3  # the series, its rows with the pieces, the piece table
    for k, w in stepping(rows, seeds, carry=policy == "carry").items():
        for f_got, f_want in (("nav", "nav"), ("history_high", "hh"), ("cd", "cd"), ("mdd", "mdd")):
            assert math.isclose(getattr(got[k], f_got), w[f_want], rel_tol=1e-9, abs_tol=1e-9), (k, f_got)


def test_a_key_with_many_gaps_brings_two_rows_a_chunk_to_the_scan(spark):
    """Every second batch is a gap of the key: its pieces stay in their chunks."""
    n = 4000
    rows = [("hot", T0 + dt.timedelta(minutes=2 * i), "t", 100.0 + i % 7, 0.0) for i in range(n)]
    rows += [("all", T0 + dt.timedelta(minutes=i), "t", 50.0, 0.0) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "portfolio string, current_time timestamp_ntz, tw_time string, total_usd_value double, transfer_adjustment double")
    out = refill_performance(df, "portfolio", None, chunk_batches=500)
    assert out.filter("portfolio = 'hot' and nav = 100 and mdd = 0").count() == n and out.filter("portfolio = 'all' and nav = 100").count() == 2 * n


def test_gap_resets_state(spark):
    rows = [dict(k="a", t=T0, total=100.0, adj=0.0), dict(k="b", t=T0 + dt.timedelta(minutes=1), total=1.0, adj=0.0),
            dict(k="a", t=T0 + dt.timedelta(minutes=2), total=50.0, adj=0.0)]
    series, seed = to_frames(spark, rows, [])
    got = {(r.portfolio, r.current_time): r for r in refill_performance(series, "portfolio", None).collect()}
    # 'a' is absent from batch 2, so at batch 3 it restarts: return 0, nav 100
    assert got[("a", T0 + dt.timedelta(minutes=2))].nav == 100.0
    carry = {(r.portfolio, r.current_time): r for r in refill_performance(series, "portfolio", None, gap_policy="carry").collect()}
    assert carry[("a", T0 + dt.timedelta(minutes=2))].nav == pytest.approx(50.0)


def _totals(spark, rows):
    return spark.createDataFrame(rows, "master_portfolio string, current_time timestamp_ntz, tw_time string, total_usd_value double, transfer_adjustment double")


def test_live_step_empty_mart_seeds_smallest_key(spark):
    cur = _totals(spark, [("m2", T0, "", 100.0, 10.0), ("m1", T0, "", 200.0, 20.0)])
    out = {r.master_portfolio: r for r in performance_step(cur, None, "master_portfolio", T0).collect()}
    assert out["m1"].current_return == 0.0 and out["m1"].nav == 100.0
    assert out["m2"].current_return == pytest.approx(0.1)  # prev_total = current total: r = adj / total
    assert out["m2"].history_high == pytest.approx(110.0)


def test_live_step_from_previous_state(spark):
    prev = spark.createDataFrame(
        [("m1", 100.0, 120.0, 110.0, 0.0, 0.1, 0.0, -0.05, T0, ""), ("m2", 0.0, 100.0, 100.0, 0.0, 0.0, 0.0, 0.0, T0, "")],
        "master_portfolio string, total_usd_value double, history_high double, nav double, current_return double, crr double, cd double, mdd double, current_time timestamp_ntz, tw_time string",
    )
    t1 = T0 + dt.timedelta(minutes=1)
    cur = _totals(spark, [("m1", t1, "", 90.0, 0.0), ("m2", t1, "", 10.0, 0.0), ("m3", t1, "", 50.0, 5.0)])
    out = {r.master_portfolio: r for r in performance_step(cur, prev, "master_portfolio", t1).collect()}
    assert out["m1"].current_return == pytest.approx(-0.1)
    assert out["m1"].nav == pytest.approx(99.0)
    assert out["m1"].history_high == pytest.approx(120.0)
    assert out["m1"].cd == pytest.approx(99.0 / 120.0 - 1)
    assert out["m1"].mdd == pytest.approx(min(99.0 / 120.0 - 1, -0.05))
    assert out["m2"].current_return is None  # previous total 0: undefined, not an error
    assert out["m3"].current_return == pytest.approx(0.1)
    assert out["m1"].tw_time == "2025-01-01 08:01:00"


@pytest.mark.parametrize("level,summary", [("portfolio", "daily_summary"), ("master", "monthly_summary")])
def test_chunked_path_equals_single_pass_on_fixtures(spark, level, summary):
    """The skew-safe chunked plan (tiny chunks: every key's history cut into
    many slices) gives the single-pass result on the driver's fixture data."""
    from conftest import SF_SMALL
    from tidemark.plans import jobs
    from tidemark.plans.fixtures import load

    p, s = load(spark, SF_SMALL, "portfolio"), load(spark, SF_SMALL, summary)
    key = "master_portfolio" if level == "master" else "portfolio"

    def rows(**kw):
        out = jobs.refill(p, s, None, level=level, **kw).collect()
        return {(r[key], r.current_time): r for r in out}

    single, chunked = rows(), rows(chunk_batches=2)
    assert set(single) == set(chunked) and len(single) > 100
    for k, a in single.items():
        b = chunked[k]
        for f in ("nav", "crr", "history_high", "cd", "mdd", "current_return"):
            assert math.isclose(getattr(a, f), getattr(b, f), rel_tol=1e-9, abs_tol=1e-9), (k, f)


def test_two_rows_at_one_time_raise(spark):
    rows = [("a", dt.datetime(2025, 1, 1, 0, m), "t", 1.0, 0.0) for m in (0, 1, 1, 2)]
    df = spark.createDataFrame(rows, "portfolio string, current_time timestamp_ntz, tw_time string, total_usd_value double, transfer_adjustment double")
    with pytest.raises(ValueError):
        refill_performance(df, "portfolio")
