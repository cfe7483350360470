"""Dedup, merge, update and the versioned table sink."""

import datetime as dt

import pytest

from tidemark.operators import maintenance as M

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "id long, portfolio string, current_time timestamp_ntz, v double"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_dedup_keeps_newest_with_tiebreak(spark):
    t1 = T0 + dt.timedelta(minutes=1)
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", t1, 2.0), (3, "a", t1, 3.0), (4, "b", T0, 4.0)])
    res = M.dedup(df, ["portfolio"], "current_time", sort_tiebreak=[("v", 1)])
    assert sorted(r.id for r in res.table.collect()) == [2, 4]
    assert sorted(r.id for r in res.removed.collect()) == [1, 3]
    s = res.summary.collect()[0]
    assert (s.matched_groups, s.deleted_ids) == (2, 2)


def test_dedup_tiebreak_on_time_field_flips_direction(spark):
    t1 = T0 + dt.timedelta(minutes=1)
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", t1, 2.0)])
    res = M.dedup(df, ["portfolio"], "current_time", sort_tiebreak=[("current_time", 1)])
    assert [r.id for r in res.table.collect()] == [1]


def test_dedup_scope_and_validation(spark):
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", T0 + dt.timedelta(days=5), 2.0)])
    res = M.dedup(df, ["portfolio"], "current_time", end=T0 + dt.timedelta(days=1))
    assert res.removed.count() == 0  # only one row in range
    with pytest.raises(ValueError):
        M.dedup(df, ["portfolio"], "current_time", batch_delete_size=0)
    with pytest.raises(ValueError):
        M.dedup(df, [], "current_time")


def test_merge_strategies(spark):
    target = rows(spark, [(1, "a", T0, 1.0), (2, "b", T0, 2.0)])
    source = spark.createDataFrame([("a", T0, None, "x"), ("c", T0, 3.0, "y")], "portfolio string, current_time timestamp_ntz, v double, note string")
    keys = ["portfolio", "current_time"]
    got = {r.portfolio: r for r in M.merge(target, source, keys).table.collect()}
    assert got["a"].v is None and got["a"].id == 1 and got["a"].note == "x"
    assert got["c"].id is None and got["c"].v == 3.0
    kept = {r.portfolio: r for r in M.merge(target, source, keys, null_keeps_target=True).table.collect()}
    assert kept["a"].v == 1.0
    rep = {r.portfolio: r for r in M.merge(target, source, keys, strategy="replace").table.collect()}
    assert rep["a"].id is None and rep["b"].id == 2
    no_up = M.merge(target, source, keys, upsert=False)
    assert sorted(r.portfolio for r in no_up.table.collect()) == ["a", "b"]
    s = M.merge(target, source, keys).summary.collect()[0]
    assert (s.matched, s.modified, s.upserted) == (1, 1, 1)


def test_merge_validation(spark):
    target = rows(spark, [(1, "a", T0, 1.0)])
    with pytest.raises(ValueError):
        M.merge(target, target, ["portfolio"], strategy="upsert")
    with pytest.raises(ValueError):
        M.merge(target, target, [])
    with pytest.raises(ValueError):
        M.merge(target, target.drop("portfolio"), ["portfolio"])
    dup = rows(spark, [(1, "a", T0, 1.0), (2, "a", T0, 2.0)])
    with pytest.raises(ValueError):
        M.merge(target, dup, ["portfolio", "current_time"])


def test_update_where(spark):
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", T0, 2.0), (3, "b", T0, 3.0)])
    ops = [
        {"filter": {"portfolio": "a"}, "update": {"$inc": {"v": 10.0}}},
        {"filter": {"portfolio": "z"}, "update": {"$set": {"v": 9.0}}, "upsert": True},
        {"filter": {"portfolio": "y"}, "update": {"$set": {"v": 9.0}}},
    ]
    res = M.update_where(spark, df, ops)
    got = sorted((r.portfolio, r.v) for r in res.table.collect())
    assert got == [("a", 2.0), ("a", 11.0), ("b", 3.0), ("z", 9.0)]
    s = res.summary.collect()[0]
    assert (s.matched, s.modified, s.upserted) == (1, 1, 1)
    with pytest.raises(ValueError):
        M.update_where(spark, df, [{"filter": {}}])


def test_delete_ids_and_latest_time_before(spark):
    from tidemark.operators.rollup import latest_time_before

    t1, t2 = T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2)
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", t1, 2.0), (3, "b", t2, 3.0)])
    ids = spark.createDataFrame([(2,), (9,)], "id long")
    assert sorted(r.id for r in M.delete_ids(df, ids).collect()) == [1, 3]
    with pytest.raises(ValueError):
        M.delete_ids(df, ids, batch_delete_size=0)
    got = df.select(latest_time_before(df, t2).alias("t")).first().t
    assert got == t1


def test_merge_with_null_keys(spark):
    target = rows(spark, [(1, None, T0, 1.0), (2, "b", T0, 2.0)])
    source = rows(spark, [(7, None, T0, 5.0), (8, None, None, 6.0)])
    res = M.merge(target, source, ["portfolio", "current_time"])
    assert sorted((r.id, r.v) for r in res.table.collect()) == [(2, 2.0), (7, 5.0), (8, 6.0)]
    assert tuple(res.summary.first()) == (1, 1, 1)


def test_updates_see_earlier_ones(spark):
    df = rows(spark, [(1, "a", T0, 1.0), (2, "a", T0, 2.0), (3, "b", T0, 3.0)])
    ops = [
        {"filter": {"portfolio": "a"}, "update": {"$set": {"portfolio": "c"}}},  # row 1
        {"filter": {"portfolio": "a"}, "update": {"$inc": {"v": 10}}},  # row 2 now
        {"filter": {"portfolio": "c"}, "update": {"$mul": {"v": 5}}},  # row 1, a match only since the first op
        {"filter": {"portfolio": "z"}, "update": {"$set": {"v": 1.0}}, "upsert": True},
        {"filter": {"portfolio": "z"}, "update": {"$inc": {"v": 1.0}}, "upsert": True},  # the row just made
        {"filter": {"portfolio": "a", "v": {"$gt": 100}}, "update": {"$set": {"v": 0.0}}},  # none
        {"filter": {"id": 3}, "update": {"$min": {"v": 3.0}, "$max": {"v": 2.0}}},  # matched, not modified
    ]
    res = M.update_where(spark, df, ops)
    assert sorted((r.portfolio, r.v) for r in res.table.collect()) == [("a", 12.0), ("b", 3.0), ("c", 5.0), ("z", 2.0)]
    assert tuple(res.summary.first()) == (5, 4, 1)


def test_plan_of_many_updates_stays_small(spark):
    df = rows(spark, [(i, "p", T0, 0.0) for i in range(50)])
    ops = [{"filter": {"id": i % 50}, "update": {"$inc": {"v": 1.0}}} for i in range(200)]
    plans = []
    for n in (2, 200):
        res = M.update_where(spark, df, ops[:n])
        plans.append(res.table._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert plans[0] == plans[1]
    assert {r.v for r in res.table.collect()} == {4.0}


def test_array_filters(spark):
    schema = "id long, items array<struct<name string, n long, v double>>, marks array<long>, deep struct<a long, b string>"
    df = spark.createDataFrame([(1, [("x", 1, 1.0), ("y", 5, None)], [1, 8, 9], (1, "k")), (2, None, [], None)], schema)
    ops = [
        {"filter": {"id": 1}, "update": {"$inc": {"items.$[e].v": 2}, "$set": {"marks.$[m]": 0}}, "array_filters": [{"e.n": {"$gte": 5}}, {"m": {"$gt": 7}}]},
        {"filter": {"deep.b": "k"}, "update": {"$set": {"items.$[].name": "z", "deep.a": 7}}},
        {"filter": {"id": 2}, "update": {"$set": {"items.$[].n": 1, "deep.a": 3}}},
    ]
    res = M.update_where(spark, df, ops)
    got = {r.id: r.asDict(recursive=True) for r in res.table.collect()}
    assert got[1]["items"] == [{"name": "z", "n": 1, "v": 1.0}, {"name": "z", "n": 5, "v": 2.0}]
    assert got[1]["marks"] == [1, 0, 0] and got[1]["deep"] == {"a": 7, "b": "k"}
    assert got[2]["items"] is None and got[2]["deep"] == {"a": 3, "b": None}
    with pytest.raises(ValueError):
        M.update_where(spark, df, [{"filter": {"id": 1}, "update": {"$set": {"items.$[e].n": 1}}}])
