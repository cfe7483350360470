"""L2: the array passes and composed steps equal a sequential fold per key."""

import datetime as dt
import random

import pytest

from tidemark.operators.cooldown import cooldown

T0 = dt.datetime(2025, 1, 1)


def sequential(events, cd, dedupe):
    out = {}
    state = {}
    for key, i, t, msg in sorted(events, key=lambda e: (e[0], e[2], e[1])):
        last_t, last_h = state.get(key, (-1e18, None))
        secs = (t - dt.datetime(1970, 1, 1)).total_seconds()
        if cd > 0 and secs - last_t < cd and (not dedupe or last_h == msg):
            out[i] = False
            continue
        state[key] = (secs, msg if dedupe else None)
        out[i] = True
    return out


@pytest.mark.parametrize("dedupe", [True, False])
def test_cooldown_matches_sequential(spark, dedupe):
    rnd = random.Random(7)
    events, i = [], 0
    for key in ["a", "b", "c"]:
        t = T0
        for _ in range(120):
            t += dt.timedelta(seconds=rnd.randint(1, 90))
            events.append((key, i, t, rnd.choice(["x", "x", "y"])))
            i += 1
    df = spark.createDataFrame(events, "key string, id long, ts timestamp_ntz, message string")
    got = {r.id: r.emitted for r in cooldown(df, 100, dedupe=dedupe, task_rows=40).collect()}
    want = sequential(events, 100, dedupe)
    assert got == want
    assert 0 < sum(want.values()) < len(want)  # some alerts are suppressed


def test_non_positive_cooldown_emits_all(spark):
    events = [("a", 1, T0, "m"), ("a", 2, T0 + dt.timedelta(seconds=1), "m")]
    df = spark.createDataFrame(events, "key string, id long, ts timestamp_ntz, message string")
    assert all(r.emitted for r in cooldown(df, 0).collect())


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("pattern", ["regular", "bursts"])
def test_cooldown_regular_cadence_and_bursts(spark, dedupe, pattern):
    """Regular 10 s alerts with a 60 s cooldown (chains never re-align, the
    case where every chunk depends on the one before) and bursts of many
    alerts inside one cooldown; a key covers tens of tasks."""
    rnd = random.Random(11)
    events, i = [], 0
    for key in ["hot", "cold"]:
        t = T0
        for k in range(400):
            if pattern == "regular":
                t += dt.timedelta(seconds=10)
            else:
                t += dt.timedelta(seconds=rnd.choice([0, 0, 1, 2, 150]))
            events.append((key, i, t, "x" if (pattern == "regular" or k % 7) else "y"))
            i += 1
    df = spark.createDataFrame(events, "key string, id long, ts timestamp_ntz, message string")
    got = {r.id: r.emitted for r in cooldown(df, 60, dedupe=dedupe, task_rows=15).collect()}
    assert got == sequential(events, 60, dedupe)


def frame(spark, events):
    return spark.createDataFrame(events, "key string, id long, ts timestamp_ntz, message string")


@pytest.mark.parametrize("dedupe", [True, False])
def test_burst_inside_one_cooldown_is_dealt_to_many_tasks(spark, dedupe, monkeypatch):
    """One key holds a burst of equal alerts far inside one cooldown: every task
    stays under its row bound, and the state passes through tasks without an emission."""
    from tidemark.operators import cooldown as module

    rnd = random.Random(3)
    events = [("k%d" % rnd.randrange(30), i, T0 + dt.timedelta(seconds=rnd.randrange(5000)), rnd.choice("xy")) for i in range(300)]
    events += [("hot", 1000 + i, T0 + dt.timedelta(milliseconds=i * 7), "y" if i in (700, 1500) else "x") for i in range(2000)]
    events += [("hot", 9000 + i, T0 + dt.timedelta(seconds=i * 400), "x") for i in range(1, 9)]
    seen = []
    DataFrame = type(spark.range(1))
    plain = DataFrame.mapInArrow

    def watched(self, func, schema, **how):
        if "emitted" in schema:
            seen.extend(len(p) for p in self.rdd.glom().collect())
        return plain(self, func, schema, **how)

    monkeypatch.setattr(DataFrame, "mapInArrow", watched)
    got = {r.id: r.emitted for r in module.cooldown(frame(spark, events), 600, dedupe=dedupe, task_rows=100).collect()}
    assert got == sequential(events, 600, dedupe)
    assert sum(seen) == len(events) and max(seen) <= 300


def test_random_tables_in_tasks_of_any_size(spark):
    rnd = random.Random(5)
    for n, keys, span, cd, rows in [(1, 1, 1, 60, 1), (60, 1, 30, 60, 5), (200, 2, 900, 60, 7), (200, 60, 900, 60, 30), (150, 1, 150, 0.5, 20), (120, 3, 10**8, 10**6, 9)]:
        events = [("k%d" % rnd.randrange(keys), i, T0 + dt.timedelta(milliseconds=500 * rnd.randrange(2 * span)), rnd.choice("xxy")) for i in range(n)]
        for dedupe in (True, False):
            got = {r.id: r.emitted for r in cooldown(frame(spark, events), cd, dedupe=dedupe, task_rows=rows).collect()}
            assert got == sequential(events, cd, dedupe)


def test_alerts_without_key_or_time(spark):
    events = [(None, 1, T0, "m"), (None, 2, T0, "m"), ("a", 3, None, "m"), ("a", 4, T0, "m"), ("a", 5, T0, None), ("a", 6, T0, None)]
    got = {r.id: r.emitted for r in cooldown(frame(spark, events), 60).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False}
    assert cooldown(frame(spark, []), 60).collect() == []


def test_steps_compose_like_folds():
    """A chunk's step function, and two of them as one, equal the fold from any state."""
    import numpy as np
    import pyarrow as pa

    from tidemark.operators import cooldown as module

    rnd = random.Random(9)
    for _ in range(200):
        cd, dedupe = rnd.choice([3, 10, 100]), rnd.random() < 0.7
        times = sorted(rnd.randrange(60) for _ in range(rnd.randrange(2, 14)))
        rows = [(t, rnd.choice("xxxy")) for t in times]
        cut = rnd.randrange(1, len(rows))

        def fold(state, part):
            for t, h in part:
                if state is None or not (t - state[0] < cd and (not dedupe or state[1] == h)):
                    state = (t, h if dedupe else "")
            return state

        def step(part):
            batch = pa.record_batch({"key": ["k"] * len(part), "id": list(range(len(part))), "t": np.array([t for t, _ in part]), "h": [h for _, h in part]})
            return module._first_step(module._read(iter([batch]), cd, dedupe), cd, dedupe)

        whole = step(rows[:cut]).then(step(rows[cut:]))
        for state in [None, *[(times[0] - back, h if dedupe else "") for back in (0, 1, 2, 5, 9, 99, 100, 200) for h in "xy"]]:
            assert step(rows)(state) == fold(state, rows) == whole(state)
