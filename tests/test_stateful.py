"""The stateful processors, run on plain in-memory state: a key's rows come in
many frames and in any order, and later micro-batches go on from the state."""

import hashlib
import random

import pandas as pd
import pytest

from tidemark.streaming.stateful import CooldownBuckets, CooldownProcessor, JobBuckets, JobProcessor


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = tuple(value)

    def put(self, values):
        self.held = list(values)


class Slices(dict):
    most = 0

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value
        Slices.most = max(Slices.most, len(value[0]))

    def removeKey(self, key):
        del self[key]


class Handle:
    def getValueState(self, name, schema):
        return Value()

    getListState = getValueState

    def getMapState(self, name, key, value):
        return Slices()


def processor(p):
    p.init(Handle())
    return p


def sequential(rows, cd, dedupe):
    state, out = None, {}
    for t, i, h in sorted(rows):
        hit = state is None or not (t - state[0] < cd and (not dedupe or state[1] == h))
        out[i] = hit
        if hit:
            state = (t, h)
    return out


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("frame_rows", [7, 1000])
def test_cooldown_over_frames_in_any_order(dedupe, frame_rows):
    rnd = random.Random(frame_rows)
    rows = [(rnd.randrange(20_000), i, rnd.choice(["x", "x", "y"])) for i in range(900)]
    early, late = [r for r in rows if r[0] < 9000], [r for r in rows if r[0] >= 9000]
    p, got = processor(CooldownProcessor(100, dedupe, slice_rows=3)), {}
    for part in (early, late):
        rnd.shuffle(part)
        frames = (pd.DataFrame(part[k : k + frame_rows], columns=["t", "id", "h"]) for k in range(0, len(part), frame_rows))
        for out in p.handleInputRows(("k",), frames, None):
            got.update(zip(out["id"].tolist(), out["emitted"].tolist()))
        assert not p.slices  # nothing of a batch stays in the state
    assert got == sequential(rows, 100, dedupe)
    if frame_rows == 7:
        assert Slices.most <= 7


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("frame_rows", [7, 1000])
def test_many_keys_share_a_call_and_keep_their_own_state(dedupe, frame_rows):
    rnd = random.Random(frame_rows)
    rows = [(f"k{rnd.randrange(20)}", rnd.randrange(20_000), i, rnd.choice(["x", "x", "y", None])) for i in range(900)]
    p, got = processor(CooldownBuckets(1500, dedupe, slice_rows=3)), {}
    for part in ([r for r in rows if r[1] < 9000], [r for r in rows if r[1] >= 9000]):
        rnd.shuffle(part)
        frames = (pd.DataFrame(part[k : k + frame_rows], columns=["key", "t", "id", "h"]) for k in range(0, len(part), frame_rows))
        for out in p.handleInputRows((3,), frames, None):
            got.update(zip(out["id"].tolist(), out["emitted"].tolist()))
        assert not p.slices
    assert got == {i: hit for k in {r[0] for r in rows} for i, hit in sequential([r[1:] for r in rows if r[0] == k], 1500, dedupe).items()}
    assert len(p.last.get()[0]) == 20


def test_no_cooldown_emits_all():
    p = processor(CooldownProcessor(0, True))
    out = pd.concat(p.handleInputRows(("k",), iter([pd.DataFrame({"t": [5, 5], "id": [1, 2], "h": ["x", "x"]})]), None))
    assert out["emitted"].tolist() == [True, True]


def jobs(events, size):
    """The batch rules in plain Python."""
    events = sorted(events, key=lambda e: (e["recorded_at"], e["event_id"]))
    start, rows = None, []
    for e in events:
        start = e["recorded_at"] if e["event"] == "submitted" else start
        rows.append((e, (e["recorded_at"] - start) / 1e6 * 1000.0 if e["event"] in ("success", "error") and start is not None else None))
    term = [(e, d) for e, d in rows if e["event"] in ("success", "error", "missed")]
    sub = [e for e, _ in rows if e["event"] == "submitted"]
    last = [
        *(sum(e["event"] == k for e, _ in rows) for k in ("submitted", "success", "error", "missed")),
        rows[-1][0]["event"], sub[-1]["scheduled_at"] if sub else None, sub[-1]["recorded_at"] if sub else None,
        term[-1][0]["recorded_at"] if term else None, term[-1][1] if term else None,
        term[-1][0]["message"] if term and term[-1][0]["event"] != "success" else None,
    ]
    history = [(k + 1, e["event_id"], e["event"], e["recorded_at"], d) for k, (e, d) in enumerate(reversed(rows[-size:]))]
    return last, history


@pytest.mark.parametrize("shuffled", [False, True])
def test_job_totals_and_history(shuffled):
    rnd = random.Random(4)
    for n in (1, 4, 30, 200):
        events = []
        for i in range(n):
            kind = rnd.choice(["submitted", "submitted", "success", "error", "missed", "other"])
            events.append(dict(event_id=i, event=kind, recorded_at=rnd.randrange(10**9), scheduled_at=rnd.choice([None, i]), message=hashlib.md5(str(i).encode()).hexdigest() if kind == "error" else None))
        events.sort(key=lambda e: (e["recorded_at"], e["event_id"]))
        parts = [events[: n // 3], events[n // 3 :]]
        if shuffled:  # inside a micro-batch, and a few events a batch late
            late = parts[0][-3:]
            parts = [parts[0][:-3], late + parts[1]] if n > 12 else parts
            for part in parts:
                rnd.shuffle(part)
        p, seen = processor(JobProcessor(12)), []
        for part in parts:
            if not part:
                continue
            seen += part
            frames = (pd.DataFrame(part[k : k + 9]).astype({"scheduled_at": "Int64"}) for k in range(0, len(part), 9))
            out = pd.concat(p.handleInputRows(("job",), frames, None))
            rows = out.astype(object).where(out.notna(), None)
            last, history = jobs(seen, 12)
            names = ["total_runs", "total_success", "total_error", "total_missed", "last_event", "last_scheduled_at", "last_started_at", "last_finished_at", "last_duration_ms", "last_error"]
            assert rows[rows["rank"].isna()][names].values.tolist() == [last]
            got = rows[rows["rank"].notna()][["rank", "event_id", "event", "recorded_at", "duration_ms"]]
            assert sorted(map(tuple, got.values.tolist())) == history


class Entries(dict):
    containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__


@pytest.mark.parametrize("frame_rows", [9, 1000])
def test_many_jobs_share_a_call_and_keep_their_own_state(frame_rows):
    rnd = random.Random(frame_rows)
    events = [
        dict(job_id=rnd.choice([None, "", *(f"j{k}" for k in range(12))]), event_id=i, event=rnd.choice(["submitted", "submitted", "success", "error", "missed", "other", None]),
             recorded_at=rnd.randrange(10**9), scheduled_at=rnd.choice([None, i]), message=rnd.choice([None, f"m{i}"]))
        for i in range(600)
    ]
    events.sort(key=lambda e: (e["recorded_at"], e["event_id"]))
    p, seen = processor(JobBuckets(12, out_rows=30)), []
    p.jobs = Entries()
    for part in (events[:300], [e for e in events[300:] if e["job_id"] != "j3"]):
        seen += part
        rnd.shuffle(part)
        frames = (pd.DataFrame(part[k : k + frame_rows]).astype({"scheduled_at": "Int64"}) for k in range(0, len(part), frame_rows))
        out = pd.concat(p.handleInputRows((5,), frames, None))
        rows = out.astype(object).where(out.notna(), None)
        brought = {e["job_id"] for e in part}
        assert set(rows["job_id"]) == brought  # jobs without an event of this batch are neither read nor written
        for name in brought:
            last, history = jobs([e for e in seen if e["job_id"] == name], 12)
            own = rows[[j == name and type(j) is type(name) for j in rows["job_id"]]]
            names = ["total_runs", "total_success", "total_error", "total_missed", "last_event", "last_scheduled_at", "last_started_at", "last_finished_at", "last_duration_ms", "last_error"]
            assert own[own["rank"].isna()][names].values.tolist() == [last]
            got = own[own["rank"].notna()][["rank", "event_id", "event", "recorded_at", "duration_ms"]]
            assert sorted(map(tuple, got.values.tolist())) == history
    assert len(p.jobs) == 14
