"""Stateful processors of the streaming jobs (``transformWithStateInPandas``).

State lives in RocksDB. A processor takes a key's rows of a micro-batch as an
iterator of Arrow-sized frames and never joins them into one: what it has to
remember beyond a frame goes into its state or into a bounded summary.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.cooldown import settle_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


ALERT_OUT = "key string, id long, hash string, emitted boolean"


class CooldownProcessor(StatefulProcessor):
    """L2 per key: the state is the last emission. Rows: key, id, t (epoch ms),
    h. Of a key with one frame, the frame is sorted and settled. More frames of a
    key arrive in no order; they are put into time slices kept in RocksDB, and one slice
    after the other is read back, settled and dropped."""

    def __init__(self, cooldown_ms: int, dedupe: bool, slice_rows: int = 2000):
        self.cooldown_ms, self.dedupe, self.slice_rows = cooldown_ms, dedupe, slice_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t long, h string")
        self.slices = handle.getMapState("slices", "slice long, part int", "id array<long>, t array<long>, h array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.last.get() if self.last.exists() else None
        first, parts, width = None, {}, 1
        for frame in rows:
            if first is None and not parts:
                first = frame
                continue
            if first is not None:
                span = int(first["t"].max() - first["t"].min())
                width = max(1, span * self.slice_rows // len(first))
                self._put(first, width, parts)
                first = None
            self._put(frame, width, parts)
        if first is not None:
            state, out = self._settle(key[0], first["id"].to_numpy(), first["t"].to_numpy(), first["h"].to_numpy(), state)
            yield out
        for at in sorted(parts):
            held = [self.slices.getValue((at, n)) for n in range(parts[at])]
            ids, times, hashes = (np.concatenate([np.asarray(x[k], dtype) for x in held]) for k, dtype in enumerate((np.int64, np.int64, object)))
            state, out = self._settle(key[0], ids, times, hashes, state)
            for n in range(parts[at]):
                self.slices.removeKey((at, n))
            yield out
        if state is not None:
            self.last.update(state)

    def _put(self, frame: pd.DataFrame, width: int, parts: dict[int, int]) -> None:
        for at, rows in frame.groupby(frame["t"].to_numpy() // width):
            at, n = int(at), parts.get(int(at), 0)
            self.slices.updateValue((at, n), (rows["id"].tolist(), rows["t"].tolist(), rows["h"].tolist()))
            parts[at] = n + 1

    def _settle(self, key, ids, times, hashes, state):
        order = np.lexsort((ids, times))
        ids, times, hashes = ids[order], times[order].astype(np.int64), hashes[order]
        flags, state = settle_key(times, pa.array(hashes, pa.string()), state, self.cooldown_ms, self.dedupe)
        return state, pd.DataFrame({"key": key, "id": ids, "hash": hashes, "emitted": flags})

    def close(self) -> None:
        pass


class CooldownBuckets(StatefulProcessor):
    """L2 for all keys of a bucket in one call: a call and a round trip to the state cost
    more than a key's few alerts. The state is the last emission of every key of
    the bucket. Rows: key, id, t (epoch ms), h. One frame is folded in time order; more
    frames go through time slices kept in RocksDB, as in ``CooldownProcessor``."""

    def __init__(self, cooldown_ms: int, dedupe: bool, slice_rows: int = 2000):
        self.cooldown_ms, self.dedupe, self.slice_rows = cooldown_ms, dedupe, slice_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "key array<string>, t array<long>, h array<string>")
        self.slices = handle.getMapState("slices", "slice long, part int", "key array<string>, id array<long>, t array<long>, h array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get() if self.last.exists() else ([], [], [])
        state = {k: (t, h) for k, t, h in zip(*held, strict=True)}
        first, parts, width = None, {}, 1
        for frame in rows:
            if first is None and not parts:
                first = frame
                continue
            if first is not None:
                span = int(first["t"].max() - first["t"].min())
                width = max(1, span * self.slice_rows // len(first))
                self._put(first, width, parts)
                first = None
            self._put(frame, width, parts)
        if first is not None:
            yield self._fold(*(first[c].tolist() for c in ("key", "id", "t", "h")), state)
        for at in sorted(parts):
            held = [self.slices.getValue((at, n)) for n in range(parts[at])]
            out = self._fold(*([v for part in held for v in part[k]] for k in range(4)), state)
            for n in range(parts[at]):
                self.slices.removeKey((at, n))
            yield out
        if state:
            self.last.update((list(state), [t for t, _ in state.values()], [h for _, h in state.values()]))

    def _put(self, frame: pd.DataFrame, width: int, parts: dict[int, int]) -> None:
        for at, rows in frame.groupby(frame["t"].to_numpy() // width):
            at, n = int(at), parts.get(int(at), 0)
            self.slices.updateValue((at, n), (rows["key"].tolist(), rows["id"].tolist(), rows["t"].tolist(), _texts(rows["h"])))
            parts[at] = n + 1

    def _fold(self, keys: list, ids: list, times: list, hashes: list, state: dict) -> pd.DataFrame:
        hashes, flags = _texts(hashes), [True] * len(ids)
        if self.cooldown_ms > 0:
            for i in np.lexsort((ids, times)).tolist():
                t, h, last = times[i], hashes[i], state.get(keys[i])
                if last is not None and t - last[0] < self.cooldown_ms and (not self.dedupe or h == last[1]):
                    flags[i] = False
                else:
                    state[keys[i]] = (t, h if self.dedupe else "")
        return pd.DataFrame({"key": keys, "id": ids, "hash": hashes, "emitted": flags})

    def close(self) -> None:
        pass


def _texts(values) -> list:
    """A missing text is None, whatever pandas made of it."""
    return [v if isinstance(v, str) else None for v in values]


JOB_OUT = (
    "job_id string, total_runs long, total_success long, total_error long, total_missed long, last_event string, "
    "last_scheduled_at long, last_started_at long, last_finished_at long, last_duration_ms double, last_error string, "
    "rank int, event_id long, event string, recorded_at long, scheduled_at long, duration_ms double, message string"
)
_COUNTED = ("submitted", "success", "error", "missed")
_TERMINAL = ("success", "error", "missed")


class _Job:
    """What is remembered of a job: the counters, the newest ``size`` events (at, event_id,
    event, scheduled, message) in order, the time of the newest submission before them, and the
    last submission and terminal event. Further events may come late and in any order."""

    def __init__(self, totals=(0,) * 4, kept=(), before=None, sub=None, term=None):
        self.totals, self.kept, self.before, self.sub, self.term = dict(zip(_COUNTED, totals)), list(kept), before, sub, term

    @classmethod
    def of(cls, totals, kept, marks) -> _Job:
        before, sub, term = marks[0], tuple(marks[1:4]), tuple(marks[4:9])
        return cls(totals, kept, before, None if sub[0] is None else sub, None if term[0] is None else term)

    @property
    def marks(self) -> tuple:
        return (self.before, *(self.sub or (None,) * 3), *(self.term or (None,) * 5))

    def add(self, events: list[tuple], size: int) -> None:
        """``events`` in order of (at, event_id)."""
        for e in events:
            if e[2] in self.totals:
                self.totals[e[2]] += 1
        sub = next((e for e in reversed(events) if e[2] == "submitted"), None)
        if sub is not None and (self.sub is None or sub[:2] > self.sub[:2]):
            self.sub = (sub[0], sub[1], sub[3])
        term = next((e for e in reversed(events) if e[2] in _TERMINAL), None)
        if term is not None and (self.term is None or term[:2] > self.term[:2]):
            self.term = (term[0], term[1], term[2], term[4], None)
        kept = sorted(self.kept + events, key=itemgetter(0, 1))
        older = [e[0] for e in kept[:-size] if e[2] == "submitted"]
        if older:
            self.before = older[-1] if self.before is None else max(self.before, older[-1])
        self.kept = kept[-size:]

    def rows(self, job_id) -> list[tuple]:
        """The job's totals and its newest events, as rows of ``JOB_OUT``."""
        start, durations = self.before, []
        for at, event_id, name, _, _ in self.kept:
            start = at if name == "submitted" else start
            durations.append((at - start) / 1e6 * 1000.0 if name in ("success", "error") and start is not None else None)
            if self.term is not None and (at, event_id) == self.term[:2]:
                self.term = (*self.term[:4], durations[-1])
        sub, term, n = self.sub or (None,) * 3, self.term or (None,) * 5, len(self.kept)
        last_error = None if term[2] in (None, "success") else term[3]
        last = (job_id, *self.totals.values(), self.kept[-1][2], sub[2], sub[0], term[0], term[4], last_error, *(None,) * 7)
        return [last, *((job_id, *(None,) * 10, n - k, e[1], e[2], e[0], e[3], durations[k], e[4]) for k, e in enumerate(self.kept))]


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.iloc[np.lexsort((frame["event_id"].to_numpy(), frame["recorded_at"].to_numpy()))]


def _events(frame: pd.DataFrame) -> list[tuple]:
    """The events of a frame; an event has a time and an id, or this raises."""
    at, ids = (frame[c].astype("int64").tolist() for c in ("recorded_at", "event_id"))
    planned = frame["scheduled_at"]
    scheduled = [None if none else at for none, at in zip(planned.isna().tolist(), planned.fillna(0).astype("int64").tolist())]
    return list(zip(at, ids, _texts(frame["event"].tolist()), scheduled, _texts(frame["message"].tolist())))


_JOB_KINDS = [(c.split()[0], {"string": object, "double": "float64"}.get(c.split()[1], "Int64")) for c in JOB_OUT.split(", ")]


def _job_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series(values, dtype=kind) for (name, kind), values in zip(_JOB_KINDS, zip(*rows))})


_MARKS = "before long, sub_at long, sub_id long, sub_scheduled long, term_at long, term_id long, term_event string, term_message string, term_duration double"
_KEPT = ("at long", "event_id long", "event string", "scheduled long", "message string")


class JobProcessor(StatefulProcessor):
    """A10, W5 and W6 per job: the newest ``size`` events (list state), the
    counters, the newest submission older than those events, and the last
    submission and terminal event (value states). Rows: job_id, event_id, event,
    recorded_at and scheduled_at in epoch microseconds, message as in the history.

    A job's changed totals come out as one row (rank NULL), its newest events as
    further rows. Events may come late and in any order: an event's place and its
    duration follow (recorded_at, event_id), as in the batch version, as long as it is among
    the newest ``size``; older ones still count."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", ", ".join(f"{c} long" for c in _COUNTED))
        self.newest = handle.getListState("newest", ", ".join(_KEPT))
        self.marks = handle.getValueState("marks", _MARKS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        job = _Job.of(self.totals.get(), [tuple(e) for e in self.newest.get()], self.marks.get()) if self.totals.exists() else _Job()
        for frame in rows:
            job.add(_events(_ordered(frame)), self.size)
        out = job.rows(key[0])
        self.totals.update(tuple(job.totals.values()))
        self.newest.put(job.kept)
        self.marks.update(job.marks)
        yield _job_frame(out)

    def close(self) -> None:
        pass


class JobBuckets(StatefulProcessor):
    """``JobProcessor`` for all jobs of a bucket in one call: frames and a call per job cost far
    more than its few events. The state is a map with an entry per job, so a micro-batch reads and
    writes the jobs that it brings and no others. Rows as there."""

    def __init__(self, size: int, out_rows: int = 20_000):
        self.size, self.out_rows = size, out_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        held = [f"{c} long" for c in _COUNTED] + [f"kept_{c.split()[0]} array<{c.split()[1]}>" for c in _KEPT]
        self.jobs = handle.getMapState("jobs", "known boolean, job_id string", f"{', '.join(held)}, {_MARKS}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        jobs: dict[str | None, _Job] = {}
        for frame in rows:
            by_job: dict[str | None, list[tuple]] = {}
            frame = _ordered(frame)
            for name, event in zip(_texts(frame["job_id"].tolist()), _events(frame)):
                by_job.setdefault(name, []).append(event)
            for name, events in by_job.items():
                if name not in jobs:
                    jobs[name] = self._held(name)
                jobs[name].add(events, self.size)
        out: list[tuple] = []
        for name, job in jobs.items():
            out += job.rows(name)
            self.jobs.updateValue(_known(name), (*job.totals.values(), *([e[k] for e in job.kept] for k in range(5)), *job.marks))
            if len(out) >= self.out_rows:
                yield _job_frame(out)
                out = []
        if out:
            yield _job_frame(out)

    def _held(self, name: str | None) -> _Job:
        if not self.jobs.containsKey(_known(name)):
            return _Job()
        held = tuple(self.jobs.getValue(_known(name)))
        return _Job.of(held[:4], zip(*held[4:9]), held[9:])

    def close(self) -> None:
        pass


def _known(job_id: str | None) -> tuple[bool, str]:
    """The key of a job in the state, where a key has no NULL."""
    return job_id is not None, job_id or ""
