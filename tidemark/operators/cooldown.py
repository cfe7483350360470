"""Alert cooldown / dedupe (L2), exact and parallel.

Rule per key, state = (time and hash of the last *emitted* alert):
an alert is emitted unless it falls within ``cooldown_sec`` of the last
emission and either dedupe is off, or dedupe is on and its message hash
equals the last emitted one. ``cooldown_sec <= 0`` emits everything.

The alerts are range-partitioned and sorted by (key, time, id) into tasks of
about ``task_rows`` alerts, whatever the keys: many small keys share a task,
a hot key (or a burst of it inside one cooldown) runs over many.

* Once an alert is emitted, the next emission is a fixed function of that
  alert alone: the first later alert of the key that is a cooldown older or
  carries another hash. These links are found for all keys of a task at once
  by binary search, and the emissions are what the links reach from each
  key's first alert (pointer doubling, a logarithmic number of array passes).
* Only the key that a task shares with the task before needs an incoming
  state. What such a chunk makes of *any* state is a step function of the
  state's time: an ordinary row per task. Neighbouring functions are composed
  in rounds, over twice the distance each time, until every chunk knows the
  state it starts from (none of this runs unless a key covers three tasks).
  A function has a step per alert within one cooldown of the chunk's first,
  but equal neighbours merge and no row holds more than that.

The result equals the sequential fold (tests compare them on random data).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import message_hash
from tidemark.operators.transfers import epoch_ms
from tidemark.session import cut_lineage

TASK_ROWS = 250_000  # alerts that one task holds
OUT_SCHEMA = "key string, id long, hash string, emitted boolean"
STEP_SCHEMA = (
    "key string, part long, own string, other_t long, other_h string, "
    "upto array<long>, out_t array<long>, out_h array<string>, rest_t long, rest_h string"
)


def cooldown(alerts: DataFrame, cooldown_sec: float = 60, *, dedupe: bool = True, task_rows: int = TASK_ROWS) -> DataFrame:
    """``alerts``: key, id (unique long), ts (naive UTC), message.
    Returns every alert with ``emitted`` (bool) and ``hash``. Alerts at one time
    count in the order of their ids. An alert without a time is emitted and
    changes no state; a NULL key is a key like any other."""
    ev = alerts.select(
        F.col("key").cast("string").alias("key"),
        F.col("id").cast("long").alias("id"),
        epoch_ms(F.col("ts")).alias("t"),
        message_hash("message").alias("h"),
    )
    cd = milliseconds(cooldown_sec)
    if cd <= 0:
        return ev.select("key", "id", F.col("h").alias("hash"), F.lit(True).alias("emitted"))
    timed = ev.filter("t is not null")
    tasks = max(1, math.ceil(timed.count() / task_rows))
    order = ["key", "t", "id"]
    # read by both passes, in the same partitions
    rows = cut_lineage(timed.repartitionByRange(tasks, *order).sortWithinPartitions(*order))
    states = _incoming(rows, cd, dedupe) if tasks > 1 else {}

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _read(batches, cd, dedupe)
        if task is not None:
            flags = _emitted(task, states.get(TaskContext.get().partitionId()), cd, dedupe)
            yield pa.RecordBatch.from_arrays([task.key, task.id, task.h, pa.array(flags)], names=["key", "id", "hash", "emitted"])

    untimed = ev.filter("t is null").select("key", "id", F.col("h").alias("hash"), F.lit(True).alias("emitted"))
    return rows.mapInArrow(settle, OUT_SCHEMA).unionByName(untimed)


class _Task(NamedTuple):
    """A task's alerts in order, and per alert the end of its key's run, the end
    of its run of equal hashes, and the next emission after it."""

    key: pa.Array
    id: pa.Array
    h: pa.Array
    t: np.ndarray
    starts: np.ndarray  # of the keys' runs
    end: np.ndarray
    same: np.ndarray
    next: np.ndarray


def _changes(values: pa.Array) -> np.ndarray:
    """Where a value differs from the one before (NULL equals NULL); True at the first."""
    filled = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.append(True, filled[1:] != filled[:-1])


def _next_in_time(t: np.ndarray, run: np.ndarray, cd: int) -> np.ndarray:
    """Per alert the first of its run, or the end of it, that is ``cd`` later."""
    out = np.empty(len(t), np.int64)
    low, width = int(t.min()), int(t.max()) - int(t.min()) + cd + 1
    runs_at_once = max(1, (1 << 62) // width)  # runs laid end to end in 64 bits
    for first in range(0, int(run[-1]) + 1, runs_at_once):
        a, b = np.searchsorted(run, [first, first + runs_at_once])
        laid = (t[a:b] - low) + (run[a:b] - first) * width
        out[a:b] = a + np.searchsorted(laid, laid + cd, side="left")
    return out


def _read(batches: Iterator[pa.RecordBatch], cd: int, dedupe: bool) -> _Task | None:
    table = pa.Table.from_batches(held) if (held := [b for b in batches if b.num_rows]) else None
    if table is None:
        return None
    key, ids, t, h = (table.column(c).combine_chunks() for c in ("key", "id", "t", "h"))
    t = t.to_numpy(zero_copy_only=False)
    new_key = _changes(key)
    starts = np.flatnonzero(new_key)
    run = np.cumsum(new_key) - 1
    end = np.append(starts[1:], len(t))[run]
    breaks = np.append(np.flatnonzero(new_key | _changes(h)), len(t))
    same = breaks[np.searchsorted(breaks, np.arange(len(t)), side="right")]
    ahead = np.minimum(_next_in_time(t, run, cd), end)
    return _Task(key, ids, h, t, starts, end, same, np.minimum(ahead, same) if dedupe else ahead)


def _first_emission(task: _Task, state: tuple[int, str] | None, cd: int, dedupe: bool) -> int:
    """The first emission in the task's first run, coming from ``state``."""
    if state is None or (dedupe and state[1] != task.h[0].as_py()):
        return 0
    end = int(task.same[0]) if dedupe else int(task.end[0])
    return int(np.searchsorted(task.t[:end], state[0] + cd, side="left"))


def _emitted(task: _Task, state: tuple[int, str] | None, cd: int, dedupe: bool) -> np.ndarray:
    n = len(task.t)
    hit = np.zeros(n + 1, bool)
    hit[task.starts[1:]] = True
    first = _first_emission(task, state, cd, dedupe)
    if first < task.end[0]:
        hit[first] = True
    jump = np.append(np.where(task.next < task.end, task.next, n), n)
    while (jump[:n] < n).any():  # what is reached in 1, 2, 4, ... links
        hit[jump[np.flatnonzero(hit)]] = True
        jump = jump[jump]
    return hit[:n]


def settle_key(t: np.ndarray, h: pa.Array, state: tuple[int, str] | None, cd: int, dedupe: bool) -> tuple[np.ndarray, tuple[int, str] | None]:
    """Which of one key's alerts, in order, are emitted coming from ``state`` (time
    in ms, hash), and the state that they leave."""
    n = len(t)
    if cd <= 0:
        return np.ones(n, bool), state
    batch = pa.record_batch({"key": pa.array(np.zeros(n, np.int8)), "id": pa.array(np.arange(n)), "t": pa.array(t), "h": h})
    task = _read(iter([batch]), cd, dedupe)
    if task is None:
        return np.zeros(0, bool), state
    flags = _emitted(task, state, cd, dedupe)
    if flags.any():
        last = int(np.flatnonzero(flags)[-1])
        state = (int(t[last]), h[last].as_py() if dedupe else "")
    return flags, state


def milliseconds(cooldown_sec: float) -> int:
    """The least whole number of ms that is a cooldown."""
    return math.ceil(round(float(cooldown_sec) * 1000, 6))


def _last_from(task: _Task, start: int, end: int) -> np.ndarray:
    """Per alert of the run [start, end) the last emission of the chain that it begins."""
    at = np.arange(start, end)
    jump = np.where(task.next[start:end] < end, task.next[start:end], at) - start
    while not np.array_equal(further := jump[jump], jump):
        jump = further
    return jump + start


class Step(NamedTuple):
    """What a chunk makes of an incoming state (time, hash), as the state that it
    leaves. None or a state of another hash than ``own`` becomes ``other``; one
    of time <= upto[k] (ascending) becomes out[k] for the first such k; any later
    one becomes ``rest``, or stays as it is if ``rest`` is None."""

    own: str | None
    other: tuple[int, str]
    upto: list[int]
    out: list[tuple[int, str]]
    rest: tuple[int, str] | None

    def __call__(self, state: tuple[int, str] | None) -> tuple[int, str]:
        if state is None or (self.own is not None and state[1] != self.own):
            return self.other
        k = int(np.searchsorted(np.asarray(self.upto, np.int64), state[0], side="left"))
        if k < len(self.upto):
            return self.out[k]
        return state if self.rest is None else self.rest

    def then(self, later: Step) -> Step:
        """This chunk and then ``later``, as one."""
        upto, out = list(self.upto), [later(s) for s in self.out]
        rest = None if self.rest is None else later(self.rest)
        if self.rest is None:  # states that pass through meet the later chunk as they are
            if self.own is not None and self.own != later.own:
                rest = later.other
            else:
                from_ = upto[-1] if upto else -math.inf
                for u, s in zip(later.upto, later.out):
                    if u > from_:
                        upto.append(u)
                        out.append(s)
                rest = later.rest
        return Step(self.own, later(self.other), *_merged(upto, out), rest)


def _merged(upto: list, out: list) -> tuple[list, list]:
    keep = [k for k in range(len(out)) if k + 1 == len(out) or out[k] != out[k + 1]]
    return [upto[k] for k in keep], [out[k] for k in keep]


def _first_step(task: _Task, cd: int, dedupe: bool) -> Step:
    """The task's first run as a function of the state that comes in."""
    end = int(task.end[0])
    last = _last_from(task, 0, end)
    # an incoming state is older than the first alert: later ones than this are never its next emission
    limit = min(int(task.same[0]) if dedupe else end, int(np.searchsorted(task.t[:end], task.t[0] + cd, side="left")))
    state = lambda j: (int(task.t[j]), task.h[int(j)].as_py() if dedupe else "")
    upto, which = task.t[:limit] - cd, last[:limit]
    keep = np.append(which[1:] != which[:-1], True) if limit else np.zeros(0, bool)
    return Step(
        task.h[0].as_py() if dedupe else None,
        state(last[0]),
        upto[keep].tolist(),
        [state(j) for j in which[keep]],
        state(last[limit]) if limit < end else None,
    )


def _row(key: str | None, part: int, s: Step) -> dict:
    rest = s.rest or (None, None)
    return dict(key=key, part=part, own=s.own, other_t=s.other[0], other_h=s.other[1], upto=s.upto, out_t=[x for x, _ in s.out], out_h=[x for _, x in s.out], rest_t=rest[0], rest_h=rest[1])


def _step(r: dict) -> Step:
    rest = None if pd.isna(r["rest_t"]) else (int(r["rest_t"]), r["rest_h"])
    own = None if r["own"] is None or r["own"] != r["own"] else r["own"]
    return Step(own, (int(r["other_t"]), r["other_h"]), [int(u) for u in r["upto"]], [(int(a), b) for a, b in zip(r["out_t"], r["out_h"])], rest)


def _incoming(rows: DataFrame, cd: int, dedupe: bool) -> dict[int, tuple[int, str]]:
    """The state that each task's first key comes in with, by task, where that
    key began in a task before: one small value per task."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _read(batches, cd, dedupe)
        if task is None:
            return
        part = TaskContext.get().partitionId()
        found = [_row(task.key[0].as_py(), part, _first_step(task, cd, dedupe))]
        if len(task.starts) > 1:  # the last key begins here: a constant
            start = int(task.starts[-1])
            j = int(_last_from(task, start, len(task.t))[0])
            out = (int(task.t[j]), task.h[j].as_py() if dedupe else "")
            found.append(_row(task.key[start].as_py(), part, Step(None, out, [], [], out)))
        yield pa.RecordBatch.from_pylist(found, schema=_ARROW_STEPS)

    chunks = cut_lineage(rows.mapInArrow(steps, STEP_SCHEMA).withColumn("key", F.coalesce("key", F.lit("\x00"))))
    # a key's chunks in order; the rows numbered are (key, task) only
    place = chunks.select("key", "part").withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("part")) - 1)
    chunks = chunks.join(place, ["key", "part"])
    longest = place.agg(F.max("at")).first()[0] or 0
    reach = 1
    while reach < longest:  # the last chunk's own result is not needed
        earlier = chunks.select("key", (F.col("at") + reach).alias("at"), *[F.col(c).alias(f"e_{c}") for c in chunks.columns if c not in ("key", "at")])
        chunks = cut_lineage(chunks.join(earlier, ["key", "at"], "left").mapInPandas(_composed, STEP_SCHEMA + ", at int"))
        reach *= 2
    # from the key's first chunk on, each function now holds all before it, and nothing comes in there
    ahead = place.select("key", (F.col("at") - 1).alias("at"), F.col("part").alias("next_part"))
    found = chunks.join(ahead, ["key", "at"]).select("next_part", "other_t", "other_h").collect()
    return {r.next_part: (r.other_t, r.other_h) for r in found}


def _composed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each chunk's function put behind that of the chunk ``reach`` before."""
    names = ["key", "part", "own", "other_t", "other_h", "upto", "out_t", "out_h", "rest_t", "rest_h", "at"]
    for frame in frames:
        out = []
        for r in frame.to_dict("records"):
            step = _step(r)
            if not pd.isna(r["e_part"]):
                step = _step({k[2:]: v for k, v in r.items() if k.startswith("e_")}).then(step)
            out.append(_row(r["key"], r["part"], step) | {"at": r["at"]})
        made = pd.DataFrame(out, columns=names)
        yield made.astype({"rest_t": "Int64"})


_ARROW_STEPS = pa.schema(
    [
        ("key", pa.string()), ("part", pa.int64()), ("own", pa.string()), ("other_t", pa.int64()), ("other_h", pa.string()),
        ("upto", pa.list_(pa.int64())), ("out_t", pa.list_(pa.int64())), ("out_h", pa.list_(pa.string())),
        ("rest_t", pa.int64()), ("rest_h", pa.string()),
    ]
)
