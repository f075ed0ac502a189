"""State per application for the streaming tables. Each processor keeps a handful of values per key.

A processor takes and gives plain tuples (``take``, ``expire``). Spark calls it through ``Together``, for many applications
under one key, or through ``PerRow`` for one; called by itself it takes and gives frames. State is read and written once for
each value and batch.
"""

from __future__ import annotations

import json
import pickle
from collections import namedtuple
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from telescale.operators.scaleout import (
    APP_END, APP_START, COMPLETE, EXECUTOR, JOB_END, JOB_START, SUBMIT,
)

PLACE = ["roll", "file_path", "split_start", "line_id"]


def _whole(value) -> int | None:
    return None if value is None else int(value)


def _in_place(rows: list) -> list:
    """Lines in the order of their log; those without a place last."""
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r[:len(PLACE)]))


def _ratio(length: int, span: int) -> float:
    if length == 0:
        return 0.0
    return 1.0 if span == 0 else length / span


class Cached:
    """A map state that is read and written at most once for each of its keys and batch.

    What comes and goes within a batch never reaches the store, and an application without state reads nothing.
    """

    def __init__(self, state) -> None:
        self.state = state
        self.begin(False)

    def begin(self, fresh: bool) -> None:
        """Forget the batch before; ``fresh`` says that the store holds nothing of this application."""
        self.fresh, self.values, self.stored, self.changed = fresh, {}, {}, {}

    def get(self, key: tuple, sure: bool = False) -> tuple | None:
        """The value of a key, None if there is none; ``sure`` that it was put."""
        if key not in self.values:
            self.stored[key] = there = not self.fresh and (sure or self.state.containsKey(key))
            self.values[key] = tuple(self.state.getValue(key)) if there else None
        return self.values[key]

    def put(self, key: tuple, value: tuple | None, new: bool = False) -> None:
        """Set a value, None to remove it; ``new`` says that the batch found nothing in the store under this key."""
        if new:
            self.stored.setdefault(key, False)
        self.values[key] = value
        self.changed[key] = True

    def write(self) -> None:
        for key in self.changed:
            value = self.values[key]
            if value is not None:
                self.state.updateValue(key, value)
            elif not self.fresh and (self.stored[key] if key in self.stored else self.state.containsKey(key)):
                self.state.removeKey(key)
        self.changed = {}


#: How long after an application's end its state is kept, for lines that were logged behind the end.
FREED_AFTER_MS = 3_600_000
#: How long it is remembered after that that the application is over.
REMEMBERED_MS = 30 * 86_400_000


class Ending(StatefulProcessor):
    """A processor whose ``states`` are dropped some time after the application's end was seen.

    What stays is a note that the application is over. Rows that arrive later are counted in it and not taken for those
    of a new application.
    """

    IN: Sequence[str] = ()  # columns of a row taken
    OUT: Sequence[str] = ()  # and of one given out
    cached: Sequence[Cached] = ()

    def __init__(self, freed_after_ms: int = FREED_AFTER_MS, remembered_ms: int = REMEMBERED_MS) -> None:
        self.freed_after_ms, self.remembered_ms = freed_after_ms, remembered_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.over = handle.getValueState("over", "late bigint", self.remembered_ms)
        self.row = namedtuple("Taken", self.IN)

    def take(self, key: tuple, rows: list, timerValues) -> list[tuple]:
        raise NotImplementedError

    def expire(self, key: tuple, timerValues, expiredTimerInfo) -> list[tuple]:
        self._begin(False)
        self._forget_all()
        return []

    def _begin(self, fresh: bool) -> None:
        self.fresh = fresh
        for state in self.cached:
            state.begin(fresh)

    def _write(self) -> None:
        for state in self.cached:
            state.write()

    def _late(self, rows: list) -> bool:
        """Whether the application is over; its rows are counted then."""
        if not self.over.exists():
            return False
        self.over.update((self.over.get()[0] + len(rows),))
        return True

    def _ended(self, rows: list, timerValues) -> None:
        if any(row.kind == APP_END for row in rows):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.freed_after_ms)

    def _forget_all(self) -> None:
        if not self.fresh:
            for state in self.states:
                state.clear()
        self._begin(True)
        self.over.update((0,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        taken = []
        for frame in rows:
            frame = frame[list(self.IN)].astype(object)
            taken += map(self.row._make, frame.where(frame.notna(), None).itertuples(index=False, name=None))
        return self._frames(self.take(key, taken, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._frames(self.expire(key, timerValues, expiredTimerInfo))

    def _frames(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        return iter([pd.DataFrame(rows, columns=list(self.OUT), dtype=object)] if rows else [])

    def close(self) -> None:
        pass


class PerRow(StatefulProcessor):
    """A processor as ``transformWithState`` calls it, with Spark's rows."""

    def __init__(self, processor: Ending) -> None:
        self.processor = processor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.processor.init(handle)
        self.out, self.at = Row(*self.processor.OUT), None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows, make = list(rows), self.processor.row._make
        if self.at is None:
            self.at = [rows[0].__fields__.index(name) for name in self.processor.IN]
        taken = [make([row[i] for i in self.at]) for row in rows]
        return (self.out(*row) for row in self.processor.take(key, taken, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return (self.out(*row) for row in self.processor.expire(key, timerValues, expiredTimerInfo))

    def close(self) -> None:
        self.processor.close()


#: The field of a row's text that names its application.
KEY = "key"
#: How many entries of its maps an application's state holds as one value; with more of them each entry is a value.
LARGE = 200
#: How many rows out make one text.
ROWS_IN_TEXT = 1000
_text = json.JSONEncoder(check_circular=False, separators=(",", ":")).encode
_UNREAD = object()


class Together(StatefulProcessor):
    """A processor as ``transformWithState`` calls it, with rows of many applications under one key, as JSON.

    To Spark each key costs a batch of rows out, and each call to the state a message; so an application's state is one value,
    read and written once a batch, and a key has one timer for all its applications of a batch. The state of an application
    with more than ``LARGE`` entries in its maps goes entry by entry, so that a batch touches those it needs only.
    """

    def __init__(self, processor: Ending) -> None:
        self.processor = processor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "app string", "state binary")
        self.entries = handle.getMapState("entries", "app string, map string, entry string", "value binary")
        self.due = handle.getMapState("due", "at bigint", "apps array<string>")
        self.over = handle.getMapState("over", "app string", "late bigint", self.processor.remembered_ms)
        self.timers: dict[int, dict[str, None]] = {}
        self.at, self.out = None, Row("rows")
        self.processor.init(self)

    # What the processor takes for its handle.

    def getValueState(self, name: str, schema: str, ttl_ms: int | None = None) -> _Value | _Note:
        return _Value(self, name) if ttl_ms is None else _Note(self)

    def getMapState(self, name: str, key: str, value: str) -> _Map:
        return _Map(self, name)

    def registerTimer(self, at: int) -> None:
        self.timers.setdefault(at, {})[self.app] = None

    # What Spark calls.

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names, make, taken = self.processor.IN, self.processor.row._make, {}
        for row in rows:
            if self.at is None:
                self.at = row.__fields__.index("row")
            fields = json.loads(row[self.at])
            taken.setdefault(fields.get(KEY), []).append(make(map(fields.get, names)))
        out = []
        for app, of_app in taken.items():
            self._load("" if app is None else f"={app}")
            out += self._texts(self.processor.take((app,), of_app, timerValues))
            self._store()
        self._set_timers()
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, out = (expiredTimerInfo.getExpiryTimeInMs(),), []
        due = self.due.getValue(at)
        self.due.removeKey(at)
        for app in [] if due is None else due[0]:
            self._load(app)
            out += self._texts(self.processor.expire((app[1:] if app else None,), timerValues, expiredTimerInfo))
            self._store()
        self._set_timers()
        return iter(out)

    def close(self) -> None:
        self.processor.close()

    def _texts(self, rows: list[tuple]) -> list[Row]:
        named = [{n: v for n, v in zip(self.processor.OUT, row) if v is not None} for row in rows]
        return [self.out(_text(named[i:i + ROWS_IN_TEXT])) for i in range(0, len(named), ROWS_IN_TEXT)]

    def _load(self, app: str) -> None:
        self.app, self.changed, self.note = app, False, _UNREAD
        held = self.held.getValue((app,))
        self.there = held is not None
        self.large, self.values, self.maps = pickle.loads(bytes(held[0])) if self.there else (False, {}, {})
        if self.there:  # an application with state is not over
            self.note = None

    def _store(self) -> None:
        if not self.changed:
            return
        if not self.large and sum(map(len, self.maps.values())) > LARGE:
            for name, entries in self.maps.items():
                for key, value in entries.items():
                    self.entries.updateValue((self.app, name, _text(key)), (pickle.dumps(value),))
            self.large, self.maps = True, {}
        if self.values or any(self.maps.values()):
            self.held.updateValue((self.app,), (pickle.dumps((self.large, self.values, self.maps)),))
        elif self.there:
            self.held.removeKey((self.app,))

    def _set_timers(self) -> None:
        for at, apps in self.timers.items():
            due = self.due.getValue((at,))
            self.due.updateValue((at,), (list(dict.fromkeys([*([] if due is None else due[0]), *apps])),))
            if due is None:
                self.handle.registerTimer(at)
        self.timers = {}


class _Value:
    """A value state of the application at hand."""

    def __init__(self, together: Together, name: str) -> None:
        self.together, self.name = together, name

    def exists(self) -> bool:
        return self.name in self.together.values

    def get(self) -> tuple:
        return self.together.values[self.name]

    def update(self, value: tuple) -> None:
        self.together.values[self.name] = value
        self.together.changed = True

    def clear(self) -> None:
        self.together.values.pop(self.name, None)
        self.together.changed = True


class _Note:
    """The note that the application at hand is over, which outlives its state."""

    def __init__(self, together: Together) -> None:
        self.together = together

    def exists(self) -> bool:
        return self.get() is not None

    def get(self) -> tuple | None:
        t = self.together
        if t.note is _UNREAD:
            t.note = t.over.getValue((t.app,))
        return t.note

    def update(self, value: tuple) -> None:
        self.together.over.updateValue((self.together.app,), value)
        self.together.note = value


class _Map:
    """A map state of the application at hand."""

    def __init__(self, together: Together, name: str) -> None:
        self.together, self.name = together, name

    def _entry(self, key: tuple) -> tuple[str, str, str]:
        return self.together.app, self.name, _text(key)

    def containsKey(self, key: tuple) -> bool:
        if self.together.large:
            return self.together.entries.containsKey(self._entry(key))
        return key in self.together.maps.get(self.name, ())

    def getValue(self, key: tuple) -> tuple:
        if self.together.large:
            return pickle.loads(bytes(self.together.entries.getValue(self._entry(key))[0]))
        return self.together.maps[self.name][key]

    def updateValue(self, key: tuple, value: tuple) -> None:
        if self.together.large:
            self.together.entries.updateValue(self._entry(key), (pickle.dumps(value),))
        else:
            self.together.maps.setdefault(self.name, {})[key] = value
        self.together.changed = True

    def removeKey(self, key: tuple) -> None:
        if self.together.large:
            self.together.entries.removeKey(self._entry(key))
        else:
            del self.together.maps[self.name][key]
        self.together.changed = True

    def clear(self) -> None:
        t = self.together
        if t.large:
            for entry in [tuple(e) for e in t.entries.keys() if tuple(e)[:2] == (t.app, self.name)]:
                t.entries.removeKey(entry)
        t.maps.pop(self.name, None)
        t.changed = True


STAGE = [
    "stage_id", "attempt_id", "stage_name", "num_tasks", "parent_stage_ids", "submit_ms", "complete_ms",
    "failure_reason", "rdd_num_partitions", "rdd_num_cached_partitions", "rdd_mem_size", "rdd_disk_size",
    "cpu_utilization", "gc_time_ratio", "shuffle_read_write_ratio", "input_output_ratio", "memory_spill_ratio",
]
OUT_TRACKED = [
    "log_id", "app_id", "seq", "message_no", "num_executors", "last_known", "kind", "t_ms", "job_id", "stage_ids",
    *STAGE,
]
MESSAGES = [APP_START, JOB_START, JOB_END, APP_END]
LATE = "late"
OUT_STAGE = [
    "app_id", "job_id", "app_time", "num_executors", "rescaling_time_ratio", *STAGE, "start_scale_out",
    "end_scale_out", "stage_rescaling_time_ratio",
]


class ScaleOutTracker(Ending):
    """Live executors and the last known scale-out, event by event, and the number of each message in its log.

    Rows that arrive after the state went come out as they are, of kind ``late``. What it does not look at comes out as it
    went in.
    """

    PASSED = ["stage_ids", *STAGE]
    IN = [*PLACE, "app_id", "initial", "driver_host", "executor_id", "host", "delta", "kind", "t_ms", "job_id", *PASSED]
    OUT = OUT_TRACKED

    def __init__(self, base: int = 0, freed_after_ms: int = FREED_AFTER_MS) -> None:
        super().__init__(freed_after_ms)
        self.base = base

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.app = handle.getValueState(
            "app",
            "app_id string, driver_host string, total int, initial int, last_known int, n bigint, messages bigint",
        )
        hosts = handle.getMapState("hosts", "executor_id string", "host string")
        self.states = (self.app, hosts)
        self.hosts = Cached(hosts)
        self.cached = (self.hosts,)

    def _host(self, row) -> str | None:
        key = (row.executor_id,)
        if row.delta > 0:
            self.hosts.put(key, (row.host,))
            return row.host
        held = self.hosts.get(key)
        if held is None:
            return None
        self.hosts.put(key, None)
        return held[0]

    def take(self, key, rows, timerValues) -> list[tuple]:
        at = len(self.IN) - len(self.PASSED)
        if self._late(rows):
            empty = (None,) * 4
            return [(key[0], row.app_id, *empty, LATE, row.t_ms, row.job_id, *row[at:]) for row in rows]
        fresh = not self.app.exists()
        self._begin(fresh)
        app_id, driver, total, initial, known, n, n_messages = (None, None, 0, None, None, 0, 0) if fresh else self.app.get()
        rows = _in_place(rows)
        app_id = next((row.app_id for row in rows if row.app_id is not None), app_id)
        driver = next((row.driver_host for row in rows if row.driver_host is not None), driver)

        out = []
        for row in rows:
            kind, number = row.kind, None
            # Executors beside the driver are not counted.
            if driver is None or kind != EXECUTOR or self._host(row) != driver:
                total += int(row.delta)
            if row.initial is not None:
                initial = int(row.initial)
            reported = alive = max(0, self.base + total)
            if kind == JOB_END or kind == JOB_START and row.job_id != 0:
                known = alive
            elif kind == JOB_START:
                reported = initial
            elif kind == APP_START:
                known = known if initial is None else initial
            elif kind == APP_END:
                reported = known
            if kind in MESSAGES:
                number = n_messages
                n_messages += 1
            out.append((key[0], app_id, n, number, reported, known, kind, row.t_ms, row.job_id, *row[at:]))
            n += 1
        self._write()
        self.app.update((app_id, driver, total, initial, known, n, n_messages))
        self._ended(rows, timerValues)
        return out


class StagePairer(Ending):
    """Holds submitted stage attempts until they complete or the application is over."""

    IN = ["seq", "kind", "stage_id", "attempt_id", "submit_ms", "complete_ms"]
    OUT = ["app_id", "stage_id", "attempt_id", "submit_ms", "complete_ms"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        submitted = handle.getMapState("submitted", "stage_id int, attempt_id int", "submit_ms bigint")
        self.begun = handle.getValueState("begun", "yes boolean")
        self.states = (submitted, self.begun)
        self.submitted = Cached(submitted)
        self.cached = (self.submitted,)

    def take(self, key, rows, timerValues) -> list[tuple]:
        if self._late(rows):
            return []
        self._begin(not self.begun.exists())
        pairs = []
        for row in sorted(rows, key=lambda r: r.seq):
            if row.kind not in (SUBMIT, COMPLETE):
                continue
            attempt = (int(row.stage_id), int(row.attempt_id))
            if row.kind == SUBMIT:
                self.submitted.put(attempt, (int(row.submit_ms),))
                continue
            held = self.submitted.get(attempt)
            if held is not None:
                self.submitted.put(attempt, None)
                if held[0] <= row.complete_ms:
                    pairs.append((key[0], *attempt, int(held[0]), int(row.complete_ms)))
        if self.fresh:
            self.begun.update((True,))
        self._write()
        self._ended(rows, timerValues)
        return pairs


class Points:
    """Times of executor events in order, held by their number with running sums over ties.

    Numbers grow with time, so a window's first and last event are found by bisection, and the sums between them by
    subtraction.
    """

    def __init__(self, state: Cached) -> None:
        self.state = state

    def begin(self, low: int, high: int) -> None:
        """Take up events ``low`` to ``high`` (not included) as held."""
        self.low, self.high = low, high

    def at(self, i: int) -> tuple[int, int, int]:
        """Time of an event, and number and summed times of the ties up to it."""
        return self.state.get((i,), sure=True)

    def append(self, t: int) -> None:
        before, ties, tie_ms = self.at(self.high - 1) if self.high > self.low else (None, 0, 0)
        tied = int(before == t)
        self.state.put((self.high,), (t, ties + tied, tie_ms + tied * t), new=True)
        self.high += 1

    def first_from(self, t: int, low: int) -> int:
        """The first event at ``t`` or later, from ``low`` on."""
        high = self.high
        while low < high:
            middle = (low + high) // 2
            if self.at(middle)[0] < t:
                low = middle + 1
            else:
                high = middle
        return low

    def drop_before(self, t: int) -> None:
        while self.low < self.high and self.at(self.low)[0] < t:
            self.state.put((self.low,), None)
            self.low += 1

    def ratio(self, start: int, end: int) -> float:
        """Share of a window between its first and last event; an application's first event never counts."""
        first = self.first_from(start, max(self.low, 1))
        last = self.first_from(end + 1, first) - 1
        if last < first:
            return 0.0
        (a, ties_a, ms_a), (b, ties_b, ms_b) = self.at(first), self.at(last)
        return _ratio(b - a + (ties_b - ties_a) * end - (ms_b - ms_a), end - start)


class JobEndCollector(Ending):
    """Holds the stages of running jobs, and emits a job's stages when it ends.

    Rows of stages are held by job and number, so a batch reads and writes those of its own jobs only. Executor events
    are kept back to the start of the oldest job still running, since no stage of it was submitted earlier; jobs stand
    in a queue in the order of their starts, so the oldest is at its head. For the window from the application's start a
    job needs just the counters in ``app``.
    """

    IN = ["seq", "kind", "t_ms", "job_id", "stage_ids", "num_executors", "last_known", *STAGE]
    OUT = OUT_STAGE
    APP = ["start", "seen", "first", "last", "ties", "tie_ms", "low", "high", "head", "tail"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        maps = (
            handle.getMapState("stage_jobs", "stage_id int", "job_id int"),
            handle.getMapState("jobs", "job_id int", "submits int, completes int"),
            handle.getMapState("listed", "job_id int", "stages array<int>"),
            handle.getMapState("queue", "place bigint", "job_id int, start_ms bigint"),
            handle.getMapState(
                "submits", "job_id int, n int",
                "stage_id int, name string, tasks int, parents array<int>, ms bigint, scale int",
            ),
            handle.getMapState(
                "completes", "job_id int, n int",
                "stage_id int, attempt int, ms bigint, scale int, ratio double, reason string, sizes array<bigint>, "
                "metrics array<double>",
            ),
            handle.getMapState("times", "place bigint", "ms bigint, ties bigint, tie_ms bigint"),
        )
        self.app = handle.getValueState("app", ", ".join(f"{c} bigint" for c in self.APP))
        self.states = (*maps, self.app)
        self.cached = tuple(map(Cached, maps))
        self.stage_jobs, self.jobs, self.listed, self.queue, self.submits, self.completes, times = self.cached
        self.points = Points(times)

    def _count(self, t: int) -> None:
        """Take one executor event into the window that began with the application."""
        s = self.held
        s["seen"] += 1
        if s["first"] is None:
            if s["seen"] > 1 and t >= s["start"]:
                s["first"] = t
        elif t == s["last"]:
            s["ties"] += 1
            s["tie_ms"] += t
        s["last"] = t

    def take(self, key, rows, timerValues) -> list[tuple]:
        if self._late(rows):
            return []
        self._begin(not self.app.exists())
        self.held = dict(zip(self.APP, (None, 0, None, None, 0, 0, 0, 0, 0, 0) if self.fresh else self.app.get()))
        self.points.begin(self.held["low"], self.held["high"])
        out = []
        for row in sorted(rows, key=lambda r: r.seq):
            if row.kind == APP_START:
                self.held["start"] = int(row.t_ms)
                for i in range(self.points.low, self.points.high):
                    self._count(self.points.at(i)[0])
            elif row.kind == EXECUTOR:
                self.points.append(int(row.t_ms))
                if self.held["start"] is not None:
                    self._count(int(row.t_ms))
            elif row.kind == JOB_START:
                self._start(int(row.job_id), int(row.t_ms), [int(i) for i in row.stage_ids])
            elif row.kind in (SUBMIT, COMPLETE):
                self._take(row)
            elif row.kind == JOB_END:
                out += [(key[0], *found) for found in self._end(row)]
        times = [int(row.t_ms) for row in rows if row.t_ms is not None]
        if times:
            self._drop(max(times))
        self.held |= {"low": self.points.low, "high": self.points.high}
        self._write()
        self.app.update(tuple(self.held[n] for n in self.APP))
        self._ended(rows, timerValues)
        return out

    def _start(self, job: int, t_ms: int, stages: list[int]) -> None:
        if self.jobs.get((job,)) is not None:
            self.listed.put((job,), ([*self.listed.get((job,))[0], *stages],))
        else:
            self.jobs.put((job,), (0, 0))
            self.listed.put((job,), (stages,), new=True)
            self.queue.put((self.held["tail"],), (job, t_ms), new=True)
            self.held["tail"] += 1
        for stage in stages:
            self.stage_jobs.put((stage,), (job,))

    def _take(self, row) -> None:
        """A submitted or completed stage, held with its job."""
        stage = int(row.stage_id)
        job = self.stage_jobs.get((stage,))
        counts = None if job is None else self.jobs.get(job)
        if counts is None:
            return
        submits, completes = counts
        if row.kind == SUBMIT:
            self.submits.put((*job, submits), (
                stage, row.stage_name, int(row.num_tasks), [int(i) for i in row.parent_stage_ids], int(row.submit_ms),
                _whole(row.last_known),
            ), new=True)
            submits += 1
        else:
            metrics = [getattr(row, c) for c in STAGE[12:]]
            self.completes.put((*job, completes), (
                stage, int(row.attempt_id), int(row.complete_ms), _whole(row.last_known),
                self.points.ratio(int(row.submit_ms), int(row.complete_ms)), row.failure_reason or "",
                [_whole(getattr(row, c)) for c in STAGE[8:12]], [None if v is None else float(v) for v in metrics],
            ), new=True)
            completes += 1
        self.jobs.put(job, (submits, completes))

    def _end(self, row) -> list[tuple]:
        job = (int(row.job_id),)
        counts = self.jobs.get(job)
        if counts is None:
            return []
        listed = self.listed.get(job)[0]
        mine, done = [], []
        for state, n, found in zip((self.submits, self.completes), counts, (mine, done)):
            for i in range(n):
                found.append(state.get((*job, i), sure=True))
                state.put((*job, i), None)
        self.jobs.put(job, None)
        self.listed.put(job, None)
        for stage in dict.fromkeys(listed):
            if self.stage_jobs.get((stage,)) == job:
                self.stage_jobs.put((stage,), None)
        if len(mine) != len(done):  # such jobs are reported by the count check
            return []
        by_stage = lambda x: x[0]
        return self._rows(row, {b[0]: (b, c) for b, c in zip(sorted(mine, key=by_stage), sorted(done, key=by_stage))})

    def _drop(self, now: int) -> None:
        """Forget executor events from before the oldest running job."""
        while self.held["head"] < self.held["tail"]:
            job, start = self.queue.get((self.held["head"],), sure=True)
            if self.jobs.get((job,)) is not None:
                now = min(now, start)
                break
            self.queue.put((self.held["head"],), None)
            self.held["head"] += 1
        if self.held["start"] is not None:
            self.points.drop_before(now)

    def _rows(self, row, stages) -> list[tuple]:
        s, end = self.held, int(row.t_ms)
        length = 0
        if s["first"] is not None:
            length = s["last"] - s["first"] + s["ties"] * end - s["tie_ms"]
        ratio = _ratio(length, end - s["start"])
        head = (int(row.job_id), end, _whole(row.num_executors), ratio)
        return [
            (*head, b[0], c[1], b[1], b[2], list(b[3]), b[4], c[2], c[5], *c[6], *c[7], b[5], c[3], c[4])
            for b, c in stages.values()
        ]


class StartComposer(Ending):
    """An application's start and its settings, from two lines of its log that may arrive apart, in any order."""

    IN = [*PLACE, "kind", "app_id", "t_ms", "settings"]
    OUT = ["app_id", "app_time", "settings"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getValueState("seen", "app_id string, app_time bigint, settings string")
        self.states = (self.seen,)

    def take(self, key, rows, timerValues) -> list[tuple]:
        if self._late(rows):  # the start was given out, or the application is over
            return []
        self._begin(not self.seen.exists())
        app_id, app_time, settings = (None, None, None) if self.fresh else self.seen.get()
        for row in _in_place(rows):
            if row.kind == APP_START and app_id is None:
                app_id, app_time = row.app_id, int(row.t_ms)
            elif row.kind == APP_END and app_id is not None and settings is None:
                self._forget_all()
                return []
            elif settings is None and row.settings is not None:
                settings = row.settings
        if app_id is not None and settings is not None:
            self._forget_all()
            return [(app_id, app_time, settings)]
        self.seen.update((app_id, app_time, settings))
        return []


class InOrder(Ending):
    """Rows of an application given out by their number, each once those before it are out.

    A row waits for its turn, and for what else it needs, until a timer of its own goes off; then it goes with what
    there is, and those before it that never came are passed over. One that comes after it was passed over is late.
    The timer counts from when the row was read, so no traffic is needed to set waiting rows free.
    """

    ROW = ""  # fields of a waiting row, the first its number, the last when it is due

    def __init__(self, wait_ms: int, remembered_ms: int = REMEMBERED_MS) -> None:
        super().__init__(remembered_ms=remembered_ms)
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        waiting = handle.getMapState("waiting", "number bigint", self.ROW)
        self.next = handle.getValueState("next", "number bigint, last bigint")
        self.states = (waiting, self.next)
        self.waiting = Cached(waiting)
        self.cached = (self.waiting,)

    def _begin_batch(self) -> None:
        """Take up where the batch before stopped; ``next`` is there as soon as anything is held."""
        self._begin(not self.next.exists())
        self.number, self.last = (0, -1) if self.fresh else self.next.get()

    def _hold(self, rows: list[tuple], timerValues) -> list[tuple]:
        """Let rows wait; returns those that were passed over before."""
        due, self.timer = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms, None
        late = [r for r in rows if r[0] < self.number]
        rows = [r for r in rows if r[0] >= self.number]
        for row in rows:
            self.waiting.put((row[0],), (*row[1:], due))
        if rows:
            self.last, self.timer = max(self.last, *(r[0] for r in rows)), due
        return late

    def _free(self, now: int) -> Iterator[tuple]:
        """Rows whose turn it is, in order; the state is written behind the last."""
        while self.number <= self.last:
            at = self.number
            while self.waiting.get((at,)) is None:  # not read yet; ``last`` is there
                at += 1
            row = (at, *self.waiting.get((at,)))
            if row[-1] > now and (at > self.number or not self._ready(row)):
                break
            self.waiting.put((at,), None)
            self.number = at + 1
            yield row[:-1]
        if self.number > self.last and self.finished:
            self._forget_all()
        else:
            self._write()
            self.next.update((self.number, self.last))
            if self.timer is not None and self.number <= self.last:
                self.handle.registerTimer(self.timer)

    def _ready(self, row: tuple) -> bool:
        return True

    def expire(self, key, timerValues, expiredTimerInfo) -> list[tuple]:
        self._begin_batch()
        if self.fresh:
            return []
        now = max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self.timer = None
        return self._out(key, now, [])


class AnswerMatcher(InOrder):
    """Gives each message its first answer in time, and gives messages out in their order.

    A message waits for its answer for ``wait_ms`` from when it was read, messages behind it wait with it; then it goes
    without one. An answer that says it was given later than ``timeout_ms`` after the message sets it free at once.
    Repeated answers to one message are taken to arrive in their order; answers from before the message are no answers
    to it. State goes once the application's end was given out.
    """

    MESSAGE = ["event_type", "job_id", "t_ms", "seq", "num_executors", "last_known"]
    IN = ["message_no", *MESSAGE, "answered_ms", "recommended_scale_out"]
    OUT = ["app_id", "message_no", *MESSAGE, "recommended_scale_out"]
    ROW = ("event_type string, job_id int, t_ms bigint, seq bigint, num_executors int, last_known int, due bigint")

    def __init__(self, timeout_ms: int, wait_ms: int) -> None:
        super().__init__(wait_ms)
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        answers = handle.getMapState(
            "answers", "event_type string, job_id int", "answered_ms bigint, recommended_scale_out int"
        )
        self.states = (*self.states, answers)
        self.answers = Cached(answers)
        self.cached = (self.waiting, self.answers)

    def _answer(self, row: tuple) -> tuple[int, int] | None:
        name = (row[1], -1 if row[2] is None else row[2])
        found = self.answers.get(name)
        if found is not None and found[0] < row[3]:
            self.answers.put(name, None)
            return None
        return found

    def _ready(self, row: tuple) -> bool:
        return self._answer(row) is not None

    def take(self, key, rows, timerValues) -> list[tuple]:
        if self._late(rows):
            return []
        self._begin_batch()
        for row in sorted((r for r in rows if r.answered_ms is not None), key=lambda r: r.answered_ms):
            name = (row.event_type, -1 if row.job_id is None else int(row.job_id))
            found = self.answers.get(name)
            if found is None or row.answered_ms < found[0]:
                self.answers.put(name, (int(row.answered_ms), int(row.recommended_scale_out)))
        new = [
            (int(row.message_no), row.event_type, *map(_whole, row[2:1 + len(self.MESSAGE)]))
            for row in rows if row.answered_ms is None
        ]
        late = self._hold(new, timerValues)
        return self._out(key, timerValues.getCurrentProcessingTimeInMs(), late)

    def _out(self, key, now: int, late: list[tuple]) -> list[tuple]:
        self.finished = False
        out = [(key[0], *row, self._scale(row)) for row in late]
        for row in self._free(now):
            self.finished = row[1] == "APPLICATION_END"
            out.append((key[0], *row, self._scale(row)))
        return out

    def _scale(self, row: tuple) -> int | None:
        found = self._answer(row)
        if found is None:
            return None
        self.answers.put((row[1], -1 if row[2] is None else row[2]), None)
        return found[1] if found[0] <= row[3] + self.timeout_ms else None


class DecisionClock(InOrder):
    """Grants a candidate if the one before it lies at least the gap behind; messages are taken in their order.

    Messages that are no candidates only keep the count. A candidate that comes after it was passed over is ``late``.
    """

    ROW = "event_type string, job_id int, t_ms bigint, seq bigint, effective_scale_out int, candidate boolean, due bigint"
    IN = ["message_no", "event_type", "job_id", "t_ms", "seq", "effective_scale_out", "candidate"]
    OUT = ["app_id", "event_type", "job_id", "t_ms", "seq", "effective_scale_out", "waited_ms", "decision"]

    def __init__(self, min_gap_ms: int, wait_ms: int) -> None:
        super().__init__(wait_ms)
        self.min_gap_ms = min_gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.previous = handle.getValueState("previous", "t_ms bigint")
        self.states = (*self.states, self.previous)

    def take(self, key, rows, timerValues) -> list[tuple]:
        taken = [
            (int(row.message_no), row.event_type, *map(_whole, row[2:6]), bool(row.candidate)) for row in rows
        ]
        if self._late(rows):
            return self._passed_over(key, taken)
        self._begin_batch()
        late = self._hold(taken, timerValues)
        return self._out(key, timerValues.getCurrentProcessingTimeInMs(), late)

    def _passed_over(self, key, late: list[tuple]) -> list[tuple]:
        return [(key[0], *row[1:-1], None, "late") for row in late if row[-1]]

    def _out(self, key, now: int, late: list[tuple]) -> list[tuple]:
        out = self._passed_over(key, late)
        self.finished = False
        before = previous = None if self.fresh or not self.previous.exists() else self.previous.get()[0]
        for row in self._free(now):
            self.finished = row[1] == "APPLICATION_END"
            if row[-1]:
                waited = 0 if previous is None else row[3] - previous
                out.append((key[0], *row[1:-1], waited, "suppressed" if waited < self.min_gap_ms else "requested"))
            if row[-1] or row[1] == "APPLICATION_START":
                previous = row[3]
        if previous != before and not (self.finished and self.number > self.last):  # else all state went
            self.previous.update((previous,))
        return out
