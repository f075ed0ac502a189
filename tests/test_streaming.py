"""State processors give the same rows wherever a micro-batch ends, in whatever order files are read, and by timers."""

from __future__ import annotations

import json
import random

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from telescale.operators.scaleout import APP_END, APP_START, COMPLETE, EXECUTOR, JOB_END, JOB_START, SUBMIT
from telescale.sources import message_sink, recommendations
from telescale.streaming import tables
from telescale.streaming.processors import (
    OUT_TRACKED, PLACE, STAGE, AnswerMatcher, DecisionClock, JobEndCollector, PerRow, ScaleOutTracker, StagePairer,
    StartComposer,
)


class Held:
    """State of one key, in memory: a value, a list or a map."""

    calls = 0

    def __init__(self):
        self.clear()

    def clear(self):
        self.value, self.items, self.map = None, [], {}

    def empty(self):
        return self.value is None and not self.items and not self.map

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value if self.value is not None else iter(self.items)

    def update(self, value):
        self.value = value

    def put(self, items):
        self.items = list(items)

    def updateValue(self, key, value):
        Held.calls += 1
        self.map[key] = value

    def containsKey(self, key):
        Held.calls += 1
        return key in self.map

    def getValue(self, key):
        Held.calls += 1
        return self.map[key]

    def removeKey(self, key):
        Held.calls += 1
        del self.map[key]

    def iterator(self):
        return iter(list(self.map.items()))


class Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def _new(self, name, *_):
        self.states[name] = Held()
        return self.states[name]

    getValueState = getListState = getMapState = _new

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    """Processing time, and the expiry of a timer."""

    def __init__(self, now=1000):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


class Run:
    """A processor with state in memory, given rows and time."""

    def __init__(self, processor):
        self.processor, self.handle, self.now, self.out = processor, Handle(), 1000, []
        processor.init(self.handle)

    def give(self, frame):
        if len(frame):
            rows = iter([frame.reset_index(drop=True)])
            self.out += list(self.processor.handleInputRows(("app",), rows, Clock(self.now)))

    def wait(self, until):
        """Let time pass; timers that are due go off in their order."""
        for at in sorted(t for t in self.handle.timers if t <= until):
            self.handle.timers.remove(at)
            self.now = max(self.now, at)
            self.out += list(self.processor.handleExpiredTimer(("app",), Clock(self.now), Clock(at)))
        self.now = until

    def rows(self):
        rows = pd.concat(self.out, ignore_index=True) if self.out else pd.DataFrame()
        rows = rows.astype(object).where(rows.notna(), None)
        return [tuple(map(str, r)) for r in rows.itertuples(index=False)]

    def gone(self):
        """Whether no state is left but the note that the application is over."""
        return all(state.empty() for name, state in self.handle.states.items() if name != "over")


def run(processor, frame, borders):
    """Rows out of a processor that is given the frame in batches, and whether all state is gone at the end."""
    live = Run(processor)
    for a, b in zip([0, *borders], [*borders, len(frame)]):
        live.give(frame.iloc[a:b])
    n = len(live.out)
    live.wait(10**9)
    assert len(live.out) == n
    return live.rows(), live.gone()


def borders_of(n):
    rng = random.Random(n)
    yield list(range(1, n))
    for i in range(1, n):
        yield [i]
    for _ in range(20):
        yield sorted(rng.sample(range(1, n), rng.randint(0, n - 1)))


def event(seq, kind, t_ms, **more):
    row = dict.fromkeys(OUT_TRACKED) | {"app_id": "app", "seq": seq, "kind": kind, "t_ms": t_ms, "last_known": 3}
    return row | {"num_executors": 3} | more


def stage(seq, kind, stage_id, attempt, submit, complete=None):
    sizes = {c: 1 for c in STAGE[8:12]} | {c: 0.5 for c in STAGE[12:]}
    named = {"stage_name": "s", "num_tasks": 4, "parent_stage_ids": [], "submit_ms": submit, "complete_ms": complete}
    return event(seq, kind, submit if complete is None else complete, stage_id=stage_id, attempt_id=attempt, **named, **sizes)


@pytest.fixture
def tracked():
    """A stage that runs twice, its second attempt overlapping the first; a job cut off by the end."""
    rows = [
        event(0, APP_START, 0), event(1, JOB_START, 1, job_id=0, stage_ids=[1, 2]), event(2, EXECUTOR, 5),
        stage(3, SUBMIT, 1, 0, 10), stage(4, SUBMIT, 2, 0, 12), stage(5, SUBMIT, 1, 1, 40), event(6, EXECUTOR, 50),
        stage(7, COMPLETE, 1, 0, 10, 55), event(8, EXECUTOR, 60), event(9, EXECUTOR, 90), stage(10, COMPLETE, 2, 0, 12, 95),
        stage(11, COMPLETE, 1, 1, 40, 140), event(12, JOB_END, 150, job_id=0), event(13, EXECUTOR, 155),
        event(14, JOB_START, 160, job_id=1, stage_ids=[3]), event(15, EXECUTOR, 165), stage(16, SUBMIT, 3, 0, 161),
        event(17, APP_END, 170),
    ]
    return pd.DataFrame(rows)


def test_job_ends_on_any_border(tracked):
    whole, _ = run(JobEndCollector(), tracked, [])
    assert whole
    for borders in borders_of(len(tracked)):
        assert run(JobEndCollector(), tracked, borders) == (whole, True), borders


def test_ratio_of_a_stage_that_runs_twice(tracked):
    """Executors at 50, 60 and 90 lie in the second attempt from 40 to 140."""
    got, _ = run(JobEndCollector(), tracked, [9])
    assert any(float(r[-1]) == pytest.approx((90 - 50) / 100) for r in got)


def test_pairs_on_any_border(tracked):
    whole, _ = run(StagePairer(), tracked, [])
    assert [r[1:] for r in whole] == [("1", "0", "10", "55"), ("2", "0", "12", "95"), ("1", "1", "40", "140")]
    for borders in borders_of(len(tracked)):
        assert run(StagePairer(), tracked, borders) == (whole, True), borders


def many_stages(n):
    """A job of n stages that are all open, and a job of one stage that runs beside it."""
    rows = [event(0, APP_START, 0), event(1, JOB_START, 1, job_id=0, stage_ids=list(range(1, n + 1)))]
    for i in range(n):
        rows += [event(len(rows), EXECUTOR, 2 + i), stage(len(rows) + 1, SUBMIT, i + 1, 0, 3 + i)]
    return rows


def test_cost_does_not_grow_with_open_stages():
    """A batch with one short job touches as much state beside 2000 open stages as beside 20."""
    calls = []
    for n in (20, 2000):
        live = Run(JobEndCollector())
        live.give(pd.DataFrame(many_stages(n)))
        Held.calls, at = 0, 3 * n
        live.give(pd.DataFrame([
            event(at, JOB_START, at, job_id=1, stage_ids=[9999]), event(at + 1, EXECUTOR, at + 1),
            stage(at + 2, SUBMIT, 9999, 0, at + 1), stage(at + 3, COMPLETE, 9999, 0, at + 1, at + 9),
            event(at + 4, JOB_END, at + 10, job_id=1),
        ]))
        assert len(live.rows()) == 1
        calls.append(Held.calls)
    assert calls[1] <= calls[0] + 4 * 7  # bisection takes log2(100) steps more for each of four searches


def test_stage_ratios_equal_a_scan_of_all_events():
    """Prefix sums and bisection against a list of times, with ties, on random windows."""
    rng = random.Random(7)
    for n in (0, 1, 2, 5, 60):
        times = sorted(rng.choices(range(40), k=n))
        windows = [sorted(rng.choices(range(-2, 45), k=2)) for _ in range(40)]
        rows = [event(0, APP_START, 0), event(1, JOB_START, 0, job_id=0, stage_ids=list(range(40)))]
        rows += [event(len(rows) + i, EXECUTOR, t) for i, t in enumerate(times)]
        for i, (a, b) in enumerate(windows):
            rows += [stage(100 + 2 * i, SUBMIT, i, 0, a), stage(101 + 2 * i, COMPLETE, i, 0, a, b)]
        rows.append(event(300, JOB_END, 50, job_id=0))
        got, _ = run(JobEndCollector(), pd.DataFrame(rows), [])
        for row, (a, b) in zip(sorted(got, key=lambda r: int(r[5])), windows):
            inside = [t for t in times[1:] if a <= t <= b]
            ms = inside[-1] - inside[0] + sum(b - x for x, y in zip(inside, inside[1:]) if x == y) if inside else 0
            want = 0.0 if ms == 0 else 1.0 if a == b else ms / (b - a)
            assert float(row[-1]) == pytest.approx(want)


def line(n, kind, t_ms=0, **more):
    row = dict.fromkeys([*PLACE, "app_id", "initial", "driver_host", "executor_id", "host", "delta", "kind", "t_ms", "job_id",
                         "stage_ids", *STAGE, "settings"])
    return row | {"roll": 0, "file_path": "f", "split_start": 0, "line_id": n, "delta": 0, "kind": kind, "t_ms": t_ms} | more


LOG = [
    line(0, "environment"), line(1, APP_START, 5, app_id="a", initial=3), line(2, EXECUTOR, 6, delta=1, executor_id="1"),
    line(3, JOB_START, 7, job_id=0), line(4, JOB_END, 9, job_id=0), line(5, JOB_START, 10, job_id=1), line(6, APP_END, 11),
]


def test_lines_after_the_end_are_counted():
    """A line that is read after the state was freed is late, and starts no new application."""
    frame = pd.DataFrame(LOG).drop(columns="settings")
    live = Run(ScaleOutTracker(3))
    live.give(frame)
    whole = pd.concat(live.out)
    assert list(whole["message_no"].dropna()) == [0, 1, 2, 3, 4] and list(whole["seq"]) == list(range(7))
    live.give(frame.iloc[2:3])  # within the hour it is taken
    assert pd.concat(live.out)["kind"].iloc[-1] == EXECUTOR
    live.wait(1000 + 3_600_000)
    assert live.gone()
    live.give(frame.iloc[2:5])
    late = live.out[-1]
    assert list(late["kind"]) == ["late"] * 3 and late["seq"].isna().all() and list(late["t_ms"]) == [6, 7, 9]
    assert live.gone() and live.handle.states["over"].value == (3,)
    for processor in (JobEndCollector(), StagePairer()):
        other = Run(processor)
        other.give(pd.DataFrame([event(0, APP_START, 0), event(1, APP_END, 9)]))
        other.wait(10**9)
        other.give(pd.DataFrame([event(2, JOB_START, 3, job_id=0, stage_ids=[1])]))
        assert other.gone() and other.handle.states["over"].value == (1,)


def test_late_rows_are_a_table(spark):
    schema = tables.TRACKED
    rows = [("l", "a", 0, 0, 1, 1, "app_start", 5), ("l", None, None, None, None, None, "late", 7),
            ("l", None, None, None, None, None, "late", 9), ("m", "b", 0, 0, 1, 1, "app_start", 5)]
    frame = spark.createDataFrame([(*r, *[None] * 19) for r in rows], schema)
    assert [tuple(r) for r in tables.late_rows(frame).collect()] == [("l", 2, 9)]


def test_an_application_starts_with_its_settings():
    """The environment and the start may arrive in any order and apart; each start comes out once."""
    frame = pd.DataFrame(LOG)
    frame.loc[0, "settings"] = '{"spark.app.name":"x"}'
    for order in ([0, 1, 6], [1, 0, 6], [1, 6, 0]):
        for borders in ([], [1], [1, 2]):
            live = Run(StartComposer())
            rows = frame.iloc[order] if order[1] != 6 else frame.iloc[[1, 0, 6]]
            for a, b in zip([0, *borders], [*borders, 3]):
                live.give(rows.iloc[a:b])
            live.give(rows)  # read again: nothing new
            assert live.rows() == [("a", "5", '{"spark.app.name":"x"}')] and live.gone()
    live = Run(StartComposer())
    live.give(frame.iloc[[1, 6]])  # no environment: no record
    assert live.rows() == [] and live.gone()


def sent(number, event_type, t_ms, job=None):
    return {"app_id": "app", "message_no": number, "event_type": event_type, "job_id": job, "t_ms": t_ms, "seq": 10 * number,
            "num_executors": 2, "last_known": 2, "answered_ms": None, "recommended_scale_out": None}


def answer(event_type, answered_ms, scale, job=None):
    return sent(0, event_type, None, job) | {
        "message_no": None, "seq": None, "answered_ms": answered_ms, "recommended_scale_out": scale}


SHORT = [
    sent(0, "APPLICATION_START", 0), sent(1, "JOB_START", 20_000, 0), sent(2, "JOB_END", 40_000, 0),
    sent(3, "JOB_START", 60_000, 1), sent(4, "JOB_END", 100_000, 1), sent(5, "APPLICATION_END", 180_000),
]
ANSWERS = [
    answer("APPLICATION_START", 1_000, 4), answer("JOB_END", 41_000, 6, 0), answer("JOB_START", 61_000, 7, 1),
    answer("JOB_END", 101_000, 8, 1), answer("APPLICATION_END", 181_000, 1),
]


def scales(live):
    return [(r[2], r[-1]) for r in live.rows()]


def test_a_lost_answer_holds_nothing_back_for_long():
    """Job start 0 of a short application is never answered: all six messages come out, without further traffic."""
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(pd.DataFrame(SHORT + ANSWERS))
    assert scales(live) == [("APPLICATION_START", "4")]
    live.wait(1000 + 59_999)
    assert len(scales(live)) == 1
    live.wait(1000 + 60_000)
    assert scales(live) == [("APPLICATION_START", "4"), ("JOB_START", "None"), ("JOB_END", "6"), ("JOB_START", "7"),
                            ("JOB_END", "8"), ("APPLICATION_END", "1")]
    assert live.gone()


@pytest.mark.parametrize("answered_at, scale", [(50_000, "5"), (61_000, "5"), (61_001, "None")])
def test_a_timer_before_at_and_after_an_answer(answered_at, scale):
    """An answer that is read before the message's timer goes off counts, one in the same moment too, a later one not."""
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(pd.DataFrame(SHORT[:2] + ANSWERS[:1]))
    found = pd.DataFrame([answer("JOB_START", 25_000, 5, 0)])
    if answered_at <= 61_000:
        live.wait(min(answered_at, 60_999))
        live.now = answered_at
        live.give(found)
        live.wait(answered_at)
    else:
        live.wait(answered_at)
        live.give(found)
    assert scales(live) == [("APPLICATION_START", "4"), ("JOB_START", scale)]


def test_each_message_has_a_timer():
    """Messages read later are given up later; nobody waits for a message that has its answer."""
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(pd.DataFrame(SHORT[:2] + ANSWERS[:1]))
    live.wait(31_000)
    live.give(pd.DataFrame(SHORT[2:4] + ANSWERS[1:2]))
    live.wait(61_000)
    assert scales(live)[1:] == [("JOB_START", "None"), ("JOB_END", "6")]
    live.wait(91_000)
    assert scales(live)[3:] == [("JOB_START", "None")]


def test_a_late_answer_sets_free_at_once():
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(pd.DataFrame([*SHORT[:2], ANSWERS[0], answer("JOB_START", 50_001, 9, 0)]))
    assert scales(live) == [("APPLICATION_START", "4"), ("JOB_START", "None")]


def test_answers_in_any_order():
    """Late, repeated, missing and early answers, and messages out of order; they come out in order, then all state is gone."""
    answers = [*ANSWERS[:2], answer("JOB_START", 25_000, 5, 0), answer("JOB_START", 95_000, 7, 1), ANSWERS[4]]
    want = [("APPLICATION_START", "4"), ("JOB_START", "5"), ("JOB_END", "6"), ("JOB_START", "None"), ("JOB_END", "None"),
            ("APPLICATION_END", "1")]
    rng = random.Random(1)
    for _ in range(60):
        rows = SHORT + answers
        rng.shuffle(rows)
        again = next(i for i, r in enumerate(rows) if r["recommended_scale_out"] == 6)
        rows.insert(rng.randint(again + 1, len(rows)), answer("JOB_END", 45_000, 9, 0))
        rows = pd.DataFrame(rows)
        for borders in ([], list(range(1, len(rows))), sorted(rng.sample(range(1, len(rows)), 4))):
            live = Run(AnswerMatcher(30_000, 60_000))
            for a, b in zip([0, *borders], [*borders, len(rows)]):
                live.give(rows.iloc[a:b])
            live.wait(10**6)
            assert scales(live) == want and live.gone()


def test_an_old_application_is_not_late():
    """Nothing but its own rows decides on a message."""
    rows = pd.DataFrame([sent(0, "APPLICATION_START", -10**12), answer("APPLICATION_START", -10**12 + 5, 3)])
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(rows.iloc[:1])
    live.give(rows.iloc[1:])
    assert scales(live) == [("APPLICATION_START", "3")]


def test_messages_after_the_end_are_counted():
    live = Run(AnswerMatcher(30_000, 60_000))
    live.give(pd.DataFrame([SHORT[0], SHORT[5] | {"message_no": 1}, ANSWERS[0], ANSWERS[4]]))
    assert live.gone()
    live.give(pd.DataFrame([answer("APPLICATION_END", 182_000, 5)]))
    assert live.gone() and live.handle.states["over"].value == (1,)


def candidates():
    times = [0, 10, 20, 34, 49, 55, 70, 80]
    kinds = ["APPLICATION_START", *["JOB_END"] * 6, "APPLICATION_END"]
    return pd.DataFrame([
        {"app_id": "app", "message_no": i, "event_type": k, "job_id": i, "t_ms": t * 1000, "seq": 5 * i,
         "effective_scale_out": 2, "candidate": k == "JOB_END" and t != 55} for i, (t, k) in enumerate(zip(times, kinds))])


DECIDED = ["suppressed"] * 3 + ["requested"] * 2


def test_decisions_on_any_border():
    rows = candidates()
    for borders in [[], *borders_of(len(rows))]:
        got, gone = run(DecisionClock(15_000, 30_000), rows, borders)
        assert [r[-1] for r in got] == DECIDED and gone


def test_decisions_in_any_order():
    """Whatever order files are read in, decisions are those of the messages' own order."""
    rng = random.Random(3)
    for _ in range(60):
        rows = candidates().sample(frac=1, random_state=rng.randint(0, 10**6))
        live = Run(DecisionClock(15_000, 30_000))
        for a, b in zip([0, 3, 6], [3, 6, 8]):
            live.give(rows.iloc[a:b])
        assert [r[-1] for r in live.rows()] == DECIDED and live.gone()


def test_a_gap_is_passed_over_by_a_timer():
    rows = candidates()
    live = Run(DecisionClock(15_000, 30_000))
    live.give(rows.drop(index=2))
    assert len(live.rows()) == 1
    live.wait(1000 + 30_000)
    assert [(r[3], r[-1]) for r in live.rows()] == [
        ("10000", "suppressed"), ("34000", "requested"), ("49000", "requested"), ("70000", "requested")]
    live.give(rows.iloc[2:3])
    assert live.rows()[-1][-1] == "late" and live.gone()


def test_messages_are_written_once(spark, tmp_path):
    """A batch that is retried, and one that is read again under another number, add nothing."""
    path = str(tmp_path / "messages")

    def lines(*keys):
        return spark.createDataFrame([(a, k, j, p, f"{a}{k}{j}{p}") for a, k, j, p in keys],
                                     "app_event_id string, event_type string, job_id int, part int, value string")

    first = lines(("a", "JOB_START", 0, None), ("a", "JOB_END", 0, 0), ("a", "JOB_END", 0, 1), ("a", "JOB_START", 0, None))
    second = lines(("a", "JOB_END", 0, 1), ("b", "APPLICATION_END", None, None))
    message_sink.write_once(lines(), path, "x", 9)
    # Messages without a note of their keys, as a run leaves them that was lost between the two.
    first.filter("part = 1").select("event_type", "value").write.partitionBy("event_type").text(f"{path}/batch=x-0")
    for rows, batch in ((first, 0), (first, 0), (second, 1), (second, 1), (first, 2), (second, 0), (first, 1)):
        message_sink.write_once(rows, path, "x", batch)
    got = sorted(r.value for r in message_sink.read_sent(spark, path).collect())
    assert got == ["aJOB_END00", "aJOB_END01", "aJOB_START0None", "bAPPLICATION_ENDNoneNone"]


def test_answer_lines(spark):
    """Each line is an answer or rejected, never both, never neither."""
    lines = [
        '{"app_event_id":"a","event_type":"JOB_END","job_id":1,"recommended_scale_out":3,"answered_ms":5}',
        '{"app_event_id":"a","event_type":"JOB_END","job_id":1,"recommended_scale_out":"x"}', "timeout", "", "[1]", "null",
        '{"app_event_id":"a","recommended_scale_out":3}', '{"event_type":"JOB_END","recommended_scale_out":3}',
    ]
    frame = spark.createDataFrame([(x,) for x in [*lines, None]], "value string")
    answers = recommendations.scan_answers(frame).collect()
    assert [tuple(r) for r in answers] == [("a", "JOB_END", 1, 5, 3)]
    rejects = {r.value: r.reason for r in recommendations.rejected_answers(frame).collect()}
    assert rejects == dict.fromkeys(["timeout", "", None], "not json") | {
        lines[1]: "missing field", "[1]": "missing field", "null": "missing field", lines[6]: "no message", lines[7]: "missing field"}
    with_names = recommendations.scan_answers(frame, spark.createDataFrame([("a", 7)], "app_event_id string, app_id int"))
    assert [r.app_id for r in with_names.select(F.col("app_id")).collect()] == [7]


def test_a_large_log_is_parsed_by_many_tasks(spark, tmp_path):
    """One log of many splits in one batch: several tasks write it, and its events keep their order. Segments are archived."""
    n = 3000
    lines = [{"Event": "SparkListenerApplicationStart", "App ID": "a", "App Name": "x", "Timestamp": 1}]
    for i in range(n):
        lines.append({"Event": "SparkListenerExecutorAdded", "Timestamp": 2 + i, "Executor ID": str(i), "Executor Info": {"Host": "h"}})
        lines.append({"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Stage Attempt ID": 0})
    for job in range(2):
        lines.append({"Event": "SparkListenerJobStart", "Job ID": job, "Submission Time": n + 5 + job, "Stage Infos": []})
    lines.append({"Event": "SparkListenerApplicationEnd", "Timestamp": n + 9})
    for at, part in enumerate((lines[:4000], lines[4000:])):
        folder = tmp_path / "logs" / "log=a" / f"roll={at}"
        folder.mkdir(parents=True)
        (folder / "part").write_text("".join(json.dumps(x) + "\n" for x in part))
    at = {name: str(tmp_path / name) for name in ("logs", "parsed", "tracked", "c1", "c2", "done")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        tables.run_available(spark, tables.stream_events(spark, at["logs"], at["parsed"], at["c1"], archive=at["done"]))
        parsed = spark.read.parquet(at["parsed"])
        files = parsed.filter("not is_task").select(F.input_file_name().alias("f")).distinct().count()
        assert files > 5 and parsed.select("batch").distinct().count() == 1
        events = tables.app_events(tables.parsed_stream(spark, at["parsed"]), F.lit(3))
        tables.run_available(spark, tables.to_files(tables.stream_app_state(events), at["tracked"], at["c2"]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = spark.read.parquet(at["tracked"]).orderBy("seq").collect()
    assert [r.t_ms for r in rows] == [1, *range(2, 2 + n), n + 5, n + 6, n + 9]
    assert rows[-2].num_executors == n and rows[n // 2].num_executors == n // 2


def test_what_comes_and_goes_in_a_batch_never_reaches_the_state(tracked):
    """An application that is new in a batch reads no map, and writes only what is left behind the batch."""
    answered = pd.DataFrame(SHORT + [*ANSWERS[:2], answer("JOB_START", 25_000, 5, 0), *ANSWERS[2:]])
    left = {"stage_jobs": 1, "jobs": 1, "listed": 1, "queue": 1, "submits": 1, "times": 1}
    for processor, rows, want in ((JobEndCollector(), tracked, left), (StagePairer(), tracked, {"submitted": 1}),
                                  (AnswerMatcher(30_000, 60_000), answered, {}), (DecisionClock(15_000, 30_000), candidates(), {})):
        live, Held.calls = Run(processor), 0
        live.give(rows)
        assert live.out and Held.calls == sum(want.values())
        assert {name: len(state.map) for name, state in live.handle.states.items() if state.map} == want


def test_spark_rows_and_frames_give_the_same(tracked):
    """The processors as Spark calls them, row by row, against frames, on any border."""
    plain = [tuple(r) for r in tracked[JobEndCollector.IN].astype(object).where(tracked[JobEndCollector.IN].notna(), None).values]
    names, clock = Row(*JobEndCollector.IN), Clock()
    want, _ = run(JobEndCollector(), tracked, [])
    for borders in borders_of(len(plain)):
        processor, got = PerRow(JobEndCollector()), []
        processor.init(Handle())
        for a, b in zip([0, *borders], [*borders, len(plain)]):
            if a < b:
                got += processor.handleInputRows(("app",), (names(*r) for r in plain[a:b]), clock)
        assert [tuple(map(str, r)) for r in got] == want and list(got[0].__fields__) == JobEndCollector.OUT
