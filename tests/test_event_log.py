"""Tables from the log of a real application, checked against a reading of the file line by line."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys

import pytest

from telescale.operators.stages import COUNTERS
from telescale.plans import bindings as b
from telescale.plans.fleet import fleet_tables, has_hot_logs
from telescale.session import shared_dir
from telescale.sources import event_log
from tests.conftest import SF
from tests.test_rescaling import literal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = str(tmp_path_factory.mktemp("log"))
    env = {**os.environ, "PYTHONPATH": ROOT}
    subprocess.run([sys.executable, f"{ROOT}/tests/write_log.py", out, "plain"], check=True, timeout=200, env=env)
    return out


@pytest.fixture(scope="module")
def events(folder):
    (path,) = glob.glob(f"{folder}/local-*")
    return [json.loads(line) for line in open(path)]


@pytest.fixture(params=["one split", "many splits"])
def parsed(request, spark, folder):
    if request.param == "many splits":
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield event_log.parse_lines(event_log.read_lines(spark, folder))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def of(events, name):
    return [e for e in events if e["Event"] == "SparkListener" + name]


def test_lines_keep_their_order_and_application(parsed, events):
    splits = event_log.log_splits(parsed)
    rows = event_log.with_app(parsed.drop("log_id", "e"), splits).orderBy("seq").collect()
    known = [e["Event"][len("SparkListener"):] for e in events]
    assert [r.event for r in rows] == [e for e in known if e in event_log.EVENTS]
    assert {r.app_id for r in rows} == {of(events, "ApplicationStart")[0]["App ID"]}
    assert len({r.seq for r in rows}) == len(rows)


def test_typed_tables(parsed, events):
    jobs = event_log.scan_job_events(parsed).orderBy("seq").collect()
    starts = [j for j in jobs if j.kind == "job_start"]
    want = of(events, "JobStart")
    assert [(j.job_id, j.t_ms, j.stage_ids) for j in starts] == [
        (e["Job ID"], e["Submission Time"], [s["Stage ID"] for s in e["Stage Infos"]]) for e in want
    ]
    results = [j.result for j in jobs if j.kind == "job_end"]
    assert results == [e["Job Result"]["Result"] for e in of(events, "JobEnd")] and "JobFailed" in results
    done = event_log.scan_stage_events(parsed).filter("kind = 'stage_complete'").orderBy("seq").collect()
    infos = [e["Stage Info"] for e in of(events, "StageCompleted")]
    assert [(s.stage_id, s.attempt_id, s.submit_ms, s.complete_ms, s.failure_reason, s.rdd_num_partitions)
            for s in done] == [
        (i["Stage ID"], i["Stage Attempt ID"], i["Submission Time"], i["Completion Time"], i.get("Failure Reason"),
         sum(r["Number of Partitions"] for r in i["RDD Info"])) for i in infos
    ]
    apps = event_log.scan_app_events(parsed).orderBy("seq").collect()
    assert [a.t_ms for a in apps] == [of(events, n)[0]["Timestamp"] for n in ("ApplicationStart", "ApplicationEnd")]
    config = {r.key: r.value for r in event_log.scan_app_config(parsed).collect()}
    assert config == of(events, "EnvironmentUpdate")[0]["Spark Properties"]
    versions = event_log.scan_versions(parsed).first()
    assert versions.spark_version == of(events, "LogStart")[0]["Spark Version"] and versions.java_version


def test_task_sums_equal_the_totals_of_completed_stages(parsed, events):
    tasks = {(r.stage_id, r.attempt_id): r for r in event_log.task_totals(parsed).collect()}
    stages = {(r.stage_id, r.attempt_id): r for r in event_log.scan_stage_accumulables(parsed).collect()}
    failed = {
        (e["Stage Info"]["Stage ID"], e["Stage Info"]["Stage Attempt ID"])
        for e in of(events, "StageCompleted") if "Failure Reason" in e["Stage Info"]
    }
    assert set(tasks) == set(stages) and failed
    for key in set(tasks) - failed:  # tasks of a failed stage may end after it
        assert [tasks[key][c] for c in COUNTERS] == [stages[key][c] for c in COUNTERS]
    assert event_log.scan_task_metrics(parsed).count() == len(of(events, "TaskEnd"))


def test_fleet_tables(spark, parsed, events, hot, request):
    if hot and "many splits" in request.node.name:
        pytest.skip("blocks and splits do not meet")
    app = of(events, "ApplicationStart")[0]
    initial = spark.createDataFrame([(app["App ID"], 4)], "app_id string, initial int")
    # Written once, as a fleet would be.
    path = shared_dir(spark, "parsed")
    event_log.write_parsed(parsed, path)
    assert has_hot_logs(event_log.read_parsed(spark, path)) is hot
    tables = fleet_tables(event_log.read_parsed(spark, path), initial, hot)
    starts = tables["job_start"].orderBy("job_id").collect()
    assert [r.num_executors for r in starts] == [4] + [0] * (len(starts) - 1)  # only the driver's own executor
    rows = tables["job_end_rows"].collect()
    points = [e["Timestamp"] for e in events if e["Event"].startswith("SparkListenerExecutor")
              and e["Event"][21:] in ("Added", "Removed")]
    ends = {e["Job ID"]: e["Completion Time"] for e in of(events, "JobEnd")}
    assert {r.job_id for r in rows} == set(ends)
    for r in rows:
        assert r.rescaling_time_ratio == literal(points, app["Timestamp"], ends[r.job_id])
        assert r.stage_rescaling_time_ratio == literal(points, r.start_time, r.end_time)
        assert 0 <= r.cpu_utilization and r.num_executors == 0
    assert len(rows) == len(of(events, "StageCompleted"))
    if hot:  # the remaining tables take the same paths
        return
    messages = {r.job_id: set(r.stages) for r in tables["job_end"].collect()}
    assert messages == {j: {r.stage_id for r in rows if r.job_id == j} for j in ends}
    start = tables["app_start"].first()
    assert tuple(start.app_specs)[:3] == ("Sort", ["1", "2"], 10)
    assert tables["app_end"].first().app_time == of(events, "ApplicationEnd")[0]["Timestamp"]
    for name in ("orphan_stages", "incomplete_stage_events", "stage_count_mismatch", "jobs_without_stages"):
        assert tables[name].count() == 0, name
    assert {r.scale_out for r in tables["scale_out"].collect()} == {0}
    assert tables["missing_required_config"].count() > 0


@pytest.mark.parametrize("layout", ["rolled", "packed"])
def test_other_layouts(spark, tmp_path, layout):
    env = {**os.environ, "PYTHONPATH": ROOT}
    subprocess.run(
        [sys.executable, f"{ROOT}/tests/write_log.py", str(tmp_path), layout], check=True, timeout=200, env=env
    )
    parsed = event_log.parse_lines(event_log.read_lines(spark, str(tmp_path)))
    jobs = event_log.scan_job_events(parsed).collect()
    assert {j.app_id[:6] for j in jobs} == {"local-"}
    assert sum(j.kind == "job_start" for j in jobs) == sum(j.kind == "job_end" for j in jobs) > 1


def test_rolled_files_and_other_spellings(spark, tmp_path):
    """Rolls are ordered by number, not by name, and the event name may stand anywhere in its line."""
    log = tmp_path / "eventlog_v2_app-1"
    log.mkdir()
    start = {"App ID": "app-1", "App Name": "n", "Timestamp": 1, "Event": "SparkListenerApplicationStart"}
    for roll in range(1, 12):
        lines = [start] if roll == 1 else [
            {"Event": "SparkListenerJobStart", "Job ID": roll, "Submission Time": roll, "Stage Infos": []},
            {"Event": "SparkListenerOther"}, {"Event": "org.example.Unknown"},
        ]
        (log / f"events_{roll}_app-1").write_text("".join(json.dumps(x) + "\n" for x in lines) + "not json\n")
    parsed = event_log.parse_lines(event_log.read_lines(spark, str(tmp_path)))
    jobs = event_log.scan_job_events(parsed).orderBy("seq").collect()
    assert [(j.app_id, j.job_id) for j in jobs] == [("app-1", i) for i in range(2, 12)]
    assert event_log.scan_app_events(parsed).count() == 1


def test_shipped_lines_are_those_of_the_logs(spark, tmp_path):
    """Lines of many logs in one file, their paths before them, give what a file for each log gives."""
    logs = {
        "log=a/roll=0": ['{"Event":"SparkListenerApplicationStart","App Name":"x\\ty","App ID":"a","Timestamp":1}',
                         '{"Event":"SparkListenerJobStart","Job ID":0,"Submission Time":2}'],
        "log=a/roll=1": ['{"Event":"SparkListenerApplicationEnd","Timestamp":9}'],
        "log=b/roll=0": ['{"Event":"SparkListenerApplicationStart","App Name":"b","App ID":"b","Timestamp":3}',
                         '{"Event":"SparkListenerApplicationEnd","Timestamp":4}'],
    }
    for path, lines in logs.items():
        (tmp_path / "own" / path).mkdir(parents=True)
        (tmp_path / "own" / path / "part.txt").write_text("\n".join(lines))
    (tmp_path / "shipped").mkdir()
    (tmp_path / "shipped" / "part.txt").write_text("\n".join(f"/{p}\t{x}" for p, lines in logs.items() for x in lines))

    def rows(layout):
        parsed = event_log.parse_lines(event_log.read_lines(spark, str(tmp_path / layout)))
        named = event_log.with_app(parsed, event_log.log_splits(parsed))
        return sorted(tuple(r) for r in named.select("app_id", "seq", "event", "e.App Name", "e.Timestamp").collect())

    assert rows("own") == rows("shipped")
    assert [r[:3] for r in rows("shipped")][:3] == [
        ("a", 0, "ApplicationStart"), ("a", 1, "JobStart"), ("a", 2, "ApplicationEnd")]


def test_logs_are_written_into_few_files(spark, tmp_path):
    ev = b.events(spark, SF)
    b.write_log(ev, str(tmp_path / "logs"), hot=False)
    parsed = event_log.parse_lines(event_log.read_lines(spark, str(tmp_path / "logs")))
    n_logs = parsed.select("log_id").distinct().count()
    assert n_logs == ev.select("app_id").distinct().count()
    assert len(list((tmp_path / "logs").rglob("part-*.txt"))) <= 8 < n_logs
