from __future__ import annotations

from pyspark.sql import functions as F

from telescale.operators import decisions, messages, specs
from telescale.settings import REQUIRED_KEYS
from telescale.sources import message_sink, recommendations
from telescale.session import shared_dir

MESSAGE = (
    "app_id string, event_type string, job_id int, t_ms long, seq long, num_executors int, last_known int"
)
# Settings an application is tested with.
CONFIG = {
    "spark.app.name": "Test Application", "spark.customExtraListener.datasizeMb": "1024",
    "spark.customExtraListener.targetRuntime": "30000", "spark.customExtraListener.minExecutors": "2",
    "spark.customExtraListener.maxExecutors": "10", "spark.driver.cores": "4", "spark.driver.memory": "8G",
    "spark.driver.memoryOverhead": "2G", "spark.executor.cores": "4", "spark.executor.memory": "16G",
    "spark.executor.memoryOverhead": "3G", "spark.customExtraListener.env.hadoopVersion": "3.2.0",
    "spark.customExtraListener.env.sparkVersion": "3.1.1", "spark.customExtraListener.env.scalaVersion": "2.12.10",
    "spark.customExtraListener.env.javaVersion": "1.8.0_181",
}


def test_answers_and_fallbacks(spark):
    rows = [
        ("a", "APPLICATION_START", None, 0, 0, None, None), ("a", "JOB_START", 0, 1, 1, 4, 4),
        ("a", "JOB_END", 0, 2, 2, 3, 3), ("a", "APPLICATION_END", None, 9, 9, 3, 3),
        ("b", "APPLICATION_START", None, 0, 0, None, None),
    ]
    sent = spark.createDataFrame(rows, MESSAGE)
    answers = spark.createDataFrame(
        [("a", "APPLICATION_START", None, 4, 1), ("a", "JOB_END", 0, 2, 9), ("a", "JOB_END", 0, 6, 3)],
        "app_id string, event_type string, job_id int, recommended_scale_out int, answered_ms long",
    )
    got = decisions.effective_recommendation(decisions.response_match(sent, answers, "answered_ms"))
    assert {(r.app_id, r.event_type): (r.effective_scale_out, r.status) for r in got.collect()} == {
        ("a", "APPLICATION_START"): (4, "answered"), ("a", "JOB_START"): (4, "timeout"),
        ("a", "JOB_END"): (6, "answered"), ("a", "APPLICATION_END"): (3, "timeout"),
        ("b", "APPLICATION_START"): (None, "failed"),
    }
    assert [(r.app_id, r.decision) for r in decisions.initial_scale_requests(got).collect()] == [("a", "initial")]
    assert [r.event_type for r in decisions.scale_change_candidates(got).collect()] == ["JOB_END"]


def test_suppressed_requests_restart_the_clock(spark, hot):
    times = [10, 20, 34, 49, 70]
    rows = [("a", "JOB_END", i, t * 1000, i, 1, 1, 2) for i, t in enumerate(times)]
    candidates = spark.createDataFrame(rows, MESSAGE + ", effective_scale_out int")
    starts = spark.createDataFrame([("a", 0)], "app_id string, app_start_ms long")
    got = decisions.scale_decisions(candidates, starts, hot=hot).orderBy("seq").collect()
    assert [r.decision for r in got] == ["suppressed"] * 3 + ["requested"] * 2
    steady = [("a", "JOB_END", i, (i + 1) * 14000, i, 1, 1, 2) for i in range(9)]
    frame = spark.createDataFrame(steady, MESSAGE + ", effective_scale_out int")
    assert {r.decision for r in decisions.scale_decisions(frame, starts, hot=hot).collect()} == {"suppressed"}


def config(spark, settings, app="app-1"):
    return spark.createDataFrame([(app, k, v) for k, v in settings.items()], "app_id string, key string, value string")


def test_app_start_record(spark):
    apps = spark.createDataFrame([("app-1", 5, "h")], "app_id string, app_time long, host string")
    facts = spark.createDataFrame([("h", "OS X", 4, 2**30)], "host string, os string, cores int, memory_bytes long")
    disks = spark.createDataFrame([("h", 2**30), ("h", 2**29)], "host string, disk_bytes long")
    settings = specs.app_config_lookup(config(spark, CONFIG))
    r = messages.app_start_records(apps, settings, specs.machine_types(facts, disks)).first()
    assert (r.application_id, r.app_name, r.is_adaptive, r.is_training) == ("app-1", "Test Application", True, False)
    assert tuple(r.app_specs) == ("Test Application", [], 1024, 30000, 2, 10)
    assert tuple(r.driver_specs) == (4, "8G", "2G") and tuple(r.executor_specs) == (4, "16G", "3G")
    assert tuple(r.environment_specs) == (
        "os:OSX-cores:4-memory:1024.0-disk_size:1.5", "3.2.0", "3.1.1", "2.12.10", "1.8.0_181"
    )
    assert messages.app_start_records(apps, settings).first().environment_specs.machine_type is None


def test_settings_are_sorted_by_shares_of_the_applications(spark):
    """No step before the shuffle sorts what a task has read, and no share is put together with others."""
    settings = specs.app_config_lookup(config(spark, CONFIG).unionByName(config(spark, {"other": "x"}, "app-2")))
    assert {r.app_id: len(r.settings) for r in settings.collect()} == {"app-1": len(CONFIG), "app-2": 0}
    assert settings.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = settings._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Aggregate" not in plan[plan.index("Exchange"):]


def test_missing_and_unreadable_settings(spark):
    rows = config(spark, CONFIG).unionByName(config(spark, {"other": "x"}, "app-2"))
    apps = spark.createDataFrame([("app-1",), ("app-2",), ("app-3",)], "app_id string")
    missing = specs.missing_required_config(apps, rows).collect()
    assert {r.key for r in missing if r.app_id == "app-3"} == set(REQUIRED_KEYS)
    assert {r.key for r in missing if r.app_id == "app-1"} == set(REQUIRED_KEYS) - set(CONFIG)
    assert {r.key for r in missing if r.app_id == "app-2"} == set(REQUIRED_KEYS)
    bad = {"spark.driver.cores": "four", "spark.customExtraListener.isAdaptive": "yes", "spark.executor.cores": "2"}
    assert {r.key for r in specs.unreadable_settings(config(spark, bad)).collect()} == set(list(bad)[:2])


def test_responses_from_text(spark):
    lines = [
        '{"app_event_id":"test-app","recommended_scale_out":5}', "oops", "{}", '{"app_event_id":"x"}',
        '{"app_event_id":"y","recommended_scale_out":"5a"}', '{"app_event_id":"z","recommended_scale_out":7,"more":1}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = recommendations.scan_recommendations(df).collect()
    assert sorted(tuple(r) for r in good) == [("test-app", 5), ("z", 7)]
    bad = {r.value: r.reason for r in recommendations.invalid_responses(df).collect()}
    assert bad == {lines[1]: "not json", **{x: "missing field" for x in lines[2:5]}}


def test_messages_round_trip(spark):
    rows = spark.createDataFrame([("e1", 3, 5, 2)], "app_id string, job_id int, app_time long, num_executors int")
    lines = messages.message_lines(rows.select("app_id", "app_time", "job_id", "num_executors"), "JOB_START", F.col("app_id"))
    path = shared_dir(spark, "round-trip")
    message_sink.write_messages(lines, path)
    got = message_sink.read_messages(spark, path).collect()
    assert [tuple(r) for r in got] == [(
        "JOB_START",
        '{"event_type":"JOB_START","payload":{"app_event_id":"e1","app_time":5,"job_id":3,"num_executors":2}}',
    )]
    typed = spark.createDataFrame([("JOB_END",), ("OTHER",), (None,)], "event_type string")
    assert messages.event_type_filter(typed).count() == 1
    assert [r.event_type for r in messages.illegal_event_types(typed).collect()] == ["OTHER"]
