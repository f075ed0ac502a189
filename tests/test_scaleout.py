from __future__ import annotations

from telescale.operators import scaleout

TIMELINE = "app_id string, seq long, kind string, t_ms long, job_id int, stage_id int, delta int, initial int"


def timeline(spark):
    rows = [
        ("a", 0, "executor", 0, None, None, 1, None),
        ("a", 1, "app_start", 10, None, None, None, 4),
        ("a", 2, "job_start", 20, 0, None, None, None),
        ("a", 3, "stage_submit", 21, None, 0, None, None),
        ("a", 4, "executor", 22, None, None, 1, None),
        ("a", 5, "stage_complete", 30, None, 0, None, None),
        ("a", 6, "job_end", 31, 0, None, None, None),
        ("a", 7, "executor", 32, None, None, 1, None),
        ("a", 8, "stage_submit", 33, None, 1, None, None),
        ("a", 9, "job_start", 34, 1, None, None, None),
        ("a", 10, "executor", 35, None, None, -1, None),
        ("a", 11, "app_end", 40, None, None, None, None),
        ("b", 0, "job_start", 20, 0, None, None, None),
    ]
    return spark.createDataFrame(rows, TIMELINE)


def test_last_known_follows_the_update_points(spark, hot):
    got = scaleout.track_scale_out(timeline(spark), hot=hot).collect()
    a = {r.seq: (r.num_executors, r.last_known, r.updates) for r in got if r.app_id == "a"}
    assert a[1][1:] == (4, True)
    assert a[2] == (4, 4, False)  # job 0 reports what was asked for and refreshes nothing
    assert a[3][1] == 4 and a[5][1] == 4
    assert a[6] == (2, 2, True)
    assert a[8][1] == 2 and a[9] == (3, 3, True)
    assert a[11] == (3, 3, False)  # the context is stopped, so the live count is not read
    assert [r.last_known for r in got if r.app_id == "b"] == [None]
    running = scaleout.track_scale_out(timeline(spark), context_stopped=False, hot=hot)
    assert running.filter("kind = 'app_end'").first().last_known == 2


def test_timeline_views(spark):
    tracked = scaleout.track_scale_out(timeline(spark), hot=False)
    assert [r.seq for r in scaleout.last_known_timeline(tracked).orderBy("seq").collect()] == [1, 6, 9]
    assert [r.last_known for r in scaleout.last_known_asof(tracked).orderBy("seq").collect()] == [4, 4, 2]


def test_hosts_of_removed_executors_and_the_driver(spark, hot):
    rows = [
        ("a", 0, "1", "h1", 1), ("a", 1, "2", "drv", 1), ("a", 2, "2", None, -1), ("a", 3, "1", None, -1),
    ]
    events = spark.createDataFrame(rows, "app_id string, seq long, executor_id string, host string, delta int")
    located = scaleout.with_executor_hosts(events, hot=hot)
    assert [r.host for r in located.orderBy("seq").collect()] == ["h1", "drv", "drv", "h1"]
    drivers = spark.createDataFrame([("a", "drv")], "app_id string, driver_host string")
    kept = scaleout.non_driver_executors(located.withColumnRenamed("host", "address"), drivers)
    counted = scaleout.alive_executor_count(kept, hot=hot).orderBy("seq").collect()
    assert [(r.seq, r.scale_out) for r in counted] == [(0, 1), (3, 0)]


def test_intervals(spark, hot):
    rows = [("a", 0, 5), ("a", 1, 5), ("a", 2, 9), ("b", 0, 7)]
    points = spark.createDataFrame(rows, "app_id string, seq long, t_ms long")
    got = scaleout.scale_out_intervals(points, hot=hot).orderBy("app_id", "seq").collect()
    assert [r.interval_ms for r in got] == [0, 4, 0, 0]
