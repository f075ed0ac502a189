from __future__ import annotations

from pyspark.sql import functions as F

from telescale.operators import stages
from telescale.operators.messages import job_end_records, job_end_rows

EVENTS = (
    "app_id string, job_id int, kind string, stage_id int, seq long, stage_name string, num_tasks int, "
    "parent_stage_ids array<int>, attempt_id int, failure_reason string, submit_ms long, complete_ms long, "
    "last_known int, rescaling_time_ratio double, rdd_num_partitions long, rdd_num_cached_partitions long, "
    "rdd_mem_size long, rdd_disk_size long"
)
SUBMIT, COMPLETE = "stage_submit", "stage_complete"


def event(job, kind, stage, seq, attempt=0, reason=None, known=1):
    done = kind == COMPLETE
    return (
        "a", job, kind, stage, seq, f"s{stage}", 10, [stage - 1], attempt, reason, seq * 10,
        seq * 10 if done else None, known, 0.5 if done else None, 1, 2, 3, 4,
    )


def test_mapping_takes_the_latest_listing(spark, hot):
    listings = spark.createDataFrame(
        [("a", 0, 1, 0), ("a", 0, 2, 0), ("a", 5, 2, 1)], "app_id string, seq long, stage_id int, job_id int"
    )
    events = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 5, 2), ("a", 6, 2), ("a", 7, 9), ("b", 8, 1)],
        "app_id string, seq long, stage_id int",
    )
    mapped = stages.stage_job_mapping(listings, events, hot=hot)
    assert [(r.seq, r.job_id) for r in mapped.orderBy("seq").collect()] == [
        (1, 0), (2, 0), (5, 1), (6, 1), (7, None), (8, None)
    ]
    assert sorted(r.seq for r in stages.orphan_stages(mapped).collect()) == [7, 8]


def test_pairs_by_position_and_the_last_attempt_wins(spark, hot):
    rows = [
        event(0, SUBMIT, 2, 1), event(0, SUBMIT, 1, 2), event(0, COMPLETE, 1, 3),
        event(0, COMPLETE, 2, 4, 0, "fetch failed"), event(0, SUBMIT, 2, 5, known=7), event(0, COMPLETE, 2, 6, 1),
        event(1, SUBMIT, 3, 7), event(1, SUBMIT, 4, 8), event(1, COMPLETE, 3, 9),
    ]
    df = spark.createDataFrame(rows, EVENTS)
    pairs = stages.stage_pairing(df, hot=hot).select(
        "job_id", "position", F.col("submit.seq").alias("s"), F.col("complete.seq").alias("c")
    )
    assert sorted(tuple(r) for r in pairs.collect()) == [(0, 1, 2, 3), (0, 2, 1, 4), (0, 3, 5, 6), (1, 1, 7, 9)]
    assert [(r.job_id, r.submits, r.completes) for r in stages.stage_count_mismatch(df).collect()] == [(1, 2, 1)]

    ended = spark.createDataFrame([("a", 0), ("a", 1)], "app_id string, job_id int")
    whole = stages.complete_jobs(df, ended)
    metrics = stages.stage_metric_ratios(stages.stage_task_totals(tasks(spark)))
    features = stages.stage_features(df.join(whole, ["app_id", "job_id"], "left_semi"), metrics, hot=hot)
    got = {r.stage_id: r for r in features.collect()}
    assert set(got) == {"1", "2"}
    assert (got["2"].attempt_id, got["2"].start_time, got["2"].end_time, got["2"].start_scale_out) == (1, 50, 60, 7)
    assert got["2"].failure_reason == "" and got["2"].parent_stage_ids == [1]
    assert got["1"].cpu_utilization == 0.75 and got["2"].cpu_utilization == 0.0

    jobs = spark.createDataFrame(
        [("a", 0, 99, 3, 0.25)],
        "app_id string, job_id int, app_time long, num_executors int, rescaling_time_ratio double",
    )
    rows = job_end_rows(jobs, features)
    one = job_end_records(rows, hot=hot).collect()
    assert len(one) == 1 and set(one[0].stages) == {"1", "2"} and (one[0].part, one[0].n_parts) == (0, 1)
    assert one[0].stages["1"].metrics.gc_time_ratio == 0.5
    parts = job_end_records(rows, stages_per_message=1, hot=hot).collect()
    assert sorted((sorted(p.stages), p.part, p.n_parts) for p in parts) == [(["1"], 0, 2), (["2"], 1, 2)]


def tasks(spark):
    row = ("a", 1, 0, 1_500_000, 1, 1, 4, 0, 0, 5, 3, 6)
    return spark.createDataFrame(
        [row, row],
        "app_id string, stage_id int, attempt_id int, cpu_ns long, run_ms long, gc_ms long, shuffle_read long, "
        "shuffle_write long, input_bytes long, output_bytes long, disk_spill long, peak_mem long",
    ).withColumn("run_ms", F.lit(2).cast("long"))


def test_metric_ratios(spark):
    got = stages.stage_metric_ratios(stages.stage_task_totals(tasks(spark))).first()
    assert got.cpu_utilization == 3_000_000 / 4_000_000
    assert (got.gc_time_ratio, got.shuffle_read_write_ratio, got.input_output_ratio) == (0.5, 1.0, 0.0)
    assert got.memory_spill_ratio == 0.5


def test_huge_run_times_do_not_overflow(spark):
    big = tasks(spark).withColumn("run_ms", F.lit(10**13).cast("long"))
    assert stages.stage_metric_ratios(stages.stage_task_totals(big)).first().cpu_utilization > 0


def test_rdd_totals(spark):
    info = "struct<num_partitions: long, num_cached_partitions: long, mem_size: long, disk_size: long>"
    df = spark.createDataFrame(
        [("a", 1, [(1, 2, 3, 4), (10, 20, 30, 40)]), ("a", 2, []), ("a", 3, None)],
        f"app_id string, stage_id int, infos array<{info}>",
    )
    arrays = df.select("stage_id", *stages.rdd_array_totals(F.col("infos"))).orderBy("stage_id").collect()
    rows = df.select("app_id", "stage_id", F.explode_outer("infos").alias("i")).select("app_id", "stage_id", "i.*")
    sums = stages.stage_rdd_totals(rows, ["stage_id"]).orderBy("stage_id").collect()
    assert [tuple(r) for r in arrays] == [tuple(r) for r in sums] == [(1, 11, 22, 33, 44), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_gaps(spark):
    events = spark.createDataFrame([event(0, SUBMIT, 1, 1), event(0, COMPLETE, 1, 2)], EVENTS)
    jobs = spark.createDataFrame([("a", 0), ("a", 1)], "app_id string, job_id int")
    assert [r.job_id for r in stages.jobs_without_stages(jobs, events).collect()] == [1]
    assert stages.incomplete_stage_events(events).count() == 0
    lost = events.withColumn("submit_ms", F.lit(None).cast("long")).withColumn("complete_ms", F.lit(None).cast("long"))
    assert stages.incomplete_stage_events(lost).count() == 2
