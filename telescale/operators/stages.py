"""Stages of a job: which job they belong to, their metrics, and the full feature record.

Stage events are rows of kind ``stage_submit`` or ``stage_complete``; ``hot`` as in ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.functions.expr import failure_reason, safe_ratio, stage_key
from telescale.operators.ordered import blocked, scan
from telescale.operators.scaleout import COMPLETE, SEQ, SUBMIT

COUNTERS = (
    "cpu_ns", "run_ms", "gc_ms", "shuffle_read", "shuffle_write",
    "input_bytes", "output_bytes", "disk_spill", "peak_mem",
)
RATIOS = (
    "cpu_utilization", "gc_time_ratio", "shuffle_read_write_ratio", "input_output_ratio",
    "memory_spill_ratio",
)
RDD_TOTALS = {
    "rdd_num_partitions": "num_partitions", "rdd_num_cached_partitions": "num_cached_partitions",
    "rdd_mem_size": "mem_size", "rdd_disk_size": "disk_size",
}


def stage_job_mapping(
    listings: DataFrame, stage_events: DataFrame, order: Sequence[str] = SEQ, hot: bool = True
) -> DataFrame:
    """Give each stage event the job that listed its stage last before it; null if none did.

    ``listings`` holds one row per job start and stage: app_id, stage_id, job_id and the order
    columns. A listing at the position of a stage event comes first.
    """
    keys, places = ["app_id", "stage_id"], [*order, "_late"]
    listed = listings.select(
        *keys, *order, F.lit(0).alias("_late"), F.col("job_id").alias("_job"),
        F.lit(None).cast(_row_type(stage_events)).alias("_row"),
    )
    looked_up = stage_events.select(
        *keys, *order, F.lit(1).alias("_late"), F.lit(None).cast("int").alias("_job"),
        F.struct(*stage_events.columns).alias("_row"),
    )
    rows = blocked(listed.unionByName(looked_up), keys, order[0], hot)
    known = scan(rows, keys, places, last={"job_id": F.col("_job")})
    return known.filter("_late = 1").select("_row.*", "job_id")


def _row_type(df: DataFrame) -> str:
    return df.schema.simpleString()


def orphan_stages(mapped: DataFrame) -> DataFrame:
    """Stage events that no job had listed."""
    return mapped.filter(F.col("job_id").isNull() | (F.col("job_id") < 0))


def incomplete_stage_events(stage_events: DataFrame) -> DataFrame:
    """Submits without a submission time and completions without a completion time."""
    return stage_events.filter(_no_time())


def timed_stage_events(stage_events: DataFrame) -> DataFrame:
    """All others; only these take part in counts and pairs."""
    return stage_events.filter(~_no_time())


def _no_time() -> Column:
    return F.when(F.col("kind") == SUBMIT, F.col("submit_ms").isNull()).otherwise(F.col("complete_ms").isNull())


def stage_order_in_job(
    stages: DataFrame, keys: Sequence[str] = ("app_id", "job_id"), order: Sequence[str] = ("stage_id", "seq"),
    hot: bool = True,
) -> DataFrame:
    """Position of each stage in its job by stage id, arrival order among equal ids.

    For hot jobs the position is the number of rows with a lower id, from counts per id, and the rank
    among the rows of the same id. Both passes then run over unique values, which blocks can split.
    """
    keys, (stage, arrival) = list(keys), order
    rank = F.col("_rn").cast("int")
    if not hot:
        placed = scan(stages, keys, order, total={"_rn": F.lit(1)})
        return placed.withColumn("position", rank).drop("_rn")
    per_id = stages.groupBy(*keys, stage).agg(F.count(F.lit(1)).alias("_n"))
    lower = scan(blocked(per_id, keys, stage), keys, [stage], total={"_upto": F.col("_n")}).select(
        *keys, stage, (F.col("_upto") - F.col("_n")).alias("_lower")
    )
    same = [*keys, stage]
    ranked = scan(blocked(stages, same, arrival), same, [arrival], total={"_rn": F.lit(1)})
    return (
        ranked.join(lower, same)
        .select(*stages.columns, (F.col("_lower") + F.col("_rn")).cast("int").alias("position"))
    )


def stage_pairing(stage_events: DataFrame, order: Sequence[str] = ("stage_id", "seq"), hot: bool = True) -> DataFrame:
    """n-th submit with n-th completion of a job: one row per pair with structs ``submit``, ``complete``.

    Both sides are numbered in one pass and meet in one grouping of at most two rows.
    """
    placed = stage_order_in_job(stage_events, ("app_id", "job_id", "kind"), order, hot)
    row = F.struct(*stage_events.columns)
    return (
        placed.groupBy("app_id", "job_id", "position")
        .agg(
            F.first(F.when(F.col("kind") == SUBMIT, row), ignorenulls=True).alias("submit"),
            F.first(F.when(F.col("kind") == COMPLETE, row), ignorenulls=True).alias("complete"),
        )
        .filter(F.col("submit").isNotNull() & F.col("complete").isNotNull())
    )


def stage_count_mismatch(stage_events: DataFrame) -> DataFrame:
    """Jobs whose submits and completions differ in number."""
    return stage_counts(stage_events).filter("submits <> completes")


def stage_counts(stage_events: DataFrame) -> DataFrame:
    return stage_events.groupBy("app_id", "job_id").agg(
        F.count_if(F.col("kind") == SUBMIT).alias("submits"),
        F.count_if(F.col("kind") == COMPLETE).alias("completes"),
    )


def jobs_without_stages(jobs: DataFrame, stages: DataFrame, keys: Sequence[str] = ("app_id", "job_id")) -> DataFrame:
    """Jobs for which no stage was submitted."""
    return jobs.join(stages.select(*keys).distinct(), list(keys), "left_anti")


def stage_task_totals(tasks: DataFrame, keys: Sequence[str] = ("app_id", "stage_id", "attempt_id")) -> DataFrame:
    """Counters of a stage attempt summed over its tasks, combined before the shuffle."""
    return tasks.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTERS])


def metric_ratios() -> list[Column]:
    """The five ratios of summed counters. CPU time is in ns, run time in ms."""
    run = F.col("run_ms").cast("double")
    pairs = [
        (F.col("cpu_ns"), run * F.lit(1000000.0)),
        (F.col("gc_ms"), run),
        (F.col("shuffle_read"), F.col("shuffle_write")),
        (F.col("input_bytes"), F.col("output_bytes")),
        (F.col("disk_spill"), F.col("peak_mem")),
    ]
    return [safe_ratio(a, b).alias(name) for name, (a, b) in zip(RATIOS, pairs)]


def stage_metric_ratios(totals: DataFrame) -> DataFrame:
    keys = [c for c in totals.columns if c not in COUNTERS]
    return totals.select(*keys, *metric_ratios())


def stage_rdd_totals(rdds: DataFrame, keys: Sequence[str] = ("app_id", "stage_id", "attempt_id")) -> DataFrame:
    """Sums over a stage's RDD rows; a stage with none has a row of nulls and gets zeros."""
    return rdds.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in RDD_TOTALS.items()]
    )


def rdd_array_totals(rdd_infos: Column) -> list[Column]:
    """The same sums over an array inside the stage's own row, without a shuffle."""
    def total(field: str) -> Column:
        zero = F.lit(0).cast("long")
        return F.coalesce(
            F.aggregate(rdd_infos, zero, lambda acc, r: acc + F.coalesce(r[field].cast("long"), zero)), zero
        )

    return [total(c).alias(name) for name, c in RDD_TOTALS.items()]


def latest_attempt_per_stage(pairs: DataFrame) -> DataFrame:
    """One row per stage of a job: the one with the highest position. Combined before the shuffle."""
    keys = ["app_id", "job_id", "stage_id"]
    last = F.max_by(F.struct(*pairs.columns), "position").alias("_last")
    return pairs.groupBy(*keys).agg(last).select("_last.*")


def complete_jobs(stage_events: DataFrame, ended_jobs: DataFrame) -> DataFrame:
    """Ended jobs with equally many submits and completions."""
    even = stage_counts(stage_events).filter("submits = completes").select("app_id", "job_id")
    return ended_jobs.join(even, ["app_id", "job_id"])


def stage_features(
    stage_events: DataFrame, metrics: DataFrame, order: Sequence[str] = ("stage_id", "seq"), hot: bool = True
) -> DataFrame:
    """Full record of every paired stage.

    ``stage_events`` carry the scale-out known to them (``last_known``), completions also their
    ``rescaling_time_ratio`` and RDD totals. ``metrics`` holds the five ratios per stage attempt;
    an attempt without tasks has zeros.
    """
    s, c = "submit", "complete"
    paired = stage_pairing(stage_events, order, hot).select(
        "app_id", "job_id", "position",
        F.col(f"{s}.stage_id").alias("stage_id"), F.col(f"{s}.stage_name").alias("stage_name"),
        F.col(f"{s}.num_tasks").alias("num_tasks"),
        F.col(f"{s}.parent_stage_ids").alias("parent_stage_ids"),
        F.col(f"{c}.stage_id").alias("_done_id"), F.col(f"{c}.attempt_id").alias("attempt_id"),
        failure_reason(F.col(f"{c}.failure_reason")).alias("failure_reason"),
        F.col(f"{s}.submit_ms").alias("start_time"), F.col(f"{c}.complete_ms").alias("end_time"),
        F.col(f"{s}.last_known").alias("start_scale_out"), F.col(f"{c}.last_known").alias("end_scale_out"),
        F.col(f"{c}.rescaling_time_ratio").alias("rescaling_time_ratio"),
        *[F.col(f"{c}.{name}").alias(name) for name in RDD_TOTALS],
    )
    ratios = metrics.select("app_id", F.col("stage_id").alias("_done_id"), "attempt_id", *RATIOS)
    full = latest_attempt_per_stage(paired).join(ratios, ["app_id", "_done_id", "attempt_id"], "left")
    zero = F.lit(0.0)
    return full.select(
        "app_id", "job_id", stage_key(F.col("stage_id")).alias("stage_id"), "stage_name", "num_tasks",
        "parent_stage_ids", "attempt_id", "failure_reason", "start_time", "end_time", "start_scale_out",
        "end_scale_out", "rescaling_time_ratio", *RDD_TOTALS,
        *[F.coalesce(F.col(r), zero).alias(r) for r in RATIOS],
    )
