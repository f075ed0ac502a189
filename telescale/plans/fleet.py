"""All tables of a fleet from its event logs, in one place.

Only narrow control lines (starts, ends, executors) take part in ordered passes. Stage metrics come
from the totals a completed stage carries itself, so task lines, by far the most, are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telescale.operators import fused, messages, rescaling, scaleout, specs, stages
from telescale.operators.ordered import has_hot_keys
from telescale.sources import event_log as log

_ROW = "app_id, seq, kind, t_ms, job_id, stage_id, delta, initial".split(", ")
_TYPES = {"job_id": "int", "stage_id": "int", "delta": "int", "initial": "int"}


def _row(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(_TYPES[c]).alias(c) for c in _ROW]
    )


def has_hot_logs(parsed: DataFrame) -> bool:
    return has_hot_keys(parsed.filter(F.col("event") != log.TASK_END), ["log_id"], fanout=2)


def tagged_rows(parsed: DataFrame, splits: DataFrame, initial: DataFrame) -> DataFrame:
    """The control lines as one timeline for the fused pass, stages with their job, executors beside the driver uncounted."""
    kind, app = F.col("kind"), Window.partitionBy("app_id")
    rows = log.control_rows(parsed)
    rows = rows.select(*[c for c in rows.columns if c not in stages.COUNTERS], *stages.metric_ratios())
    timed = F.when(kind == scaleout.SUBMIT, F.col("submit_ms")).when(kind == scaleout.COMPLETE, F.col("complete_ms"))
    is_stage = kind.isin(scaleout.SUBMIT, scaleout.COMPLETE)
    rows = log.with_app(rows, splits).withColumn("t_ms", F.coalesce(timed, "t_ms")).filter(~is_stage | timed.isNotNull())
    rows = rows.join(initial, "app_id", "left").withColumn("initial", F.when(kind == scaleout.APP_START, F.col("initial")))
    # Each job start gives a row for each of its stages, from which later rows of the stage learn their job.
    listed = F.concat(F.array(F.lit(None).cast("int")), F.coalesce("stage_ids", F.array().cast("array<int>")))
    nothing = F.array(F.lit(None).cast("int"))
    rows = rows.withColumn("_listed", F.explode(F.when(kind == scaleout.JOB_START, listed).otherwise(nothing)))
    listing = F.col("_listed").isNotNull()
    rows = rows.withColumn("stage_id", F.coalesce("_listed", "stage_id")).drop("stage_ids")
    by_stage = Window.partitionBy("app_id", "stage_id").orderBy("seq", F.when(listing, 0).otherwise(1))
    of_stage = F.last(F.when(listing, F.col("job_id")), ignorenulls=True).over(
        by_stage.rowsBetween(Window.unboundedPreceding, 0))
    by_executor = Window.partitionBy("app_id", "executor_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "job_id": F.when(is_stage, of_stage).otherwise(F.col("job_id")),
        "host": F.last("host", ignorenulls=True).over(by_executor), "driver_host": F.max("driver_host").over(app),
    }).filter(~listing)
    on_driver = (kind == scaleout.EXECUTOR) & F.coalesce(F.col("host") == F.col("driver_host"), F.lit(False))
    return rows.withColumn("delta", F.when(on_driver, 0).otherwise(F.col("delta"))).drop(
        "_listed", "host", "driver_host", "executor_id")


def job_end_stages(parsed: DataFrame, splits: DataFrame, initial: DataFrame, base: int = 0) -> DataFrame:
    """Job ends with their stages in one pass over the control lines."""
    described = fused.described_events(tagged_rows(parsed, splits, initial), scaleout.SEQ, base)
    in_time = lambda end: F.col("seq") < end["seq"]
    return fused.job_stages(described, in_time, carried=[*stages.RDD_TOTALS, *stages.RATIOS]).drop("_done_id")


def fleet_tables(
    parsed: DataFrame, initial: DataFrame, hot: bool = True, base: int = 0
) -> dict[str, DataFrame]:
    """Tables by name, from parsed log lines and the first answers (app_id, initial).

    An application without a first answer keeps null for its initial scale-out. ``base`` executors were there
    before the log.
    """
    splits = log.log_splits(parsed)
    apps = log.scan_app_events(parsed, splits)
    jobs = log.scan_job_events(parsed, splits)
    logged = log.scan_stage_events(parsed, splits)
    incomplete = stages.incomplete_stage_events(logged)
    stage_events = stages.timed_stage_events(logged)
    executors = log.scan_executor_events(parsed, splits)
    settings = specs.app_config_lookup(log.scan_app_config(parsed, splits))

    drivers = settings.select("app_id", specs.setting("spark.driver.host").alias("driver_host"))
    located = scaleout.with_executor_hosts(executors, hot=hot).join(drivers, "app_id", "left")
    # Executors beside the driver mark a change of scale but are not counted.
    on_driver = F.coalesce(F.col("host") == F.col("driver_host"), F.lit(False))
    counted = located.withColumn("delta", F.when(on_driver, 0).otherwise(F.col("delta")))

    starts = apps.filter(F.col("kind") == scaleout.APP_START)
    timeline = (
        _row(apps.join(initial, "app_id", "left").withColumn(
            "initial", F.when(F.col("kind") == scaleout.APP_START, F.col("initial"))
        ))
        .unionByName(_row(counted.withColumn("kind", F.lit(scaleout.EXECUTOR))))
        .unionByName(_row(jobs))
        .unionByName(_row(stage_events.withColumn(
            "t_ms", F.when(F.col("kind") == scaleout.SUBMIT, F.col("submit_ms")).otherwise(F.col("complete_ms"))
        )))
    )
    tracked = scaleout.track_scale_out(timeline, base=base, hot=hot)

    windows = rescaling.stage_windows(
        stage_events.filter(F.col("kind") == scaleout.COMPLETE).select("app_id", "seq", "submit_ms", "complete_ms")
    )
    ratios = rescaling.rescaling_time_ratio(windows, executors, hot=hot)
    listings = jobs.filter(F.col("kind") == scaleout.JOB_START).select(
        "app_id", "seq", "job_id", F.explode("stage_ids").alias("stage_id")
    )
    mapped = stages.stage_job_mapping(listings, stage_events, hot=hot)
    known = scaleout.last_known_asof(tracked).select("app_id", "seq", "last_known")
    described = (
        mapped.filter("job_id is not null").join(known, ["app_id", "seq"])
        .join(ratios.select("app_id", "seq", "rescaling_time_ratio"), ["app_id", "seq"], "left")
    )
    ended = jobs.filter(F.col("kind") == scaleout.JOB_END).select(
        "app_id", "job_id", F.col("t_ms").alias("end_ms"), F.col("seq").alias("end_seq")
    )
    # A job is reported with what its stages had logged by its end.
    in_time = described.join(ended.select("app_id", "job_id", "end_seq"), ["app_id", "job_id"]).filter("seq < end_seq")
    in_time = in_time.drop("end_seq")
    whole = stages.complete_jobs(in_time, ended)
    metrics = stages.stage_metric_ratios(log.scan_stage_accumulables(parsed, splits))
    features = stages.stage_features(
        in_time.join(whole.select("app_id", "job_id"), ["app_id", "job_id"], "left_semi"), metrics, hot=hot
    )
    job_windows = rescaling.job_windows(
        ended, starts.select("app_id", F.col("t_ms").alias("app_start_ms"))
    )
    job_ratio = rescaling.rescaling_time_ratio(job_windows, executors, hot=hot)
    job_ends = messages.ended_jobs(tracked).join(
        job_ratio.select("app_id", "job_id", "rescaling_time_ratio"), ["app_id", "job_id"]
    )
    if hot:
        rows = messages.job_end_rows(job_ends, features)
    else:
        rows = job_end_stages(parsed, splits, initial, base)
    return {
        "app_start": messages.app_start_records(
            starts.select("app_id", F.col("t_ms").alias("app_time")), settings
        ),
        "job_start": messages.job_start_records(tracked),
        "job_end_rows": rows,
        "job_end": messages.job_end_records(rows, hot=hot),
        "app_end": messages.app_end_records(tracked),
        "scale_out": scaleout.alive_executor_count(counted, hot=hot),
        "last_known": scaleout.last_known_timeline(tracked),
        "orphan_stages": stages.orphan_stages(mapped),
        "incomplete_stage_events": incomplete,
        "stage_count_mismatch": stages.stage_count_mismatch(in_time),
        "jobs_without_stages": stages.jobs_without_stages(ended, described),
        "stage_task_totals": log.task_totals(parsed, splits),
        "missing_required_config": specs.missing_required_config(starts, log.scan_app_config(parsed, splits)),
    }
