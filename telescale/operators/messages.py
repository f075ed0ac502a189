"""The four kinds of messages an application sends over its life, as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telescale.operators import specs
from telescale.operators.ordered import blocked, scan
from telescale.operators.scaleout import APP_END, JOB_END, JOB_START
from telescale.operators.stages import RATIOS, RDD_TOTALS
from telescale.settings import EVENT_TYPES

STAGES_PER_MESSAGE = 100_000


def app_start_records(apps: DataFrame, settings: DataFrame, machines: DataFrame | None = None) -> DataFrame:
    """Start records of applications (app_id, app_time and optionally host), with their configuration."""
    joined = apps.join(settings, "app_id")
    if machines is not None:
        joined = joined.join(machines, "host", "left")
    else:
        joined = joined.withColumn("machine_type", F.lit(None).cast("string"))
    return joined.select(
        F.col("app_id").cast("string").alias("application_id"),
        specs.setting("spark.app.name").alias("app_name"),
        "app_time",
        *specs.adaptive_training_flags(),
        specs.app_specs().alias("app_specs"),
        specs.node_specs("driver").alias("driver_specs"),
        specs.node_specs("executor").alias("executor_specs"),
        F.struct("machine_type", *specs.environment_versions()).alias("environment_specs"),
    )


def job_start_records(tracked: DataFrame) -> DataFrame:
    """Job starts; job 0 reports the scale-out the application was given, later ones the live count."""
    return tracked.filter(F.col("kind") == JOB_START).select(
        "app_id", "job_id", F.col("t_ms").alias("app_time"), "num_executors"
    )


def app_end_records(tracked: DataFrame) -> DataFrame:
    return tracked.filter(F.col("kind") == APP_END).select(
        "app_id", F.col("t_ms").alias("app_time"), "num_executors"
    )


def ended_jobs(tracked: DataFrame) -> DataFrame:
    return tracked.filter(F.col("kind") == JOB_END).select(
        "app_id", "job_id", F.col("t_ms").alias("app_time"), "num_executors"
    )


def job_end_rows(jobs: DataFrame, features: DataFrame) -> DataFrame:
    """Job ends with one row per stage: the form for analysis.

    ``jobs`` has app_id, job_id, app_time, num_executors and rescaling_time_ratio.
    """
    stage = features.withColumnRenamed("rescaling_time_ratio", "stage_rescaling_time_ratio")
    return jobs.join(stage, ["app_id", "job_id"])


def stage_struct() -> Column:
    return F.struct(
        "stage_id", "stage_name", "num_tasks", "parent_stage_ids", "attempt_id", "failure_reason",
        "start_time", "end_time", "start_scale_out", "end_scale_out",
        F.col("stage_rescaling_time_ratio").alias("rescaling_time_ratio"),
        *RDD_TOTALS, F.struct(*RATIOS).alias("metrics"),
    )


def job_end_records(
    rows: DataFrame, stages_per_message: int = STAGES_PER_MESSAGE, hot: bool = True
) -> DataFrame:
    """Job ends with their stages as a map, from ``job_end_rows``: the form for messages.

    A job gives one row for each ``stages_per_message`` of its stages. Every row has its ``part``, from 0 on, and
    ``n_parts``; the parts together hold all stages of the job.
    """
    keys = ["app_id", "job_id"]
    numbered = rows.withColumn("_stage", F.col("stage_id").cast("long"))
    numbered = scan(
        blocked(numbered, keys, "_stage", hot), keys, ["_stage"], total={"_rn": F.lit(1)}
    )
    part = F.floor((F.col("_rn") - 1) / F.lit(stages_per_message))
    entry = F.struct(F.col("stage_id"), stage_struct())
    return (
        numbered.withColumn("part", part.cast("int"))
        .groupBy(*keys, "part", "app_time", "num_executors", "rescaling_time_ratio")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("stages"))
        .withColumn("n_parts", F.count("*").over(Window.partitionBy(*keys)).cast("int"))
    )


def event_type_filter(messages: DataFrame) -> DataFrame:
    """Messages of one of the four phases."""
    return messages.filter(F.col("event_type").isin(EVENT_TYPES))


def illegal_event_types(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("event_type").isNotNull() & ~F.col("event_type").isin(EVENT_TYPES))


def message_lines(records: DataFrame, event_type: str, app_event_id: Column | None = None) -> DataFrame:
    """Envelope of each record as JSON text: columns event_type, value."""
    if app_event_id is not None:
        records = records.withColumn("app_id", app_event_id).withColumnRenamed("app_id", "app_event_id")
    payload = F.struct(*records.columns)
    return records.select(
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(F.lit(event_type).alias("event_type"), payload.alias("payload"))).alias("value"),
    )


def keyed_lines(
    records: DataFrame, event_type: str, app: Column | None = None, named: bool = False
) -> DataFrame:
    """Envelopes with the key of each message: application, event type, and job and part where the kind has them.

    ``named`` records carry their app_id as ``app_event_id`` in the envelope.
    """
    held = records.columns
    key = {
        "app_event_id": (F.col("app_id") if app is None else app).cast("string"),
        "job_id": F.col("job_id").cast("int") if "job_id" in held else F.lit(None).cast("int"),
        "part": F.col("part").cast("int") if "part" in held else F.lit(None).cast("int"),
    }
    own = records.withColumnRenamed("app_id", "app_event_id") if named else records
    if named:
        key["app_event_id"] = F.col("app_event_id").cast("string")
    payload = F.struct(*own.columns).alias("payload")
    return own.select(
        F.lit(event_type).alias("event_type"), *(c.alias(n) for n, c in key.items()),
        F.to_json(F.struct(F.lit(event_type).alias("event_type"), payload)).alias("value"),
    )
