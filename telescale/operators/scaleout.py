"""Executor counts over time, and the scale-out an application last knew at each of its events.

``order`` names the columns that order the events of an application; the first one must be a whole
number (line number in the log, or milliseconds). ``hot`` is explained in ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.operators.ordered import BLOCK, blocked, scan

APP_START, APP_END = "app_start", "app_end"
JOB_START, JOB_END = "job_start", "job_end"
EXECUTOR = "executor"
SUBMIT, COMPLETE = "stage_submit", "stage_complete"

SEQ = ("seq",)


def non_driver_executors(executors: DataFrame, driver_hosts: DataFrame) -> DataFrame:
    """Rows of ``executors`` (app_id, address ``host:port``) that are not on the driver's host."""
    host = F.split("address", ":").getItem(0)
    return (
        executors.join(driver_hosts.select("app_id", "driver_host"), "app_id")
        .filter(host != F.col("driver_host"))
        .drop("driver_host")
    )


def with_executor_hosts(
    executor_events: DataFrame, order: Sequence[str] = SEQ, hot: bool = True
) -> DataFrame:
    """Removal rows carry no host: give them the host of the added row of the same executor."""
    keys = ["app_id", "executor_id"]
    seen = scan(blocked(executor_events, keys, order[0], hot), keys, order, last={"_host": F.col("host")})
    return seen.withColumn("host", F.col("_host")).drop("_host", BLOCK)


def alive_executor_count(
    executor_events: DataFrame, order: Sequence[str] = SEQ, initial: int = 0, hot: bool = True
) -> DataFrame:
    """Live executors after each executor event (``delta`` +1 or -1)."""
    counted = scan(
        blocked(executor_events, ["app_id"], order[0], hot), ["app_id"], order,
        total={"_alive": F.col("delta")},
    )
    return counted.withColumn("scale_out", alive(initial)).drop("_alive", BLOCK)


def alive(initial: int = 0):
    return F.greatest(F.lit(0), F.col("_alive") + F.lit(initial)).cast("int")


def scale_out_intervals(
    points: DataFrame, order: Sequence[str] = ("t_ms", "seq"), hot: bool = True
) -> DataFrame:
    """Milliseconds until the application's next executor event, 0 for its last one."""
    keys = ["app_id"]
    seen = scan(blocked(points, keys, order[0], hot), keys, order, after={"_next": F.col("t_ms")})
    gap = F.coalesce(F.col("_next") - F.col("t_ms"), F.lit(0))
    return seen.withColumn("interval_ms", gap).drop("_next", BLOCK)


def track_scale_out(
    timeline: DataFrame, order: Sequence[str] = SEQ, base: int = 0, context_stopped: bool = True,
    hot: bool = True,
) -> DataFrame:
    """Add ``num_executors``, ``last_known`` and ``updates`` to a timeline.

    A timeline has one row per event: app_id, kind, job_id, ``delta`` (executor rows), ``initial``
    (the scale-out answered to the application's start) and the order columns. The last known value
    starts as ``initial`` and takes the live count at job starts other than job 0 and at job ends.
    At the application's end the context is stopped already, so the last known value is reported.
    """
    keys = ["app_id"]
    counted = scan(
        blocked(timeline, keys, order[0], hot), keys, order,
        total={"_alive": F.coalesce("delta", F.lit(0))},
        last={"_initial": F.col("initial")},
    ).withColumn("_alive", alive(base))
    kind, first_job = F.col("kind"), F.col("job_id") == 0
    reads_count = (kind == JOB_END) | ((kind == JOB_START) & ~first_job)
    if not context_stopped:
        reads_count = reads_count | (kind == APP_END)
    counted = counted.withColumn(
        "_update", F.when(kind == APP_START, F.col("_initial")).when(reads_count, F.col("_alive"))
    )
    known = scan(counted, keys, order, last={"last_known": F.col("_update")})
    return known.select(
        *timeline.columns,
        F.when((kind == JOB_START) & first_job, F.col("_initial"))
        .when(kind == APP_END, F.col("last_known"))
        .otherwise(F.col("_alive")).cast("int").alias("num_executors"),
        F.col("last_known").cast("int").alias("last_known"),
        F.col("_update").isNotNull().alias("updates"),
    )


def last_known_timeline(tracked: DataFrame) -> DataFrame:
    """The points at which the last known scale-out is set."""
    return tracked.filter("updates").drop("updates", "num_executors")


def last_known_asof(tracked: DataFrame) -> DataFrame:
    """Stage submits and completions with the scale-out known at that moment."""
    return tracked.filter(F.col("kind").isin(SUBMIT, COMPLETE)).drop("updates", "num_executors")
