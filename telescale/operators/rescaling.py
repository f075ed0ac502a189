"""Share of a time window that an application spent between executor changes.

Take the executor events of an application by time, each lasting until the next one. Of those that
touch the window, the first and the last are its start and end state and do not count; the lengths
of the others, clipped to the window, are summed and divided by the window's length.

No window is paired with the events inside it. With B the first event at or after the window's
start that is not the application's first event, and L the last event at or before its end, the sum
is L - B. Events that share a millisecond have length 0 and run to the window's end; prefix sums
over such ties give their part. Both lookups come from one ordered pass over distinct milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.functions.expr import safe_ratio
from telescale.operators.ordered import BLOCK, blocked, scan

# Times are summed in two halves, so that no sum of many milliseconds since 1970 leaves a long.
_HALF = 1 << 20


def _high(ms: Column) -> Column:
    return F.shiftright(ms, 20)


def _low(ms: Column) -> Column:
    return ms.bitwiseAND(F.lit(_HALF - 1))


def executor_marks(points: DataFrame, windows: DataFrame, hot: bool = True) -> DataFrame:
    """For every window bound: counts of events, ties, and the nearest events around it.

    Rows are collapsed to one per application and millisecond before the shuffle, so neither a
    burst of events nor many windows with the same start can fill a task.
    """
    keys = ["app_id"]
    bounds = windows.select(
        "app_id", F.explode(F.array("window_start", "window_end")).alias("t_ms"),
        F.lit(0).alias("_point"),
    )
    moments = points.select("app_id", "t_ms", F.lit(1).alias("_point")).unionByName(bounds)
    rows = blocked(moments, keys, "t_ms", hot)
    block = [BLOCK] if hot else []
    distinct = rows.groupBy("app_id", *block, "t_ms").agg(F.sum("_point").alias("_m"))
    t, m = F.col("t_ms"), F.col("_m")
    point = F.when(m > 0, t)
    seen = scan(distinct, keys, ["t_ms"], before={"_earlier": point})
    initial = F.col("_earlier").isNull() & (m > 0)
    # Pairs of equal times, without the one that involves the application's first event.
    ties = F.greatest(F.lit(0), m - 1 - initial.cast("int"))
    seen = seen.withColumn("_ties", ties).withColumn("_candidate", F.when((m > 1) | ~initial, point))
    marks = scan(
        seen, keys, ["t_ms"],
        total={
            "_count": m,
            "_tied": F.col("_ties"),
            "_high": F.col("_ties") * _high(t),
            "_low": F.col("_ties") * _low(t),
        },
        last={"_last": point},
        after={"_later": F.col("_candidate"), "_later_any": point},
    )
    return marks.select(
        "app_id", "t_ms",
        F.col("_count").alias("count_upto"),
        (F.col("_count") - m).alias("count_before"),
        F.col("_tied").alias("ties_upto"),
        (F.col("_tied") - F.col("_ties")).alias("ties_before"),
        F.col("_high").alias("high_upto"), F.col("_low").alias("low_upto"),
        (F.col("_high") - F.col("_ties") * _high(t)).alias("high_before"),
        (F.col("_low") - F.col("_ties") * _low(t)).alias("low_before"),
        F.col("_last").alias("last_point"),
        F.coalesce(F.col("_candidate"), F.col("_later")).alias("next_counted"),
        F.coalesce(point, F.col("_later_any")).alias("next_point"),
    )


def _with_marks(windows: DataFrame, points: DataFrame, hot: bool) -> DataFrame:
    marks = executor_marks(points, windows, hot)
    start = marks.select(
        "app_id", F.col("t_ms").alias("window_start"), "count_before", "ties_before", "high_before",
        "low_before", "next_counted", "next_point",
    )
    end = marks.select(
        "app_id", F.col("t_ms").alias("window_end"), "count_upto", "ties_upto", "high_upto", "low_upto",
        "last_point",
    )
    return windows.join(start, ["app_id", "window_start"], "left").join(
        end, ["app_id", "window_end"], "left"
    )


def rescaling_time_ratio(
    windows: DataFrame, points: DataFrame, tie_mode: str = "stretch", hot: bool = True
) -> DataFrame:
    """Add ``rescaling_ms`` and ``rescaling_time_ratio`` to windows (app_id, window_start, window_end).

    ``points`` are executor events (app_id, t_ms). ``tie_mode="plain"`` gives events that share a
    millisecond no length instead of running them to the window's end.
    """
    if tie_mode not in ("stretch", "plain"):
        raise ValueError(f"unknown tie_mode {tie_mode!r}")
    end = F.col("window_end")
    span = F.col("last_point") - F.col("next_counted")
    ties = F.col("ties_upto") - F.col("ties_before")
    # Every tie lasts from its own time to the window's end.
    high = _high(end) * ties - (F.col("high_upto") - F.col("high_before"))
    low = _low(end) * ties - (F.col("low_upto") - F.col("low_before"))
    stretched = high * F.lit(_HALF).cast("long") + low
    length = span + stretched if tie_mode == "stretch" else span
    return (
        _with_marks(windows, points, hot)
        .withColumn("rescaling_ms", F.when(span >= 0, length).otherwise(F.lit(0)).cast("long"))
        .withColumn("rescaling_time_ratio", safe_ratio(F.col("rescaling_ms"), end - F.col("window_start")))
        .select(*windows.columns, "rescaling_ms", "rescaling_time_ratio")
    )


def interior_intervals(windows: DataFrame, points: DataFrame, hot: bool = True) -> DataFrame:
    """How many executor intervals touch each window, and how many remain without the first and last."""
    touching = F.when(
        F.col("next_point").isNotNull(),
        F.greatest(F.lit(0), F.col("count_upto") - F.greatest(F.col("count_before") - 1, F.lit(0))),
    ).otherwise(F.lit(0))
    return (
        _with_marks(windows, points, hot)
        .withColumn("n_overlapping", touching.cast("long"))
        .withColumn("n_interior", F.greatest(F.lit(0), F.col("n_overlapping") - 2).cast("long"))
        .select(*windows.columns, "n_overlapping", "n_interior")
    )


def stage_windows(completes: DataFrame) -> DataFrame:
    """Window of a completed stage: absent times count as 0."""
    return completes.withColumn("window_start", F.coalesce("submit_ms", F.lit(0).cast("long"))).withColumn(
        "window_end", F.coalesce("complete_ms", F.lit(0).cast("long"))
    )


def job_windows(job_ends: DataFrame, app_starts: DataFrame, window_start: str = "app_start") -> DataFrame:
    """Window of an ended job, from the application's start to the job's end.

    ``window_start="zero"`` starts at the epoch instead, as an application start that was never
    recorded would.
    """
    if window_start == "zero":
        return job_ends.withColumn("window_start", F.lit(0).cast("long")).withColumn(
            "window_end", F.col("end_ms")
        )
    if window_start != "app_start":
        raise ValueError(f"unknown window_start {window_start!r}")
    starts = app_starts.select("app_id", F.col("app_start_ms").alias("window_start"))
    return job_ends.join(starts, "app_id").withColumn("window_end", F.col("end_ms"))
