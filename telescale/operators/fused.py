"""Job ends with their stages in one pass over an application's events.

All that a job-end record needs is carried along one frame of tagged rows: the executor counts and the last known
scale-out, both ends of every rescaling window, the stages of each job and their pairs. The frame is shuffled once, by
application; every later step groups or orders within an application, so it sorts but does not shuffle again, and no
branch reads the events a second time.

One application's rows meet in one task here. Where one has too many for that, ``hot`` plans (see ``ordered``) give the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telescale.functions.expr import failure_reason, safe_ratio, stage_key
from telescale.operators.scaleout import APP_START, COMPLETE, EXECUTOR, JOB_END, SUBMIT, track_scale_out

WINDOW = "window"  # kind of the row that stands for the start of a completed stage's window
APP = ["app_id"]


def with_window_starts(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add a row at the start of each completed stage's window; ``_wid`` names the window in both rows."""
    start = F.col("_start")
    kinds = F.when(F.col("kind") == COMPLETE, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    marked = rows.withColumn("_wid", F.struct(*order)).withColumn("_start", F.explode(kinds))
    return marked.withColumns({
        "t_ms": F.when(start, F.coalesce("submit_ms", F.lit(0))).otherwise(F.col("t_ms")),
        "kind": F.when(start, WINDOW).otherwise(F.col("kind")),
    }).drop("_start")


def with_executor_marks(rows: DataFrame, tie_order: Sequence[str]) -> DataFrame:
    """Add ``_marks``: what the executor events up to, before and after each row's millisecond say.

    Each event lasts until the next one. Ties are events at the millisecond of the one before them, that one not being
    the application's first; their times are summed from the application's first row on, so that sums stay small.
    """
    t, point = F.col("t_ms"), F.col("kind") == EXECUTOR
    app = Window.partitionBy(*APP)
    upto = app.orderBy("t_ms", *tie_order).rowsBetween(Window.unboundedPreceding, 0)
    prior = upto.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumns({
        "_number": F.count(F.when(point, 1)).over(upto), "_before": F.last(F.when(point, t), ignorenulls=True).over(prior),
        "_zero": F.min("t_ms").over(app),
    })
    tied = point & (F.col("_number") >= 3) & (F.col("_before") == t)
    placed = placed.withColumn("_tie", tied.cast("long"))
    tie, since = F.col("_tie"), t - F.col("_zero")
    by_time = app.orderBy("t_ms")
    here, earlier = (by_time.rangeBetween(Window.unboundedPreceding, n) for n in (0, -1))
    later = app.orderBy(F.col("t_ms").desc()).rangeBetween(Window.unboundedPreceding, 0)
    marks = {
        "last_point": F.max(F.when(point, t)).over(here),
        "ties_upto": F.sum(tie).over(here), "tied_ms_upto": F.sum(tie * since).over(here),
        "ties_before": F.coalesce(F.sum(tie).over(earlier), F.lit(0)),
        "tied_ms_before": F.coalesce(F.sum(tie * since).over(earlier), F.lit(0)),
        # The application's first event never counts, so it is none to begin with.
        "next_counted": F.min(F.when(point & (F.col("_number") > 1), t)).over(later),
    }
    placed = placed.withColumns({f"_m_{n}": c for n, c in marks.items()})
    held = F.struct(*[F.col(f"_m_{n}").alias(n) for n in marks])
    return placed.withColumn("_marks", held).drop("_number", "_before", "_tie", *[f"_m_{n}" for n in marks])


def rescaling_ratio(start: Column, end: Column, start_ms: Column, end_ms: Column, zero: Column) -> Column:
    """Share of a window from the marks at its two ends; see ``rescaling``."""
    span = end["last_point"] - start["next_counted"]
    ties = end["ties_upto"] - start["ties_before"]
    stretched = ties * (end_ms - zero) - (end["tied_ms_upto"] - start["tied_ms_before"])
    length = F.when(span >= 0, span + stretched).otherwise(F.lit(0)).cast("long")
    return safe_ratio(length, end_ms - start_ms)


def described_events(rows: DataFrame, order: Sequence[str], base: int = 0) -> DataFrame:
    """Add ``num_executors``, ``last_known`` and ``ratio`` (of completed stages and ended jobs) to a timeline.

    A timeline is that of ``track_scale_out``; completed stages also have ``submit_ms`` and ``complete_ms``.
    """
    tracked = track_scale_out(with_window_starts(rows, order), order, base, hot=False)
    marked = with_executor_marks(tracked, order)
    kind, marks = F.col("kind"), F.col("_marks")
    of_window, of_app = Window.partitionBy(*APP, "_wid"), Window.partitionBy(*APP)
    marked = marked.withColumns({
        "_from": F.max(F.when(kind == WINDOW, marks)).over(of_window),
        "_app_from": F.max(F.when(kind == APP_START, marks)).over(of_app),
        "_app_ms": F.max(F.when(kind == APP_START, F.col("t_ms"))).over(of_app),
    }).filter(kind != WINDOW)
    submitted, done = F.coalesce("submit_ms", F.lit(0)), F.coalesce("complete_ms", F.lit(0))
    of_stage = rescaling_ratio(F.col("_from"), marks, submitted, done, F.col("_zero"))
    of_job = rescaling_ratio(F.col("_app_from"), marks, F.col("_app_ms"), F.col("t_ms"), F.col("_zero"))
    ratio = F.when(kind == COMPLETE, of_stage).when(kind == JOB_END, of_job)
    return marked.withColumn("ratio", ratio).drop("_wid", "_zero", "_marks", "_from", "_app_from", "_app_ms", "updates")


def job_stages(
    events: DataFrame, in_time: Callable[[Column], Column], order: Sequence[str] = ("stage_id", "seq"),
    carried: Sequence[str] = (),
) -> DataFrame:
    """Paired stages of ended jobs with as many submits as completions, one row per stage, with the job's end.

    ``events`` are those of ``described_events``. ``in_time`` says of a stage event, given the row of its job's end,
    whether it counts; ``carried`` are further columns of completions.
    """
    kind, keys = F.col("kind"), [*APP, "job_id"]
    job = Window.partitionBy(*keys)
    end = F.struct("t_ms", "seq", "num_executors", "ratio")
    staged = events.filter(kind.isin(JOB_END, SUBMIT, COMPLETE) & F.col("job_id").isNotNull())
    staged = staged.withColumn("_end", F.max(F.when(kind == JOB_END, end)).over(job))
    staged = staged.filter(kind.isin(SUBMIT, COMPLETE) & F.col("_end").isNotNull()).filter(in_time(F.col("_end")))
    counts = [F.count_if(kind == k).over(job) for k in (SUBMIT, COMPLETE)]
    staged = staged.withColumns({"_submits": counts[0], "_completes": counts[1]}).filter("_submits = _completes")
    position = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy(*order))
    submit = F.struct("stage_id", "stage_name", "num_tasks", "parent_stage_ids", "submit_ms", "last_known")
    complete = F.struct("stage_id", "attempt_id", "failure_reason", "complete_ms", "last_known", "ratio", *carried)
    pairs = staged.withColumn("position", position).groupBy(*keys, "position").agg(
        F.first(F.when(kind == SUBMIT, submit), ignorenulls=True).alias("s"),
        F.first(F.when(kind == COMPLETE, complete), ignorenulls=True).alias("c"), F.first("_end").alias("end"),
    ).filter("s is not null and c is not null")
    last = F.max_by(F.struct("s", "c", "end"), "position").alias("_last")
    pairs = pairs.withColumn("_stage", F.col("s.stage_id")).groupBy(*keys, "_stage").agg(last).select(*keys, "_last.*")
    return pairs.select(
        *keys, F.col("end.t_ms").alias("app_time"), F.col("end.num_executors").alias("num_executors"),
        F.col("end.ratio").alias("rescaling_time_ratio"), stage_key(F.col("s.stage_id")).alias("stage_id"),
        F.col("s.stage_name").alias("stage_name"), F.col("s.num_tasks").alias("num_tasks"),
        F.col("s.parent_stage_ids").alias("parent_stage_ids"), F.col("c.stage_id").alias("_done_id"),
        F.col("c.attempt_id").alias("attempt_id"), failure_reason(F.col("c.failure_reason")).alias("failure_reason"),
        F.col("s.submit_ms").alias("start_time"), F.col("c.complete_ms").alias("end_time"),
        F.col("s.last_known").alias("start_scale_out"), F.col("c.last_known").alias("end_scale_out"),
        F.col("c.ratio").alias("stage_rescaling_time_ratio"), *[F.col(f"c.{name}").alias(name) for name in carried],
    )
