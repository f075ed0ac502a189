"""Recommendations, the fallback for missing ones, and the scaling decisions that follow.

Messages: app_id, event_type, job_id, t_ms, num_executors, last_known and the order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescale.operators.ordered import BLOCK, blocked, scan
from telescale.operators.scaleout import SEQ
from telescale.settings import MIN_REQUEST_GAP_MS


def response_match(messages: DataFrame, responses: DataFrame, order: str | None = None) -> DataFrame:
    """Messages with the answer given to them, null where none came.

    A message is named by application, event type and job (null for application messages). Of repeated answers the
    first by ``order`` counts; without an order of answers, the smallest.
    """
    first = F.min("recommended_scale_out") if order is None else F.min_by("recommended_scale_out", order)
    answers = responses.groupBy("app_id", "event_type", F.coalesce("job_id", F.lit(-1)).alias("_job")).agg(
        first.alias("recommended_scale_out")
    )
    return (
        messages.withColumn("_job", F.coalesce("job_id", F.lit(-1)))
        .join(answers, ["app_id", "event_type", "_job"], "left").drop("_job")
    )


def effective_recommendation(matched: DataFrame) -> DataFrame:
    """Add ``effective_scale_out`` and ``status``: without an answer the present count stays.

    An application whose start was not answered has failed.
    """
    answered = F.col("recommended_scale_out").isNotNull()
    start = F.col("event_type") == "APPLICATION_START"
    return matched.withColumn(
        "effective_scale_out",
        F.when(answered, F.col("recommended_scale_out")).when(~start, F.col("num_executors")),
    ).withColumn(
        "status", F.when(answered, "answered").when(start, "failed").otherwise("timeout")
    )


def is_candidate() -> Column:
    changed = F.col("effective_scale_out") != F.col("last_known")
    return F.col("event_type").isin("JOB_START", "JOB_END") & changed


def scale_change_candidates(effective: DataFrame) -> DataFrame:
    """Job messages whose recommendation differs from the last known scale-out."""
    return effective.filter(is_candidate())


def scale_decisions(
    candidates: DataFrame, app_starts: DataFrame, order: Sequence[str] = SEQ,
    min_gap_ms: int = MIN_REQUEST_GAP_MS, hot: bool = True,
) -> DataFrame:
    """Grant a candidate only if the one before it, granted or not, lies at least the gap behind.

    The first candidate is measured from the application's start.
    """
    keys = ["app_id"]
    started = candidates.join(app_starts.select("app_id", "app_start_ms"), "app_id")
    seen = scan(blocked(started, keys, order[0], hot), keys, order, before={"_previous": F.col("t_ms")})
    waited = F.col("t_ms") - F.coalesce("_previous", "app_start_ms")
    return (
        seen.withColumn("waited_ms", waited)
        .withColumn("decision", F.when(waited < min_gap_ms, "suppressed").otherwise("requested"))
        .drop("_previous", "app_start_ms", BLOCK)
    )


def initial_scale_requests(effective: DataFrame) -> DataFrame:
    """The request that follows an answered application start; no gap applies to it."""
    return effective.filter(
        (F.col("event_type") == "APPLICATION_START") & (F.col("status") == "answered")
    ).withColumn("decision", F.lit("initial"))
