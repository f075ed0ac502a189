"""Answers of a recommender as JSON lines: ``{"app_event_id": ..., "recommended_scale_out": ...}``.

Where the answers to all messages of an application are logged together, a line also names its message by
``event_type`` and ``job_id`` and may say when it was given (``answered_ms``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "app_event_id string, recommended_scale_out int"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.from_json("value", SCHEMA, {"mode": "PERMISSIVE"}).alias("_answer"))


def _complete():
    return F.col("_answer.app_event_id").isNotNull() & F.col("_answer.recommended_scale_out").isNotNull()


def scan_recommendations(lines: DataFrame) -> DataFrame:
    """Readable answers; the others are in ``invalid_responses``."""
    return _parsed(lines).filter(_complete()).select("_answer.*")


def invalid_responses(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON object, or miss a field or hold another type in it."""
    no_json = F.try_parse_json("value").isNull()
    return _parsed(lines).filter(~F.coalesce(_complete(), F.lit(False))).select(
        "value", F.when(no_json, "not json").otherwise("missing field").alias("reason")
    )


ANSWER = f"{SCHEMA}, event_type string, job_id int, answered_ms bigint"


def _named():
    return F.col("_a.app_event_id").isNotNull() & F.col("_a.event_type").isNotNull() & F.col(
        "_a.recommended_scale_out").isNotNull()


def scan_answers(lines: DataFrame, apps: DataFrame | None = None) -> DataFrame:
    """Answers with the message that each belongs to: the input of ``response_match``.

    ``apps`` maps app_event_id, the name an application got with its first answer, to app_id; without it that name is
    the app_id. Lines that name no message, and those of unknown applications, are left out.
    """
    read = lines.select(F.from_json("value", ANSWER, {"mode": "PERMISSIVE"}).alias("_a")).filter(_named()).select("_a.*")
    if apps is None:
        read = read.withColumnRenamed("app_event_id", "app_id")
    else:
        read = read.join(apps.select("app_event_id", "app_id"), "app_event_id")
    return read.select("app_id", "event_type", "job_id", "answered_ms", "recommended_scale_out")


def rejected_answers(lines: DataFrame) -> DataFrame:
    """Lines that ``scan_answers`` cannot read: no JSON, a field missing or of another type, or no message named."""
    read = lines.select("value", F.from_json("value", ANSWER, {"mode": "PERMISSIVE"}).alias("_a"))
    complete = F.col("_a.app_event_id").isNotNull() & F.col("_a.recommended_scale_out").isNotNull()
    reason = (
        F.when(F.try_parse_json("value").isNull(), "not json").when(~F.coalesce(complete, F.lit(False)), "missing field")
        .otherwise("no message")
    )
    return read.filter(~F.coalesce(_named(), F.lit(False))).select("value", reason.alias("reason"))
