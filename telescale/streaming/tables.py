"""The same tables kept up to date from log segments as they arrive.

Segments are closed files. Each stage of the chain is one streaming query with its own checkpoint,
and the files it writes are the next one's source:

    log segments -> parsed lines -> tracked events -> stage pairs, job ends
                                 -> application starts
    tracked events, job ends, application starts -> messages, each once
    answer lines -> answers, rejected lines
    sent messages + answers -> effective recommendations -> decisions

State is kept per log. The rows a micro-batch has of one log are sorted inside the processor, so
``files_per_trigger`` bounds them; file order within an application decides. The tracker numbers the messages of a log,
and what follows it goes by these numbers, so that its files may be read in any order. There is no clock over
applications: logs may arrive in any order and at any age. An application's state goes an hour after its end was read;
lines that arrive later are counted.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telescale.operators import decisions, messages, specs
from telescale.operators.scaleout import (
    APP_END, APP_START, COMPLETE, EXECUTOR, JOB_END, JOB_START, SUBMIT,
)
from telescale.operators.stages import metric_ratios
from telescale.settings import MIN_REQUEST_GAP_MS, OPTIONAL_KEYS, REQUIRED_KEYS, RESPONSE_TIMEOUT_MS
from telescale.sources import event_log, recommendations
from telescale.streaming.processors import (
    KEY, LATE, PLACE, AnswerMatcher, DecisionClock, Ending, JobEndCollector, ScaleOutTracker, StagePairer, StartComposer,
    Together,
)

#: How long after its time limit an answer may still be on its way, and how long messages may be read out of order.
LAG_MS = 30_000
#: How many keys applications are dealt to; a checkpoint keeps them for life, as it does its state partitions.
KEYS = 4096

STAGE_FIELDS = (
    "stage_id int, attempt_id int, stage_name string, num_tasks int, parent_stage_ids array<int>, "
    "submit_ms bigint, complete_ms bigint, failure_reason string, rdd_num_partitions bigint, "
    "rdd_num_cached_partitions bigint, rdd_mem_size bigint, rdd_disk_size bigint, cpu_utilization double, "
    "gc_time_ratio double, shuffle_read_write_ratio double, input_output_ratio double, "
    "memory_spill_ratio double"
)
EVENT_FIELDS = f"kind string, t_ms bigint, job_id int, stage_ids array<int>, {STAGE_FIELDS}"
TRACKED = (
    f"log_id string, app_id string, seq bigint, message_no bigint, num_executors int, last_known int, {EVENT_FIELDS}"
)
MESSAGE = (
    "app_id string, message_no bigint, event_type string, job_id int, t_ms bigint, seq bigint, num_executors int, "
    "last_known int"
)
START = "app_id string, app_time bigint, settings string"
RESPONSE = "app_id string, event_type string, job_id int, answered_ms bigint, recommended_scale_out int"
STAGE_OUT = (
    f"job_id int, app_time bigint, num_executors int, rescaling_time_ratio double, {STAGE_FIELDS}, "
    "start_scale_out int, end_scale_out int, stage_rescaling_time_ratio double"
)


def _kept(rows: DataFrame, key: str, processor: Ending, out: str) -> DataFrame:
    """What a processor gives for the rows of each application or log ``key``; columns it does not take stay behind.

    Rows go as JSON both ways, since Spark takes longer over the cells of a row than over the row.
    """
    dealt = rows.select(
        F.pmod(F.xxhash64(key), F.lit(KEYS)).cast("int").alias("dealt_to"),
        F.to_json(F.struct(F.col(key).alias(KEY), *processor.IN)).alias("row"),
    )
    found = dealt.groupBy("dealt_to").transformWithState(
        Together(processor), outputStructType="rows string", outputMode="Append", timeMode="ProcessingTime"
    )
    return found.select(F.inline(F.from_json("rows", f"array<struct<{out}>>", {"mode": "FAILFAST"})))


def stream_events(
    spark: SparkSession, logs: str, out: str, checkpoint: str, files_per_trigger: int = 1000, archive: str | None = None
):
    """Parse new log segments and append them; a batch that is retried replaces its own folder.

    Each task writes the lines of its own splits, in one pass and in their order: a large log is parsed and written by
    as many tasks as it has splits. Segments that are done with move to the folder ``archive``, if there is one.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.text(logs).select("value", *event_log.line_origin())

    def append(batch: DataFrame, batch_id: int) -> None:
        parsed = event_log.parse_lines(batch.withColumn("line_id", F.monotonically_increasing_id()))
        is_task = (F.col("event") == event_log.TASK_END).alias("is_task")
        parsed.select("*", is_task).write.partitionBy("is_task").mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


def parsed_stream(spark: SparkSession, parsed: str, files_per_trigger: int | None = None) -> DataFrame:
    """Control lines of the batches parsed so far.

    A micro-batch takes whole parsed batches, since the lines that a log has in one lie in several files; how much that is
    was bounded when they were parsed. ``files_per_trigger`` is for parsed batches of one file only.
    """
    schema = spark.read.parquet(parsed).drop("batch", "is_task").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{parsed}/batch=*/is_task=false")


def _stage_ratios(rows: DataFrame) -> DataFrame:
    with_totals = rows.select("*", *event_log.accumulable_totals())
    return with_totals.select("*", *metric_ratios())


def app_events(parsed: DataFrame, initial: Column) -> DataFrame:
    """Parsed lines as the rows the tracker needs; task lines are left out."""
    names = F.create_map(*[F.lit(x) for pair in event_log.KINDS.items() for x in pair])
    rows = parsed.filter(F.col("event").isin(*event_log.KINDS)).withColumn("kind", names[F.col("event")])
    start = F.col("kind") == APP_START
    rows = _stage_ratios(rows.select("*", *event_log.stage_columns()))
    return rows.select(
        "log_id", *PLACE,
        F.when(start, F.col("e.`App ID`")).alias("app_id"),
        F.when(start, initial).cast("int").alias("initial"),
        F.try_element_at("e.`Spark Properties`", F.lit("spark.driver.host")).alias("driver_host"),
        F.col("e.`Executor ID`").alias("executor_id"), F.col("e.`Executor Info`.Host").alias("host"),
        F.when(F.col("event") == "ExecutorAdded", 1).when(F.col("event") == "ExecutorRemoved", -1)
        .otherwise(0).alias("delta"),
        "kind",
        F.coalesce(
            "e.Timestamp", "e.`Submission Time`", "e.`Completion Time`", "complete_ms", "submit_ms"
        ).alias("t_ms"),
        F.col("e.`Job ID`").alias("job_id"), F.col("e.`Stage Infos`.`Stage ID`").alias("stage_ids"),
        *[f.split()[0] for f in STAGE_FIELDS.split(", ")],
    )


def stream_app_state(events: DataFrame, base: int = 0) -> DataFrame:
    """Each event with its number in the log, the live count and the last known scale-out."""
    return _kept(events, "log_id", ScaleOutTracker(base), TRACKED)


def stream_job_end(tracked: DataFrame) -> DataFrame:
    """Rows of ended jobs, one per stage, emitted at the job's end; its state is dropped then."""
    return _kept(tracked.filter(F.col("kind") != LATE), "app_id", JobEndCollector(), f"app_id string, {STAGE_OUT}")


def late_rows(tracked: DataFrame) -> DataFrame:
    """How many lines of each log arrived after its state was freed, and the latest time among them."""
    late = tracked.filter(F.col("kind") == LATE).groupBy("log_id")
    return late.agg(F.count("*").alias("n_late"), F.max("t_ms").alias("last_ms"))


def start_lines(parsed: DataFrame) -> DataFrame:
    """The lines that make up an application's start, with the settings that specifications read as JSON."""
    rows = parsed.filter(F.col("event").isin("EnvironmentUpdate", "ApplicationStart", "ApplicationEnd"))
    known = F.map_filter("e.`Spark Properties`", lambda k, _: k.isin([*REQUIRED_KEYS, *OPTIONAL_KEYS]))
    names = F.create_map(*[F.lit(x) for pair in event_log.KINDS.items() for x in pair])
    return rows.select(
        "log_id", *PLACE, names[F.col("event")].alias("kind"), F.col("e.`App ID`").alias("app_id"),
        F.col("e.Timestamp").alias("t_ms"), F.to_json(known).alias("settings"),
    )


def stream_app_starts(lines: DataFrame) -> DataFrame:
    """Start of each application with its settings, once both of its lines have arrived."""
    return _kept(lines, "log_id", StartComposer(), START)


def stream_stage_pairs(tracked: DataFrame) -> DataFrame:
    """Submit and completion of each stage attempt, held per application for as long as it runs."""
    out = "app_id string, stage_id int, attempt_id int, submit_ms bigint, complete_ms bigint"
    rows = tracked.filter(F.col("kind").isin(SUBMIT, COMPLETE, APP_END))
    return _kept(rows, "app_id", StagePairer(), out)


def message_rows(tracked: DataFrame) -> DataFrame:
    types = {APP_START: "APPLICATION_START", APP_END: "APPLICATION_END", JOB_START: "JOB_START", JOB_END: "JOB_END"}
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return tracked.filter(F.col("kind").isin(*types)).select(
        "app_id", "message_no", names[F.col("kind")].alias("event_type"), "job_id", "t_ms", "seq", "num_executors",
        "last_known",
    )


def start_messages(starts: DataFrame) -> DataFrame:
    """Envelopes of application starts, with their keys."""
    records = messages.app_start_records(
        starts.select("app_id", "app_time"),
        starts.select("app_id", F.from_json("settings", "map<string, string>").alias("settings")),
    )
    return messages.keyed_lines(records, "APPLICATION_START", F.col("application_id"))


def tracked_messages(tracked: DataFrame) -> DataFrame:
    """Envelopes of job starts and application ends, with their keys."""
    starts = messages.keyed_lines(messages.job_start_records(tracked), "JOB_START", named=True)
    return starts.unionByName(messages.keyed_lines(messages.app_end_records(tracked), "APPLICATION_END", named=True))


def job_end_messages(rows: DataFrame) -> DataFrame:
    """Envelopes of job ends, with their keys, from rows of ``stream_job_end`` that hold whole jobs."""
    rows = rows.withColumnsRenamed({"submit_ms": "start_time", "complete_ms": "end_time"})
    records = messages.job_end_records(rows.withColumn("stage_id", F.col("stage_id").cast("string")), hot=False)
    return messages.keyed_lines(records, "JOB_END", named=True)


def stream_response_timeout(
    sent: DataFrame, responses: DataFrame, timeout_ms: int = RESPONSE_TIMEOUT_MS, wait_ms: int | None = None
) -> DataFrame:
    """Messages with their first answer if it was given in time, else with the fallback, in order per application.

    A message is given up ``wait_ms`` after it was read, by a timer of its own; that is the time limit and a lag.
    """
    messages_in = sent.select(
        "app_id", "message_no", *AnswerMatcher.MESSAGE, F.lit(None).cast("bigint").alias("answered_ms"),
        F.lit(None).cast("int").alias("recommended_scale_out"),
    )
    rows = messages_in.unionByName(responses.select(
        "app_id", "event_type", "job_id", "answered_ms", "recommended_scale_out"
    ), allowMissingColumns=True)
    wait_ms = timeout_ms + LAG_MS if wait_ms is None else wait_ms
    matched = _kept(rows, "app_id", AnswerMatcher(timeout_ms, wait_ms), f"{MESSAGE}, recommended_scale_out int")
    return decisions.effective_recommendation(matched)


def stream_scale_decisions(
    effective: DataFrame, min_gap_ms: int = MIN_REQUEST_GAP_MS, wait_ms: int = LAG_MS
) -> DataFrame:
    """Decision on each candidate, from the time of the one before it kept in state.

    Messages are taken by their numbers; one that is missing is waited for up to ``wait_ms``.
    """
    rows = effective.select(
        "app_id", "message_no", "event_type", "job_id", "t_ms", "seq", F.col("effective_scale_out").cast("int"),
        F.coalesce(decisions.is_candidate(), F.lit(False)).alias("candidate"),
    )
    out = "app_id string, event_type string, job_id int, t_ms bigint, seq bigint, effective_scale_out int, " \
          "waited_ms bigint, decision string"
    return _kept(rows, "app_id", DecisionClock(min_gap_ms, wait_ms), out)


def answer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a recommender as they arrive, in closed files."""
    return spark.readStream.option("recursiveFileLookup", "true").text(folder)


def stream_answers(lines: DataFrame) -> DataFrame:
    """Answers that can be read and name their message; the other lines are in ``stream_rejects``."""
    return recommendations.scan_answers(lines)


def stream_rejects(lines: DataFrame) -> DataFrame:
    """Lines that give no answer to a message, with the reason. Run it under a checkpoint of its own."""
    return recommendations.rejected_answers(lines)


def to_files(rows: DataFrame, out: str, checkpoint: str):
    return rows.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    ).outputMode("append")


def run_available(spark: SparkSession, writer) -> None:
    """Process everything that is there, in as many batches as the limits ask for, and stop.

    A query with timers asks for one more batch without data for ever, so there are none; timers go off in the
    batches of the next run.
    """
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)


def run_settled(writer, wait_ms: int, at_most_s: int = 600) -> None:
    """Process everything that is there and go on until timers of ``wait_ms`` have gone off, then stop.

    In service a query just runs on; this is for those that are started now and then.
    """
    query = writer.trigger(processingTime="0 seconds").start()
    give_up, quiet_since = time.monotonic() + at_most_s, None
    try:
        while time.monotonic() < give_up:
            time.sleep(0.1)
            if query.exception() is not None:
                raise query.exception()
            done = query.lastProgress
            if done is None or done["numInputRows"]:
                quiet_since = None
            elif quiet_since is None:
                quiet_since = time.monotonic()
            # A batch that began after the last timer was due has set free what waited.
            elif time.monotonic() > quiet_since + wait_ms / 1000 + 2 * done["batchDuration"] / 1000 + 1:
                return
        raise TimeoutError("rows were still coming")
    finally:
        query.stop()
