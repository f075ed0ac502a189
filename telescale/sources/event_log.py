"""Spark event logs (JSON lines, single or rolled files, any number of applications) as typed tables.

``parse_lines`` reads each line once with one schema that names only the fields used here; Spark
prunes it further to what a query asks for. The result can be written as parquet and read back.

Logs are files of their own, or shipped: a collector that gathers lines of many logs into larger files puts
before each line the path of the log it is from and a tab (``shipped``). A file for each log costs more to
create, list and open than a short log costs to read.

A log names its application in one line only, and the text reader gives no line numbers. Both are
resolved per log and file split: a split has at most ``spark.sql.files.maxPartitionBytes`` of lines, so the
join on (log, split) is even however large a single log is. A line's ``seq`` orders it in its log:
the line span of all earlier splits plus its place in its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telescale.operators.scaleout import (
    APP_END, APP_START, COMPLETE, EXECUTOR, JOB_END, JOB_START, SUBMIT,
)
from telescale.operators.stages import COUNTERS, rdd_array_totals, stage_task_totals

# Event names and field names of the log format.
_STAGE = """struct<`Stage ID`: int, `Stage Attempt ID`: int, `Stage Name`: string, `Number of Tasks`: int,
    `Parent IDs`: array<int>, `Submission Time`: bigint, `Completion Time`: bigint, `Failure Reason`: string,
    `RDD Info`: array<struct<`Number of Partitions`: bigint, `Number of Cached Partitions`: bigint,
                             `Memory Size`: bigint, `Disk Size`: bigint>>,
    `Accumulables`: array<struct<`Name`: string, `Value`: string>>>"""
_METRICS = """struct<`Executor Run Time`: bigint, `Executor CPU Time`: bigint, `JVM GC Time`: bigint,
    `Peak Execution Memory`: bigint, `Disk Bytes Spilled`: bigint,
    `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
    `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>,
    `Input Metrics`: struct<`Bytes Read`: bigint>, `Output Metrics`: struct<`Bytes Written`: bigint>>"""
LINE_SCHEMA = f"""`App ID` string, `App Name` string, `Timestamp` bigint, `Spark Version` string,
    `Spark Properties` map<string, string>, `JVM Information` map<string, string>,
    `Job ID` int, `Submission Time` bigint, `Completion Time` bigint,
    `Stage Infos` array<struct<`Stage ID`: int>>, `Job Result` struct<`Result`: string>,
    `Stage Info` {_STAGE}, `Executor ID` string, `Executor Info` struct<`Host`: string>,
    `Stage ID` int, `Stage Attempt ID` int, `Task Metrics` {_METRICS}"""
PREFIX = "SparkListener"
TASK_END = "TaskEnd"
EVENTS = (
    "LogStart", "EnvironmentUpdate", "ApplicationStart", "ApplicationEnd", "JobStart", "JobEnd",
    "StageSubmitted", "StageCompleted", "ExecutorAdded", "ExecutorRemoved", TASK_END,
)
ACCUMULABLES = {
    "cpu_ns": ("executorCpuTime",), "run_ms": ("executorRunTime",), "gc_ms": ("jvmGCTime",),
    "shuffle_read": ("shuffle.read.remoteBytesRead", "shuffle.read.localBytesRead"),
    "shuffle_write": ("shuffle.write.bytesWritten",), "input_bytes": ("input.bytesRead",),
    "output_bytes": ("output.bytesWritten",), "disk_spill": ("diskBytesSpilled",),
    "peak_mem": ("peakExecutionMemory",),
}

#: The kind of row that each line other than those of tasks becomes.
KINDS = {
    "EnvironmentUpdate": "environment", "ApplicationStart": APP_START, "ApplicationEnd": APP_END,
    "JobStart": JOB_START, "JobEnd": JOB_END, "StageSubmitted": SUBMIT, "StageCompleted": COMPLETE,
    "ExecutorAdded": EXECUTOR, "ExecutorRemoved": EXECUTOR,
}

_HEAD = '{"Event":"'
_SPLIT = ["file_path", "split_start"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all logs below a folder, with the file and split they come from."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    return raw.select("value", F.monotonically_increasing_id().alias("line_id"), *line_origin())


def line_origin() -> list:
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
    ]


def shipped(log_path: Column, line: Column) -> Column:
    """A line of a log as a collector writes it: the path of the log's file, a tab, the line."""
    return F.concat(log_path, F.lit("\t"), line)


def parse_lines(lines: DataFrame) -> DataFrame:
    """One row per line of a known event: log_id, roll, origin, ``event`` and the parsed line ``e``.

    A rolled log is a folder of numbered files, any other log is one file. Shipped lines have the path of that file
    before them, which becomes a part of ``file_path``: a shipped file is one file for each log in it. A line of a log
    itself is a JSON object and begins with its brace.
    """
    tab = F.when(~F.col("value").startswith("{"), F.instr("value", "\t")).otherwise(0)
    lines = lines.withColumn("_tab", tab).withColumns({
        "_log": F.when(F.col("_tab") > 1, F.substr("value", F.lit(1), F.col("_tab") - 1)),
        "value": F.when(F.col("_tab") > 1, F.substr("value", F.col("_tab") + 1)).otherwise(F.col("value")),
    }).withColumns({
        "_log": F.coalesce("_log", "file_path"), "file_path": F.concat_ws("#", "file_path", "_log"),
    })
    value, file = F.col("value"), F.col("_log")
    # Spark writes the event's name first; other layouts are parsed for it.
    name = F.when(
        value.startswith(_HEAD), F.substring_index(F.substr(value, F.lit(len(_HEAD) + 1)), '"', 1)
    ).otherwise(F.get_json_object(value, "$.Event"))
    folder = F.regexp_extract(file, r"^(.*/(?:eventlog_v2_|log=)[^/]*)/", 1)
    roll = F.regexp_extract(file, r"/(?:events_|roll=)([0-9]+)", 1).try_cast("long")
    rolled = folder != ""
    return (
        lines.withColumn("_name", name)
        .filter(F.col("_name").isin([PREFIX + e for e in EVENTS]))
        .select(
            F.when(rolled, folder).otherwise(file).alias("log_id"),
            F.when(rolled, F.coalesce(roll, F.lit(0))).otherwise(F.lit(0)).cast("long").alias("roll"),
            *_SPLIT, "line_id",
            F.substr(F.col("_name"), F.lit(len(PREFIX) + 1)).alias("event"),
            F.from_json("value", LINE_SCHEMA).alias("e"),
        )
    )


def write_parsed(parsed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write parsed lines without a shuffle: task lines apart from the others, sorted for row-group skipping."""
    is_task = (F.col("event") == TASK_END).alias("is_task")
    parsed.select("*", is_task).sortWithinPartitions("is_task", "event").write.partitionBy("is_task").mode(
        mode
    ).parquet(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def log_splits(parsed: DataFrame) -> DataFrame:
    """Per file split: its application and the number of lines before it in the log."""
    app = F.when(F.col("event") == "ApplicationStart", F.col("e.`App ID`"))
    splits = parsed.groupBy("log_id", "roll", *_SPLIT).agg(
        F.min("line_id").alias("first_line"),
        (F.max("line_id") - F.min("line_id") + 1).alias("n_lines"),
        # A set of one name aggregates by hash; the maximum of a text would sort all lines.
        F.get(F.collect_set(app), F.lit(0)).alias("app_id"),
    )
    log = Window.partitionBy("log_id")
    earlier = log.orderBy("roll", *_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        *_SPLIT, "first_line", F.max("app_id").over(log).alias("app_id"),
        F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)).alias("lines_before"),
    )


def with_app(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Add app_id and seq to rows that still have their origin."""
    seq = F.col("lines_before") + F.col("line_id") - F.col("first_line")
    return rows.join(splits, _SPLIT).withColumn("seq", seq)


def _pick(parsed: DataFrame, kinds: dict[str, str]) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return parsed.filter(F.col("event").isin(*kinds)).withColumn("kind", names[F.col("event")])


def control_rows(parsed: DataFrame) -> DataFrame:
    """All lines but those of tasks as rows of one frame: origin, kind and what a line of that kind says."""
    names = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    event = F.col("event")
    return parsed.filter(event.isin(*KINDS)).select(
        *_SPLIT, "line_id", names[event].alias("kind"), F.col("e.`Job ID`").alias("job_id"),
        F.col("e.`Stage Infos`.`Stage ID`").alias("stage_ids"), F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.`Executor Info`.Host").alias("host"),
        F.try_element_at("e.`Spark Properties`", F.lit("spark.driver.host")).alias("driver_host"),
        F.when(event == "ExecutorAdded", 1).when(event == "ExecutorRemoved", -1).alias("delta"),
        F.coalesce("e.Timestamp", "e.`Submission Time`", "e.`Completion Time`").alias("t_ms"),
        *stage_columns(), *accumulable_totals(),
    )


def scan_app_events(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    rows = _pick(parsed, {"ApplicationStart": APP_START, "ApplicationEnd": APP_END})
    rows = rows.select(
        *_SPLIT, "line_id", "kind", F.col("e.`App Name`").alias("app_name"), F.col("e.Timestamp").alias("t_ms")
    )
    return with_app(rows, splits or log_splits(parsed)).select("app_id", "seq", "kind", "app_name", "t_ms")


def scan_job_events(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    rows = _pick(parsed, {"JobStart": JOB_START, "JobEnd": JOB_END}).select(
        *_SPLIT, "line_id", "kind", F.col("e.`Job ID`").alias("job_id"),
        F.coalesce("e.`Submission Time`", "e.`Completion Time`").alias("t_ms"),
        F.col("e.`Stage Infos`.`Stage ID`").alias("stage_ids"), F.col("e.`Job Result`.Result").alias("result"),
    )
    return with_app(rows, splits or log_splits(parsed)).select(
        "app_id", "seq", "kind", "job_id", "t_ms", "stage_ids", "result"
    )


def stage_columns() -> list:
    s = "e.`Stage Info`"
    infos = F.transform(
        F.col(f"{s}.`RDD Info`"),
        lambda r: F.struct(
            r["Number of Partitions"].alias("num_partitions"),
            r["Number of Cached Partitions"].alias("num_cached_partitions"),
            r["Memory Size"].alias("mem_size"), r["Disk Size"].alias("disk_size"),
        ),
    )
    return [
        F.col(f"{s}.`Stage ID`").alias("stage_id"), F.col(f"{s}.`Stage Attempt ID`").alias("attempt_id"),
        F.col(f"{s}.`Stage Name`").alias("stage_name"), F.col(f"{s}.`Number of Tasks`").alias("num_tasks"),
        F.col(f"{s}.`Parent IDs`").alias("parent_stage_ids"),
        F.col(f"{s}.`Submission Time`").alias("submit_ms"),
        F.col(f"{s}.`Completion Time`").alias("complete_ms"),
        F.col(f"{s}.`Failure Reason`").alias("failure_reason"), *rdd_array_totals(infos),
    ]


STAGE_KINDS = {"StageSubmitted": SUBMIT, "StageCompleted": COMPLETE}


def scan_stage_events(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    rows = _pick(parsed, STAGE_KINDS).select(*_SPLIT, "line_id", "kind", *stage_columns())
    return with_app(rows, splits or log_splits(parsed)).drop(*_SPLIT, "line_id", "first_line", "lines_before")


def scan_executor_events(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    rows = parsed.filter(F.col("event").isin("ExecutorAdded", "ExecutorRemoved")).select(
        *_SPLIT, "line_id", F.col("e.Timestamp").alias("t_ms"), F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.`Executor Info`.Host").alias("host"),
        F.when(F.col("event") == "ExecutorAdded", 1).otherwise(-1).alias("delta"),
    )
    return with_app(rows, splits or log_splits(parsed)).select(
        "app_id", "seq", "t_ms", "executor_id", "host", "delta"
    )


def _task_rows(parsed: DataFrame) -> DataFrame:
    m, zero = "e.`Task Metrics`", F.lit(0).cast("long")

    def number(*fields):
        out = zero
        for f in fields:
            out = out + F.coalesce(F.col(f"{m}.{f}"), zero)
        return out

    fields = {
        "cpu_ns": ("`Executor CPU Time`",), "run_ms": ("`Executor Run Time`",), "gc_ms": ("`JVM GC Time`",),
        "shuffle_read": (
            "`Shuffle Read Metrics`.`Remote Bytes Read`", "`Shuffle Read Metrics`.`Local Bytes Read`"
        ),
        "shuffle_write": ("`Shuffle Write Metrics`.`Shuffle Bytes Written`",),
        "input_bytes": ("`Input Metrics`.`Bytes Read`",), "output_bytes": ("`Output Metrics`.`Bytes Written`",),
        "disk_spill": ("`Disk Bytes Spilled`",), "peak_mem": ("`Peak Execution Memory`",),
    }
    return parsed.filter(F.col("event") == TASK_END).select(
        *_SPLIT, "line_id", F.col("e.`Stage ID`").alias("stage_id"),
        F.col("e.`Stage Attempt ID`").alias("attempt_id"), *[number(*f).alias(n) for n, f in fields.items()],
    )


def scan_task_metrics(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Counters of each task. For sums per stage use ``task_totals``."""
    return with_app(_task_rows(parsed), splits or log_splits(parsed)).select(
        "app_id", "seq", "stage_id", "attempt_id", *COUNTERS
    )


def task_totals(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Counters per stage attempt; tasks are summed per split before they meet their application."""
    keys = ["stage_id", "attempt_id"]
    per_split = stage_task_totals(_task_rows(parsed), [*_SPLIT, *keys])
    named = per_split.join((splits or log_splits(parsed)).select(*_SPLIT, "app_id"), _SPLIT)
    return stage_task_totals(named, ["app_id", *keys])


def accumulable_totals() -> list:
    """The same counters from the accumulables of a completed stage; absent ones are zero."""
    values = F.map_from_entries(
        F.filter(
            F.transform(
                F.col("e.`Stage Info`.Accumulables"), lambda a: F.struct(a["Name"].alias("k"), a["Value"].alias("v"))
            ),
            lambda a: a["k"].startswith("internal.metrics."),
        )
    )

    def number(names):
        out = F.lit(0).cast("long")
        for n in names:
            text = F.try_element_at(values, F.lit("internal.metrics." + n))
            out = out + F.coalesce(text.try_cast("long"), F.lit(0).cast("long"))
        return out

    return [number(names).alias(c) for c, names in ACCUMULABLES.items()]


def scan_stage_accumulables(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    rows = parsed.filter(F.col("event") == "StageCompleted").select(
        *_SPLIT, "line_id", F.col("e.`Stage Info`.`Stage ID`").alias("stage_id"),
        F.col("e.`Stage Info`.`Stage Attempt ID`").alias("attempt_id"), *accumulable_totals(),
    )
    return with_app(rows, splits or log_splits(parsed)).select("app_id", "stage_id", "attempt_id", *COUNTERS)


def scan_app_config(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Settings of each application, one row per key."""
    rows = parsed.filter(F.col("event") == "EnvironmentUpdate").select(
        *_SPLIT, "line_id", F.explode("e.`Spark Properties`").alias("key", "value")
    )
    return with_app(rows, splits or log_splits(parsed)).select("app_id", "key", "value")


def scan_versions(parsed: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Spark, Java and Scala versions as the log itself states them."""
    rows = parsed.filter(F.col("event").isin("LogStart", "EnvironmentUpdate")).select(
        *_SPLIT, "line_id", F.col("e.`Spark Version`").alias("spark_version"),
        F.try_element_at("e.`JVM Information`", F.lit("Java Version")).alias("java_version"),
        F.try_element_at("e.`JVM Information`", F.lit("Scala Version")).alias("scala_version"),
    )
    named = with_app(rows, splits or log_splits(parsed))
    return named.groupBy("app_id").agg(
        *[F.max(c).alias(c) for c in ("spark_version", "java_version", "scala_version")]
    )
