"""Telemetry frames derived from the generic test tables (see FIXTURES.md).

An application is a user, an event id is a position in the log. Sign-ups add an executor, errors
remove one, purchases start a job (and end the one before), views are stages and clicks are
recommendations. Every frame keeps all rows of its table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telescale.operators import fused, messages, rescaling, stages as stage_ops
from telescale.operators.ordered import blocked, has_hot_keys, scan
from telescale.operators.scaleout import (
    APP_END, APP_START, COMPLETE, EXECUTOR, JOB_END, JOB_START, SUBMIT, track_scale_out,
)
from telescale.sources import event_log

INITIAL = 5

# Rank of the events that share a position.
ANSWER = "answer"
RANK = {ANSWER: -1, APP_START: 0, EXECUTOR: 1, JOB_END: 2, JOB_START: 3, SUBMIT: 4, COMPLETE: 5, APP_END: 6}
ORDER = ("t_ms", "rank", "seq")


_FRAMES: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()


def once(fn):
    """Build a frame of the same events only once: a query that uses it twice then shares its plan."""
    @wraps(fn)
    def build(ev: DataFrame, hot: bool = True) -> DataFrame:
        frames = _FRAMES.setdefault(ev, {})
        if (fn.__name__, hot) not in frames:
            frames[fn.__name__, hot] = fn(ev, hot)
        return frames[fn.__name__, hot]

    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("app_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("et"),
        F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("t_ms"),
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def is_hot(ev: DataFrame) -> bool:
    """Whether one application's events, each at most three rows of a frame, are too many for a task."""
    return has_hot_keys(ev, ["app_id"], fanout=3)


def executor_events(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("et").isin("signup", "error")).select(
        "app_id", "seq", "t_ms", F.when(F.col("et") == "signup", 1).otherwise(-1).alias("delta")
    )


@once
def jobs(ev: DataFrame, hot: bool = True) -> DataFrame:
    keys = ["app_id"]
    starts = ev.filter(F.col("et") == "purchase").select("app_id", "seq", "t_ms")
    numbered = scan(
        blocked(starts, keys, "seq", hot), keys, ["seq"],
        total={"_n": F.lit(1)}, after={"end_seq": F.col("seq"), "end_ms": F.col("t_ms")},
    )
    return numbered.select(
        "app_id", (F.col("_n") - 1).cast("int").alias("job_id"),
        F.col("seq").alias("start_seq"), F.col("t_ms").alias("start_ms"), "end_seq", "end_ms",
    )


@once
def stages(ev: DataFrame, hot: bool = True) -> DataFrame:
    """Views, with the job they fall into (-1 before the first) and its end."""
    keys, purchase = ["app_id"], F.col("et") == "purchase"
    steps = ev.filter(F.col("et").isin("purchase", "view"))
    placed = scan(
        blocked(steps, keys, "seq", hot), keys, ["seq"],
        total={"_n": purchase.cast("int")}, after={"end_ms": F.when(purchase, F.col("t_ms"))},
    )
    return placed.filter(F.col("et") == "view").select(
        "app_id", (F.col("_n") - 1).cast("int").alias("job_id"), F.col("seq").alias("stage_id"),
        F.col("seq").alias("submit_seq"), F.col("t_ms").alias("submit_ms"), done_ms().alias("complete_ms"),
        "end_ms", "k",
    )


def done_ms():
    return F.col("t_ms") + F.floor(F.col("value") * 3600000)


def stage_times(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("et") == "view").select(
        "app_id", F.col("seq").alias("stage_id"), F.col("t_ms").alias("submit_ms"), done_ms().alias("complete_ms")
    )


def recommendations(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("et") == "click").select(
        "app_id", "seq", "t_ms", (F.col("k") % 10 + 1).alias("recommended_scale_out")
    )


def app_bounds(ev: DataFrame) -> DataFrame:
    """First and last event of each application."""
    return ev.groupBy("app_id").agg(
        F.min("seq").alias("start_seq"), F.min_by("t_ms", "seq").alias("app_start_ms"),
        F.max("seq").alias("end_seq"), F.max_by("t_ms", "seq").alias("app_end_ms"),
    )


def _event(kind: str, t_ms: str, seq: str, **extra):
    def column(name, type_):
        return extra.get(name, F.lit(None)).cast(type_).alias(name)

    return F.struct(
        F.col(t_ms).alias("t_ms"), F.lit(RANK[kind]).alias("rank"), F.col(seq).alias("seq"),
        F.lit(kind).alias("kind"), column("job_id", "int"), column("stage_id", "long"),
        column("delta", "int"), column("initial", "int"),
    )


def _events(df: DataFrame, *structs) -> DataFrame:
    return df.select("app_id", F.inline(F.array(*structs)))


TIMELINE = ("t_ms", "rank", "seq", "kind", "job_id", "stage_id", "delta", "initial")


@once
def timeline(ev: DataFrame, hot: bool = True) -> DataFrame:
    """All events of all applications in one frame, ordered by ``ORDER``."""
    if not hot:
        return tagged_rows(ev).select("app_id", *TIMELINE)
    job, stage = F.col("job_id"), F.col("stage_id")
    bounds = _events(
        app_bounds(ev),
        _event(APP_START, "app_start_ms", "start_seq", initial=F.lit(INITIAL)),
        _event(APP_END, "app_end_ms", "end_seq"),
    )
    executor = _events(executor_events(ev), _event(EXECUTOR, "t_ms", "seq", delta=F.col("delta")))
    job_rows = _events(
        jobs(ev, hot),
        _event(JOB_START, "start_ms", "start_seq", job_id=job),
        _event(JOB_END, "end_ms", "end_seq", job_id=job),
    ).filter("seq is not null")
    stage_rows = _events(
        stages(ev, hot),
        _event(SUBMIT, "submit_ms", "submit_seq", job_id=job, stage_id=stage),
        _event(COMPLETE, "complete_ms", "submit_seq", job_id=job, stage_id=stage),
    )
    return bounds.unionByName(executor).unionByName(job_rows).unionByName(stage_rows)


def tasks(spark: SparkSession, sf_dir: str, more: Sequence = ()) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")

    def whole(c):
        return F.col(c).cast("long")

    def cents(c):
        return F.round(F.col(c) * 100).cast("long")

    return line.select(
        F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("stage_id"),
        whole("l_quantity").alias("run_ms"), cents("l_extendedprice").alias("cpu_ns"),
        (F.col("l_suppkey") % 5).alias("gc_ms"), cents("l_tax").alias("shuffle_read"),
        cents("l_discount").alias("shuffle_write"), F.col("l_partkey").alias("input_bytes"),
        (F.col("l_suppkey") % 3).alias("output_bytes"), (F.col("l_partkey") % 4).alias("disk_spill"),
        whole("l_quantity").alias("peak_mem"), *more,
    )


def rdds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("stage_id"),
        F.col("l_quantity").cast("long").alias("num_partitions"),
        F.col("l_linenumber").cast("long").alias("num_cached_partitions"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("mem_size"),
        F.col("l_partkey").alias("disk_size"),
    )


@once
def tracked(ev: DataFrame, hot: bool = True) -> DataFrame:
    return track_scale_out(timeline(ev, hot), ORDER, base=INITIAL, hot=hot)


MESSAGE_TYPES = {
    APP_START: "APPLICATION_START", APP_END: "APPLICATION_END", JOB_START: "JOB_START", JOB_END: "JOB_END",
}


def message_type():
    return F.create_map(*[F.lit(x) for pair in MESSAGE_TYPES.items() for x in pair])[F.col("kind")]


@once
def all_messages(ev: DataFrame, hot: bool = True) -> DataFrame:
    return tracked(ev, hot).filter(F.col("kind").isin(*MESSAGE_TYPES)).select(
        "app_id", message_type().alias("event_type"), "job_id", *ORDER, "num_executors", "last_known"
    )


def responses(ev: DataFrame, sent: DataFrame, hot: bool = True) -> DataFrame:
    """The recommendation that was latest when each message was sent, if there was one."""
    keys = ["app_id"]
    if not hot:
        rows = tagged_rows(ev, answers=True).filter(F.col("kind").isin(ANSWER, *MESSAGE_TYPES))
        value = F.when(F.col("kind") == ANSWER, F.col("k") % 10 + 1)
        seen = scan(rows, keys, ORDER, last={"_r": value}).filter((F.col("kind") != ANSWER) & F.col("_r").isNotNull())
        return seen.select("app_id", message_type().alias("event_type"), "job_id", F.col("_r").alias("recommended_scale_out"))
    known = recommendations(ev).select(
        "app_id", "t_ms", F.lit(-1).alias("rank"), "seq", "recommended_scale_out"
    )
    rows = sent.select("app_id", *ORDER, "event_type", "job_id").unionByName(known, allowMissingColumns=True)
    seen = scan(
        blocked(rows, keys, ORDER[0], hot), keys, ORDER, last={"_r": F.col("recommended_scale_out")}
    )
    return seen.filter("event_type is not null and _r is not null").select(
        "app_id", "event_type", "job_id", F.col("_r").alias("recommended_scale_out")
    )


@once
def stage_events(ev: DataFrame, hot: bool = True) -> DataFrame:
    """Submits of all stages in a job, and completions of those done by the job's end."""
    placed = stages(ev, hot).filter("job_id >= 0")
    rows = [_kind(SUBMIT), F.when(F.col("complete_ms") <= F.col("end_ms"), _kind(COMPLETE))]
    return placed.select(
        "app_id", "job_id", "stage_id", F.col("submit_seq").alias("seq"), "submit_ms", "complete_ms",
        "end_ms", "k", F.explode(F.array_compact(F.array(*rows))).alias("kind"),
    )


def _kind(kind: str):
    return F.lit(kind)


def stage_rows(spark: SparkSession, sf_dir: str, ev: DataFrame, hot: bool = True) -> DataFrame:
    """Stage features of the ended jobs whose stages are all complete."""
    all_events = stage_events(ev, hot)
    whole = stage_ops.complete_jobs(all_events, jobs(ev, hot).filter("end_ms is not null"))
    described = all_events.join(whole.select("app_id", "job_id"), ["app_id", "job_id"], "left_semi")
    described = described.select(
        "*", F.concat(F.lit("view at "), F.col("stage_id").cast("string")).alias("stage_name"),
        F.col("k").alias("num_tasks"), F.array(F.col("stage_id") - 1).alias("parent_stage_ids"),
        F.lit(0).alias("attempt_id"), F.when(F.col("k") % 13 == 0, "lost executor").alias("failure_reason"),
    )
    known = tracked(ev, hot).filter(F.col("kind").isin(SUBMIT, COMPLETE)).select(
        "app_id", "seq", "kind", "last_known"
    )
    described = described.join(known, ["app_id", "seq", "kind"])
    ratios = rescaling.rescaling_time_ratio(
        rescaling.stage_windows(stage_times(ev)),
        executor_events(ev), hot=hot,
    ).select("app_id", "stage_id", "rescaling_time_ratio")
    of_stage = stage_times(ev).select("app_id", "stage_id")
    rdd_totals = stage_ops.stage_rdd_totals(rdds(spark, sf_dir).drop("stage_id"), ["job_id"])
    totals = stage_ops.RDD_TOTALS
    described = (
        described.join(ratios, ["app_id", "stage_id"])
        .join(rdd_totals.withColumnRenamed("job_id", "stage_id"), "stage_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in totals})
    )
    metrics = stage_ops.stage_metric_ratios(
        stage_ops.stage_task_totals(tasks(spark, sf_dir).drop("stage_id"), ["job_id"])
    ).withColumnRenamed("job_id", "stage_id").join(of_stage, "stage_id").withColumn("attempt_id", F.lit(0))
    return stage_ops.stage_features(described, metrics, hot=hot)


def tagged_rows(ev: DataFrame, answers: bool = False) -> DataFrame:
    """The timeline with what its stages carry, from one pass over the events of each application."""
    order = Window.partitionBy("app_id").orderBy("seq")
    purchase = F.col("et") == "purchase"
    placed = ev.filter(F.col("app_id").isNotNull()).withColumns({
        "job_id": F.sum(purchase.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int") - 1,
        "_first": F.lag("seq").over(order).isNull(), "_last": F.lead("seq").over(order).isNull(),
    })

    def event(kind: str, when, t_ms="t_ms", job=None, stage=None, delta=None, initial=None):
        def of(value, type_):
            return (F.lit(None) if value is None else value).cast(type_)

        return F.when(when, F.struct(
            F.col(t_ms).alias("t_ms"), F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"),
            of(job, "int").alias("job_id"), of(stage, "long").alias("stage_id"), of(delta, "int").alias("delta"),
            of(initial, "int").alias("initial"),
        ))

    et, job, stage = F.col("et"), F.col("job_id"), F.col("seq")
    events = [
        event(APP_START, F.col("_first"), initial=F.lit(INITIAL)), event(APP_END, F.col("_last")),
        event(EXECUTOR, et.isin("signup", "error"), delta=F.when(et == "signup", 1).otherwise(-1)),
        event(JOB_END, purchase & (job > 0), job=job - 1), event(JOB_START, purchase, job=job),
        event(SUBMIT, et == "view", job=job, stage=stage),
        event(COMPLETE, et == "view", "complete_ms", job=job, stage=stage),
    ]
    if answers:
        events.append(event(ANSWER, et == "click"))
    placed = placed.withColumn("complete_ms", done_ms())
    rows = placed.select(
        "app_id", "seq", F.col("t_ms").alias("submit_ms"), "complete_ms", "k", F.inline(F.array_compact(F.array(*events))))
    return rows.withColumns({
        "stage_name": F.concat(F.lit("view at "), F.col("stage_id").cast("string")), "num_tasks": F.col("k"),
        "parent_stage_ids": F.array(F.col("stage_id") - 1), "attempt_id": F.lit(0),
        "failure_reason": F.when(F.col("k") % 13 == 0, "lost executor"),
    })


def stage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and RDD totals of each stage from one pass over the tasks, the ratios worked out."""
    whole = tasks(spark, sf_dir, [F.col(c) for c in ("l_quantity", "l_linenumber", "l_extendedprice", "l_partkey")])
    line = whole.withColumns({
        "num_partitions": F.col("l_quantity").cast("long"), "num_cached_partitions": F.col("l_linenumber").cast("long"),
        "mem_size": F.round(F.col("l_extendedprice") * 100).cast("long"), "disk_size": F.col("l_partkey"),
    })
    totals = [F.sum(c).alias(c) for c in stage_ops.COUNTERS]
    totals += [F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in stage_ops.RDD_TOTALS.items()]
    return line.groupBy("job_id").agg(*totals).select("job_id", *stage_ops.RDD_TOTALS, *stage_ops.metric_ratios())


def job_end_stages(spark: SparkSession, sf_dir: str, ev: DataFrame) -> DataFrame:
    """Job ends with their stages by the fused pass: the rows of ``job_ends`` and ``stage_rows`` joined."""
    described = fused.described_events(tagged_rows(ev), ORDER, base=INITIAL)
    in_time = lambda end: (F.col("kind") == SUBMIT) | (F.col("complete_ms") <= end["t_ms"])
    rows = fused.job_stages(described, in_time)
    totals = stage_totals(spark, sf_dir)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in stage_ops.RDD_TOTALS]
    zero += [F.coalesce(c, F.lit(0.0)).alias(c) for c in stage_ops.RATIOS]
    kept = [c for c in rows.columns if c != "_done_id"]
    return rows.join(totals.withColumnRenamed("job_id", "_done_id"), "_done_id", "left").select(*kept, *zero)


def job_ends(ev: DataFrame, hot: bool = True) -> DataFrame:
    """Ended jobs with executor count and the ratio of the whole time since the application's start."""
    ended = jobs(ev, hot).filter("end_ms is not null")
    windows = rescaling.job_windows(ended, app_bounds(ev).select("app_id", "app_start_ms"))
    ratio = rescaling.rescaling_time_ratio(windows, executor_events(ev), hot=hot)
    counts = messages.ended_jobs(tracked(ev, hot))
    return ratio.select("app_id", "job_id", "rescaling_time_ratio").join(counts, ["app_id", "job_id"])


@once
def listings(ev: DataFrame, hot: bool = True) -> DataFrame:
    """Stage numbers (ten per application) that each job lists when it starts."""
    numbers = stages(ev, hot).filter("job_id >= 0").select(
        "app_id", "job_id", (F.col("k") % 10).alias("stage_id")
    ).distinct()
    starts = jobs(ev, hot).select("app_id", "job_id", F.col("start_seq").alias("seq"))
    return numbers.join(starts, ["app_id", "job_id"])


def clicked_stages(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("et") == "click").select("app_id", "seq", (F.col("k") % 10).alias("stage_id"))


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, text = F.col("p_size"), (lambda c: c.cast("string"))
    listener, env = "spark.customExtraListener.", "spark.customExtraListener.env."
    always = F.lit(True)
    name = F.when(size % 4 == 0, F.col("p_type")).otherwise(
        F.concat("p_type", F.lit(" with Params("), "p_brand", F.lit(", "), text(size), F.lit(")"))
    )
    entries = [
        ("spark.app.name", name, always),
        ("spark.executor.memory", F.concat(text(size), F.lit("G")), always),
        ("spark.executor.memoryOverhead", F.lit("2G"), size % 3 == 0),
        ("spark.executor.cores", text(size % 8 + 1), always),
        ("spark.driver.cores", text(size % 4 + 1), size % 7 != 0),
        ("spark.driver.memory", F.concat(text(size % 6 + 1), F.lit(".5g")), always),
        ("spark.dynamicAllocation.enabled", F.lit("true"), size % 11 != 0),
        (listener + "isAdaptive", F.when(size % 3 == 0, "true").otherwise("FALSE"), size % 3 != 2),
        (listener + "isTraining", F.lit("true"), size % 4 == 1),
        (listener + "bridgeServiceAddress", F.concat(F.lit("tcp://"), "p_brand"), always),
        (listener + "datasizeMb", text(F.col("p_retailprice") / 1000), size % 5 != 0),
        (listener + "targetRuntime", text(size * 1000), size % 13 != 0),
        (listener + "minExecutors", F.lit("2"), always),
        (listener + "maxExecutors", F.when(size % 19 == 0, "many").otherwise(text(size % 10 + 2)), always),
        (env + "hadoopVersion", F.lit("3.3.4"), size % 17 != 0),
        (env + "sparkVersion", F.lit("3.5.3"), always),
        (env + "scalaVersion", F.lit("2.12.18"), always),
        (env + "javaVersion", F.concat(F.lit("1.8.0_"), text(size)), always),
    ]
    structs = [
        F.when(cond, F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v, cond in entries
    ]
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"), F.inline(F.array_compact(F.array(*structs)))
    )


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.alias("host"), F.concat(F.lit("OS "), "n_name").alias("os"), (key % 16 + 1).alias("cores"),
        ((key + 1).cast("long") * 1073741824).alias("memory_bytes"),
    )


def host_disks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("host"),
        (F.round(F.abs("s_acctbal") * 100).cast("long") * 1000000).alias("disk_bytes"),
    )


def answer_lines(ev: DataFrame) -> DataFrame:
    """Answers of the recommender as text; some are no JSON, lack a field or hold the wrong type."""
    app, k = F.col("app_id").cast("string"), F.col("k")
    head = F.concat(F.lit('{"app_event_id":"'), app, F.lit('"'))
    line = (
        F.when(k % 10 == 3, F.lit("timeout"))
        .when(k % 10 == 4, F.concat(head, F.lit("}")))
        .when(k % 10 == 5, F.concat(head, F.lit(',"recommended_scale_out":"x"}')))
        .otherwise(F.concat(head, F.lit(',"recommended_scale_out":'), (k % 10 + 1).cast("string"), F.lit("}")))
    )
    return ev.filter(F.col("et") == "click").select(line.alias("value"))


def message_answer_lines(answers: DataFrame) -> DataFrame:
    """One line for each answer, and a later, different one as a second answer to the same message."""
    first = answers.select(
        F.col("app_id").cast("string").alias("app_event_id"), "event_type", "job_id",
        F.lit(0).cast("long").alias("answered_ms"), "recommended_scale_out",
    )
    again = first.withColumns({
        "answered_ms": F.col("answered_ms") + 1, "recommended_scale_out": F.col("recommended_scale_out") + 1,
    })
    return first.union(again).select(F.to_json(F.struct(*first.columns)).alias("value"))


# Event log lines derived from the events table.

# Places of the lines that share a millisecond.
PLACE = {
    "LogStart": -5, "EnvironmentUpdate": -4, "ApplicationStart": -3, "StageCompleted": -1, "JobEnd": 1,
    "JobStart": 2, "ApplicationEnd": 9,
}


def _line(event: str, at, **fields):
    named = [value.alias(name.replace("_", " ")) for name, value in fields.items()]
    value = F.to_json(F.struct(F.lit("SparkListener" + event).alias("Event"), *named))
    return F.struct(
        at.alias("at_ms"), F.lit(PLACE.get(event, 0)).alias("place"), F.col("seq"), value.alias("value")
    )


def log_lines(ev: DataFrame, hot: bool = True) -> DataFrame:
    """The lines a Spark event log would hold for the events: app_id, at_ms, place, seq, value."""
    app, t, k, seq, et = F.col("app_id").cast("string"), F.col("t_ms"), F.col("k"), F.col("seq"), F.col("et")
    done = done_ms()
    stage = [
        seq.alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
        F.concat(F.lit("view at "), seq.cast("string")).alias("Stage Name"), k.alias("Number of Tasks"),
        F.array(seq - 1).alias("Parent IDs"), t.alias("Submission Time"),
    ]
    outcome = [
        done.alias("Completion Time"), F.when(k % 13 == 0, "lost executor").alias("Failure Reason"),
        F.array(F.struct(k.alias("Number of Partitions"), (k % 3).alias("Number of Cached Partitions"),
                         (k * 10).alias("Memory Size"), (k * 20).alias("Disk Size"))).alias("RDD Info"),
    ]
    host = F.struct(F.concat(F.lit("host-"), (k % 10).cast("string")).alias("Host"))
    metrics = F.struct(
        k.alias("Executor Run Time"), seq.alias("Executor CPU Time"), (k % 5).alias("JVM GC Time"),
        F.struct((k % 4).alias("Remote Bytes Read"), (k % 6).alias("Local Bytes Read"))
        .alias("Shuffle Read Metrics"),
        F.struct((k % 8).alias("Bytes Read")).alias("Input Metrics"),
    )
    name = k.cast("string")
    lines = F.array(
        F.when(et == "signup", _line("ExecutorAdded", t, Timestamp=t, Executor_ID=name, Executor_Info=host)),
        F.when(et == "error", _line("ExecutorRemoved", t, Timestamp=t, Executor_ID=name)),
        F.when(et == "view", _line("StageSubmitted", t, Stage_Info=F.struct(*stage))),
        F.when(et == "view", _line("StageCompleted", done, Stage_Info=F.struct(*stage, *outcome))),
        F.when(et == "click", _line("TaskEnd", t, Stage_ID=k % 10, Stage_Attempt_ID=F.lit(0), Task_Metrics=metrics)),
    )
    own = ev.filter(et != "purchase").select("app_id", F.inline(F.array_compact(lines)))

    # The format itself puts all stages of a job into the line of its start.
    listed = stages(ev, hot).filter("job_id >= 0").groupBy("app_id", "job_id").agg(
        F.sort_array(F.collect_list("stage_id")).alias("ids")
    )
    infos = F.transform(
        F.coalesce("ids", F.array().cast("array<bigint>")), lambda i: F.struct(i.alias("Stage ID"))
    )
    job, start, end = F.col("job_id"), F.col("start_ms"), F.col("end_ms")
    job_lines = F.array(
        _line("JobStart", start, Job_ID=job, Submission_Time=start, Stage_Infos=infos),
        F.when(end.isNotNull(), _line("JobEnd", end, Job_ID=job, Completion_Time=end,
                                      Job_Result=F.struct(F.lit("JobSucceeded").alias("Result")))),
    )
    of_jobs = jobs(ev, hot).withColumnRenamed("start_seq", "seq").join(
        listed, ["app_id", "job_id"], "left"
    ).select("app_id", F.inline(F.array_compact(job_lines)))

    properties = F.create_map(
        F.lit("spark.app.name"), F.concat(F.lit("app "), app),
        F.lit("spark.executor.cores"), (F.col("app_id") % 8 + 1).cast("string"),
    )
    first, last = F.col("app_start_ms"), F.col("app_end_ms")
    app_lines = F.array(
        _line("LogStart", first, Spark_Version=F.lit("4.1.2")),
        _line("EnvironmentUpdate", first, Spark_Properties=properties),
        _line("ApplicationStart", first, App_ID=app, App_Name=F.concat(F.lit("app "), app), Timestamp=first),
        _line("ApplicationEnd", F.col("quiet_ms"), Timestamp=last),
    )
    quiet = ev.groupBy("app_id").agg(F.max(F.when(et == "view", done).otherwise(t)).alias("quiet_ms"))
    bounds = app_bounds(ev).withColumnRenamed("start_seq", "seq").join(quiet, "app_id")
    return own.unionByName(of_jobs).unionByName(bounds.select("app_id", F.inline(app_lines)))


def write_log(ev: DataFrame, path: str, hot: bool = True, segments: int = 1, segment: int = 0) -> None:
    """Write one segment in time of every application's log, as a collector ships them: many logs in a file.

    Lines of a log lie together, in order. A segment of a large application spans several files, in the order of their
    names.
    """
    lines = log_lines(ev, hot)
    if segments > 1:
        low, high = ev.agg(F.min("t_ms"), F.max("t_ms")).first()
        width = (high - low) // segments + 1
        place = F.least(F.floor((F.col("at_ms") - low) / width), F.lit(segments - 1))
        lines = lines.filter(place == segment)
    order = ["app_id", "at_ms", "place", "seq"]
    log = F.coalesce(F.col("app_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    log_path = F.concat(F.lit("/log="), log, F.lit(f"/roll={segment}"))
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(
        event_log.shipped(log_path, F.col("value"))
    ).write.mode("append").text(path)
