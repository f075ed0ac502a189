"""Every operator as a query over the test tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescale.functions import expr
from telescale.operators import decisions, messages, rescaling, scaleout, specs, stages
from telescale.plans import bindings as b
from telescale.plans import live
from telescale.plans.fleet import fleet_tables, has_hot_logs
from telescale.session import shared_dir
from telescale.sources import event_log, message_sink, recommendations
from telescale.streaming import tables

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    ev = b.events(spark, sf)
    return ev, b.is_hot(ev)


# --- projections, filters -------------------------------------------------------------------------


def _app_starts(spark, sf):
    size = b.table(spark, sf, "part").select(
        F.col("p_partkey").alias("app_id"), (F.col("p_partkey") * 1000).alias("app_time"),
        (F.col("p_partkey") % 25).alias("host"),
    )
    machines = specs.machine_types(b.hosts(spark, sf), b.host_disks(spark, sf))
    return messages.app_start_records(size, specs.app_config_lookup(b.config(spark, sf)), machines)


@query
def app_start_records(spark, sf):
    return _app_starts(spark, sf).select(
        "application_id", "app_name", "app_time", "is_adaptive", "is_training",
        "app_specs.algorithm_name", F.array_join("app_specs.algorithm_args", "|").alias("algorithm_args"),
        "app_specs.datasize_mb", "app_specs.target_runtime", "app_specs.min_executors",
        "app_specs.max_executors",
        *[F.col(f"{n}_specs.{c}").alias(f"{n}_{c}") for n in ("driver", "executor")
          for c in ("cores", "memory", "memory_overhead")],
        "environment_specs.*",
    )


@query
def job_start_records(spark, sf):
    ev, hot = _events(spark, sf)
    return messages.job_start_records(b.tracked(ev, hot))


@query
def app_end_records(spark, sf):
    ev, hot = _events(spark, sf)
    return messages.app_end_records(b.tracked(ev, hot))


@query
def missing_required_config(spark, sf):
    apps = b.table(spark, sf, "part").select(F.col("p_partkey").alias("app_id"))
    silent = apps.select((-1 - F.col("app_id")).alias("app_id"))  # as many applications without any setting
    return specs.missing_required_config(apps.union(silent), b.config(spark, sf))


@query
def non_driver_executors(spark, sf):
    ev = b.events(spark, sf)
    k = F.col("k")
    address = F.concat(F.lit("host-"), (k % 10).cast("string"), F.lit(":"), (7000 + k).cast("string"))
    executors = ev.filter(F.col("et") == "signup").select("app_id", "seq", address.alias("address"))
    hosts = ev.groupBy("app_id").agg(
        F.concat(F.lit("host-"), (F.col("app_id") % 10).cast("string")).alias("driver_host")
    )
    return scaleout.non_driver_executors(executors, hosts)


@query
def invalid_responses(spark, sf):
    path = shared_dir(spark, "answers")
    b.answer_lines(b.events(spark, sf)).write.text(path)
    return recommendations.invalid_responses(recommendations.read_lines(spark, path))


def _typed_messages(spark, sf):
    names = {
        "purchase": "JOB_START", "view": "JOB_END", "signup": "APPLICATION_START",
        "error": "APPLICATION_END", "click": "CLICK",
    }
    event_type = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("et")]
    return b.events(spark, sf).select("app_id", "seq", event_type.alias("event_type"))


@query
def event_type_filter(spark, sf):
    return messages.event_type_filter(_typed_messages(spark, sf))


@query
def illegal_event_types(spark, sf):
    return messages.illegal_event_types(_typed_messages(spark, sf))


@query
def incomplete_stage_events(spark, sf):
    ev, hot = _events(spark, sf)
    kinds = F.explode(F.array(F.lit(scaleout.SUBMIT), F.lit(scaleout.COMPLETE)))
    rows = b.stages(ev, hot).select(
        "app_id", "stage_id", kinds.alias("kind"),
        F.when(F.col("k") % 11 != 0, F.col("submit_ms")).alias("submit_ms"),
        F.when(F.col("k") % 7 != 0, F.col("complete_ms")).alias("complete_ms"),
    )
    return stages.incomplete_stage_events(rows)


@query
def adaptive_training_flags(spark, sf):
    return specs.app_config_lookup(b.config(spark, sf)).select("app_id", *specs.adaptive_training_flags())


def _effective(spark, sf):
    ev, hot = _events(spark, sf)
    sent = b.all_messages(ev, hot)
    matched = decisions.response_match(sent, b.responses(ev, sent, hot))
    return ev, hot, decisions.effective_recommendation(matched)


_MESSAGE = ("app_id", "event_type", "job_id", "t_ms", "seq", "num_executors", "last_known")


@query
def scale_change_candidates(spark, sf):
    _, _, effective = _effective(spark, sf)
    return decisions.scale_change_candidates(effective).select(*_MESSAGE, "effective_scale_out")


# --- joins ----------------------------------------------------------------------------------------


@query
def stage_job_mapping(spark, sf):
    ev, hot = _events(spark, sf)
    return stages.stage_job_mapping(b.listings(ev, hot), b.clicked_stages(ev), hot=hot)


@query
def last_known_asof(spark, sf):
    ev, hot = _events(spark, sf)
    return scaleout.last_known_asof(b.tracked(ev, hot)).select(
        "app_id", "stage_id", "kind", "t_ms", "last_known"
    )


@query
def stage_pairing(spark, sf):
    ev, hot = _events(spark, sf)
    return stages.stage_pairing(b.stage_events(ev, hot), hot=hot).select(
        "app_id", "job_id", "position", F.col("submit.stage_id").alias("submit_stage_id"),
        F.col("complete.stage_id").alias("complete_stage_id"),
    )


@query
def stage_rescaling_ratio(spark, sf):
    ev, hot = _events(spark, sf)
    windows = rescaling.stage_windows(b.stage_times(ev))
    ratio = rescaling.rescaling_time_ratio(windows, b.executor_events(ev), hot=hot)
    return ratio.select("app_id", "stage_id", "rescaling_ms", "rescaling_time_ratio")


@query
def response_match(spark, sf):
    ev, hot = _events(spark, sf)
    sent = b.all_messages(ev, hot)
    return decisions.response_match(sent, b.responses(ev, sent, hot)).select(
        *_MESSAGE, "recommended_scale_out"
    )


@query
def orphan_stages(spark, sf):
    ev, hot = _events(spark, sf)
    mapped = stages.stage_job_mapping(b.listings(ev, hot), b.clicked_stages(ev), hot=hot)
    return stages.orphan_stages(mapped).select("app_id", "seq", "stage_id")


@query
def jobs_without_stages(spark, sf):
    orders = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"))
    return stages.jobs_without_stages(orders, b.tasks(spark, sf), ["job_id"])


@query
def app_config_lookup(spark, sf):
    settings = specs.app_config_lookup(b.config(spark, sf)).select(
        "app_id", specs.setting("spark.executor.memory").alias("executor_memory"),
        specs.setting("spark.customExtraListener.targetRuntime").alias("target_runtime"),
    )
    line = b.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("app_id"), F.col("l_orderkey").alias("job_id"), "l_linenumber"
    )
    return line.join(settings, "app_id")


# --- aggregations ---------------------------------------------------------------------------------


@query
def alive_executor_count(spark, sf):
    ev, hot = _events(spark, sf)
    return scaleout.alive_executor_count(b.executor_events(ev), initial=b.INITIAL, hot=hot)


@query
def stage_task_totals(spark, sf):
    return stages.stage_task_totals(b.tasks(spark, sf), ["job_id", "stage_id"])


@query
def stage_metric_ratios(spark, sf):
    return stages.stage_metric_ratios(stages.stage_task_totals(b.tasks(spark, sf), ["job_id", "stage_id"]))


@query
def stage_rdd_totals(spark, sf):
    return stages.stage_rdd_totals(b.rdds(spark, sf), ["job_id", "stage_id"])


def _job_ratio(spark, sf, window_start):
    ev, hot = _events(spark, sf)
    ended = b.jobs(ev, hot).filter("end_ms is not null").select("app_id", "job_id", "end_ms")
    windows = rescaling.job_windows(ended, b.app_bounds(ev), window_start)
    ratio = rescaling.rescaling_time_ratio(windows, b.executor_events(ev), hot=hot)
    return ratio.select("app_id", "job_id", "rescaling_ms", "rescaling_time_ratio")


@query
def job_rescaling_ratio(spark, sf):
    return _job_ratio(spark, sf, "app_start")


@query
def job_rescaling_ratio_from_zero(spark, sf):
    return _job_ratio(spark, sf, "zero")


def _job_end_stages(spark, sf):
    """Job ends with their stages: in one pass, or in blocks where an application is too large for a task."""
    ev, hot = _events(spark, sf)
    if hot:
        return messages.job_end_rows(b.job_ends(ev, hot), b.stage_rows(spark, sf, ev, hot))
    return b.job_end_stages(spark, sf, ev)


@query
def stage_features(spark, sf):
    ev, hot = _events(spark, sf)
    if hot:
        rows = b.stage_rows(spark, sf, ev, hot)
    else:
        rows = b.job_end_stages(spark, sf, ev).drop("app_time", "num_executors", "rescaling_time_ratio")
        rows = rows.withColumnRenamed("stage_rescaling_time_ratio", "rescaling_time_ratio")
    return rows.withColumn("parent_stage_ids", F.array_join("parent_stage_ids", ","))


@query
def job_end_records(spark, sf):
    rows = _job_end_stages(spark, sf)
    return rows.withColumn("parent_stage_ids", F.array_join("parent_stage_ids", ","))


@query
def stage_count_mismatch(spark, sf):
    ev, hot = _events(spark, sf)
    return stages.stage_count_mismatch(b.stage_events(ev, hot))


@query
def effective_recommendation(spark, sf):
    _, _, effective = _effective(spark, sf)
    return effective.select(*_MESSAGE, "effective_scale_out", "status")


def _numbered(spark, sf):
    ev, hot = _events(spark, sf)
    rows = b.stages(ev, hot).filter("job_id >= 0").select(
        "app_id", "job_id", (F.col("k") % 10).alias("stage_id"), F.col("submit_seq").alias("seq")
    )
    return stages.stage_order_in_job(rows, hot=hot)


@query
def latest_attempt_per_stage(spark, sf):
    return stages.latest_attempt_per_stage(_numbered(spark, sf))


@query
def host_disk_total(spark, sf):
    return specs.host_disk_total(b.host_disks(spark, sf))


# --- windows --------------------------------------------------------------------------------------


@query
def scale_out_intervals(spark, sf):
    ev, hot = _events(spark, sf)
    points = scaleout.alive_executor_count(b.executor_events(ev), initial=b.INITIAL, hot=hot)
    return scaleout.scale_out_intervals(points, hot=hot)


@query
def interior_intervals(spark, sf):
    ev, hot = _events(spark, sf)
    windows = rescaling.stage_windows(b.stage_times(ev))
    counted = rescaling.interior_intervals(windows, b.executor_events(ev), hot=hot)
    return counted.select("app_id", "stage_id", "n_overlapping", "n_interior")


@query
def last_known_timeline(spark, sf):
    ev, hot = _events(spark, sf)
    return scaleout.last_known_timeline(b.tracked(ev, hot)).select(
        "app_id", "seq", "kind", "t_ms", "last_known"
    )


@query
def stage_order_in_job(spark, sf):
    return _numbered(spark, sf)


@query
def scale_decisions(spark, sf):
    ev, hot, effective = _effective(spark, sf)
    candidates = decisions.scale_change_candidates(effective)
    decided = decisions.scale_decisions(candidates, b.app_bounds(ev), b.ORDER, hot=hot)
    return decided.select(
        "app_id", "event_type", "job_id", "t_ms", "effective_scale_out", "waited_ms", "decision"
    )


@query
def answers_to_decisions(spark, sf):
    """The same decisions from answers that were written as text and read again."""
    ev, hot = _events(spark, sf)
    sent = b.all_messages(ev, hot)
    path = shared_dir(spark, "answers")
    b.message_answer_lines(b.responses(ev, sent, hot)).write.text(path)
    apps = b.app_bounds(ev).select(F.col("app_id").cast("string").alias("app_event_id"), "app_id")
    answers = recommendations.scan_answers(recommendations.read_lines(spark, path), apps)
    matched = decisions.response_match(sent, answers, "answered_ms")
    candidates = decisions.scale_change_candidates(decisions.effective_recommendation(matched))
    decided = decisions.scale_decisions(candidates, b.app_bounds(ev), b.ORDER, hot=hot)
    return decided.select("app_id", "event_type", "job_id", "t_ms", "effective_scale_out", "waited_ms", "decision")


@query
def initial_scale_requests(spark, sf):
    _, _, effective = _effective(spark, sf)
    return decisions.initial_scale_requests(effective).select(
        "app_id", "t_ms", "effective_scale_out", "decision"
    )


# --- scalar expressions ---------------------------------------------------------------------------


@query
def safe_ratio(spark, sf):
    return b.tasks(spark, sf).select(
        "job_id", "stage_id", "shuffle_read", "shuffle_write",
        expr.safe_ratio(F.col("shuffle_read"), F.col("shuffle_write")).alias("ratio"),
    )


def _settings(spark, sf):
    return specs.app_config_lookup(b.config(spark, sf))


@query
def algorithm_and_args(spark, sf):
    name = specs.setting("spark.app.name")
    return _settings(spark, sf).select(
        "app_id", expr.algorithm_name(name).alias("algorithm_name"),
        F.array_join(expr.algorithm_args(name), "|").alias("algorithm_args"),
        F.size(expr.algorithm_args(name)).alias("n_args"),
    )


@query
def datasize_mb(spark, sf):
    text = specs.setting("spark.customExtraListener.datasizeMb")
    return _settings(spark, sf).select("app_id", expr.datasize_mb(text).alias("datasize_mb"))


@query
def memory_overhead(spark, sf):
    overhead = expr.memory_overhead(
        specs.setting("spark.executor.memoryOverhead"), specs.setting("spark.executor.memory")
    )
    return _settings(spark, sf).select("app_id", overhead.alias("memory_overhead"))


@query
def app_specs(spark, sf):
    flat = _settings(spark, sf).select("app_id", specs.app_specs().alias("s")).select("app_id", "s.*")
    return flat.withColumn("algorithm_args", F.array_join("algorithm_args", "|"))


@query
def node_specs(spark, sf):
    roles = F.array(*[
        F.struct(F.lit(r).alias("role"), specs.node_specs(r).alias("s")) for r in ("driver", "executor")
    ])
    return _settings(spark, sf).select("app_id", F.inline(roles)).select("app_id", "role", "s.*")


@query
def unreadable_settings(spark, sf):
    return specs.unreadable_settings(b.config(spark, sf))


@query
def machine_type(spark, sf):
    return specs.machine_types(b.hosts(spark, sf), b.host_disks(spark, sf))


@query
def interval_clip(spark, sf):
    ev, hot = _events(spark, sf)
    day = 86400000
    gaps = scaleout.scale_out_intervals(b.executor_events(ev), hot=hot)
    bounds = b.app_bounds(ev).select("app_id", "app_start_ms")
    start = F.col("app_start_ms")
    clipped = expr.interval_clip(F.col("t_ms"), F.col("interval_ms"), start + 10 * day, start + 20 * day)
    return gaps.join(bounds, "app_id").select("app_id", "seq", clipped.alias("clipped_ms"))


def _reasons(spark, sf):
    return b.events(spark, sf).filter(F.col("et") == "view").select(
        "app_id", F.col("seq").alias("stage_id"), F.when(F.col("k") % 13 == 0, "lost executor").alias("reason")
    )


@query
def failure_reason_default(spark, sf):
    return _reasons(spark, sf).select(
        "app_id", "stage_id", expr.failure_reason(F.col("reason")).alias("failure_reason")
    )


@query
def stage_id_text(spark, sf):
    return _reasons(spark, sf).select("app_id", expr.stage_key(F.col("stage_id")).alias("stage_id"))


@query
def environment_versions(spark, sf):
    return _settings(spark, sf).select("app_id", *specs.environment_versions())


# --- sources and sinks ----------------------------------------------------------------------------


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark, sf, name, write) -> str:
    """The folder that ``write`` filled, once per session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        path = shared_dir(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def log_folder(spark, sf) -> str:
    """Logs written from the events table."""
    ev, hot = _events(spark, sf)
    return _once(spark, sf, "logs", lambda path: b.write_log(ev, path, hot))


def parse_log(spark, sf) -> DataFrame:
    """All lines of these logs, read and parsed anew."""
    return event_log.parse_lines(event_log.read_lines(spark, log_folder(spark, sf)))


def _parsed(spark, sf):
    """The parsed lines as a table."""
    return event_log.read_parsed(
        spark, _once(spark, sf, "parsed", lambda path: event_log.write_parsed(parse_log(spark, sf), path)))


@query
def scan_app_events(spark, sf):
    return event_log.scan_app_events(_parsed(spark, sf))


@query
def scan_job_events(spark, sf):
    rows = event_log.scan_job_events(_parsed(spark, sf))
    return rows.withColumn("stage_ids", F.array_join("stage_ids", ","))


@query
def scan_stage_events(spark, sf):
    rows = event_log.scan_stage_events(_parsed(spark, sf))
    return rows.withColumn("parent_stage_ids", F.array_join("parent_stage_ids", ","))


@query
def scan_executor_events(spark, sf):
    return event_log.scan_executor_events(_parsed(spark, sf))


@query
def scan_task_metrics(spark, sf):
    return event_log.scan_task_metrics(_parsed(spark, sf))


@query
def scan_task_totals(spark, sf):
    return event_log.task_totals(_parsed(spark, sf))


@query
def scan_app_config(spark, sf):
    return event_log.scan_app_config(_parsed(spark, sf))


@query
def scan_versions(spark, sf):
    return event_log.scan_versions(_parsed(spark, sf))


def _fleet(spark, sf):
    parsed = _parsed(spark, sf)
    apps = event_log.scan_app_events(parsed).select("app_id").distinct()
    return fleet_tables(parsed, apps.withColumn("initial", F.lit(b.INITIAL)), has_hot_logs(parsed), b.INITIAL)


@query
def fleet_job_end_rows(spark, sf):
    """Job ends with their stages, all the way from the log."""
    return _fleet(spark, sf)["job_end_rows"].select(
        "app_id", "job_id", "app_time", "num_executors", "rescaling_time_ratio",
        F.col("stage_id").cast("int").alias("stage_id"), "stage_name", "num_tasks",
        F.array_join("parent_stage_ids", ",").alias("parent_stage_ids"), "attempt_id", "failure_reason",
        F.col("start_time").alias("submit_ms"), F.col("end_time").alias("complete_ms"), "start_scale_out",
        "end_scale_out", "stage_rescaling_time_ratio", "rdd_num_partitions", "rdd_disk_size",
    )


@query
def fleet_job_start(spark, sf):
    return _fleet(spark, sf)["job_start"]


@query
def scan_recommendations(spark, sf):
    path = shared_dir(spark, "answers")
    b.answer_lines(b.events(spark, sf)).write.text(path)
    return recommendations.scan_recommendations(recommendations.read_lines(spark, path))


@query
def sink_messages(spark, sf):
    ev, hot = _events(spark, sf)
    tracked, app = b.tracked(ev, hot), F.col("app_id").cast("string")
    rows = _job_end_stages(spark, sf)
    lines = (
        messages.message_lines(messages.job_start_records(tracked), "JOB_START", app)
        .unionByName(messages.message_lines(messages.app_end_records(tracked), "APPLICATION_END", app))
        .unionByName(messages.message_lines(messages.job_end_records(rows, hot=hot), "JOB_END", app))
        .unionByName(messages.message_lines(_app_starts(spark, sf), "APPLICATION_START"))
    )
    path = shared_dir(spark, "messages")
    message_sink.write_messages(lines, path)
    return _sent_fields(message_sink.read_messages(spark, path))


# --- streaming ------------------------------------------------------------------------------------


@query
def stream_events(spark, sf):
    parsed = live.chain(spark, sf).parsed()
    rows = event_log.with_app(parsed.drop("log_id", "e"), event_log.log_splits(parsed))
    return rows.select("app_id", "seq", "event")


@query
def stream_app_state(spark, sf):
    rows = live.chain(spark, sf).read("tracked").filter("kind not in ('environment', 'late')")
    return rows.select("app_id", "kind", "t_ms", "job_id", "num_executors", "last_known")


@query
def stream_stage_pairs(spark, sf):
    return live.chain(spark, sf).read("pairs")


@query
def stream_job_end(spark, sf):
    return live.chain(spark, sf).read("job_ends").select(
        "app_id", "job_id", "app_time", "num_executors", "rescaling_time_ratio", "stage_id", "stage_name",
        "num_tasks", F.array_join("parent_stage_ids", ",").alias("parent_stage_ids"), "attempt_id",
        "failure_reason", "submit_ms", "complete_ms", "start_scale_out", "end_scale_out",
        "stage_rescaling_time_ratio", "rdd_num_partitions", "rdd_disk_size",
    )


@query
def stream_response_timeout(spark, sf):
    return live.chain(spark, sf).read("effective").drop("seq", "message_no", "recommended_scale_out")


@query
def stream_scale_decisions(spark, sf):
    return live.chain(spark, sf).read("decisions").drop("seq")


def _sent_fields(read):
    """Fields of messages as they were written: those that tell whether the whole of each kind came through."""
    payload = (
        "app_event_id string, app_time long, job_id int, num_executors int, rescaling_time_ratio double, "
        "stages map<string, struct<stage_id string, num_tasks bigint, metrics struct<gc_time_ratio double>>>, "
        "application_id string, app_name string, driver_specs struct<cores int, memory string>, "
        "environment_specs struct<machine_type string>"
    )
    schema = f"event_type string, payload struct<{payload}>"
    read = read.select("event_type", F.from_json("value", schema).alias("m"))
    return read.select(
        "event_type", F.col("m.event_type").alias("tag"), "m.payload.app_event_id", "m.payload.app_time",
        "m.payload.job_id", "m.payload.num_executors", "m.payload.rescaling_time_ratio",
        F.when(F.col("m.payload.stages").isNotNull(), F.size("m.payload.stages")).alias("n_stages"),
        F.expr(
            "aggregate(map_values(m.payload.stages), 0L, (n, s) -> n + if(s.metrics.gc_time_ratio >= 0, s.num_tasks, 0))"
        ).alias("n_tasks"),
        "m.payload.application_id", "m.payload.app_name", F.col("m.payload.driver_specs.memory").alias("driver_memory"),
        F.col("m.payload.environment_specs.machine_type").alias("machine_type"),
    )


@query
def stream_messages(spark, sf):
    """Messages of all four kinds, each written once."""
    return _sent_fields(live.chain(spark, sf).messages())


@query
def stream_answers(spark, sf):
    """Answers read from lines as they arrive."""
    return live.chain(spark, sf).read("answered")


@query
def stream_rejects(spark, sf):
    """Lines of the recommender that are no answers, with the reason."""
    return live.chain(spark, sf).read("rejects")


@query
def stream_late_rows(spark, sf):
    """Lines read of each log, and those among them that arrived after its state was freed: none in this chain."""
    tracked = live.chain(spark, sf).read("tracked")
    counts = tracked.groupBy("log_id").agg(F.max("app_id").alias("app_id"), F.count("*").alias("n_rows"))
    late = counts.join(tables.late_rows(tracked), "log_id", "left")
    return late.select("app_id", "n_rows", F.coalesce("n_late", F.lit(0)).alias("n_late"))
