"""The streaming chain run over logs written from the test tables, segment by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescale.plans import bindings as b
from telescale.session import STATE_STORE, shared_dir
from telescale.sources import event_log, message_sink
from telescale.streaming import tables

SEGMENTS = 2
#: How long a message waits for its answer here: all answers are there when the messages are read.
WAIT_MS = 2000


class Chain:
    """Feeds the segments one after the other; every query picks up where its checkpoint left off."""

    def __init__(self, spark: SparkSession, sf_dir: str, segments: int = SEGMENTS) -> None:
        self.spark = spark
        self.root = shared_dir(spark, "live")
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        ev = b.events(spark, sf_dir)
        hot = b.is_hot(ev)
        # A query keeps its number of state partitions for life: one per core, not one per shuffle block.
        planned = spark.conf.get("spark.sql.shuffle.partitions")
        cores = spark.sparkContext.defaultParallelism
        for segment in range(segments):
            b.write_log(ev, self.at("logs"), hot, segments, segment)
            spark.conf.set("spark.sql.shuffle.partitions", str(min(int(planned), cores)))
            try:
                self.advance()
                self.answer(segment, last=segment == segments - 1)
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", planned)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stream(self, name: str, schema: str) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(self.at(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.at(name))

    def parsed(self) -> DataFrame:
        return event_log.read_parsed(self.spark, self.at("parsed")).drop("batch", "is_task")

    def messages(self) -> DataFrame:
        return message_sink.read_sent(self.spark, self.at("messages"))

    def send(self, rows: DataFrame, make, source: str) -> None:
        checkpoint = self.at(f"checkpoints/messages-{source}")
        tables.run_available(
            self.spark, message_sink.stream_messages(rows, make, self.at("messages"), source, checkpoint)
        )

    def run(self, rows: DataFrame, name: str) -> None:
        tables.run_available(self.spark, tables.to_files(rows, self.at(name), self.at(f"checkpoints/{name}")))

    def advance(self) -> None:
        spark = self.spark
        tables.run_available(
            spark,
            tables.stream_events(spark, self.at("logs"), self.at("parsed"), self.at("checkpoints/parsed"))
        )
        parsed = tables.parsed_stream(spark, self.at("parsed"))
        events = tables.app_events(parsed, F.lit(b.INITIAL))
        self.run(tables.stream_app_state(events, base=b.INITIAL), "tracked")
        tracked = self.stream("tracked", tables.TRACKED)
        self.run(tables.stream_stage_pairs(tracked), "pairs")
        self.run(tables.stream_job_end(tracked), "job_ends")
        self.run(tables.stream_app_starts(tables.start_lines(tables.parsed_stream(spark, self.at("parsed")))), "starts")
        ends = spark.readStream.schema(self.read("job_ends").schema).parquet(self.at("job_ends"))
        self.send(tracked, tables.tracked_messages, "tracked")
        self.send(ends, tables.job_end_messages, "job_ends")
        self.send(self.stream("starts", tables.START), tables.start_messages, "starts")
        self.run(tables.message_rows(tracked), "sent")

    def answer(self, segment: int, last: bool) -> None:
        """Answers that take 0 to 44 seconds, and none to some jobs, as lines of text with bad ones among them."""
        sent = self.read("sent")
        answered = f"{self.root}/answers"
        delay = F.coalesce(F.col("job_id") * 7 % 45 * 1000, F.lit(0))
        answer = F.struct(
            F.col("app_id").alias("app_event_id"), "event_type", "job_id", (F.col("t_ms") + delay).alias("answered_ms"),
            F.coalesce(F.col("job_id") % 10 + 1, F.lit(b.INITIAL)).cast("int").alias("recommended_scale_out"),
        )
        new = sent
        if segment:
            keys = ["app_id", "event_type", "_job"]
            job = F.coalesce("job_id", F.lit(-1)).alias("_job")
            seen = self.spark.read.parquet(self.at("asked"))
            new = sent.select("*", job).join(seen.select("app_id", "event_type", job), keys, "left_anti").drop("_job")
        new = new.select("app_id", "message_no", "event_type", "job_id", "t_ms")
        lines = new.filter("job_id is null or job_id % 7 <> 3").select(F.to_json(answer).alias("value"))
        bad = new.filter("event_type = 'JOB_END' and job_id % 5 = 0").select(
            F.when(F.col("job_id") % 10 == 0, "timeout").otherwise(F.to_json(F.struct(F.col("app_id").alias("app_event_id"))))
            .alias("value"))
        lines.unionByName(bad).write.mode("append").text(answered)
        new.write.mode("append").parquet(self.at("asked"))
        arriving = tables.answer_lines(self.spark, answered)
        self.run(tables.stream_answers(arriving), "answered")
        self.run(tables.stream_rejects(arriving), "rejects")
        if not last:
            return
        answers = self.stream("answered", tables.RESPONSE)
        effective = tables.stream_response_timeout(self.stream("sent", tables.MESSAGE), answers, wait_ms=WAIT_MS)
        self.settle(effective, "effective")
        schema = self.read("effective").schema
        decided = tables.stream_scale_decisions(
            self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(self.at("effective")), wait_ms=60_000
        )
        self.run(decided, "decisions")

    def settle(self, rows: DataFrame, name: str) -> None:
        writer = tables.to_files(rows, self.at(name), self.at(f"checkpoints/{name}"))
        tables.run_settled(writer, WAIT_MS)


_CHAINS: dict[tuple[str, str], Chain] = {}


def chain(spark: SparkSession, sf_dir: str) -> Chain:
    """The chain over one folder of tables, run once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHAINS:
        _CHAINS[key] = Chain(spark, sf_dir)
    return _CHAINS[key]
