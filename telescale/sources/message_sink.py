"""Messages as JSON lines in files, one folder per event type."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_messages(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``event_type, value`` rows. Rows stay where they are: no shuffle by the four types."""
    lines.select("event_type", "value").write.partitionBy("event_type").mode(mode).text(path)


KEY = ["app_event_id", "event_type", "job_id", "part"]
#: Folders that the keys of sent messages are dealt to; a batch reads those of its own applications only.
BUCKETS = 64


def _keys_of(path: str) -> str:
    return path.rstrip("/") + "_keys"


def write_once(lines: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Write the messages of a batch that were not sent before: columns of ``KEY`` and value.

    Keys are noted after their messages. A batch that is retried finds the messages it had written without a note in its
    own folder, so whatever is read again, under the same or another number, adds nothing, and nothing is ever taken back.
    """
    spark = lines.sparkSession
    bucket = F.pmod(F.xxhash64("app_event_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    whole = [F.coalesce(c, F.lit(-1)).alias(f"_{c}") for c in ("job_id", "part")]
    fresh = lines.select(*KEY, "value", bucket).dropDuplicates(KEY)
    keys, folder = _keys_of(path), f"{path}/batch={source}-{batch_id}"
    buckets = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if not buckets:
        return
    sent = _read(spark, "app_event_id string, event_type string, job_id int, part int, bucket int", keys, "parquet")
    if sent is not None:
        named = ["app_event_id", "event_type", "_job_id", "_part"]
        sent = sent.filter(F.col("bucket").isin(buckets)).select(*KEY, *whole).select(*named)
        fresh = fresh.select("*", *whole).join(sent, named, "left_anti").select(*KEY, "value", "bucket")
    fresh = fresh.persist()
    try:
        new = fresh.select("event_type", "value")
        written = _read(spark, "value string, event_type string", folder, "text")
        if written is not None:
            new = new.join(written, ["event_type", "value"], "left_anti")
        new.write.partitionBy("event_type").mode("append").text(folder)
        fresh.select(*KEY, "bucket").repartition("bucket").write.partitionBy("bucket").mode("append").parquet(keys)
    finally:
        fresh.unpersist()


def _read(spark: SparkSession, schema: str, path: str, form: str) -> DataFrame | None:
    """A table of files; None before the first one is written."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stream_messages(lines: DataFrame, make, path: str, source: str, checkpoint: str):
    """Start sending messages that ``make`` gives for each batch of ``lines``; each message is written once."""
    def send(batch: DataFrame, batch_id: int) -> None:
        write_once(make(batch), path, source, batch_id)

    return lines.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    schema = "value string, event_type string"
    return spark.read.schema(schema).text(path).select(F.col("event_type"), F.col("value"))


def read_sent(spark: SparkSession, path: str) -> DataFrame:
    """What the batches of ``stream_messages`` wrote."""
    schema = "value string, batch string, event_type string"
    read = spark.read.schema(schema).option("basePath", path).text(f"{path}/batch=*")
    return read.select("event_type", "value")
