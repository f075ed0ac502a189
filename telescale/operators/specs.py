"""Application, node and environment specifications from configuration rows (app_id, key, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.functions import expr
from telescale.settings import OPTIONAL_KEYS, REQUIRED_KEYS

LISTENER = "spark.customExtraListener."
ENVIRONMENT = LISTENER + "env."


def missing_required_config(apps: DataFrame, config: DataFrame) -> DataFrame:
    """Every required key an application does not set, also of applications (app_id) without any setting.

    One row per application is kept of the settings, with at most 15 keys.
    """
    present = F.collect_set(F.when(F.col("key").isin(REQUIRED_KEYS), F.col("key")))
    required = F.array(*[F.lit(k) for k in REQUIRED_KEYS])
    known = apps.select("app_id").distinct().join(config.groupBy("app_id").agg(present.alias("_present")), "app_id", "left")
    missing = F.array_except(required, F.coalesce("_present", F.array().cast("array<string>")))
    return known.select("app_id", F.explode(missing).alias("key"))


def app_config_lookup(config: DataFrame) -> DataFrame:
    """One row per application with the settings the specifications read, as a map.

    A maximum of texts is aggregated in sorted order. The rows are shuffled first, so that a task sorts those of its
    share of the applications and not all that its part of the input holds. The number of shares is set, since rows
    that compress well would be put together again to many times their size.
    """
    known = F.col("key").isin(REQUIRED_KEYS + OPTIONAL_KEYS)
    values = [
        F.max(F.when(F.col("key") == k, F.col("value"))).alias(f"_{i}")
        for i, k in enumerate(REQUIRED_KEYS + OPTIONAL_KEYS)
    ]
    entries = F.array(
        *[F.struct(F.lit(k).alias("key"), F.col(f"_{i}").alias("value"))
          for i, k in enumerate(REQUIRED_KEYS + OPTIONAL_KEYS)]
    )
    rows = config.select("app_id", "key", F.when(known, F.col("value")).alias("value"))
    shares = int(config.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = rows.repartition(shares, "app_id").groupBy("app_id").agg(*values)
    return wide.select(
        "app_id", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("settings")
    )


def setting(key: str):
    return F.try_element_at(F.col("settings"), F.lit(key))


def node_specs(role: str):
    """Struct of cores, memory and memory overhead of ``driver`` or ``executor``."""
    memory = setting(f"spark.{role}.memory")
    return F.struct(
        expr.whole_number(setting(f"spark.{role}.cores")).alias("cores"),
        memory.alias("memory"),
        expr.memory_overhead(setting(f"spark.{role}.memoryOverhead"), memory).alias("memory_overhead"),
    )


def app_specs():
    name = setting("spark.app.name")
    return F.struct(
        expr.algorithm_name(name).alias("algorithm_name"),
        expr.algorithm_args(name).alias("algorithm_args"),
        expr.datasize_mb(setting(LISTENER + "datasizeMb")).alias("datasize_mb"),
        expr.whole_number(setting(LISTENER + "targetRuntime")).alias("target_runtime"),
        expr.whole_number(setting(LISTENER + "minExecutors")).alias("min_executors"),
        expr.whole_number(setting(LISTENER + "maxExecutors")).alias("max_executors"),
    )


def environment_versions():
    return [
        setting(ENVIRONMENT + name).alias(column)
        for name, column in (
            ("hadoopVersion", "hadoop_version"), ("sparkVersion", "spark_version"),
            ("scalaVersion", "scala_version"), ("javaVersion", "java_version"),
        )
    ]


def adaptive_training_flags():
    return [
        expr.flag(setting(LISTENER + "isAdaptive"), True).alias("is_adaptive"),
        expr.flag(setting(LISTENER + "isTraining"), False).alias("is_training"),
    ]


def unreadable_settings(config: DataFrame) -> DataFrame:
    """Settings whose text is no number or no boolean where one is needed; specifications hold null there."""
    whole = ["spark.driver.cores", "spark.executor.cores"] + [
        LISTENER + k for k in ("targetRuntime", "minExecutors", "maxExecutors")
    ]
    flags = [LISTENER + "isAdaptive", LISTENER + "isTraining"]
    key, value = F.col("key"), F.col("value")
    bad = (
        (key.isin(whole) & value.try_cast("int").isNull())
        | ((key == LISTENER + "datasizeMb") & value.try_cast("double").isNull())
        | (key.isin(flags) & ~F.lower(value).isin("true", "false"))
    )
    return config.filter(bad)


def host_disk_total(disks: DataFrame) -> DataFrame:
    """Disk size of each host in GB."""
    gigabyte = F.lit(1024.0 * 1024 * 1024)
    return disks.groupBy("host").agg((F.sum("disk_bytes") / gigabyte).alias("disk_gb"))


def machine_types(hosts: DataFrame, disks: DataFrame) -> DataFrame:
    """Text description of each host; a host without disks has 0 GB."""
    joined = hosts.join(host_disk_total(disks), "host", "left")
    disk = F.coalesce("disk_gb", F.lit(0.0))
    text = expr.machine_type(F.col("os"), F.col("cores"), F.col("memory_bytes"), disk)
    return joined.select("host", text.alias("machine_type"))
