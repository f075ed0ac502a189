"""Configuration keys, defaults and limits that results depend on."""

# Settings every application must carry.
REQUIRED_KEYS = [
    "spark.driver.cores",
    "spark.driver.memory",
    "spark.executor.cores",
    "spark.executor.memory",
    "spark.dynamicAllocation.enabled",
    "spark.customExtraListener.isAdaptive",
    "spark.customExtraListener.bridgeServiceAddress",
    "spark.customExtraListener.datasizeMb",
    "spark.customExtraListener.targetRuntime",
    "spark.customExtraListener.minExecutors",
    "spark.customExtraListener.maxExecutors",
    "spark.customExtraListener.env.hadoopVersion",
    "spark.customExtraListener.env.sparkVersion",
    "spark.customExtraListener.env.scalaVersion",
    "spark.customExtraListener.env.javaVersion",
]

# Settings that are read but may be absent.
OPTIONAL_KEYS = [
    "spark.app.name",
    "spark.driver.host",
    "spark.driver.memoryOverhead",
    "spark.executor.memoryOverhead",
    "spark.customExtraListener.isTraining",
]

# The four phases a message can report.
EVENT_TYPES = ["JOB_START", "JOB_END", "APPLICATION_START", "APPLICATION_END"]

PARAMS_SEPARATOR = "with Params("
OVERHEAD_FRACTION = 0.1
MIN_REQUEST_GAP_MS = 15000
RESPONSE_TIMEOUT_MS = 30000
