"""Session defaults and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. They are safe to apply to a session someone else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Folders are listed by at most so many tasks: the default of 10,000 is a task, and its result, for nearly every one.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts can be long: the default of 10,000 rows a batch would hold tens of megabytes on both sides.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings that only take effect when the application starts.
STATIC_CONF = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "ticktide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **STATIC_CONF}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and make checkpoint() usable."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own, because there the driver and the
    executors see the same disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="ticktide-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/ticktide/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Cut lineage through the reliable checkpoint folder, so lost executors cost no recomputation."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
