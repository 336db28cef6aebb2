"""Session construction and the shared scratch location.

Everything that must survive an executor loss (stream checkpoints, stream
result tables, materialised intermediate tables) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  A folder of our own is only set
when the session has none, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings that suit the operators here at any scale: AQE re-plans joins by
# the real size of their sides (the baseline side is tiny), coalesces the
# small post-aggregation shuffles and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state off the JVM heap, and each micro-batch commits a change
    # log instead of a full state snapshot.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Sizing for the large-cluster case (~100 TB of raw rows, ~1000 executors).
# Every scan feeds a partial aggregate whose output is tiny (one row per
# series-hour or series-day per task), so big input splits cost no memory
# and cut the task count: 100 TB / 1 GiB is ~100k tasks instead of ~800k at
# the 128 MiB default.  What is shuffled afterwards is hourly-sized; AQE
# coalesces the shuffle partitions down to the advisory size.  The baseline
# side is broadcast by AQE only when its materialised size is under the
# threshold.  Stream state partitions are fixed at a query's first start by
# spark.sql.shuffle.partitions.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(1 << 30),
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "flowtally", conf: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """A session with the defaults above; ``cluster=True`` adds
    :data:`CLUSTER_CONF` and leaves the master to ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    if master and not cluster:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if shuffle_partitions and not cluster:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir``, else the context's
    checkpoint dir).  Only when neither is set in a single-machine session
    (tests) a fresh folder of our own is created and registered; a cluster
    without a shared folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:  # classic sessions only; a Spark Connect session has no context
        context = spark.sparkContext
        jdir = context._jsc.sc().getCheckpointDir()
    except (AttributeError, PySparkException):
        context = jdir = None
    if not root and jdir is not None and jdir.isDefined():
        root = jdir.get()
    if not root:
        if context is not None and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="flowtally-ckpt-")
        if context is not None:
            context.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/flowtally/{name}-{uuid.uuid4().hex[:12]}"
