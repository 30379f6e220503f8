"""Session settings every job relies on, and the folder for tables a job needs in between."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the plans count on. They can be set on a running session, so a caller's own
# session (notebook, cluster submit) behaves like one built here.
RUNTIME_CONF = {
    # Event times carry no zone; UTC keeps every zoned intermediate equal to them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large share of the rows is split over several tasks in every join,
    # also where that costs one more exchange after the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The rebalance hint before writes splits large and merges small output partitions.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Folders are a table's partitions: what another session wrote is seen without registering it.
    "spark.sql.hive.manageFilesourcePartitions": "false",
    # Tasks that write into few folders, as here, need no sort by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # What an execution exchanged goes when it ends, not when the driver happens to collect its garbage:
    # a job of many steps holds the exchanges of one. A plan that runs again makes them again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Row images are JSON text, which this writes in about half the bytes of the default.
    "spark.sql.parquet.compression.codec": "zstd",
}

# What a task reads of an exchange, at most: sorted, the compressed bytes take some twenty times the
# memory. Exchanges start with partitions enough for that, and small ones are merged; beyond 200
# a task would gather what it sends in memory.
_READ, _MOST_READ = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 32 << 20
_FIRST, _LEAST_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 200


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; one that reads less a task, or starts with more partitions, stays so."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_READ)) > _MOST_READ:
        spark.conf.set(_READ, f"{_MOST_READ}b")
    first = spark.conf.get(_FIRST, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(first) < _LEAST_FIRST:
        spark.conf.set(_FIRST, str(_LEAST_FIRST))
    return spark


def build_session(app: str = "tidelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session for a job of its own. ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a folder of its machine. On a cluster that would
    leave each executor with files that no other sees, so it is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return tempfile.mkdtemp(prefix=f"tidelake-{label}-")
    return f"{shared.rstrip('/')}/tidelake/{label}-{uuid.uuid4().hex}"
