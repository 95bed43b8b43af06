"""SparkSession construction and the settings every job relies on."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings that change results or plans, applied to every session we build.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (warehouse, product, day) may reuse a (warehouse, product)
    # partitioning produced by the running-total window.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "mercato", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MERCATO_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to a session someone else built."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.requireAllClusterKeysForCoPartition"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is. Only when it is unset on a local master (tests) do we point it at a
    fresh scratch folder; on a cluster every executor would write its own disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="mercato-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Rows of the largest table that one task sorts; two sorts of them fit its share of an executor.
ROWS_PER_TASK = 1_000_000


def start_partitions(spark: SparkSession, rows: int) -> int:
    """Let shuffles start with a partition for every ``ROWS_PER_TASK`` of the
    largest table's ``rows`` where the session has fewer; AQE merges small ones.
    With a fixed number a task's sorts grow with the input until they spill."""
    parts, given = -(-rows // ROWS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if parts > given:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return max(parts, given)


def start_buckets(spark: SparkSession) -> int:
    """Partitions that this session's shuffles start with. A table in as many
    buckets is read without a shuffle by its key; fewer would be dealt again."""
    given = spark.conf.get("spark.sql.shuffle.partitions")
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true") != "true":
        return int(given)
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or given)


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing: dict[str, list] = {}
_removing_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Within it, the shuffle files of a job are removed on all executors once
    the job has ended. Otherwise they stay until the driver's garbage collector
    finds them, so that the shuffles of every table written so far are on disk
    at once. Threads may be within it at the same time."""
    session = spark.sparkContext.applicationId
    with _removing_lock:
        inside = _removing.setdefault(session, [0, None])
        if not inside[0]:
            inside[1] = spark.conf.get(REMOVE_SHUFFLES, "false")
            spark.conf.set(REMOVE_SHUFFLES, "true")
        inside[0] += 1
    try:
        yield
    finally:
        with _removing_lock:
            inside[0] -= 1
            if not inside[0]:
                spark.conf.set(REMOVE_SHUFFLES, inside[1])


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of parquet: enough
    shuffle partitions that each holds about ``target_partition_bytes`` (so
    sorts and hash aggregates fit in executor memory instead of spilling),
    AQE to coalesce the small ones and split skewed ones at run time."""
    parts = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
