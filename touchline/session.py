"""Session construction and shared-storage helpers.

The settings here are the ones the jobs rely on at scale:

* AQE re-plans at every shuffle boundary: it coalesces small partitions,
  converts a sort-merge join into a broadcast join only when the *measured*
  size of one side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
  (a checked broadcast with the sort-merge plan as the fallback) and splits
  skewed join partitions.
* The session time zone is pinned, because month/hour/day-of-week depend on it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MiB = 1024 * 1024


def sizing_conf(input_bytes: int, partition_bytes: int = 256 * MiB) -> dict[str, str]:
    """Partition settings for jobs reading about ``input_bytes``.

    Scans are split at ``partition_bytes``; shuffles start with about one
    partition per ``partition_bytes`` of input (an upper bound: partial
    aggregation and filters shrink the data), AQE then merges partitions
    below half that size and splits join partitions above four times it. At
    100 TB this gives about 400 000 partitions rather than the default 200,
    whose tasks would each have to sort hundreds of gigabytes.
    """
    shuffle = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
    }


def build_session(
    master: str = "local[*]",
    app_name: str = "touchline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect.

    ``input_bytes`` (the size of the data to read) sizes scan splits and
    shuffle partitions with ``sizing_conf``; ``shuffle_partitions`` overrides.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if input_bytes is not None:
        conf.update(sizing_conf(input_bytes))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    *and* the session is local (tests) do we create one of our own; on a
    cluster a machine-local folder would not be visible to other executors, so
    we refuse instead of guessing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS, S3, ABFS, ...) before running jobs that write scratch data"
            )
        configured = tempfile.mkdtemp(prefix="touchline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/touchline-{name}-{uuid.uuid4().hex}"


__all__ = [
    "DEFAULT_CONF",
    "build_session",
    "sizing_conf",
    "ensure_checkpoint_dir",
    "scratch_path",
]

