"""Session helpers.

Library code never creates its own session; it takes the caller's. These helpers
are for scripts and tests: they build a local session with the settings the
library assumes (UTC, AQE with skew-join handling, no UI) and resolve the shared
checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed aggregates are deleted once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "riskspark", extra=None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RISKSPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it names a shared file system and must be set; only local runs and
    tests get a fresh folder under /tmp when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="riskspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024, checkpoint_dir: str | None = None) -> dict:
    """Settings for a cluster run sized to the input.

    Shuffle partitions: enough that one partition of the largest shuffle (about the input
    size after column pruning; we assume the full input as an upper bound) stays near
    ``target_partition_bytes``, and at least twice the total cores; AQE then coalesces
    small ones and splits skewed ones. File splits of the same size keep scan tasks
    in line with shuffle tasks.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    conf = dict(DEFAULT_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
            "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        }
    )
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    return conf
