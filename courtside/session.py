"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job can count on.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting handles a key that holds a large
# share of the rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames that are gone are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "courtside", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs everything in the driver JVM.
            builder = builder.config("spark.driver.memory", os.environ.get("COURTSIDE_DRIVER_MEMORY", "8g"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Target bytes per shuffle partition and per input split.  128 MiB keeps a
# task's working set well inside a few-GiB executor slice, so sorts and
# aggregations spill rarely; AQE merges smaller partitions at run time.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(input_bytes: int, cores: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict:
    """Settings sized for a job reading ``input_bytes`` on ``cores`` executor cores.

    * ``spark.sql.shuffle.partitions``: enough partitions that each holds
      about ``target_bytes`` of the (pre-aggregation) input, and at least two
      waves of tasks; AQE coalesces them when the shuffle turns out smaller.
    * ``spark.sql.files.maxPartitionBytes``: scan splits of the same size.
    * AQE advisory size and skew-split threshold from the same target, so a
      hot key (a third of all rows) is split into target-sized pieces.
    """
    by_size = -(-input_bytes // target_bytes)
    partitions = max(2 * cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_bytes // 16),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without one (tests, laptops) gets
    a fresh scratch folder; a cluster session without one is an error, because
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    scratch = tempfile.mkdtemp(prefix="courtside-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
