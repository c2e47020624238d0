"""Session bootstrap (S13) and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the package relies on. AQE re-plans joins at run
# time (broadcast only below the size threshold, skew-join splitting for hot
# keys, partition coalescing), so no join in the package forces a strategy on
# a side whose size grows with the data.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove reliable checkpoints of the distributed ordinal once unused.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # DROPMALFORMED only drops bad rows when every column is parsed.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "rankforge",
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Return the active session or build one with the package defaults.

    On a cluster the launcher supplies master and resources; locally pass
    ``master="local[8]"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used. Only when nothing is configured (unit tests on one machine)
    a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for it"
            )
        configured = tempfile.mkdtemp(prefix="rankforge-ckpt-")
    if configured.startswith("/"):
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job reading ``input_bytes``: scan splits and shuffle
    partitions of about ``target_partition_bytes`` so every task fits in
    executor memory without spilling much; AQE then merges small partitions
    and splits skewed ones around the same size. For 100 TB this gives
    ~400k initial shuffle partitions."""
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on the session."""
    for key, value in conf.items():
        spark.conf.set(key, value)


@contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """Jobs run inside pass rows to Python in Arrow batches of about
    ``max_bytes``, however long the rows are; the setting is put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before)
