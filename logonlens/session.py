"""Session construction and the shared scratch location.

Scratch data (round trips, lineage cuts, streaming checkpoints) always goes under
``spark.checkpoint.dir``: on a cluster that is the shared folder the cluster names;
only when it is unset (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "logonlens",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir. Only a local session without one gets a folder of
    this machine; on a cluster other machines could not see it, so it has to be configured."""
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="logonlens-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, local)
    spark.sparkContext.setCheckpointDir(local)
    return (spark.sparkContext.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "logonlens-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


MIN_SHUFFLE_PARTITIONS = 200      # Spark's own default


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of log.

    AQE coalesces small partitions at run time, so the initial number only has to be
    large enough that no shuffle partition outgrows executor memory (every shuffle here
    follows a map-side partial aggregate, so it carries far less than the input). Raise
    ``target_partition_bytes`` where map-output bookkeeping (mappers x reducers) gets large.
    """
    initial = max(MIN_SHUFFLE_PARTITIONS, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.scheduler.mode": "FAIR",
    }
