"""Session helpers.

The library never creates a cluster session on its own: callers pass the
``SparkSession`` they run under.  ``local_session`` exists for tests, the
benchmark and the driver smoke check.  ``checkpoint_root`` reads the shared
folder the cluster names in ``spark.checkpoint.dir`` and only falls back to a
scratch folder when the setting is absent (local runs).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Number of tasks a table scan is dealt to; unset (no shuffle) unless a session asks for it.
SCAN_PARTITIONS = "spark.quire.scan.partitions"

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quire")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        # The supplied tables are single row groups: deal their rows to all cores.
        .config(SCAN_PARTITIONS, str(shuffle_partitions))
    )
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is left untouched; without it this raises, as executors could not read
    back what others wrote to a folder of their own.  A local session (tests,
    benchmark) gets a fresh folder under the system temp directory.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="quire-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return scratch


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (lineage cuts)."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for one written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
