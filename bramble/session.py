"""Session helpers for tests and the bench (library code never builds a session)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "bramble") -> SparkSession:
    """A local session with the settings the library expects (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Generated methods above HotSpot's 8000-byte JIT limit would run interpreted;
        # fall back to per-operator code for those plans instead (3-4x faster here).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Materialised statistics are small checkpoints; delete them once unreferenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("BRAMBLE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local tests, the bench) do we create a private one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if fallback is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local one is unsafe on a cluster")
    path = fallback or tempfile.mkdtemp(prefix="bramble-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
