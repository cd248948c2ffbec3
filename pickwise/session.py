"""Session defaults and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; only a session with
a local master (tests) may go without and then gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession


def _submitted() -> dict[str, str]:
    """Settings given on submission: they are in the JVM that the launcher starts."""
    SparkContext._ensure_initialized()
    return dict(SparkConf(loadDefaults=True).getAll())


def build_session(master: str | None = None, partitions: int | None = None, app: str = "pickwise") -> SparkSession:
    """A session with the settings the engine relies on.

    Settings given on submission win: only those that are unset get a value here.
    ``partitions`` is for local sessions (tests, bench); a cluster's own
    ``spark.sql.shuffle.partitions`` is never touched."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    given = _submitted()
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        # factor blocks travel to Python in Arrow batches: bound them by bytes, not rows
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in wanted.items():
        if k not in given:
            b = b.config(k, v)
    if partitions and (master or given.get("spark.master", "")).startswith("local"):
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared working folder (the checkpoint directory)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pickwise-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared folder."""
    return os.path.join(shared_dir(spark), "pickwise", purpose, uuid.uuid4().hex)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss and fixes
    the row-to-partition assignment of ``df`` for every later reader.

    The plan is persisted (memory, spilling to disk) while the checkpoint is written,
    so it runs once rather than once for the count and again for the files."""
    shared_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
