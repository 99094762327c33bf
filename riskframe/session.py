"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def _driver_memory(cap_mb: int = 8192) -> str:
    """About 60 % of physical memory, at most ``cap_mb`` (local mode: the driver is the executor)."""
    try:
        total_mb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (1024 * 1024)
    except (ValueError, OSError, AttributeError):
        return f"{cap_mb}m"
    return f"{max(1024, min(cap_mb, int(total_mb * 0.6)))}m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riskframe", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench: UTC, AQE on, UI off."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", _driver_memory())
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.rolling.enabled", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (shared storage). Only a
    local-mode session without the setting gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before "
                               "running jobs that cut lineage")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


ROWS_PER_TASK = 50_000  # fewer rows than this are not worth a task of their own in every job


def in_few_tasks(df: DataFrame, n_rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows in parts of about ``rows_per_task``, without a shuffle and in no more parts than now.

    For learners, which run hundreds of short jobs over the same rows: what a join left in many
    small parts would cost a task per part in every one of them. ``df`` should be persisted.
    """
    return df.coalesce(max(1, -(-n_rows // rows_per_task)))
