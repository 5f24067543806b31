"""Session helpers: a tuned local/cluster session and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Runtime SQL settings every job here relies on. They are all session-level
# and safe to apply to a session the caller created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only sides whose measured size is below this bound; AQE
    # re-checks the bound with runtime statistics.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "recordflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          # Keep the driver's status store small in long-running sessions
          # with many short jobs (monitoring retention only).
          .config("spark.ui.retainedJobs", "100")
          .config("spark.ui.retainedStages", "200")
          .config("spark.ui.retainedTasks", "5000")
          .config("spark.sql.ui.retainedExecutions", "50")
          .config("spark.cleaner.periodicGC.interval", "2min")
          .config("spark.driver.memory", os.environ.get("RECORDFLOW_DRIVER_MEMORY", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException:  # a static setting: only a new session can change it
            pass


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only a local master may leave it unset: there a private folder is made.
    Elsewhere executors would not see such a folder, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: only the conf is visible
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="recordflow-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core setting locked by the session: folder is still used below
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def run_dir(spark: SparkSession, kind: str) -> str:
    """A fresh sub-folder of the shared folder for one run's outputs."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized for a job that reads ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at the input size over the target partition
    size (at least two waves of tasks) and AQE coalesces them at runtime to
    the advisory size, so a partition fits in executor memory without
    spilling; skewed partitions are split by AQE's skew join handling.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


class JobTag:
    """Tag the jobs this thread starts, so another thread can cancel them.

    Uses SparkContext job tags on a classic session, session tags where only
    the session API is available (Spark Connect).
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.tag = spark, tag
        try:
            self.sc = spark.sparkContext
        except Exception:
            self.sc = None

    def __enter__(self):
        if self.sc is not None:
            self.sc.addJobTag(self.tag)
        else:
            self.spark.addTag(self.tag)
        return self

    def cancel(self) -> None:
        if self.sc is not None:
            self.sc.cancelJobsWithTag(self.tag)
        else:
            self.spark.interruptTag(self.tag)

    def __exit__(self, *exc):
        if self.sc is not None:
            self.sc.removeJobTag(self.tag)
        else:
            self.spark.removeTag(self.tag)
        return False
