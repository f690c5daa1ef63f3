"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Options every job relies on. Hours are taken in UTC; AQE re-plans joins and
# splits skewed shuffle partitions at runtime; checkpoint files (per-key stats
# and sums) are deleted once their frames are garbage collected, so repeated
# runs do not fill the shared folder.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "callstats",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the job options applied.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests;
    on a cluster they come from the submit command.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see, taken from ``spark.checkpoint.dir``.

    A cluster must name one. Only a local-mode session without it gets a
    private temporary folder (tests, notebooks).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir().rstrip("/")
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="callstats-ckpt-"))
        return sc.getCheckpointDir().rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
