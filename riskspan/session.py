"""Spark session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps (day arithmetic and the DuckDB
# oracle both assume it), adaptive execution (runtime broadcast decisions use
# measured sizes, skewed shuffle partitions are split), ANSI left on, so
# operators use try_* functions where the reference yields nulls.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.log.level": "ERROR",
    "spark.log.structuredLogging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "riskspan",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings in ``BASE_CONF``.

    On a cluster pass ``master=None`` and let spark-submit decide; tests use
    ``local[*]`` with few shuffle partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on this machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local runs, tests) a
    folder of our own is created and registered.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="riskspan-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``); used where a plan is
    reused by several downstream aggregates.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
