"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every quarry job wants, whatever the cluster size.  Partition
# counts are left to AQE: it coalesces small shuffles at sf0.1 and splits
# skewed partitions at 100 TB.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python workers are bounded in bytes too: a prompt or
    # a document can be 100 KB, so 10k-row batches alone would not bound memory
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with quarry's defaults.

    On a cluster ``master`` is None and the launcher decides.  Locally, tests
    pass ``local[*]`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers of this machine import the library wherever the driver was started.

    On a cluster the library is installed or sent with the job; the path is
    then one more entry that holds nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables, from ``spark.checkpoint.dir``.

    Where the setting is absent, a local session uses its warehouse folder;
    on a cluster the setting is required, as a folder of the driver's machine
    would be invisible to the executors.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
