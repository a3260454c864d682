"""Session helpers for tests, the bench and local runs.

On a cluster, use the cluster's session: the library reads its settings
(``spark.checkpoint.dir`` for stages) and never overrides them.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed for. AQE coalesces small shuffles and
# splits skewed join partitions. Static broadcast from size *estimates* is
# off; broadcasts come from bounded row counts in the operators or from AQE
# measuring finished stages.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "recordtable") -> SparkSession:
    """Local session for tests and the bench: UI off, recommended settings, a checkpoint dir if unset."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RECORDTABLE_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if os.environ.get("RECORDTABLE_CHECKPOINT_DIR"):
        builder = builder.config("spark.checkpoint.dir", os.environ["RECORDTABLE_CHECKPOINT_DIR"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the session names in ``spark.checkpoint.dir`` (or set on its context)."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return d or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; make a scratch one only when none is set (tests).

    A scratch folder is machine-local, so it is made only where the driver and
    the executors are one process.
    """
    d = checkpoint_dir(spark)
    if not d:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="recordtable-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder (never a machine-local temp dir)."""
    d = checkpoint_dir(spark)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return f"{d.rstrip('/')}/{name}-{uuid.uuid4().hex}"
