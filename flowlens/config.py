"""Session helpers: recommended settings and the shared checkpoint folder.

The caller owns the SparkSession.  These helpers only read settings, and set
the checkpoint folder when (and only when) the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Settings the detector's plans are written for.  AQE re-plans joins and
#: coalesces small shuffle partitions at run time; skew-join splitting covers
#: the shuffled joins that can meet a hot key.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "flowlens") -> SparkSession:
    """Local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read.  When it
    is unset, a local master gets a fresh folder; any other raises.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="flowlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written tables)."""
    return "/".join([checkpoint_dir(spark)] + [p.strip("/") for p in parts])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and reread: one
    job, where an eager checkpoint computes its input twice."""
    return staged_with_count(df, name)[0]


def staged_with_count(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged`` and the number of rows, observed while they are written."""
    path = scratch_path(df.sparkSession, "flowlens-staged", f"{name}-{uuid.uuid4().hex}")
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(rows.get["n"])
