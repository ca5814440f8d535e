"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no broadcast from planner estimates (file sizes can badly understate a
    # side); AQE still broadcasts a side whose measured shuffle output is small
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # remove checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "ledgermatch",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    On a cluster the master and resources come from spark-submit; locally
    pass ``master="local[8]"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Where it is unset, a local session gets a folder of its own, registered so
    that every later call agrees on it; a cluster session is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgermatch-ckpt-")  # one machine: nobody else reads it
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/ledgermatch/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, worked out once and kept as compressed columns in a fresh scratch folder. A
    checkpoint would keep whole uncompressed rows, several times as many bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
