"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "trendlake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every trendlake job assumes.

    * UTC session zone: year / month of zoned timestamps must not depend on
      the machine running the driver.
    * AQE on: shuffle partitions are coalesced at runtime, skewed join
      partitions split, sort-merge joins turned into broadcast joins when the
      *measured* build side is small.
    * No web UI.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the directory must be a shared file system named by
    ``spark.checkpoint.dir``; a machine-local folder would lose checkpoints
    with the executor that wrote them.  Only a local-mode session (tests,
    single-machine runs) gets a private temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        base = os.environ.get("TMPDIR", "/tmp")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="trendlake-ckpt-", dir=base))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared "
        "checkpoint directory on a cluster")


_BYTE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
               "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (Spark returns it as
    ``10485760b``, ``20MB``, ...); negative means broadcasting is disabled."""
    v = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")).strip().lower()
    m = re.fullmatch(r"(-?\d+(?:\.\d+)?)\s*([a-z]*)", v)
    if not m or m.group(2) not in _BYTE_UNITS:
        return 10 << 20
    return int(float(m.group(1)) * _BYTE_UNITS[m.group(2)])


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over the task slots when the input has fewer partitions than
    slots (one small file); larger inputs keep their scan splits.  Only for
    row-wise work, whose results do not depend on the layout."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
