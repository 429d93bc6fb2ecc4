"""Existence, listing and deletion of paths through the Hadoop file system of
the path, so every scheme Spark reads works alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Full paths of the entries of a folder whose names begin with
    ``prefix``, by name; none when the folder is missing."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return [f"{path.rstrip('/')}/{x}" for x in names if x.startswith(prefix)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
