"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import trendlake
from trendlake.session import ensure_checkpoint_dir
from trendlake.sources.files import delete

# A word: a run of code points other than space, tab, LF, VT, FF, CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Make this package importable on the executors: the ``*.py`` files go as
    one zip through Spark's own file server, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_trendlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(trendlake.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = os.path.join(tempfile.mkdtemp(prefix="trendlake-code-"), "trendlake_code.zip")
    with open(target, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(target)
    sc._trendlake_shipped = True


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for an intermediate table, under ``spark.checkpoint.dir``
    (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and a lost executor costs only the re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``written`` made, when nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over the task slots when the input has fewer partitions
    than slots (one small file); larger inputs keep their scan splits.  Only
    for row-wise work, whose results do not depend on the layout."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def word_count(text) -> "F.Column":
    """Words of a text column; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def crc_remainder(id_col, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def finite(vector):
    """Whether a vector Column is there and holds finite numbers only."""
    v = vector.cast("array<double>")
    return vector.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def dense(lists: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of doubles, shorter rows
    filled up with zeros."""
    length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dim))
    out[np.arange(dim)[None, :] < length[:, None]] = flat
    return out
