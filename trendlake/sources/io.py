"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, MapType, StringType, StructField, StructType,
                               TimestampType)

from trendlake.operators.aggregate import category_year
from trendlake.operators.prepare import base_table
from trendlake.roles import YEAR_COL, Roles

# The field names of the original item record (explicit schema,
# so no inference pass over the input).
ITEM_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("name", StringType()),
    StructField("full_name", StringType()),
    StructField("language", StringType()),
    StructField("stars", LongType()),
    StructField("forks", LongType()),
    StructField("open_issues", LongType()),
    StructField("created_at", StringType()),
    StructField("updated_at", StringType()),
    StructField("description", StringType()),
    StructField("topics", ArrayType(StringType())),
    StructField("html_url", StringType()),
])

# The fields of the original's stored mark.
MARK_SCHEMA = StructType([
    StructField("_id", StringType()),
    StructField("last_fetched_at", TimestampType()),
    StructField("record_count", LongType()),
])

DOCUMENT_STORE_FORMATS = ("mongo", "mongodb")


def read_json_array(spark: SparkSession, path: str, schema: StructType | None = ITEM_SCHEMA) -> DataFrame:
    """Files each holding one JSON array of records.

    A multi-line JSON file cannot be split, so each file is one scan task;
    read it once and keep the data in Parquet (``write_layers``) for
    everything downstream.
    """
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def load(spark: SparkSession, source: str = "json", path: str | None = None,
         schema: StructType | None = None, **options) -> DataFrame:
    """Load the item table from a named source.

    ``json`` (default) reads JSON-array files with the item schema unless
    another is given; ``parquet``/``csv``/``orc``/... go through
    ``spark.read.format`` with their own schema (or the one given; CSV with a
    header).  The document-store source needs a connection URI option (error
    otherwise) and the store's Spark connector on the classpath; it is passed
    through unchanged.
    """
    if source == "json":
        if path is None:
            raise ValueError("path is required for the json source")
        return read_json_array(spark, path, schema or ITEM_SCHEMA)
    if source in DOCUMENT_STORE_FORMATS:
        if not any("connection.uri" in k or k == "uri" for k in options):
            raise ValueError("a connection URI option is required for the document-store source")
        return spark.read.format("mongodb").options(**options).load()
    r = spark.read.format(source).options(**options)
    if schema is not None:
        r = r.schema(schema)
    if source == "csv":
        r = r.option("header", True)
        if schema is None:
            r = r.option("inferSchema", True)
    return r.load(path) if path is not None else r.load()


def read_result(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """S3: an earlier CSV result - a single file or a directory of part files
    (all parts are read)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV result with a header.

    Array, map and struct columns (CSV has no such types) are written as
    JSON strings.
    """
    nested = (ArrayType, MapType, StructType)
    out = df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested)
                      else F.col(f.name) for f in df.schema.fields])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite a JSON-lines result."""
    df.write.mode("overwrite").json(path)


def write_layers(raw: DataFrame, roles: Roles, base: str, digits: int | None = None) -> dict[str, str]:
    """Bronze (raw), silver (clean, partitioned by event year), gold
    (category x year aggregate) Parquet layers under ``base``.

    Silver is partitioned by ``year`` so later year-range reads prune whole
    directories; gold is computed from the written silver layer, so the raw
    input is scanned once more at most.
    """
    paths = {k: f"{base.rstrip('/')}/{k}" for k in ("bronze", "silver", "gold")}
    raw.write.mode("overwrite").parquet(paths["bronze"])
    spark = raw.sparkSession
    silver = base_table(spark.read.parquet(paths["bronze"]), roles)
    # rebalance by year: a few large files per year directory instead of one
    # per task and year; AQE splits a year that holds most of the rows.
    (silver.hint("rebalance", YEAR_COL).write.mode("overwrite")
     .partitionBy(YEAR_COL).parquet(paths["silver"]))
    gold = category_year(spark.read.parquet(paths["silver"]), roles, digits)
    gold.write.mode("overwrite").parquet(paths["gold"])
    return paths


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], name: str) -> dict:
    """A19 while writing: run ``write(df)`` and return ``{"output": name,
    "row_count": n}`` where n is counted by ``DataFrame.observe`` during the
    write itself - no second pass over the output."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("row_count")))
    return {"output": name, "row_count": obs.get["row_count"]}


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` queryable from SQL as ``name``."""
    df.createOrReplaceTempView(name)
    return df


# --- high-water mark -----------------------------------------------------------

def load_mark(spark: SparkSession, path: str, mark_id: str = "fetch_checkpoint") -> tuple | None:
    """(last_fetched_at, record_count) of the stored mark, None if absent.
    Marks are appended, the latest time counts: the mark never goes back, and
    an append that fails leaves the earlier ones as they are.  Only a missing
    path means no mark; any other error is raised."""
    marks = read_or_none(spark.read.schema(MARK_SCHEMA).parquet, path)
    if marks is None:
        return None
    rows = (marks.where((F.col("_id") == mark_id) & F.col("last_fetched_at").isNotNull())
            .orderBy(F.desc("last_fetched_at"), F.desc("record_count")).take(1))
    return (rows[0]["last_fetched_at"], rows[0]["record_count"]) if rows else None


def save_mark(written: DataFrame, roles: Roles, path: str, mark_id: str = "fetch_checkpoint") -> DataFrame:
    """Add the mark of data that *has been written*: the latest update
    time in it and its row count (one aggregate over the written rows, saved
    after the write, so a failed write never advances the mark).  A run that
    wrote nothing, or no update time, adds no mark."""
    t = written.schema[roles.update_time].dataType
    upd = F.col(roles.update_time)
    upd = F.try_to_timestamp(upd) if isinstance(t, StringType) else upd.cast("timestamp")
    mark = written.agg(F.lit(mark_id).alias("_id"), F.max(upd).alias("last_fetched_at"),
                       F.count(F.lit(1)).alias("record_count")).where("last_fetched_at is not null")
    mark.write.mode("append").parquet(path)
    return mark


# --- missing input -------------------------------------------------------------

def read_or_none(reader, *args, **kwargs) -> DataFrame | None:
    """Run a reader; a missing path gives None instead of an error."""
    try:
        return reader(*args, **kwargs)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def quality_or_error(spark: SparkSession, df: DataFrame | None, report, message: str = "input missing",
                     **kwargs) -> DataFrame:
    """S12 for the quality step: the report, or a one-row error record when
    the input is missing (the other steps raise)."""
    if df is None:
        return spark.createDataFrame([(message,)], "error string")
    return report(df, **kwargs)
