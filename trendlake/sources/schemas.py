"""Schema log of a stored table: which batches may change its columns, and how.

Rules, for a table with schema ``old`` and a batch with schema ``new``:

* a column new to the table is added at the end (rows written before read null);
* a column the batch lacks stays (matched rows keep their value, new rows null);
* a column of another type takes the narrowest type both fit into without loss
  (``widened``): integers to longer integers, to decimals that hold all their
  digits, and up to int to double; float to double; decimals to more digits on both
  sides; dates to timestamps without zone; a column without type to any; structs,
  arrays and maps by their parts;
* anything else (a string where numbers are, a long where doubles are) is a
  ``SchemaConflict``, raised before anything is written.

Parquet files keep the schema they were written with; a reader asks for the
table's schema, and the scan fills up and widens while it reads.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StructField, StructType, TimestampNTZType)

from trendlake.sources.files import exists

_INTEGERS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}     # decimal digits they need


class SchemaConflict(ValueError):
    """A batch column that cannot share a column of the table."""


def _decimal(whole: int, scale: int, name: str) -> DecimalType:
    if whole + scale > 38:
        raise SchemaConflict(f"{name}: no decimal holds {whole} digits before and {scale} after the point")
    return DecimalType(whole + scale, scale)


def common_type(a: DataType, b: DataType, name: str = "") -> DataType:
    """The narrowest type that holds every value of both, or SchemaConflict."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    kinds = {type(a), type(b)}
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b, name + ".")
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType, name + "[]"), True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(common_type(a.keyType, b.keyType, name + " key"),
                       common_type(a.valueType, b.valueType, name + " value"), True)
    if kinds <= set(_INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS[type(t)])
    if kinds == {FloatType, DoubleType} or kinds <= {ByteType, ShortType, IntegerType, DoubleType}:
        return DoubleType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if DecimalType in kinds and kinds <= {DecimalType, *_INTEGERS}:
        whole = lambda t: t.precision - t.scale if isinstance(t, DecimalType) else _INTEGERS[type(t)]
        scale = lambda t: t.scale if isinstance(t, DecimalType) else 0
        return _decimal(max(whole(a), whole(b)), max(scale(a), scale(b)), name)
    raise SchemaConflict(f"{name}: {a.simpleString()} and {b.simpleString()} have no common type")


def merged_schema(old: StructType, new: StructType, prefix: str = "") -> StructType:
    """The table's schema after a batch with schema ``new``; every column nullable."""
    known = {f.name: f for f in new.fields}
    out = [StructField(f.name, common_type(f.dataType, known[f.name].dataType, prefix + f.name)
                       if f.name in known else f.dataType, True) for f in old.fields]
    have = set(old.fieldNames())
    return StructType(out + [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in have])


def widened_to(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with its own columns only, each in the type ``schema`` gives it."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name)
                       if f.name in types and types[f.name] != f.dataType else F.col(f"`{f.name}`") for f in df.schema.fields])


CHANGES = "column_name string, change string, old_type string, new_type string"


def changes(old: StructType | None, new: StructType | None) -> list[tuple]:
    """(column, change, old type, new type) for every column of either schema;
    change is added, removed, widened or same."""
    before = {f.name: f.dataType.simpleString() for f in (old.fields if old else [])}
    after = {f.name: f.dataType.simpleString() for f in (new.fields if new else [])}
    kind = lambda a, b: "added" if a is None else "removed" if b is None else "same" if a == b else "widened"
    return [(c, kind(before.get(c), after.get(c)), before.get(c), after.get(c)) for c in dict.fromkeys([*before, *after])]


def drift_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q3 between two versions of a table: per column its change, both types
    and how many rows hold a value in it before and after (one aggregate over each version)."""
    rows = changes(before.schema, after.schema)
    spark = after.sparkSession

    def filled(df, name):
        counts = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias(name)) for c in df.columns]
        return df.agg(F.array(*counts).alias("x")).select(F.inline("x"))

    return (spark.createDataFrame(rows, CHANGES).join(filled(before, "rows_before"), "column_name", "left")
            .join(filled(after, "rows_after"), "column_name", "left")
            .na.fill(0, ["rows_before", "rows_after"]))


# --- log of a folder table ---------------------------------------------------------

LOG = "number long, schema string"


def logged_schema(spark: SparkSession, path: str) -> StructType | None:
    """The last schema in the log beside a folder table's files, or None."""
    log = f"{path.rstrip('/')}/_schemas"
    if not exists(spark, log):
        return None
    last = spark.read.schema(LOG).parquet(log).orderBy(F.desc("number")).first()
    return StructType.fromJson(json.loads(last["schema"])) if last else None


def log_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Append ``schema`` to the log unless it is the last one already."""
    log = f"{path.rstrip('/')}/_schemas"
    if logged_schema(spark, path) == schema:
        return
    number = spark.read.schema(LOG).parquet(log).count() if exists(spark, log) else 0
    spark.createDataFrame([(number, schema.json())], LOG).coalesce(1).write.mode("append").parquet(log)
