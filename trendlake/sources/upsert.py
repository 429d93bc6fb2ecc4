"""Keyed upsert of a batch into a table (S7, S8, J3) as a pure DataFrame
function, plus two table writers for folders of Parquet files on any file
system Spark can reach (paths are only ever opened through Spark / Hadoop)."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from trendlake.operators.ingest import dedupe_first
from trendlake.session import broadcast_threshold, ensure_checkpoint_dir
from trendlake.sources.files import children, delete, exists
from trendlake.sources.schemas import SchemaConflict, log_schema, logged_schema, merged_schema, widened_to

STAMP = "ingested_at"


def _stamp(ts) -> F.Column:
    if ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ts, datetime):
        ts = ts.isoformat(sep=" ")
    return F.lit(str(ts).replace("T", " ").rstrip("Z")).cast("timestamp_ntz")


def latest_per_key(batch: DataFrame, key: str, update_time: str | None) -> DataFrame:
    """Batch rows with a key, one per key: the latest ``update_time`` wins,
    the remaining columns (descending) break ties."""
    b = batch.where(F.col(key).isNotNull())
    order = [update_time] if update_time else []
    return dedupe_first(b, key, order, descending=True)


def keys_fit_broadcast(keys: DataFrame) -> bool:
    """Whether a frame of keys may be broadcast: its rows' bytes, measured in
    one pass (16 bytes of row header and the value, as JSON text if nested),
    against the broadcast threshold."""
    width = F.lit(16)
    for f in keys.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            width = width + 8 + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("struct", "array", "map")):
            width = width + 8 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            width = width + 16
    size = keys.agg(F.sum(width.cast("long"))).first()[0] or 0
    return size <= max(0, broadcast_threshold(keys.sparkSession))


def upsert(target: DataFrame, batch: DataFrame, key: str, update_time: str | None = None,
           ingested_at=None, broadcast_keys: bool | None = None) -> DataFrame:
    """The table after upserting ``batch`` into ``target`` by ``key``.

    * batch rows with a null key are skipped;
    * a key repeated in the batch keeps its latest row (``update_time``);
    * every batch row is stamped with ``ingested_at``;
    * matched rows take the batch's value for every column the batch has
      (a null included) and keep the target's value for the others;
    * target rows whose key is not in the batch are unchanged.

    Plan.  An incremental batch is usually tiny next to the table, so the
    de-duplicated batch is written once with a reliable checkpoint and its
    keys are measured.  When their bytes fit the broadcast threshold
    (``broadcast_keys=None``: decided by that measure; ``True`` / ``False``
    force a plan) the untouched target rows pass through a broadcast anti
    join (map-only: the table is never shuffled) and only the matched rows
    are fetched with a broadcast semi join and merged with the batch.
    Otherwise one full outer equi-join on the key (both sides unique per key
    after the dedupe, so no hot key can form).  Both plans give the same
    rows.  Upserting the same batch twice gives the same table except for
    ``ingested_at``.
    """
    b = latest_per_key(batch, key, update_time).withColumn(STAMP, _stamp(ingested_at))
    b_cols = [c for c in b.columns if c != key]
    t_cols = [c for c in target.columns if c != key]
    out_cols = t_cols + [c for c in b_cols if c not in t_cols]
    if broadcast_keys is None:
        # written once (reliable checkpoint): measured, then read by the merge
        ensure_checkpoint_dir(b.sparkSession)
        b = b.checkpoint()
        broadcast_keys = keys_fit_broadcast(b.select(key))

    bb = b.select(key, *[F.col(c).alias(f"_b_{c}") for c in b_cols], F.lit(True).alias("_b_hit"))

    def merged(t_side: DataFrame, how: str) -> DataFrame:
        tt = t_side.select(key, *[F.col(c).alias(f"_t_{c}") for c in t_cols])
        j = tt.join(bb, on=key, how=how)
        hit = F.col("_b_hit").isNotNull()
        out = [F.col(key)]
        for c in out_cols:
            if c in t_cols and c in b_cols:
                out.append(F.when(hit, F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
            elif c in t_cols:
                out.append(F.col(f"_t_{c}").alias(c))
            else:
                out.append(F.col(f"_b_{c}").alias(c))
        return j.select(*out)

    if not broadcast_keys:
        return merged(target, "full_outer")
    keys = F.broadcast(b.select(key))
    untouched = target.join(keys, on=key, how="left_anti").select(
        key, *[F.col(c) if c in t_cols else F.lit(None).cast(b.schema[c].dataType).alias(c) for c in out_cols])
    matched = target.join(keys, on=key, how="left_semi")
    return untouched.unionByName(merged(matched, "right_outer"))


def upsert_stats(target: DataFrame, batch: DataFrame, key: str,
                 update_time: str | None = None) -> DataFrame:
    """One row of upsert counters for ``batch`` against ``target``

    * ``matched_count``  batch keys already in the target
    * ``modified_count`` matched keys where a shared column changes value
                         (null-safe comparison; the ingest stamp is ignored)
    * ``upserted_count`` batch keys new to the target (inserted by the upsert)
    * ``skipped_count``  batch rows without a key

    As in ``upsert``, the de-duplicated batch is written once, and one whose
    keys fit the broadcast threshold fetches the touched target rows with a
    broadcast semi join (no table shuffle).
    """
    ensure_checkpoint_dir(batch.sparkSession)
    b = latest_per_key(batch, key, update_time).checkpoint()
    shared = [c for c in b.columns if c != key and c in target.columns and c != STAMP]
    t_side = target
    if keys_fit_broadcast(b.select(key)):
        # only the target rows the batch touches, found map-side
        t_side = target.join(F.broadcast(b.select(key)), on=key, how="left_semi")
    tt = t_side.select(key, *[F.col(c).alias(f"_t_{c}") for c in shared], F.lit(True).alias("_t_hit"))
    j = b.join(tt, on=key, how="left")
    hit = F.col("_t_hit").isNotNull()
    changed = F.lit(False)
    for c in shared:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    counts = j.agg(
        F.count(F.when(hit, 1)).alias("matched_count"),
        F.count(F.when(hit & changed, 1)).alias("modified_count"),
        F.count(F.when(~hit, 1)).alias("upserted_count"))
    skipped = batch.where(F.col(key).isNull()).agg(F.count(F.lit(1))).scalar()
    return counts.select("*", skipped.alias("skipped_count"))


# --- copy-on-write table folder -----------------------------------------------

def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a copy-on-write table, oldest first: the ``v-*``
    folders with Spark's ``_SUCCESS`` marker, which the committer writes last
    (a torn write has none and is never read)."""
    return [v for v in children(spark, path, "v-") if exists(spark, f"{v}/_SUCCESS")]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version of a copy-on-write table, or None."""
    found = versions(spark, path)
    return found[-1] if found else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Current version of a copy-on-write table in the schema of its log, so that
    partition values keep their types; None without a version."""
    v = current_version(spark, path)
    if not v:
        return None
    schema = logged_schema(spark, path)
    return spark.read.parquet(v) if schema is None else spark.read.schema(schema).parquet(v)


def _epoch_mark(stream: str) -> str:
    return f"-s{hashlib.sha256(stream.encode()).hexdigest()[:16]}e"


def committed_epoch(spark: SparkSession, path: str, stream: str) -> int | None:
    """Last epoch of ``stream`` that a kept version of a copy-on-write table holds."""
    mark = _epoch_mark(stream)
    found = [int(v.rsplit(mark, 1)[1]) for v in versions(spark, path) if mark in v.rsplit("/", 1)[1]]
    return max(found) if found else None


def write_upsert(spark: SparkSession, path: str, batch: DataFrame, key: str,
                 update_time: str | None = None, ingested_at=None,
                 partition_by: Sequence[str] = (), keep_versions: int = 2,
                 stream: str | None = None, epoch: int | None = None) -> str:
    """Upsert ``batch`` into the table at ``path`` and return the new version.

    Columns follow the rules of ``schemas``.  With ``stream`` and ``epoch`` the
    epoch is part of the version's name, so both become visible together, and an
    epoch that a kept version already holds is skipped (the current version is
    returned); one stream per table is assumed.

    The new table is written to a fresh version folder, which readers see
    only once it is complete; a failed or retried job never exposes a
    half-written table.  The last ``keep_versions`` versions stay (at least
    the new one and, for readers that have opened it, the one before), older
    ones are deleted after the write.  One writer at a time is assumed.  The whole
    table is rewritten: large tables use ``KeyedTable`` or ``write_upsert_partitioned``.
    """
    if stream is not None and epoch <= (-1 if (done := committed_epoch(spark, path, stream)) is None else done):
        return current_version(spark, path)
    old = read_table(spark, path)
    schema = merged_schema(old.schema if old is not None else StructType([]), batch.schema)
    if old is None:
        new = latest_per_key(batch, key, update_time).withColumn(STAMP, _stamp(ingested_at))
    else:
        new = upsert(widened_to(old, schema), widened_to(batch, schema), key, update_time, ingested_at)
    log_schema(spark, path, merged_schema(schema, new.schema))
    known = versions(spark, path)
    number = int(known[-1].rsplit("/v-", 1)[1].split("-")[0]) + 1 if known else 0
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    version = f"{path.rstrip('/')}/v-{number:012d}-{stamp}-{uuid.uuid4().hex[:8]}"
    if stream is not None:
        version += f"{_epoch_mark(stream)}{epoch}"
    w = new.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    for stale in known[:max(0, len(known) + 1 - max(2, keep_versions))]:
        delete(spark, stale)
    return version


def _among(columns: Sequence[str], rows) -> F.Column:
    """Rows whose ``columns`` equal one of ``rows`` (nulls equal nulls)."""
    cond = F.lit(False)
    for row in rows:
        match = F.lit(True)
        for c in columns:
            match = match & (F.col(c).isNull() if row[c] is None else (F.col(c) == F.lit(row[c])))
        cond = cond | match
    return cond


PRUNE_PARTITIONS = 1000


def read_partitioned(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of ``write_upsert_partitioned`` in the schema of its log: partition
    values in their stored types (never inferred from folder names), columns
    that a file was written without null."""
    schema = logged_schema(spark, path)
    return spark.read.schema(schema).parquet(path) if schema is not None else None


def _unlogged_schema(spark: SparkSession, path: str, batch: StructType, cols: Sequence[str]) -> StructType:
    """Schema of a folder written without a log: that of all its files, with the
    partition columns in the batch's types."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    types = {f.name: f.dataType for f in batch.fields}
    return StructType([StructField(f.name, types[f.name] if f.name in cols else f.dataType, True) for f in found.fields])


def write_upsert_partitioned(spark: SparkSession, path: str, batch: DataFrame, key: str,
                             partition_by: Sequence[str], update_time: str | None = None,
                             ingested_at=None) -> int:
    """Upsert ``batch`` into a partitioned Parquet table, rewriting only the
    partitions the batch touches; returns how many partitions were touched.

    Touched are the partitions the batch rows name and those that hold the
    batch's keys now (found by a scan of key and partition columns only), so a
    key whose partition value changes moves: its old row goes.  Touched
    partitions are read by static pruning when they are few (up to
    ``PRUNE_PARTITIONS`` values become a predicate), else by a semi join with
    their values over the whole table - the same rows either way.  They are
    replaced by dynamic partition overwrite; every other partition's files
    stay.  A partition that loses its last row is deleted after the write.
    Each partition is replaced on its own: atomic per partition, not across.

    Columns follow the rules of ``schemas``; the table's schema is logged beside
    its files and every read asks for it.  Partition columns keep their type.
    Folders cannot tell an empty text from a missing value: both are the null
    partition, in the batch as in the table.
    """
    ensure_checkpoint_dir(spark)
    cols = list(partition_by)
    writer_opts = {"partitionOverwriteMode": "dynamic"}
    fresh = latest_per_key(batch, key, update_time)
    fresh = fresh.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols
                               if fresh.schema[c].dataType.simpleString() == "string"})
    if not exists(spark, path):
        log_schema(spark, path, merged_schema(StructType([]), fresh.withColumn(STAMP, _stamp(ingested_at)).schema))
    stored = logged_schema(spark, path) or _unlogged_schema(spark, path, fresh.schema, cols)
    schema = merged_schema(stored, fresh.withColumn(STAMP, _stamp(ingested_at)).schema)
    for c in cols:
        if c in stored.fieldNames() and schema[c].dataType != stored[c].dataType:
            raise SchemaConflict(f"{c}: a partition column keeps its type {stored[c].dataType.simpleString()}")
    fresh = widened_to(fresh, schema).checkpoint()
    log_schema(spark, path, schema)
    parts = fresh.select(*cols).distinct()
    if not children(spark, path, f"{_escaped(cols[0])}="):
        (fresh.withColumn(STAMP, _stamp(ingested_at)).write.mode("append")
         .partitionBy(*cols).parquet(path))
        return parts.count()
    table = spark.read.schema(schema).parquet(path)
    keys = fresh.select(key)
    if keys_fit_broadcast(keys):
        keys = F.broadcast(keys)
    held = table.select(key, *cols).join(keys, key, "left_semi").select(*cols)
    parts = parts.unionByName(held).distinct().checkpoint()
    n = parts.count()
    if n <= PRUNE_PARTITIONS:
        touched = table.where(_among(cols, parts.collect()))
    else:
        named = parts.select(*[F.col(c).alias(f"_p_{c}") for c in cols])
        on = F.lit(True)
        for c in cols:
            on = on & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
        touched = table.join(named, on, "left_semi")
    new = upsert(touched, fresh, key, update_time, ingested_at).checkpoint()
    (new.hint("rebalance", *cols).write.mode("overwrite").options(**writer_opts)
     .partitionBy(*cols).parquet(path))
    emptied = parts.join(new.select(*[F.col(c).alias(f"_n_{c}") for c in cols]).distinct(),
                         [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in cols], "left_anti")
    for row in emptied.toLocalIterator():
        delete(spark, path.rstrip("/") + "".join(f"/{_partition_folder(c, row[c])}" for c in cols))
    return n


_ESCAPED = "\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(1, 32)))


def _partition_folder(column: str, value) -> str:
    """Folder name of a partition value, escaped as Spark's writers do."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else _escaped(str(value))
    return f"{_escaped(column)}={text}"


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)
