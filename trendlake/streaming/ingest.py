"""Incremental ingest as a Structured Streaming job.

The original "incremental mode" is a scheduled batch that remembers a
timestamp.  Here the file source's checkpoint remembers which input files
have been processed, ``trigger(availableNow=True)`` processes everything new
and stops (a scheduled run), and every micro-batch is filtered, de-duplicated
and upserted into a Parquet table.

Exactly once.  ``foreachBatch`` hands a batch over again when a run fails before
its epoch is logged.  The keyed table and the versions table commit the epoch
number together with the data (one log folder, one version name), so a batch
that failed before its commit is written as if for the first time, and one that
failed after it is skipped: rows, stamps and version numbers are those of one
run.  Only partitioned tables (replaced partition by partition) rely on the upsert
being keyed: a replay gives the same rows apart from ``ingested_at``.

``first_seen`` is the stream's own duplicate check: a key's state outlives
micro-batches and runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from trendlake.operators.totals import Totals
from trendlake.roles import Roles
from trendlake.sources.io import ITEM_SCHEMA
from trendlake.sources.keyed import KeyedTable
from trendlake.sources.upsert import write_upsert, write_upsert_partitioned


# JSON of whole rows, without loss of microseconds or null fields
_ROW_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def first_seen(stream: DataFrame, key: str, order_by: Sequence[str] = (), forget_after: str | None = None) -> DataFrame:
    """The first record of every key, over all micro-batches and runs of a
    streaming query (its checkpoint holds the state: one flag per key).

    Inside a micro-batch the smallest by ``order_by`` (nulls last), then by the record's
    JSON text, is the first, so the result does not depend on the order of tasks.
    Records without a key pass: they cannot be recognised again.  A key's records of one batch
    are read in Arrow batches and only the best so far is held.  ``forget_after`` (a
    duration like ``30 days``, processing time) drops the state of keys not seen for
    that long, which bounds it; without, it grows with the distinct keys.
    """
    millis = None
    if forget_after is not None:
        millis = int(stream.sparkSession.range(1).select(
            F.expr(f"CAST(INTERVAL {forget_after} AS INTERVAL DAY TO SECOND)").alias("i")).first()[0].total_seconds() * 1000)
    order = [f"o{i}" for i in range(len(order_by))] + ["record"]

    def first(keys, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for frame in frames:
            rows = frame if best is None else pd.concat([best, frame])
            best = rows.sort_values(order, na_position="last", kind="stable").head(1)
        known = state.exists
        state.update((True,))
        if millis is not None:
            state.setTimeoutDuration(millis)
        if not known and best is not None:
            yield best[["record"]]

    schema = stream.schema
    packed = stream.select(F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)],
                           F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _ROW_JSON).alias("record"))
    timeout = GroupStateTimeout.NoTimeout if millis is None else GroupStateTimeout.ProcessingTimeTimeout
    kept = packed.where("k IS NOT NULL").groupBy("k").applyInPandasWithState(
        first, "record string", "seen boolean", "append", timeout)
    kept = kept.unionByName(packed.where("k IS NULL").select("record"))
    return kept.select(F.from_json("record", schema, _ROW_JSON).alias("r")).select("r.*")


def ingest_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str, roles: Roles,
                  schema: StructType = ITEM_SCHEMA, source_format: str = "json", min_measure=None,
                  shape: Callable[[DataFrame], DataFrame] | None = None, ingested_at=None,
                  options: dict | None = None, wait: bool = True, partition_by: Sequence[str] = (),
                  keep_versions: int = 2, keyed: bool = False, totals: Sequence[Totals] = (),
                  only_first: bool = False, order_by: Sequence[str] = ()) -> StreamingQuery:
    """Take the input files added since the last run, keep rows with
    ``measure > min_measure``, apply ``shape`` (e.g. ``flatten_items``),
    upsert by ``roles.key`` (latest ``roles.update_time`` wins) into the
    table at ``target``; the position is kept in ``checkpoint``.

    With ``keyed`` the table is a ``KeyedTable``: a batch rewrites only the files that
    hold its keys, and ``totals`` are kept up.  With ``partition_by`` the table
    is partitioned and a batch rewrites only the partitions it touches.
    Otherwise each batch writes a new version of the table and ``keep_versions`` of
    them are kept.  With ``only_first`` a key counts once, ever: later records of a
    key seen before are dropped (``first_seen``; ``order_by`` decides inside a micro-batch).

    ``source_format="json"`` reads JSON-array files (``multiLine``).
    """
    reader = spark.readStream.schema(schema).format(source_format)
    if source_format == "json":
        reader = reader.option("multiLine", True)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)
    if only_first:
        stream = first_seen(stream, roles.key, order_by)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch
        if min_measure is not None:
            rows = rows.where(F.col(roles.measure) > F.lit(min_measure))
        if shape is not None:
            rows = shape(rows)
        if keyed:
            KeyedTable(rows.sparkSession, target, roles.key, roles.update_time, totals).upsert(
                rows, ingested_at, checkpoint, epoch_id)
            return
        if rows.isEmpty():
            return
        if partition_by:
            write_upsert_partitioned(rows.sparkSession, target, rows, roles.key, partition_by, roles.update_time,
                                     ingested_at)
        else:
            write_upsert(rows.sparkSession, target, rows, roles.key, roles.update_time, ingested_at,
                         keep_versions=keep_versions, stream=checkpoint, epoch=epoch_id)

    q = (stream.writeStream.foreachBatch(upsert_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q
