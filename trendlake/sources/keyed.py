"""A keyed table of Parquet files whose upserts rewrite only the files that hold
the batch's keys (S7), with exactly-once epochs (T1), a schema history (Q3) and
maintained totals (S6).

Folder:

    data/<write>/part-*.parquet   rows, sorted by key; never changed once written
    index/<write>/                key filters of those files
    totals/<name>/<write>/        maintained aggregates
    log/v-<number>/               a version: its files with their smallest and largest
                                  key, and one row of facts (schema, epochs, history)

A version exists once its log folder is complete (Spark's ``_SUCCESS`` is written
last), so data, schema, totals and epochs become visible together; whatever a
failed run left behind is never read, and ``vacuum`` removes it.  One writer at a
time is assumed.

Finding the files of a batch, each step on what the one before left:

1. key ranges: for every file the smallest batch key not below its first key, by
   one sort of file bounds and batch keys together (range partitions, a running
   minimum in each, and one value handed on per partition); the file stays if
   that key is not beyond its last;
2. key filters: one bit per key hash in 32,768-bit blocks, built and probed by
   built-in functions; tried while keys x files stays under ``PROBES``;
3. the key column of the files left is read and joined with the batch: exact.

Steps 1 and 2 only save reading; which files are rewritten is decided by step 3.
Only touched files are read in full.  Lists of file names pass through the
driver, as in any Parquet read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendlake.operators.totals import Totals
from trendlake.session import ensure_checkpoint_dir
from trendlake.sources.files import children, delete, exists
from trendlake.sources.schemas import CHANGES, changes, drift_report, merged_schema, widened_to
from trendlake.sources.upsert import STAMP, _stamp, keys_fit_broadcast, latest_per_key, upsert

FILE_ROWS = 1 << 18
FILTER_BITS = 1 << 22           # per file: 16 bits a key at FILE_ROWS keys
PROBES = 100_000_000
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Commit:
    """What an upsert did: the version now current, whether it is new, and how
    many files were dropped, kept and written."""
    version: int
    new: bool
    files_rewritten: int = 0
    files_kept: int = 0
    files_written: int = 0


def _side(keys: DataFrame) -> DataFrame:
    """Batch keys as a join side: broadcast when their measured bytes allow it."""
    return F.broadcast(keys) if keys_fit_broadcast(keys) else keys


class KeyedTable:
    """The table in folder ``path``, one row per ``key``; ``totals`` are kept up with every upsert."""

    def __init__(self, spark: SparkSession, path: str, key: str, update_time: str | None = None,
                 totals: Sequence[Totals] = (), file_rows: int = FILE_ROWS, filter_bits: int = FILTER_BITS):
        self.spark, self.path, self.key, self.update_time = spark, path.rstrip("/"), key, update_time
        self.totals, self.file_rows, self.filter_bits = list(totals), file_rows, filter_bits
        self._known: dict[int, dict] = {}       # facts of versions, which never change

    # --- versions ------------------------------------------------------------------

    def _log(self, number: int) -> str:
        return f"{self.path}/log/v-{number:012d}"

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        return [int(v.rsplit("/v-", 1)[1]) for v in children(self.spark, f"{self.path}/log", "v-")
                if exists(self.spark, f"{v}/_SUCCESS")]

    def version(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def facts(self, version: int | None = None) -> dict | None:
        """schema, history, epochs, totals and time of a version (default: the current)."""
        number = self.version() if version is None else version
        if number is None:
            return None
        if number not in self._known:
            rows = self.spark.read.schema("facts string").parquet(self._log(number)).where("facts IS NOT NULL").collect()
            self._known[number] = json.loads(rows[0][0])
        return self._known[number]

    def _schema(self, version: int) -> StructType:
        return StructType.fromJson(json.loads(self.facts(version)["schema"]))

    def _bounds(self, schema: StructType) -> str:
        kind = schema[self.key].dataType.simpleString()
        return f"file string, n_rows long, min_key {kind}, max_key {kind}"

    def files(self, version: int | None = None) -> DataFrame:
        """Files of a version: file, n_rows, min_key, max_key."""
        number = self.version() if version is None else version
        return self.spark.read.schema(self._bounds(self._schema(number))).parquet(self._log(number)).where("file IS NOT NULL")

    def _rows(self, names: list[str], schema: StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows of a version (default: the current) in its schema; None before the first."""
        facts = self.facts(version)
        if facts is None:
            return None
        names = [r["file"] for r in self.files(version).select("file").collect()]
        return self._rows(sorted(names), StructType.fromJson(json.loads(facts["schema"])))

    def read_totals(self, name: str, version: int | None = None) -> DataFrame | None:
        facts = self.facts(version)
        return self.spark.read.parquet(f"{self.path}/{facts['totals'][name]}") if facts else None

    def schema_history(self) -> DataFrame:
        """version, column_name, change, old_type, new_type: every change of the schema since the first version."""
        facts = self.facts() or {"history": []}
        rows, before = [], None
        for number, text in facts["history"]:
            after = StructType.fromJson(json.loads(text))
            rows += [(number, *c) for c in changes(before, after) if c[1] != "same"]
            before = after
        return self.spark.createDataFrame(rows, "version long, " + CHANGES)

    def drift(self, before: int, after: int) -> DataFrame:
        """Q3 between two kept versions: per column its change and its filled rows in each."""
        return drift_report(self.read(before), self.read(after))

    def epoch(self, stream: str) -> int | None:
        """Last epoch of ``stream`` that a version holds."""
        facts = self.facts()
        return facts["epochs"].get(stream) if facts else None

    # --- finding files ---------------------------------------------------------------

    def _by_range(self, files: DataFrame, keys: DataFrame) -> DataFrame:
        """Files with at least one batch key from their first to their last key."""
        k = F.col("k")
        ends = files.select(F.col("min_key").alias("k"), "file", "max_key")
        marks = keys.select(F.col(self.key).alias("k"), F.lit(None).cast("string").alias("file"),
                            F.lit(None).cast(files.schema["max_key"].dataType).alias("max_key"))
        both = ends.unionByName(marks).repartitionByRange("k").withColumn("p", F.spark_partition_id()).checkpoint()
        # equal keys: batch keys come first from above, so a file's first key finds itself
        down = Window.partitionBy("p").orderBy(F.desc("k"), F.asc_nulls_first("file"))
        batch_key = F.when(F.col("file").isNull(), k)
        near = both.withColumn("near", F.last(batch_key, ignorenulls=True).over(
            down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        # one row per partition: its smallest batch key, handed down to the partitions before it
        firsts = both.groupBy("p").agg(F.min(batch_key).alias("first"))
        handed = firsts.select("p", F.min("first").over(
            Window.orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)).alias("handed"))
        return (near.where("file IS NOT NULL").join(handed, "p")
                .where(F.coalesce("near", "handed") <= F.col("max_key")).select("file", k.alias("min_key"), "max_key"))

    def _position(self, rows: DataFrame):
        """Bit of a key; integers hash alike in every width."""
        whole = rows.schema[self.key].dataType.simpleString() in _INTEGERS
        return F.pmod(F.xxhash64(F.col(self.key).cast("long") if whole else F.col(self.key)), F.lit(self.filter_bits))

    def _filters_hold(self, facts: dict) -> bool:
        """Whether all filters were built from keys that hash as today's: the key never changed its type, but for
        the width of integers."""
        kinds = {StructType.fromJson(json.loads(text))[self.key].dataType.simpleString() for _, text in facts["history"]}
        return len(kinds) == 1 or kinds <= set(_INTEGERS)

    def _by_filter(self, files: DataFrame, keys: DataFrame, writes: list[str]) -> DataFrame:
        """Files (of step 1) whose filter has the bit of a batch key in their range."""
        index = self.spark.read.schema("file string, bucket long, bits binary").parquet(*[f"{self.path}/index/{w}" for w in writes]).join(files, "file")
        at = self._position(keys)
        probe = keys.select(F.col(self.key).alias("k"), F.bitmap_bucket_number(at).alias("bucket"),
                            F.bitmap_bit_position(at).alias("bit"))
        byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.expr("shiftleft(1, CAST(bit % 8 AS INT))")) != 0
        return (index.join(probe, "bucket").where(is_set & F.col("k").between(F.col("min_key"), F.col("max_key")))
                .select("file").distinct())

    @staticmethod
    def _file_name():
        return F.substring_index(F.col("_metadata.file_path"), "/", -2)

    def touched(self, keys: DataFrame) -> list[str]:
        """Names of the current files that hold one of ``keys`` (unique, not null)."""
        number = self.version()
        if number is None:
            return []
        ensure_checkpoint_dir(self.spark)
        return self._touched(number, keys, _side(keys), keys.count())

    def _touched(self, number: int, keys: DataFrame, side: DataFrame, n_keys: int) -> list[str]:
        schema = self._schema(number)
        near = self._by_range(self.files(number), keys).collect()
        names = [r["file"] for r in near]
        if names and self._filters_hold(self.facts(number)) and len(names) * n_keys <= PROBES:
            writes = sorted({n.split("/")[0] for n in names})
            kind = schema[self.key].dataType.simpleString()
            bounds = self.spark.createDataFrame(near, f"file string, min_key {kind}, max_key {kind}")
            names = [r[0] for r in self._by_filter(bounds, keys, writes).collect()]
        if not names:
            return []
        held = self._rows(sorted(names), StructType([schema[self.key]])).select(self.key, self._file_name().alias("file"))
        return sorted(r[0] for r in held.join(side, self.key, "left_semi").select("file").distinct().collect())

    # --- writing ---------------------------------------------------------------------

    def upsert(self, batch: DataFrame, ingested_at=None, stream: str | None = None, epoch: int | None = None) -> Commit:
        """Upsert ``batch`` (semantics of ``upsert``; schema rules of ``schemas``)
        as one new version.  With ``stream`` and ``epoch`` the epoch is committed in
        the same version, and an epoch that a version already holds is skipped.
        A batch without keyed rows makes no version."""
        spark, facts, now = self.spark, self.facts(), self.version()
        if stream is not None and facts and facts["epochs"].get(stream, -1) >= epoch:
            return Commit(now, False)
        ensure_checkpoint_dir(spark)
        fresh = latest_per_key(batch, self.key, self.update_time).withColumn(STAMP, _stamp(ingested_at))
        old = StructType.fromJson(json.loads(facts["schema"])) if facts else StructType([])
        schema = merged_schema(old, fresh.schema)
        # written once: every later step reads the same rows and the same stamp
        fresh = widened_to(fresh, schema).checkpoint()
        size = fresh.agg(F.count(F.lit(1)).alias("n"), F.first(STAMP).alias("stamp")).first()
        if not size["n"]:
            return Commit(-1 if now is None else now, False)
        keys = fresh.select(self.key)
        fits = keys_fit_broadcast(keys)
        side = F.broadcast(keys) if fits else keys
        names = self._touched(now, keys, side, size["n"]) if now is not None else []
        held = self._rows(names, schema)
        after = widened_to(fresh, schema)
        if names:
            after = upsert(held, fresh.drop(STAMP), self.key, None, size["stamp"], broadcast_keys=fits)
        present = set(after.columns)
        after = after.select(*[F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in schema.fields])
        write = uuid.uuid4().hex
        (after.repartitionByRange(self.key).sortWithinPartitions(self.key)
         .write.option("maxRecordsPerFile", self.file_rows).parquet(f"{self.path}/data/{write}"))
        added = self._index(write, schema)
        totals = {t.name: self._follow(t, facts, held if names else None, write, side, schema) for t in self.totals}
        return self._commit(now, facts, schema, names, added, write, totals, stream, epoch)

    def _index(self, write: str, schema: StructType) -> DataFrame:
        """Write the key filters of a write's files; returns their bounds."""
        rows = (self.spark.read.schema(StructType([schema[self.key]])).parquet(f"{self.path}/data/{write}")
                .select(self.key, self._file_name().alias("file")))
        at = self._position(rows)
        (rows.groupBy("file", F.bitmap_bucket_number(at).alias("bucket"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
         .write.option("compression", "zstd").parquet(f"{self.path}/index/{write}"))
        return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min(self.key).alias("min_key"),
                                        F.max(self.key).alias("max_key"))

    def _follow(self, spec: Totals, facts: dict | None, held: DataFrame | None, write: str, side: DataFrame,
                schema: StructType) -> str:
        """Write the totals after a change; reads the touched files (old and new) and the totals before."""
        new = self.spark.read.schema(schema).parquet(f"{self.path}/data/{write}").join(side, self.key, "left_semi")
        gone = held.join(side, self.key, "left_semi") if held is not None else None
        before = None
        if facts and spec.name in facts["totals"]:
            before = self.spark.read.parquet(f"{self.path}/{facts['totals'][spec.name]}")
        elif facts:
            # totals asked for on a table that has none yet: counted once, from the version before
            before = spec.parts(self.read(), 1)
        place = f"totals/{spec.name}/{write}"
        spec.apply(before, spec.deltas(gone, new)).write.parquet(f"{self.path}/{place}")
        return place

    def _commit(self, now, facts, schema, dropped, added, write, totals, stream, epoch) -> Commit:
        number = 0 if now is None else now + 1
        history = list(facts["history"]) if facts else []
        if not history or history[-1][1] != schema.json():
            history.append((number, schema.json()))
        epochs = dict(facts["epochs"]) if facts else {}
        if stream is not None:
            epochs[stream] = epoch
        told = {"schema": schema.json(), "history": history, "epochs": epochs, "write": write,
                "totals": {**(facts["totals"] if facts else {}), **totals}}
        kind, columns = schema[self.key].dataType.simpleString(), self._bounds(schema)
        kept = self.spark.createDataFrame([], columns)
        if now is not None:
            gone = self.spark.createDataFrame([(n,) for n in dropped], "file string")
            kept = self.files(now).withColumns({c: F.col(c).cast(kind) for c in ("min_key", "max_key")}).join(
                gone, "file", "left_anti")
        listed = kept.unionByName(added).withColumn("facts", F.lit(None).cast("string")).unionByName(
            self.spark.createDataFrame([(None, None, None, None, json.dumps(told))], columns + ", facts string"))
        place = self._log(number)
        if exists(self.spark, place):
            delete(self.spark, place)       # an incomplete version of a run that failed: never read
        seen = Observation()
        (listed.observe(seen, F.count("file").alias("all"), F.count_if(F.startswith("file", F.lit(write))).alias("new"))
         .hint("rebalance").write.mode("errorifexists").parquet(place))
        return Commit(number, True, len(dropped), seen.get["all"] - seen.get["new"], seen.get["new"])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Keep the last ``keep`` versions; delete older ones and every file, filter
        and total that no kept version names.  Returns the deleted paths."""
        found = self.versions()
        kept = found[-max(1, keep):]
        if not kept:
            return []
        live = {r[0] for v in kept for r in self.files(v).select("file").collect()}
        writes = {n.split("/")[0] for n in live}
        totals = {p for v in kept for p in self.facts(v)["totals"].values()}
        doomed = [self._log(v) for v in found if v not in kept]
        for place in children(self.spark, f"{self.path}/data"):
            name = place.rsplit("/", 1)[1]
            if name not in writes:
                doomed += [place, f"{self.path}/index/{name}"]
            else:
                doomed += [f for f in children(self.spark, place, "part-") if f"{name}/{f.rsplit('/', 1)[1]}" not in live]
        for group in children(self.spark, f"{self.path}/totals"):
            doomed += [p for p in children(self.spark, group) if p[len(self.path) + 1:] not in totals]
        for place in doomed:
            delete(self.spark, place)
        return doomed
