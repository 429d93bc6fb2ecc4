"""Keyed table: touched files, schema log, epochs, maintained totals."""

import os

import pytest
from pyspark.sql import functions as F

from trendlake.operators.totals import Totals
from trendlake.sources import keyed as kt
from trendlake.sources.keyed import KeyedTable
from trendlake.sources.schemas import SchemaConflict, changes, common_type, merged_schema
from trendlake.sources.upsert import upsert

AT = "2024-01-01 00:00:00"
LATER = "2024-02-01 00:00:00"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def items(spark, start, stop, v=0, extra=""):
    return spark.range(start, stop, numPartitions=4).selectExpr("id", f"id % 7 + {v} AS v", "concat('n', id) AS name", *(
        [extra] if extra else []))


def small_files(spark, path, n=2000, per_file=20, **more):
    t = KeyedTable(spark, path, "id", file_rows=per_file, filter_bits=1 << 18, **more)
    t.upsert(items(spark, 0, n), AT)
    return t


def test_clustered_batch_rewrites_few_files(spark, scratch):
    t = small_files(spark, scratch)
    before = {r.file for r in t.files().collect()}
    assert len(before) >= 100
    batch = items(spark, 700, 720, v=100)                      # one per cent of the keys, side by side
    expected = upsert(t.read(), batch, "id", None, LATER)
    c = t.upsert(batch, LATER)
    after = {r.file for r in t.files().collect()}
    assert c.new and c.version == 1 and c.files_rewritten < 0.05 * len(before)
    assert len(before - after) == c.files_rewritten and c.files_kept == len(before & after)
    assert rows_of(t.read()) == rows_of(expected.select(*t.read().columns))
    # the version before is still whole
    assert rows_of(t.read(0)) == rows_of(items(spark, 0, 2000).withColumn("ingested_at", F.lit(AT).cast("timestamp_ntz")))


def test_filter_spares_files_whose_range_holds_the_key(spark, scratch, monkeypatch):
    """Even keys only: an odd key lies inside a file's range, but in no file."""
    t = KeyedTable(spark, scratch, "id", file_rows=50, filter_bits=1 << 18)
    t.upsert(spark.range(0, 2000, 2).selectExpr("id", "1 AS v"), AT)
    odd = spark.createDataFrame([(i,) for i in (301, 555, 1201)], "id long")
    near = t._by_range(t.files(), odd).collect()
    assert len(near) == 3 and all(r.min_key < k < r.max_key for r, k in zip(sorted(near, key=lambda r: r.min_key), (301, 555, 1201)))
    read = []
    real = KeyedTable._rows
    monkeypatch.setattr(KeyedTable, "_rows", lambda self, names, schema: (read.append(list(names)), real(self, names, schema))[1])
    assert t.touched(odd) == [] and read == []                  # no key column was read
    even = spark.createDataFrame([(300,), (1200,)], "id long")
    held = t.touched(even)
    assert len(held) == 2
    monkeypatch.setattr(kt, "PROBES", 0)                        # without the filters: the same files
    assert t.touched(even) == held and t.touched(odd) == []


@pytest.mark.parametrize("keys", [[-5], [0], [1999], [2500], [0, 1999], list(range(0, 2000, 13)), [999, 1000, 1001]])
def test_touched_files_are_exactly_those_with_a_key(spark, scratch, keys):
    t = small_files(spark, scratch, per_file=33)
    where = {}
    for r in t.files().collect():
        for k in range(r.min_key, r.max_key + 1):
            where[k] = r.file
    df = spark.createDataFrame([(k,) for k in keys], "id long").repartition(3)
    assert t.touched(df) == sorted({where[k] for k in keys if k in where})


def test_text_keys_equal_upsert(spark, scratch):
    words = ["", "a", "B", "é", "日本", "zz", "a\u0000b", "x" * 300]
    first = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "id string, v int")
    t = KeyedTable(spark, scratch, "id", file_rows=2, filter_bits=1 << 16)
    t.upsert(first, AT)
    batch = spark.createDataFrame([("é", 100), ("new", 101), (None, 1), ("", 102), ("", 7)], "id string, v int")
    expected = rows_of(upsert(t.read(), batch, "id", None, LATER))
    t.upsert(batch, LATER)
    assert rows_of(t.read()) == expected


def test_empty_batches_make_no_version(spark, scratch):
    t = KeyedTable(spark, scratch, "id")
    assert t.read() is None and t.version() is None
    assert not t.upsert(items(spark, 0, 0), AT).new and t.version() is None
    t.upsert(items(spark, 0, 5), AT)
    assert not t.upsert(spark.createDataFrame([(None, 3, "x")], "id long, v long, name string"), AT).new
    assert t.version() == 0


def test_vacuum_keeps_what_kept_versions_read(spark, scratch):
    t = small_files(spark, scratch, n=400)
    for k in range(4):
        t.upsert(items(spark, 100 * k, 100 * k + 5, v=k + 50), LATER)
    before, older = rows_of(t.read()), rows_of(t.read(3))
    os.makedirs(os.path.join(scratch, "data", "torn"))
    doomed = t.vacuum(2)
    assert t.versions() == [3, 4] and os.path.join(scratch, "data", "torn") in doomed
    assert rows_of(t.read()) == before and rows_of(t.read(3)) == older
    assert t.vacuum(2) == []
    t.upsert(items(spark, 390, 410, v=9), LATER)                # still a working table
    assert t.read().count() == 410


# --- epochs ------------------------------------------------------------------------

def test_failure_between_write_and_commit(spark, scratch, monkeypatch):
    """The rerun of an epoch that was written but not committed, and the replay of
    one that was committed, give the rows, stamps and version of one run."""
    one, two = (KeyedTable(spark, os.path.join(scratch, x), "id", file_rows=20) for x in ("one", "two"))
    batches = [items(spark, 0, 100), items(spark, 50, 130, v=10)]
    for e, b in enumerate(batches):
        one.upsert(b, AT, "s", e)
    two.upsert(batches[0], AT, "s", 0)
    real = KeyedTable._commit
    monkeypatch.setattr(KeyedTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        two.upsert(batches[1], AT, "s", 1)
    assert two.version() == 0 and two.epoch("s") == 0           # nothing of the failed run shows
    monkeypatch.setattr(KeyedTable, "_commit", real)
    assert two.upsert(batches[1], AT, "s", 1).version == 1
    for e, b in enumerate(batches):                             # replays
        c = two.upsert(b, LATER, "s", e)
        assert not c.new and c.version == 1
    assert rows_of(two.read()) == rows_of(one.read())
    assert (two.version(), two.epoch("s")) == (one.version(), one.epoch("s")) == (1, 1)
    assert two.upsert(batches[0], AT, "other", 0).new           # another stream has its own epochs
    assert two.epoch("s") == 1 and two.epoch("other") == 0
    torn = sorted(os.listdir(os.path.join(scratch, "two", "data")))
    two.vacuum(9)
    assert len(torn) - len(os.listdir(os.path.join(scratch, "two", "data"))) == 1


def test_torn_version_folder_is_replaced(spark, scratch):
    t = KeyedTable(spark, scratch, "id")
    t.upsert(items(spark, 0, 5), AT)
    os.makedirs(os.path.join(scratch, "log", "v-000000000001"))  # a commit that died half way
    assert t.version() == 0
    assert t.upsert(items(spark, 5, 8), AT).version == 1 and t.read().count() == 8


# --- schema log --------------------------------------------------------------------

def test_new_columns_survive_batches_without_them(spark, scratch):
    t = small_files(spark, scratch, n=60, per_file=10)
    t.upsert(items(spark, 5, 8, extra="'E' AS extra"), AT)
    t.upsert(items(spark, 7, 12, v=20), LATER)                   # no extra: key 7 keeps its own
    got = {r.id: (r.v, r.extra) for r in t.read().collect()}
    assert got[5] == (5, "E") and got[7] == (20, "E") and got[8] == (21, None) and got[40] == (5, None)
    t.upsert(spark.createDataFrame([(1, "only")], "id long, other string"), LATER)
    r = t.read().where("id = 1").first()
    assert (r.v, r.name, r.extra, r.other) == (1, "n1", None, "only")


def test_widened_columns_read_alike_from_old_and_new_files(spark, scratch):
    kinds = "id int, a smallint, b float, c decimal(6,2), d date, e struct<x:int>, f array<int>"
    t = KeyedTable(spark, scratch, "id", file_rows=2)
    t.upsert(spark.sql("SELECT CAST(id AS INT) AS id, CAST(id AS SMALLINT) AS a, CAST(id + 0.5 AS FLOAT) AS b, "
                       "CAST(id + 0.25 AS DECIMAL(6,2)) AS c, DATE'2024-01-05' AS d, named_struct('x', CAST(id AS INT)) AS e, "
                       "array(CAST(id AS INT)) AS f FROM range(8)"), AT)
    assert t.read().drop("ingested_at").schema.simpleString() == f"struct<{kinds.replace(' ', ':').replace(',:', ',')}>"
    t.upsert(spark.sql("SELECT 3000000000 AS id, 70000 AS a, 1e300 AS b, CAST(1 AS DECIMAL(10,4)) AS c, "
                       "TIMESTAMP_NTZ'2024-01-05 10:00:00' AS d, named_struct('x', 5, 'y', 'new') AS e, array(5000000000) AS f"), LATER)
    t.upsert(spark.sql("SELECT CAST(3 AS BIGINT) AS id, 9 AS a"), LATER)    # an old key, found by its wider form
    got = {r.id: r for r in t.read().collect()}
    assert len(got) == 9 and (got[3].a, got[3].b) == (9, 3.5) and (got[4].a, got[4].e.x, got[4].e.y) == (4, 4, None)
    assert str(got[4].c) == "4.2500" and str(got[4].d) == "2024-01-05 00:00:00" and got[4].f == [4]
    assert got[3000000000].a == 70000 and got[3000000000].e.y == "new"
    told = {(r.version, r.column_name): (r.change, r.old_type, r.new_type) for r in t.schema_history().collect()}
    assert told[0, "a"] == ("added", None, "smallint") and told[1, "a"] == ("widened", "smallint", "int")
    assert told[1, "id"] == ("widened", "int", "bigint") and not [k for k in told if k[0] == 2]


def test_conflicts_are_refused_before_anything_is_written(spark, scratch):
    t = small_files(spark, scratch, n=20)
    before = sorted(os.listdir(os.path.join(scratch, "data")))
    for batch in (spark.createDataFrame([(1, "text")], "id long, v string"), spark.createDataFrame([(1, 1.5)], "id long, v double")):
        with pytest.raises(SchemaConflict):
            t.upsert(batch, AT)
    assert sorted(os.listdir(os.path.join(scratch, "data"))) == before and t.version() == 0


def test_common_types(spark):
    from pyspark.sql.types import StructType as S
    t = lambda x: S.fromDDL("c " + x)["c"].dataType
    ok = [("tinyint", "bigint", "bigint"), ("int", "double", "double"), ("float", "double", "double"), ("void", "string", "string"),
          ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"), ("date", "timestamp_ntz", "timestamp_ntz"),
          ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>")]
    for a, b, c in ok:
        assert common_type(t(a), t(b)).simpleString() == c == common_type(t(b), t(a)).simpleString()
    for a, b in (("bigint", "double"), ("string", "int"), ("float", "int"), ("timestamp", "date"), ("decimal(38,0)", "decimal(10,5)"),
                 ("struct<a:int>", "int")):
        with pytest.raises(SchemaConflict):
            common_type(t(a), t(b), "c")
    assert changes(None, S.fromDDL("a int")) == [("a", "added", None, "int")]
    assert merged_schema(S.fromDDL("a int"), S.fromDDL("B int, a bigint")).simpleString() == "struct<a:bigint,B:int>"


def test_drift_between_versions(spark, scratch):
    t = small_files(spark, scratch, n=40)
    t.upsert(spark.createDataFrame([(1, None, "E"), (90, 4, None)], "id long, v long, extra string"), LATER)
    got = {r.column_name: tuple(r)[1:] for r in t.drift(0, 1).collect()}
    assert got["extra"] == ("added", None, "string", 0, 1) and got["v"] == ("same", "bigint", "bigint", 40, 40)
    assert got["name"] == ("same", "string", "string", 40, 40) and got["id"] == ("same", "bigint", "bigint", 40, 41)


# --- maintained totals ---------------------------------------------------------------

SPEC = Totals("by_name", {"g": "v % 3", "h": "length(name)"}, {"total": "v", "price": "CAST(v AS DOUBLE) / 8"})


def recomputed(t, spec=SPEC):
    return rows_of(spec.apply(None, spec.parts(t.read(), 1)))


def test_totals_follow_every_batch(spark, scratch):
    t = small_files(spark, scratch, n=300, totals=[SPEC])
    assert rows_of(t.read_totals("by_name")) == recomputed(t) != []
    for batch in (items(spark, 100, 130, v=5), items(spark, 290, 1200, v=1),
                  spark.createDataFrame([(1, None, "w"), (2, 3, None), (1, 8, "late")], "id long, v long, name string")):
        t.upsert(batch, LATER)
        assert rows_of(t.read_totals("by_name")) == recomputed(t)
    assert rows_of(t.read_totals("by_name", 0)) == rows_of(SPEC.apply(None, SPEC.parts(t.read(0), 1)))


def test_groups_that_lose_their_last_row_go(spark, scratch):
    spec = Totals("t", {"name": "name"})
    t = KeyedTable(spark, scratch, "id", totals=[spec])
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, name string"), AT)
    t.upsert(spark.createDataFrame([(1, "b"), (2, "b")], "id long, name string"), AT)
    assert rows_of(t.read_totals("t")) == [("b", 3)]


def test_totals_read_touched_files_only(spark, scratch):
    t = small_files(spark, scratch, n=2000, totals=[SPEC])
    keys = spark.createDataFrame([(700,), (705,)], "id long")
    names = t.touched(keys)
    assert 1 <= len(names) <= 2
    read = []
    real = Totals.deltas
    try:
        Totals.deltas = lambda self, gone, new: (read.extend(gone.inputFiles()), real(self, gone, new))[1]
        t.upsert(items(spark, 700, 706, v=3).where("id IN (700, 705)"), LATER)
    finally:
        Totals.deltas = real
    assert {"/".join(f.split("/")[-2:]) for f in read} == set(names)


def test_totals_may_start_late(spark, scratch):
    small_files(spark, scratch, n=100)
    t = KeyedTable(spark, scratch, "id", file_rows=20, filter_bits=1 << 18, totals=[SPEC])
    t.upsert(items(spark, 90, 120, v=4), LATER)
    assert rows_of(t.read_totals("by_name")) == recomputed(t)


# --- folder tables -------------------------------------------------------------------

@pytest.mark.parametrize("values, kind", [(["01", "02", "1e3", "x/y", "2024-01-05"], "string"),
                                          (["2024-01-05", "2024-02-01"], "date"), ([1, 2], "bigint")])
def test_partition_values_keep_their_type(spark, scratch, values, kind):
    from trendlake.sources.upsert import read_partitioned, write_upsert_partitioned
    path = os.path.join(scratch, "p")
    make = lambda rows: spark.createDataFrame(rows, "id long, v long, part string").withColumn(
        "part", F.col("part").cast(kind))
    first = [(i, i, str(values[i % len(values)])) for i in range(3 * len(values))]
    write_upsert_partitioned(spark, path, make(first), "id", ["part"])
    folders = sorted(x for x in os.listdir(path) if x.startswith("part="))
    assert write_upsert_partitioned(spark, path, make([(0, 50, str(values[0]))]), "id", ["part"]) == 1
    assert sorted(x for x in os.listdir(path) if x.startswith("part=")) == folders
    got = {r.id: (r.v, str(r.part)) for r in read_partitioned(spark, path).collect()}
    assert got == {i: (50 if i == 0 else v, p) for i, v, p in first}
    assert read_partitioned(spark, path).count() == len(first)


def test_empty_text_and_null_are_one_partition(spark, scratch):
    from trendlake.sources.upsert import read_partitioned, write_upsert_partitioned
    path, ddl = os.path.join(scratch, "p"), "id long, part string, v int"
    write_upsert_partitioned(spark, path, spark.createDataFrame([(1, "", 1), (2, None, 1), (3, "a", 1)], ddl), "id", ["part"])
    write_upsert_partitioned(spark, path, spark.createDataFrame([(1, None, 2), (2, "", 2), (3, "", 2)], ddl), "id", ["part"])
    assert rows_of(read_partitioned(spark, path).select("id", "part", "v")) == [(1, None, 2), (2, None, 2), (3, None, 2)]
    assert not os.path.exists(os.path.join(path, "part=a"))


def test_partitioned_table_keeps_new_columns(spark, scratch):
    from trendlake.sources.upsert import read_partitioned, write_upsert_partitioned
    path = os.path.join(scratch, "p")
    up = lambda rows, ddl: write_upsert_partitioned(spark, path, spark.createDataFrame(rows, ddl), "id", ["part"])
    up([(1, "x", 1), (2, "y", 2)], "id long, part string, v int")
    up([(2, "y", "E")], "id long, part string, extra string")
    up([(3, "y", 3_000_000_000)], "id long, part string, v long")
    assert rows_of(read_partitioned(spark, path).select("id", "part", "v", "extra")) == [
        (1, "x", 1, None), (2, "y", 2, "E"), (3, "y", 3_000_000_000, None)]
    with pytest.raises(SchemaConflict):
        up([(1, 5)], "id long, part int")


def test_folder_without_a_log_is_taken_over(spark, scratch):
    from trendlake.sources.upsert import read_partitioned, write_upsert_partitioned
    path = os.path.join(scratch, "p")
    spark.createDataFrame([(1, "01", 1)], "id long, part string, v int").write.partitionBy("part").parquet(path)
    spark.createDataFrame([(2, "02", 1, "E")], "id long, part string, v int, extra string").write.mode("append").partitionBy("part").parquet(path)
    write_upsert_partitioned(spark, path, spark.createDataFrame([(1, "01", 9)], "id long, part string, v int"), "id", ["part"])
    assert rows_of(read_partitioned(spark, path).select("id", "part", "v", "extra")) == [(1, "01", 9, None), (2, "02", 1, "E")]


def test_versions_table_follows_the_schema_rules(spark, scratch):
    from trendlake.sources.upsert import read_table, write_upsert
    up = lambda rows, ddl: write_upsert(spark, scratch, spark.createDataFrame(rows, ddl), "id")
    up([(1, 1), (2, 2)], "id int, v int")
    up([(2, 3_000_000_000, "E")], "id long, v long, extra string")
    up([(1, 7)], "id long, v int")
    assert rows_of(read_table(spark, scratch).select("id", "v", "extra")) == [(1, 7, None), (2, 3_000_000_000, "E")]
    with pytest.raises(SchemaConflict):
        up([(1, "a")], "id long, v string")


def test_versions_table_keeps_partition_types(spark, scratch):
    from trendlake.sources.upsert import read_table, write_upsert
    for rows in ([(1, "01", 1), (2, "2", 1)], [(2, "02", 5)]):
        write_upsert(spark, scratch, spark.createDataFrame(rows, "id long, part string, v int"), "id", partition_by=["part"])
    assert rows_of(read_table(spark, scratch).select("id", "part", "v")) == [(1, "01", 1), (2, "02", 5)]


# --- streams -------------------------------------------------------------------------

SCHEMA = "id long, v long, at timestamp, tags array<string>"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(rows))


def test_first_seen_over_runs(spark, scratch):
    from pyspark.sql.types import StructType
    from trendlake.streaming.ingest import first_seen
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))

    def run():
        stream = first_seen(spark.readStream.schema(StructType.fromDDL(SCHEMA)).json(src), "id", ["at"])
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(
            availableNow=True).start().awaitTermination()
        return rows_of(spark.read.parquet(out).select("id", "v", F.date_format("at", "HH:mm:ss.SSSSSS"), "tags"))

    land(src, "a.json", ['{"id":1,"v":9,"at":"2024-01-01T10:00:02.000001Z","tags":["x"]}', '{"id":1,"v":2,"at":"2024-01-01T10:00:01.123456Z"}',
                         '{"id":2,"v":3}', '{"v":4}'])
    first = run()
    assert first == sorted([(1, 2, "10:00:01.123456", None), (2, 3, None, None), (None, 4, None, None)], key=repr)
    land(src, "b.json", ['{"id":1,"v":7,"at":"2020-01-01T00:00:00Z"}', '{"id":3,"v":1}', '{"v":4}'])
    assert run() == sorted(first + [(3, 1, None, None), (None, 4, None, None)], key=repr)


@pytest.mark.parametrize("keyed", [True, False])
def test_stream_epochs_are_committed_once(spark, scratch, monkeypatch, keyed):
    """A run that dies after its table was written, but before its epoch was
    logged: the rerun gives the rows, stamps and versions of one run."""
    from pyspark.sql.types import StructType
    from trendlake import REFERENCE_ROLES as R
    from trendlake.sources import upsert as up
    from trendlake.streaming import ingest as ing
    schema = StructType.fromDDL("id long, v long, updated_at string")

    def run(name, **more):
        path = os.path.join(scratch, name)
        return ing.ingest_stream(spark, os.path.join(scratch, "in"), path, path + "-ck", R, schema=schema, source_format="json",
                                 options={"multiLine": "false"}, keyed=keyed, **more)

    def state(name):
        path = os.path.join(scratch, name)
        if keyed:
            t = KeyedTable(spark, path, "id")
            return t.version(), rows_of(t.read())
        return len(up.versions(spark, path)), rows_of(up.read_table(spark, path))

    def dying(target, name):
        real = getattr(target, name)

        def broken(*a, **k):
            real(*a, **k)
            raise RuntimeError("lost after the commit")
        monkeypatch.setattr(target, name, broken)
        with pytest.raises(Exception):
            run("two", ingested_at=AT)
        monkeypatch.setattr(target, name, real)

    land(os.path.join(scratch, "in"), "a.json", ['{"id":1,"v":1,"updated_at":"1"}', '{"id":2,"v":1,"updated_at":"1"}'])
    run("one", ingested_at=AT)
    run("two", ingested_at=AT)
    land(os.path.join(scratch, "in"), "b.json", ['{"id":2,"v":5,"updated_at":"2"}', '{"id":3,"v":1,"updated_at":"1"}'])
    run("one", ingested_at=AT)
    dying(*((KeyedTable, "upsert") if keyed else (ing, "write_upsert")))
    done = state("two")
    run("two", ingested_at=LATER)                               # replay: skipped, stamps included
    assert state("two") == done == state("one")
    land(os.path.join(scratch, "in"), "c.json", ['{"id":3,"v":8,"updated_at":"3"}'])
    run("one", ingested_at=LATER)
    run("two", ingested_at=LATER)
    assert state("two") == state("one")


def test_stream_takes_each_key_once(spark, scratch):
    from pyspark.sql.types import StructType
    from trendlake import REFERENCE_ROLES as R
    from trendlake.streaming.ingest import ingest_stream
    schema, src, path = StructType.fromDDL("id long, v long, updated_at string"), os.path.join(scratch, "in"), os.path.join(scratch, "t")
    spec = Totals("all", {"one": "1"}, {"v": "v"})
    for name, rows in (("a.json", ['{"id":1,"v":1,"updated_at":"1"}', '{"id":1,"v":2,"updated_at":"2"}']),
                       ("b.json", ['{"id":1,"v":3,"updated_at":"3"}', '{"id":2,"v":4,"updated_at":"1"}'])):
        land(src, name, rows)
        ingest_stream(spark, src, path, path + "-ck", R, schema=schema, options={"multiLine": "false"}, keyed=True, totals=[spec],
                      only_first=True, order_by=["updated_at"], ingested_at=AT)
    t = KeyedTable(spark, path, "id")
    assert [r[:2] for r in rows_of(t.read())] == [(1, 1), (2, 4)] and rows_of(t.read_totals("all")) == [(1, 2, 5)]
    assert t.epoch(path + "-ck") == 1


def test_mark_errors_are_not_taken_for_no_mark(spark, scratch):
    from trendlake.sources import io
    assert io.load_mark(spark, os.path.join(scratch, "none")) is None
    with open(os.path.join(scratch, "broken"), "w", encoding="utf-8") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        io.load_mark(spark, os.path.join(scratch, "broken"))
