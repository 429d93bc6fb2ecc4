"""Sources, sinks, copy-on-write upsert and the streaming ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from trendlake import REFERENCE_ROLES as R
from trendlake.operators.quality import quality_report
from trendlake.sources import io
from trendlake.sources.upsert import (current_version, keys_fit_broadcast, read_table, versions, write_upsert,
                                      write_upsert_partitioned)
from trendlake.streaming.ingest import ingest_stream


def record(i, stars=100, lang="Python", updated="2024-01-01T00:00:00Z", created="2022-03-01T00:00:00Z",
           topics=("ai",)):
    return {"id": i, "name": f"r{i}", "full_name": f"o/r{i}", "language": lang, "stars": stars, "forks": 1,
            "open_issues": 0, "created_at": created, "updated_at": updated, "description": None,
            "topics": list(topics), "html_url": None}


def write_array(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(records, fh, indent=2)


def test_read_json_array_and_load(spark, scratch):
    p = os.path.join(scratch, "raw", "raw.json")
    write_array(p, [record(1), record(2, lang=None), {"id": 3, "name": "x"}])
    df = io.read_json_array(spark, p)
    assert df.count() == 3 and df.columns == io.ITEM_SCHEMA.fieldNames()
    assert io.load(spark, "json", p).count() == 3
    df.write.parquet(os.path.join(scratch, "pq"))
    assert io.load(spark, "parquet", os.path.join(scratch, "pq")).count() == 3
    with pytest.raises(ValueError):
        io.load(spark, "mongo")


def test_csv_results_all_parts(spark, scratch):
    df = spark.range(0, 100, numPartitions=4).selectExpr("id", "id * 2 AS v")
    out = os.path.join(scratch, "res")
    io.write_csv(df, out)
    back = io.read_result(spark, out, "id long, v long")
    assert back.count() == 100 and back.agg({"v": "sum"}).first()[0] == 9900


def test_write_json_and_register(spark, scratch):
    df = spark.createDataFrame([("Go", 3)], "language string, total_stars long")
    io.write_json(df, os.path.join(scratch, "j"))
    assert spark.read.json(os.path.join(scratch, "j")).first().language == "Go"
    io.register(df, "totals_view")
    assert spark.sql("SELECT total_stars FROM totals_view").first()[0] == 3


def test_layers_partitioned_by_year(spark, scratch):
    p = os.path.join(scratch, "raw.json")
    write_array(p, [record(1, created="2022-01-01T00:00:00Z"), record(2, created="2023-06-01T00:00:00Z"),
                    record(3, lang=None)])
    paths = io.write_layers(io.read_json_array(spark, p), R, os.path.join(scratch, "lake"))
    assert spark.read.parquet(paths["bronze"]).count() == 3
    assert sorted(d for d in os.listdir(paths["silver"]) if d.startswith("year=")) == ["year=2022", "year=2023"]
    gold = spark.read.parquet(paths["gold"])
    assert sorted((r.year, r.repo_count) for r in gold.collect()) == [(2022, 1), (2023, 1)]


def test_mark_roundtrip(spark, scratch):
    path = os.path.join(scratch, "mark")
    assert io.load_mark(spark, path) is None
    df = spark.createDataFrame([record(1, updated="2024-03-01T10:00:00Z"), record(2, updated="2024-03-02T00:00:00Z")],
                               io.ITEM_SCHEMA)
    io.save_mark(df, R, path)
    ts, n = io.load_mark(spark, path)
    assert n == 2 and (ts.year, ts.month, ts.day) == (2024, 3, 2)
    # neither an empty run nor an older batch nor a failed write moves the mark back
    io.save_mark(df.limit(0), R, path)
    io.save_mark(spark.createDataFrame([record(3, updated="2023-01-01T00:00:00Z")], io.ITEM_SCHEMA), R, path)
    with pytest.raises(Exception):
        io.save_mark(df.withColumn("updated_at", F.raise_error(F.lit("lost"))), R, path)
    assert io.load_mark(spark, path) == (ts, n)


def test_missing_input(spark, scratch):
    df = io.read_or_none(io.read_json_array, spark, os.path.join(scratch, "nope.json"))
    assert df is None
    rep = io.quality_or_error(spark, df, quality_report, "raw input missing")
    assert rep.first().error == "raw input missing"


def test_copy_on_write_upsert(spark, scratch):
    table = os.path.join(scratch, "table")
    b1 = spark.createDataFrame([record(1, stars=1), record(2, stars=2)], io.ITEM_SCHEMA)
    v1 = write_upsert(spark, table, b1, "id", "updated_at", "2024-01-02 00:00:00")
    b2 = spark.createDataFrame([record(2, stars=20, updated="2024-02-01T00:00:00Z"), record(3, stars=3)],
                               io.ITEM_SCHEMA)
    v2 = write_upsert(spark, table, b2, "id", "updated_at", "2024-02-02 00:00:00")
    assert v1 != v2 and current_version(spark, table) == v2
    got = {r.id: r.stars for r in read_table(spark, table).collect()}
    assert got == {1: 1, 2: 20, 3: 3}
    assert spark.read.parquet(v1).count() == 2  # the old version is untouched


def test_stream_ingest_in_two_runs_equals_one(spark, scratch):
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    t_two, t_one = os.path.join(scratch, "two"), os.path.join(scratch, "one")
    first = [record(1, stars=100), record(2, stars=40), record(3, stars=300)]
    second = [record(1, stars=150, updated="2024-02-01T00:00:00Z"), record(4, stars=500), record(None, stars=999)]
    write_array(os.path.join(src, "a.json"), first)
    ingest_stream(spark, src, t_two, ck, R, min_measure=50, ingested_at="2024-03-01 00:00:00")
    write_array(os.path.join(src, "b.json"), second)
    ingest_stream(spark, src, t_two, ck, R, min_measure=50, ingested_at="2024-03-01 00:00:00")
    got = {r.id: r.stars for r in read_table(spark, t_two).collect()}
    assert got == {1: 150, 3: 300, 4: 500}
    # one run over both files gives the same table
    ingest_stream(spark, src, t_one, os.path.join(scratch, "ck1"), R, min_measure=50,
                  ingested_at="2024-03-01 00:00:00")
    strip = lambda p: sorted(tuple(r) for r in read_table(spark, p).drop("ingested_at").collect())
    assert strip(t_one) == strip(t_two)
    # a run with no new files leaves the table as it is
    before = current_version(spark, t_two)
    ingest_stream(spark, src, t_two, ck, R, min_measure=50)
    assert current_version(spark, t_two) == before


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, scratch):
    from trendlake.sources.upsert import write_upsert_partitioned
    table = os.path.join(scratch, "ptable")
    year = lambda r: int(r["created_at"][:4])
    schema = StructType(io.ITEM_SCHEMA.fields + [StructField("year", IntegerType())])
    rows = [record(i, stars=i, created=f"{2020 + i % 3}-05-01T00:00:00Z") for i in range(12)]
    first = spark.createDataFrame([{**r, "year": year(r)} for r in rows], schema)
    assert write_upsert_partitioned(spark, table, first, "id", ["year"], "updated_at", "2024-01-01 00:00:00") == 3
    files = {y: sorted(os.listdir(os.path.join(table, f"year={y}"))) for y in (2020, 2021, 2022)}
    upd = [record(4, stars=400, created="2021-05-01T00:00:00Z", updated="2024-02-01T00:00:00Z"),
           record(99, stars=99, created="2021-07-01T00:00:00Z")]
    batch = spark.createDataFrame([{**r, "year": year(r)} for r in upd], schema)
    assert write_upsert_partitioned(spark, table, batch, "id", ["year"], "updated_at", "2024-03-01 00:00:00") == 1
    assert sorted(os.listdir(os.path.join(table, "year=2020"))) == files[2020]
    assert sorted(os.listdir(os.path.join(table, "year=2022"))) == files[2022]
    got = {r.id: (r.stars, r.year) for r in spark.read.parquet(table).collect()}
    assert len(got) == 13 and got[4] == (400, 2021) and got[99] == (99, 2021) and got[1] == (1, 2021)


def test_write_observed_counts_during_write(spark, scratch):
    df = spark.range(0, 250, numPartitions=5).selectExpr("id", "id % 7 AS k")
    out = os.path.join(scratch, "obs")
    m = io.write_observed(df, lambda d: d.write.mode("overwrite").parquet(out), "ids")
    assert m == {"output": "ids", "row_count": 250}
    assert spark.read.parquet(out).count() == 250


def test_flatten_raw_api_items(spark, scratch):
    from trendlake.operators.ingest import ITEM_FIELDS, flatten_items
    p = os.path.join(scratch, "api", "page.json")
    write_array(p, [{"id": 1, "name": "a", "full_name": "o/a", "language": "Go", "stargazers_count": 70,
                     "forks_count": None, "created_at": "2023-01-01T00:00:00Z", "owner": {"login": "o"}},
                    {"id": 2, "name": "b", "stargazers_count": 9}])
    raw = spark.read.option("multiLine", True).json(p)
    out = {r.id: r for r in flatten_items(raw).collect()}
    assert flatten_items(raw).columns == list(ITEM_FIELDS)
    assert (out[1].stars, out[1].forks, out[1].open_issues, out[1].topics) == (70, 0, 0, [])
    assert (out[2].stars, out[2].language, out[2].html_url) == (9, None, None)


def test_stream_ingest_of_raw_api_items(spark, scratch):
    from pyspark.sql.types import LongType, StringType

    from trendlake.operators.ingest import flatten_items
    api_schema = StructType([StructField("id", LongType()), StructField("name", StringType()),
                             StructField("full_name", StringType()), StructField("language", StringType()),
                             StructField("stargazers_count", LongType()), StructField("forks_count", LongType()),
                             StructField("created_at", StringType()), StructField("updated_at", StringType())])
    src = os.path.join(scratch, "api")
    write_array(os.path.join(src, "p1.json"), [
        {"id": 1, "name": "a", "language": "Go", "stargazers_count": 80, "forks_count": 3,
         "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"},
        {"id": 2, "name": "b", "language": "Go", "stargazers_count": 20,
         "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}])
    write_array(os.path.join(src, "p2.json"), [
        {"id": 1, "name": "a", "language": "Go", "stargazers_count": 95,
         "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-03-01T00:00:00Z"}])
    table = os.path.join(scratch, "items")
    ingest_stream(spark, src, table, os.path.join(scratch, "ck"), R, schema=api_schema,
                  shape=lambda df: flatten_items(df).where("stars > 50"), ingested_at="2024-04-01 00:00:00")
    got = {r.id: (r.stars, r.forks, r.topics) for r in read_table(spark, table).collect()}
    assert got == {1: (95, 0, [])}


def test_load_csv_source(spark, scratch):
    out = os.path.join(scratch, "items_csv")
    spark.createDataFrame([(1, "Go", 10)], "id long, language string, stars long").write.option("header", True).csv(out)
    df = io.load(spark, "csv", out)
    r = df.first()
    assert (r.id, r.language, r.stars) == (1, "Go", 10)


def test_partitioned_upsert_with_null_partition(spark, scratch):
    from trendlake.sources.upsert import write_upsert_partitioned
    table = os.path.join(scratch, "ntable")
    schema = "id long, v long, updated_at string, year int"
    first = spark.createDataFrame([(1, 1, "2024-01-01", None), (2, 2, "2024-01-01", 2020)], schema)
    write_upsert_partitioned(spark, table, first, "id", ["year"], "updated_at", "2024-01-02 00:00:00")
    batch = spark.createDataFrame([(1, 10, "2024-02-01", None)], schema)
    assert write_upsert_partitioned(spark, table, batch, "id", ["year"], "updated_at", "2024-02-02 00:00:00") == 1
    got = {r.id: (r.v, r.year) for r in spark.read.parquet(table).collect()}
    assert got == {1: (10, None), 2: (2, 2020)}


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_upserts_on_any_path_form(spark, scratch, scheme, monkeypatch, tmp_path_factory):
    rows = [record(i, stars=i, created=f"{2020 + i % 2}-05-01T00:00:00Z") for i in range(6)]
    first = spark.createDataFrame(rows, io.ITEM_SCHEMA).withColumn("year", F.substring("created_at", 1, 4).cast("int"))
    one = first.where("id = 1").withColumn("stars", F.lit(100).cast("long"))
    whole, parts = f"{scheme}{scratch}/whole", f"{scheme}{scratch}/parts"
    for batch, stamp in ((first, "2024-01-01 00:00:00"), (one, "2024-02-01 00:00:00")):
        monkeypatch.chdir(tmp_path_factory.mktemp("cwd"))
        write_upsert(spark, whole, batch, "id", "updated_at", stamp)
        write_upsert_partitioned(spark, parts, batch, "id", ["year"], "updated_at", stamp)
    expected = {i: 100 if i == 1 else i for i in range(6)}
    assert {r.id: r.stars for r in read_table(spark, whole).collect()} == expected
    assert {r.id: r.stars for r in spark.read.parquet(parts).collect()} == expected


def test_versions_are_kept_as_told(spark, scratch):
    table = os.path.join(scratch, "t")
    seen = [write_upsert(spark, table, spark.createDataFrame([record(i)], io.ITEM_SCHEMA), "id", "updated_at",
                         keep_versions=3) for i in range(5)]
    assert versions(spark, table) == seen[-3:]
    assert read_table(spark, table).count() == 5
    os.makedirs(os.path.join(table, "v-000000000099-torn"))  # no _SUCCESS: never read
    assert current_version(spark, table) == seen[-1]


def test_key_that_changes_partition_moves(spark, scratch):
    table = os.path.join(scratch, "p")
    schema = "id long, year int, name string, updated_at string"
    first = spark.createDataFrame([(0, 2020, "a", "1"), (1, 2021, "b", "1"), (2, 2022, "c", "1")], schema)
    write_upsert_partitioned(spark, table, first, "id", ["year"], "updated_at", "2024-01-01 00:00:00")
    batch = spark.createDataFrame([(0, 2021, "moved", "2")], schema)
    assert write_upsert_partitioned(spark, table, batch, "id", ["year"], "updated_at", "2024-02-01 00:00:00") == 2
    got = sorted((r.id, r.year, r.name) for r in spark.read.parquet(table).collect())
    assert got == [(0, 2021, "moved"), (1, 2021, "b"), (2, 2022, "c")]


def test_many_touched_partitions_take_the_join(spark, scratch, monkeypatch):
    from trendlake.sources import upsert as up
    monkeypatch.setattr(up, "PRUNE_PARTITIONS", 2)
    table, schema = os.path.join(scratch, "m"), "id long, part string, v int"
    first = spark.createDataFrame([(i, f"p/{i}", 1) for i in range(5)] + [(9, None, 1)], schema)
    write_upsert_partitioned(spark, table, first, "id", ["part"])
    batch = spark.createDataFrame([(i, f"p/{i}", 2) for i in range(4)] + [(9, "p/1", 2)], schema)
    write_upsert_partitioned(spark, table, batch, "id", ["part"])
    got = sorted((r.id, r.part, r.v) for r in spark.read.parquet(table).collect())
    assert got == [(0, "p/0", 2), (1, "p/1", 2), (2, "p/2", 2), (3, "p/3", 2), (4, "p/4", 1), (9, "p/1", 2)]


def test_wide_keys_are_measured_in_bytes(spark):
    wide = spark.range(200).select(F.repeat(F.lit("x"), 1000).alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
        assert not keys_fit_broadcast(wide) and keys_fit_broadcast(wide.limit(50))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stream_into_partitions_leaves_the_others(spark, scratch):
    src, ck, table = (os.path.join(scratch, x) for x in ("in", "ck", "t"))
    shape = lambda df: df.withColumn("year", F.substring("created_at", 1, 4).cast("int"))
    run = lambda: ingest_stream(spark, src, table, ck, R, shape=shape, partition_by=["year"],
                                ingested_at="2024-03-01 00:00:00")
    write_array(os.path.join(src, "a.json"), [record(i, created=f"{2020 + i}-01-01T00:00:00Z") for i in range(3)])
    run()
    before = {y: sorted(os.listdir(os.path.join(table, f"year={y}"))) for y in (2020, 2021, 2022)}
    write_array(os.path.join(src, "b.json"), [record(1, stars=7, created="2021-01-01T00:00:00Z",
                                                     updated="2025-01-01T00:00:00Z")])
    run()
    after = {y: sorted(os.listdir(os.path.join(table, f"year={y}"))) for y in (2020, 2021, 2022)}
    assert [y for y in before if before[y] != after[y]] == [2021]
    assert {r.id: r.stars for r in spark.read.parquet(table).collect()}[1] == 7
