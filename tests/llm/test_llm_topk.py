"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label string, norm string, v string, block string"


def brute(rows, k, every):
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, vector) in enumerate(ints):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(vector, c)), i)
                            for n, (i, c) in enumerate(ints) if n != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize("case", ["normal", "ties", "awkward", "huge"])
def test_top_k(spark, monkeypatch, case):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "SEEDS", 16)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 12)) * rng.lognormal(0, 1, (300, 1))
    if case == "ties":
        x = np.round(x[:, :3])
        x[50:200] = x[50]
    if case == "huge":
        x = x * 3e4
    rows = [(i, [float(a) for a in v], "l", "n", "v", "b") for i, v in enumerate(x)]
    if case == "awkward":
        tail = ("l", "n", "v", "b")
        rows += [(None, [1.0] * 12, *tail), (1000, None, *tail), (1001, [None] + [1.0] * 11, *tail),
                 (1002, [float("nan")] * 12, *tail), (1003, [float("inf")] + [0.0] * 11, *tail), (1010, [], *tail),
                 (1020, [0.0] * 12, *tail), (1030, [2.0], *tail), rows[10], rows[11], (20, [1.0] * 12, *tail), (11, [9.0] * 12, *tail), (-20, [-3.0] * 12, *tail)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("id") % 10 == 0, 5)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, 5, 10))


def test_rows_of_a_repeated_id_all_count(spark):
    rows = [(i, v, "", "", "", "") for i, v in [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (51, [2.0, 0.0]), (51, [3.0, 1.0]),
                                                (50, [1.0, 0.0]), (7, [2.0, 0.0])]]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0, 5).collect()
    assert len(got) == 15 and sorted(tuple(r) for r in got) == sorted(brute(rows, 5, 50))


def test_blocks_meet_in_many_partitions(spark, monkeypatch):
    """Queries and candidates of a pair of blocks get to the same task when partitions are not merged into one."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "SEEDS", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(a) for a in v], "l", "n", "v", "b") for i, v in enumerate(rng.normal(size=(600, 6)))]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, 5).collect()
    finally:
        spark.conf.set(name, before)
    assert len(got) == 300 and sorted(tuple(r) for r in got) == sorted(brute(rows, 5, 10))


def test_rows_without_an_id_are_candidates(spark, monkeypatch, tmp_path):
    """No queries, last in ties, null in the result; the query's table, in several blocks."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    monkeypatch.setattr(topk, "SEEDS", 16)
    x = np.round(np.random.default_rng(5).normal(size=(400, 3)), 1).astype(np.float32)
    x[100:130] = x[100] = [4.0, -4.0, 4.0]
    ids = [None if i % 7 == 0 else (i * 25) % 2000 - 500 for i in range(400)]
    rows = [(i, [float(a) for a in v]) for i, v in zip(ids, x)]
    rows += [(None, None), (None, [None, 9.0, 9.0]), (None, [float("inf"), 9.0, 9.0]), ((1 << 63) - 1, rows[100][1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    ints = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if v is not None and all(a is not None and np.isfinite(a) for a in v)]
    want = []
    for at, (q, vector) in enumerate(ints):
        if q is not None and q % 50 == 0:
            scored = sorted((-int(vector @ c), i is None, i or 0) for n, (i, c) in enumerate(ints) if n != at)[:5]
            want += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scored)]
    got = topk.op9_topk(spark, str(tmp_path))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert any(r[2] is None for r in want) and sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_only_rows_without_an_id_beside_the_query(spark):
    rows = [(i, v, "", "", "", "") for i, v in [(50, [1.0]), (None, [2.0]), (None, [2.0]), (None, [-1.0])]]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == [(50, 1, None, 131072), (50, 2, None, 131072), (50, 3, None, -65536)]


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(50, [1.0, 2.0], "", "", "", ""), (51, [3.0, 4.0], "", "", "", "")], SCHEMA)
    got = topk.top_k(df, F.col("id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(50, 1, 51, 256 * 768 + 512 * 1024)]
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(df.where("vec_id = 51"), F.col("id") % 50 == 0).count() == 0


def test_blocks_are_pruned(spark):
    """Late blocks of short vectors are skipped, with the same result."""
    rng = np.random.default_rng(0)
    c = np.floor(256 * rng.normal(size=(4000, 16)) * np.linspace(8, 0.01, 4000)[:, None])
    q = np.floor(256 * rng.normal(size=(20, 16)))
    ids, seen = np.arange(4000), []
    real = topk.exact_products
    try:
        topk.exact_products = lambda a, b: (seen.append(a.shape[0] * b.shape[0]), real(a, b))[1]
        rows, scores, found = topk.block_top(np.arange(-20, 0), q, np.full(20, -np.inf), ids, ids, c, np.linalg.qr(
            rng.normal(size=(16, 16)))[0])
    finally:
        topk.exact_products = real
    for k in range(20):
        s = (q[k] @ c.T).astype(np.int64)
        order = np.lexsort((ids, -s))[:5]
        assert found[rows == k].tolist() == order.tolist() and scores[rows == k].tolist() == s[order].tolist()
    assert sum(seen) < 0.5 * 20 * 4000
