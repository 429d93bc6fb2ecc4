"""Betweenness: closed forms and brute-force Brandes on a small fixture."""

from collections import deque

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from trendlake.operators import graph as gr
from trendlake.plans import catalog


def edge_frame(spark, pairs):
    rows = [(min(a, b), max(a, b), "e") for a, b in pairs]
    return spark.createDataFrame(rows, "src string, dst string, edge_type string")


def scores(df):
    return {r.node: r.betweenness_centrality for r in df.collect()}


def brandes(edges):
    """Textbook Brandes (2001), all sources, normalised for undirected graphs."""
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    nodes = sorted(adj)
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        order, preds = [], {v: [] for v in nodes}
        sigma, dist = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, -1)
        sigma[s], dist[s] = 1.0, 0
        q = deque([s])
        while q:
            v = q.popleft()
            order.append(v)
            for w in adj[v]:
                if dist[w] < 0:
                    dist[w] = dist[v] + 1
                    q.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        for w in reversed(order):
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    n = len(nodes)
    return {v: b / ((n - 1) * (n - 2)) for v, b in bc.items()}


def test_star_of_five(spark):
    got = scores(gr.betweenness(edge_frame(spark, [("c", f"l{i}") for i in range(4)]), k=None))
    assert got["c"] == pytest.approx(1.0)
    assert all(got[f"l{i}"] == 0.0 for i in range(4))


def test_path_of_four(spark):
    got = scores(gr.betweenness(edge_frame(spark, [("a", "b"), ("b", "c"), ("c", "d")]), k=None))
    assert [got[v] for v in "abcd"] == pytest.approx([0.0, 2 / 3, 2 / 3, 0.0])


def test_two_nodes_all_zero(spark):
    assert scores(gr.betweenness(edge_frame(spark, [("a", "b")]))) == {"a": 0.0, "b": 0.0}


@pytest.mark.parametrize("hot", [None, 3])
def test_documents_graph_matches_brute_force(spark, hot):
    # every source (k >= n) -> exact; hot=3 forces the salted join path
    edges = catalog.q_edges(spark, SMALL).where(F.col("src").startswith("repo:1")
                                                | F.col("dst").startswith("repo:1"))
    pairs = [(r.src, r.dst) for r in edges.collect()]
    expected = brandes(pairs)
    got = scores(gr.betweenness(edges, k=10_000, hot_degree=hot))
    assert set(got) == set(expected)
    for v, b in expected.items():
        assert got[v] == pytest.approx(b, abs=1e-12)


def test_sampled_sources_are_scaled(spark):
    pairs = [("c", f"l{i}") for i in range(6)]
    full = scores(gr.betweenness(edge_frame(spark, pairs), k=None))
    sampled = scores(gr.betweenness(edge_frame(spark, pairs), k=3, seed=7))
    # every leaf source credits the centre with 5 paths; scale n / k compensates the sample
    assert full["c"] == pytest.approx(1.0)
    chosen = gr.sample_sources(spark.createDataFrame([(v,) for v in ["c"] + [f"l{i}" for i in range(6)]],
                                                     "node string"), 3, 7).collect()
    leaves = sum(1 for r in chosen if r.s != "c")
    assert sampled["c"] == pytest.approx(leaves * 5 / 30 * 7 / 3)


def test_degree_centrality(spark):
    deg = {r.node: r.degree_centrality
           for r in gr.degree_centrality(edge_frame(spark, [("a", "b"), ("b", "c")])).collect()}
    assert deg == {"a": 0.5, "b": 1.0, "c": 0.5}


def test_graph_metrics_sorted_by_degree(spark):
    rows = gr.graph_metrics(edge_frame(spark, [("c", f"l{i}") for i in range(4)]), k=None).collect()
    assert rows[0].node == "c" and rows[0].degree_centrality == 1.0


def test_id_collision_falls_back_to_exact_numbering(spark, monkeypatch):
    # every name hashes to the same id: the exact numbering must take over
    monkeypatch.setattr(gr.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    got = scores(gr.betweenness(edge_frame(spark, [("a", "b"), ("b", "c"), ("c", "d")]), k=None))
    assert [got[v] for v in "abcd"] == pytest.approx([0.0, 2 / 3, 2 / 3, 0.0])


def test_graph_metrics_degree_matches_degree_query(spark):
    edges = catalog.q_edges(spark, SMALL)
    a = {r.node: r.degree_centrality for r in gr.graph_metrics(edges, k=5).collect()}
    b = {r.node: r.degree_centrality for r in gr.degree_centrality(edges).collect()}
    assert a == b


def test_hot_node_buckets_hold_a_fixed_number_of_rows(spark):
    hub = spark.createDataFrame([("hub", f"x{i:04d}", "e") for i in range(1000)], "src string, dst string, edge_type string")
    adj = gr._adjacency(hub).select(F.xxhash64("u").alias("u"), F.xxhash64("w").alias("w"))
    deg = adj.groupBy("u").agg(F.count(F.lit(1)).alias("deg"))
    for limit in (1 << 20, -1):  # hot table broadcast, or joined
        rows, hot = gr.salted_adjacency(adj, deg, 100, limit)
        sizes = [r["n"] for r in rows.groupBy("u", "asalt").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert hot.count() == 1 and sum(sizes) == 2000 and max(sizes) <= 160
