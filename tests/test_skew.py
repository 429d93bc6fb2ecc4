"""A third of all rows on one key / year / tag / hub node: results stay exact
and the plans keep their map-side partial steps."""

from collections import deque

import pytest
from pyspark.sql import functions as F

from trendlake import REFERENCE_ROLES as R
from trendlake.operators import aggregate as agg
from trendlake.operators import graph as gr
from trendlake.operators import ingest as ing
from trendlake.operators import prepare as prep
from trendlake.sources.io import ITEM_SCHEMA
from trendlake.sources.upsert import upsert

N = 3000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_items(spark):
    rows = []
    for i in range(N):
        key = 7 if i % 3 == 0 else i                      # key 7 holds a third of the rows
        year = 2023 if i % 3 == 0 else 2020 + i % 4       # 2023 holds more than a third
        tags = ["hot"] if i % 3 == 0 else [f"t{i % 11}"]  # tag "hot" holds a third
        rows.append((key, f"n{i}", None, "Go" if i % 3 else "Py", i % 997, 1, 0,
                     f"{year}-0{1 + i % 9}-01T00:00:00Z", f"2024-01-01T00:{i % 60:02d}:{i % 59:02d}Z",
                     None, tags, None))
    return rows, spark.createDataFrame(rows, ITEM_SCHEMA)


def test_hot_key_dedupe_and_upsert(spark):
    rows, df = skewed_items(spark)
    d = ing.dedupe_first(df, "id", ["updated_at"])
    assert "partial_min" in plan(d)
    hot = [r for r in rows if r[0] == 7]
    first = min(hot, key=lambda r: (r[8], r[1]))
    got = d.where("id = 7").first()
    assert (got.updated_at, got.name) == (first[8], first[1])
    assert d.count() == len({r[0] for r in rows})
    up = upsert(df.limit(0), df, "id", "updated_at", "2024-02-01 00:00:00")
    latest = max(hot, key=lambda r: (r[8], r[1]))
    got = up.where("id = 7").first()
    assert (got.updated_at, got.name) == (latest[8], latest[1])
    assert up.count() == len({r[0] for r in rows})


def test_hot_year_top_n(spark):
    rows, df = skewed_items(spark)
    top = ing.top_n_per_year(df, R, 5)
    assert "WindowGroupLimit" in plan(top)
    for y in (2020, 2021, 2022, 2023):
        in_year = sorted((r for r in rows if r[7].startswith(str(y))), key=lambda r: (-r[4], r[0]))[:5]
        got = top.where(F.col("year") == y).orderBy(F.desc("stars"), "id").collect()
        assert [(r.id, r.stars) for r in got] == [(r[0], r[4]) for r in in_year]


def test_hot_tag_stats(spark):
    rows, df = skewed_items(spark)
    stats = agg.tag_stats(prep.base_table(df, R), R)
    assert "partial_count" in plan(stats)
    hot = stats.where("topic = 'hot'").first()
    assert hot.repo_count == N // 3
    assert hot.total_stars == sum(r[4] for r in rows if r[10] == ["hot"])


def brandes(pairs):
    adj = {}
    for a, b in pairs:
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


def test_hub_node_salted_betweenness(spark):
    # items 0..89: every third one in category "hub" (a third of all items), the rest
    # spread over 6 small categories; one tag per five items
    rows = [(i, "hub" if i % 3 == 0 else f"c{i % 6}", [f"g{i % 5}"]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, language string, topics array<string>")
    edges = gr.build_edges(df, R)
    pairs = [(r.src, r.dst) for r in edges.collect()]
    expected = brandes(pairs)
    got = {r.node: r.betweenness_centrality for r in gr.betweenness(edges, k=None, hot_degree=10).collect()}
    for v, b in expected.items():
        assert got[v] == pytest.approx(b, abs=1e-12)
