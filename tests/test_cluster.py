"""Clustering: the rows alone decide (C1, C2); tokens of every script."""

import hashlib
import json
import math
import os
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from conftest import ROOT, SMALL
from trendlake.operators import cluster as cl

RUN = """
import json, sys, tempfile
sys.path.insert(0, {root!r})
from trendlake.operators import cluster as cl
from trendlake.session import get_spark
scratch = tempfile.mkdtemp(prefix="trendlake-cluster-")
spark = get_spark("local[{cores}]", shuffle_partitions={cores}, extra={{"spark.checkpoint.dir": scratch + "/ck",
                  "spark.local.dir": scratch + "/local"}})
docs = spark.read.parquet({small!r} + "/documents.parquet").select("doc_id", "text")
path = scratch + "/docs"
docs.repartition({files}).write.parquet(path)
out = cl.cluster_texts(spark.read.parquet(path), "text", restarts=2, max_iter=3)
print("RESULT" + json.dumps(sorted((r.doc_id, r.cluster_id) for r in out.collect())))
"""


@pytest.mark.parametrize("seed_layout", [(2, 1)])
def test_same_clusters_whatever_cores_and_splits(seed_layout):
    found = []
    for cores, files in [seed_layout, (4, 1), (4, 7)]:
        code = RUN.format(root=ROOT, small=SMALL, cores=cores, files=files)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600,
                              env=os.environ | {"PYTHONPATH": ROOT})
        assert done.returncode == 0, done.stderr[-2000:]
        found.append(json.loads(done.stdout.split("RESULT", 1)[1].splitlines()[0]))
    assert len(found[0]) == 200
    assert found[0] == found[1] == found[2]


def test_tokens_of_every_script(spark):
    texts = ["café über naïve", "Привет, мир!", "你好 世界", "résumé", "a_b 12", "..."]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.token: r.n_tokens for r in cl.token_stats(df, "t").collect()}
    assert got == {t: 1 for t in ["café", "über", "naïve", "привет", "мир", "你好", "世界", "résumé", "a_b", "12"]}
    vectors = {r.id: r.f for r in cl.text_features(df, "t", "f", dim=1024).collect()}
    assert [sum(x != 0 for x in vectors[i]) for i in range(6)] == [3, 2, 2, 1, 2, 0]


def test_token_stats_counts_rows_and_repeats(spark):
    df = spark.createDataFrame([(1, "A a b"), (2, "a"), (3, None), (4, "")], "id long, t string")
    got = {r.token: (r.n_tokens, r.n_rows) for r in cl.token_stats(df, "t").collect()}
    assert got == {"a": (3, 2), "b": (1, 1)}


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, t string")
    out = cl.cluster_texts(df, "t", restarts=2)
    assert out.columns == ["id", "cluster_id"] and out.count() == 0


def brute(rows, k, seed, restarts, max_iter):
    """Plain Lloyd iterations in Python integers from the same start centres."""
    top = max(abs(e) for _, v in rows for e in v)
    scale = 2.0 ** (15 - math.frexp(top)[1])
    x = [[math.floor(e * scale + 0.5) for e in v] for _, v in rows]
    h = [int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % cl.PRIME for key, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (h[i], rows[i][0], x[i]))
    start = cl.first_centres(np.array([h[i] for i in order]), np.array([x[i] for i in order], dtype=float), k, seed, restarts)
    best = None
    for r in range(restarts):
        centres = [[int(e) for e in c] for c in start[r]]
        for turn in range(max_iter + 1):
            far = [[sum((a - b) ** 2 for a, b in zip(p, c)) for c in centres] for p in x]
            ids = [d.index(min(d)) for d in far]
            if turn == max_iter:
                break
            for c in range(k):
                mine = [p for p, i in zip(x, ids) if i == c]
                if mine:
                    centres[c] = [(2 * sum(col) + len(mine)) // (2 * len(mine)) for col in zip(*mine)]
        cost = sum(min(d) for d in far)
        if best is None or cost < best[0]:
            best = (cost, {key: i for (key, _), i in zip(rows, ids)})
    return best[1]


@pytest.mark.parametrize("spread,max_iter", [(0.2, 20), (5.0, 4)])
def test_k_means_equals_plain_lloyd(spark, spread, max_iter):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6)) * 10
    rows = [(i, [float(e) for e in centres[i % 4] + spread * rng.normal(size=6)]) for i in range(120)]
    out = cl.cluster(spark.createDataFrame(rows, "id long, e array<double>").repartition(5), "e", k=4, restarts=3,
                     max_iter=max_iter)
    got = {r.id: r.cluster_id for r in out.collect()}
    assert got == brute(rows, 4, 42, 3, max_iter)
    if spread < 1:
        assert len({(i % 4, c) for i, c in got.items()}) == 4


def test_start_centres_differ_and_follow_the_distance():
    x = np.array([[0.0]] * 50 + [[1000.0]] * 2)
    c = cl.first_centres(np.arange(52) * 7919, x, 2, 42, 10)
    assert all(sorted(run.ravel().tolist()) == [0.0, 1000.0] for run in c)


def test_rows_without_a_vector_and_fewer_rows_than_clusters(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, 2.0]), (None, [9.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, e array<double>")
    got = {r.id: r.cluster_id for r in cl.cluster(df, "e", k=5, restarts=2).collect()}
    assert got[2] is None and got[3] is None and got[6] is None
    assert got[1] == got[4] != got[None]
    zero = cl.cluster(spark.createDataFrame([(1, [0.0]), (2, [])], "id long, e array<double>"), "e", k=2)
    assert {r.cluster_id for r in zero.collect()} == {0}


def test_text_features_against_plain_python(spark):
    texts = ["a b a c", "b", None, "...", "C d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.f for r in cl.text_features(df, "t", "f", hashes=64, dim=8).collect()}
    words = [(t or "").lower().split() if t != "..." else [] for t in texts]
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
    seen = Counter(b for w in words for b in {bucket(t) for t in w})
    for i, w in enumerate(words):
        v = [0.0] * 8
        for b in map(bucket, w):
            v[b % 8] += (1 if b // 8 % 2 == 0 else -1) * math.floor(1024 * math.log(6 / (seen[b] + 1)) + 0.5)
        length = math.sqrt(sum(e * e for e in v)) or 1.0
        assert got[i] == [math.floor(cl.UNIT * e / length + 0.5) for e in v]
