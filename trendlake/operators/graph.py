"""Item-category-tag graph: edges, degree and betweenness centrality.

The graph lives in an edge DataFrame ``(src, dst, edge_type)``: an undirected
simple graph, one row per unordered node pair, ``src < dst``.

Betweenness is Brandes' algorithm run level-synchronously for all sampled
sources at once: the state is a DataFrame of ``(source, node, sigma)`` rows
per BFS level, every level one salted equi-join with the adjacency list plus
a grouped sum; the dependency accumulation walks the levels back the same
way.  Work and state are O(k * edges) and O(k * nodes) and spread over all
tasks; no node's adjacency list is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions import node_name
from trendlake.roles import Roles
from trendlake.session import broadcast_threshold, ensure_checkpoint_dir

# Node-name prefixes and edge types of the item graph.
ITEM_PREFIX, CATEGORY_PREFIX, TAG_PREFIX = "repo", "lang", "topic"
ITEM_CATEGORY_EDGE, ITEM_TAG_EDGE = "repo-language", "repo-topic"
UNKNOWN_CATEGORY = "Unknown"


def build_edges(df: DataFrame, roles: Roles) -> DataFrame:
    """G1: an item-category edge for every row (null or empty category ->
    ``lang:Unknown``) and an item-tag edge for every tag; parallel edges
    (a repeated tag, a repeated item) are merged."""
    item = F.concat(F.lit(ITEM_PREFIX + ":"), F.coalesce(F.col(roles.key).cast("string"), F.lit("None")))
    cat_edges = df.select(item.alias("a"), node_name(CATEGORY_PREFIX, roles.category, UNKNOWN_CATEGORY).alias("b"),
                          F.lit(ITEM_CATEGORY_EDGE).alias("edge_type"))
    tag_edges = (df.select(item.alias("a"), F.explode(F.col(roles.tags)).alias("_t"))
                 .select("a", F.concat(F.lit(TAG_PREFIX + ":"), F.coalesce(F.col("_t"), F.lit("None"))).alias("b"),
                         F.lit(ITEM_TAG_EDGE).alias("edge_type")))
    e = cat_edges.unionByName(tag_edges).where(F.col("a") != F.col("b"))
    return (e.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "edge_type")
            .groupBy("src", "dst").agg(F.max("edge_type").alias("edge_type")))


def _adjacency(edges: DataFrame) -> DataFrame:
    return (edges.select(F.col("src").alias("u"), F.col("dst").alias("w"))
            .unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("w"))))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """``degree / (n - 1)`` per node (1.0 for a one-node graph)."""
    deg = _adjacency(edges).groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    n = deg.agg(F.count(F.lit(1))).scalar()
    return deg.select("node", "degree",
                      F.when(n > 1, F.col("degree") / (n - 1)).otherwise(F.lit(1.0)).alias("degree_centrality"))


def _with_salt(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Replicate rows whose ``key`` is a hot node once per salt value of that node."""
    j = df.join(hot, F.col(key) == F.col("_hot"), "left")
    n_salts = F.coalesce(F.col("_nsalt"), F.lit(1))
    return j.withColumn("salt", F.explode(F.sequence(F.lit(0), n_salts - 1))).drop("_hot", "_nsalt")


def sample_sources(nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """The ``k`` nodes with the smallest md5 of "seed:node" (ties by name): a
    deterministic, uniform-looking sample chosen without a driver round trip."""
    h = F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col("node")).cast("binary"))
    return nodes.orderBy(h, F.col("node")).limit(k).select(F.col("node").alias("s"))


HOT_DEGREE = 100_000


def salted_adjacency(adj: DataFrame, deg: DataFrame, hot_degree: int, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The adjacency list (u, w, asalt) with the rows of every node of
    ``hot_degree`` or more spread over ``ceil(degree / hot_degree)`` salts, and
    the table of those nodes (_hot, _nsalt), to be broadcast only if it fits."""
    hot = deg.where(F.col("deg") >= hot_degree).select(
        F.col("u").alias("_hot"), F.ceil(F.col("deg") / hot_degree).cast("int").alias("_nsalt")).checkpoint()
    if hot.count() * 32 <= broadcast_bytes:
        hot = F.broadcast(hot)
    spread = (adj.join(hot, F.col("u") == F.col("_hot"), "left")
              .select("u", "w", F.when(F.col("_nsalt").isNull(), F.lit(0))
                      .otherwise(F.pmod(F.xxhash64("w"), F.col("_nsalt"))).cast("int").alias("asalt"))
              .repartition("u", "asalt").checkpoint())
    return spread, hot


def betweenness(edges: DataFrame, k: int | None = 100, seed: int = 42, normalized: bool = True,
                hot_degree: int | None = None, with_degree: bool = False) -> DataFrame:
    """Betweenness centrality from ``min(k, n)`` sampled sources.

    Scaling as in the classic sampled estimator: for normalized scores
    ``1 / ((n-1)(n-2)) * n / k`` (0 for n <= 2), else ``1/2 * n / k``.  With
    ``k >= n`` every node is a source and the result is exact; the state then
    holds n x n rows, so keep ``k`` fixed on large graphs.

    Per BFS level: expand the frontier over the adjacency list, then one
    grouped aggregate over (expansion UNION the two previous levels) both
    sums the path counts and drops nodes already seen - one shuffle.  The
    dependency pass walks the levels back the same way.

    Adjacency join: the adjacency list's byte size is computed exactly from
    the degree table; when it fits ``spark.sql.autoBroadcastJoinThreshold``
    it is broadcast (no shuffle, no skew).  Beyond that it is joined by a
    shuffle on pre-partitioned data, with hot nodes salted: a node with
    ``degree >= hot_degree`` (a fixed ``HOT_DEGREE`` by default, whatever the
    graph's size) has its adjacency rows spread over
    ``ceil(degree / hot_degree)`` buckets and frontier rows reaching it are
    replicated per bucket, so a bucket holds about ``hot_degree`` adjacency
    rows of one node.  The table of hot nodes is broadcast when its counted
    rows fit the threshold, else joined.
    Node names are replaced by 64-bit ids for the iteration (a
    collision-checked hash of the name; an exact numbering if it collides).
    Every level is checkpointed to the reliable checkpoint directory
    (lineage cut; survives executor loss).
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    named = _adjacency(edges)
    # Node names -> 64-bit ids so that every join and grouping of the iteration
    # hashes and shuffles longs, not strings.  The id is a hash of the name,
    # computed in place (no join, so a hub node's adjacency rows never meet in
    # one join task); a distinct count proves it collision-free, otherwise ids
    # come from an exact, checkpointed numbering joined by name.
    ids = (named.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
           .withColumn("nid", F.xxhash64("node")).checkpoint())
    n, m2, distinct_ids = ids.agg(F.count(F.lit(1)), F.coalesce(F.sum("deg"), F.lit(0)),
                                  F.count_distinct("nid")).first()
    extra = [F.col("deg").alias("degree")] if with_degree else []
    if n <= 2:
        return ids.select("node", *extra, F.lit(0.0).alias("betweenness_centrality"))
    if distinct_ids == n:
        adj = named.select(F.xxhash64("u").alias("u"), F.xxhash64("w").alias("w"))
    else:
        ids = ids.withColumn("nid", F.monotonically_increasing_id()).checkpoint()
        id_of = ids.select("node", "nid")
        adj = (named.join(id_of.withColumnsRenamed({"node": "u", "nid": "u_id"}), "u")
               .join(id_of.withColumnsRenamed({"node": "w", "nid": "w_id"}), "w")
               .select(F.col("u_id").alias("u"), F.col("w_id").alias("w")))
    id_of = ids.select("node", "nid")
    deg = ids.select(F.col("nid").alias("u"), "deg")
    kk = n if k is None else min(int(k), n)
    # UnsafeRow of two longs: 8 (null bits) + 2 x 8
    adj_bytes = m2 * 24
    limit = broadcast_threshold(spark)
    small = 0 <= adj_bytes <= limit and hot_degree is None

    if small:
        adj_b = F.broadcast(adj.checkpoint())

        def expand(df: DataFrame, key: str, value: str) -> DataFrame:
            return df.join(adj_b, df[key] == adj_b["u"]).select("s", F.col("w").alias("v"), value)
    else:
        adj_s, hot = salted_adjacency(adj, deg, hot_degree or HOT_DEGREE, limit)

        def expand(df: DataFrame, key: str, value: str) -> DataFrame:
            return (_with_salt(df, key, hot)
                    .join(adj_s, (F.col(key) == F.col("u")) & (F.col("salt") == F.col("asalt")))
                    .select("s", F.col("w").alias("v"), value))

    # forward: BFS levels with shortest-path counts
    sources = sample_sources(ids.select("node"), kk, seed).join(
        id_of.withColumnsRenamed({"node": "s", "nid": "s_id"}), "s").select(F.col("s_id").alias("s"))
    levels = [sources.select("s", F.col("s").alias("v"), F.lit(1.0).alias("sigma")).checkpoint()]
    reached_total = kk
    while reached_total < kk * n:  # stop early once every source has reached every node
        cur = levels[-1]
        # In an undirected graph a neighbour of level d lies on level d-1, d or d+1.
        seen = cur.select("s", "v", F.lit(None).cast("double").alias("sigma"), F.lit(1).alias("_old"))
        if len(levels) > 1:
            seen = seen.unionByName(levels[-2].select("s", "v", F.lit(None).cast("double").alias("sigma"),
                                                      F.lit(1).alias("_old")))
        reached = expand(cur, "v", "sigma").withColumn("_old", F.lit(0))
        nxt = (reached.unionByName(seen).groupBy("s", "v")
               .agg(F.sum("sigma").alias("sigma"), F.max("_old").alias("_old"))
               .where(F.col("_old") == 0).drop("_old").checkpoint())
        found = nxt.count()  # reads the checkpoint, no recomputation
        if found == 0:
            break
        levels.append(nxt)
        reached_total += found

    # backward: dependencies, deepest level first
    deltas = []
    below = levels[-1].select("s", "v", "sigma", F.lit(0.0).alias("delta"))
    for d in range(len(levels) - 2, 0, -1):
        coef = below.select("s", F.col("v").alias("x"), ((1.0 + F.col("delta")) / F.col("sigma")).alias("coef"))
        contrib = expand(coef, "x", "coef").select("s", "v", F.lit(None).cast("double").alias("sigma"), "coef")
        here = levels[d].select("s", "v", "sigma", F.lit(None).cast("double").alias("coef"))
        cur = (contrib.unionByName(here).groupBy("s", "v")
               .agg(F.max("sigma").alias("sigma"), F.sum("coef").alias("csum"))
               .where(F.col("sigma").isNotNull())
               .select("s", "v", "sigma", F.coalesce(F.col("sigma") * F.col("csum"), F.lit(0.0)).alias("delta"))
               .checkpoint())
        deltas.append(cur.select("v", "delta"))
        below = cur

    if normalized:
        scale = 1.0 / ((n - 1) * (n - 2)) * n / kk
    else:
        scale = 0.5 * n / kk
    if deltas:
        acc = deltas[0]
        for dd in deltas[1:]:
            acc = acc.unionByName(dd)
        score = acc.groupBy(F.col("v").alias("nid")).agg(F.sum("delta").alias("_b"))
        out = ids.join(score, "nid", "left")
    else:
        out = ids.withColumn("_b", F.lit(0.0))
    return out.select("node", *extra,
                      (F.coalesce(F.col("_b"), F.lit(0.0)) * F.lit(scale)).alias("betweenness_centrality"))


def graph_metrics(edges: DataFrame, k: int | None = 100, seed: int = 42, digits: int | None = None) -> DataFrame:
    """G4 (J4, O7): degree and betweenness centrality per node, highest degree
    first (betweenness rounded to ``digits``: its last bits depend on the
    order of the sums).  The degrees come from the betweenness run's own degree table
    (one adjacency aggregation for both measures)."""
    btw = betweenness(edges, k=k, seed=seed, with_degree=True)
    n = btw.agg(F.count(F.lit(1))).scalar()
    deg_c = F.when(n > 1, F.col("degree") / (n - 1)).otherwise(F.lit(1.0))
    score = F.col("betweenness_centrality")
    score = F.round(score, digits) if digits is not None else score
    return (btw.select("node", deg_c.alias("degree_centrality"), score.alias("betweenness_centrality"))
            .orderBy(F.desc("degree_centrality"), F.asc("node")))
