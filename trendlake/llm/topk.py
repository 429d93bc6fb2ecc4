"""Exact top-k search by inner product over norm-sorted vectors.

Components are floor(256 * x).  Candidates are laid out in blocks by
descending length; queries get a first threshold (their k-th best score among
the longest ``seeds`` vectors) and meet only the blocks whose longest vector
can still reach it: q.c <= |q| |c|.  Inside a block, slices are taken in
descending length with vectors rotated by the right singular vectors of a
sample: the products of the first ``lead`` rotated coordinates plus the
Cauchy-Schwarz bound of the rest, |q_rest| |c_rest|, are compared with the
query's running threshold, and only survivors get the exact integer product.
The rotation and the seeds only decide what is skipped, never the result; the
bounds carry a margin for rounding.

Queries are blocked with others that meet about as many candidate blocks, so
few block pairs that cannot matter are formed; a task holds one block of queries and one of candidates.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part; a row with a null vec_id is no query but a candidate like any other,
counts after all others in ties and stays null in the result; vectors of different lengths are
compared with zeros appended to the shorter (one very long vector sets the width,
and the rotation is width x width on the driver); rows that repeat a vec_id, equal
ones included, are rows of their own: each is a candidate and, if it is a query,
answered apart, with only itself left out (query_id and rank then repeat); all
scores tie towards the smaller vec_id; extra columns are not read; scores beyond a long are cut to its
ends; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import ship_code, table, written

K = 5
QUERY_MODULUS = 50
SEEDS, SAMPLE = 1024, 4096
QUERY_BLOCK, CANDIDATE_BLOCK, SLICE = 2048, 4096, 512
_EXACT = float(1 << 53)


def integer_vectors(lists, dim: int) -> np.ndarray:
    """floor(256 * x) as integer-valued doubles, zero-padded to ``dim``."""
    out = np.zeros((len(lists), dim))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return np.floor(256.0 * out)


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact q @ c.T of integer-valued doubles; an int64 array, cut at its ends."""
    if not q.size or not c.size or np.abs(q).max() * np.abs(c).max() * max(1, q.shape[1]) < _EXACT:
        return (q @ c.T).astype(np.int64)
    a = np.array([[int(x) for x in r] for r in q], dtype=object).reshape(q.shape)
    b = np.array([[int(x) for x in r] for r in c], dtype=object).reshape(c.shape)
    return np.clip(a.dot(b.T), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of(rows, scores, ids, k: int):
    """The first k per row by (score descending, id ascending)."""
    order = np.lexsort((ids, ~scores, rows))
    rows, scores, ids = rows[order], scores[order], ids[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], scores[keep], ids[keep]


def block_top(q_uids, q, limits, c_uids, c_ids, c, rotation, k: int = K, lead: int | None = None,
              slice_rows: int = SLICE):
    """Top-k candidates of one block for each query, given lower limits of the
    queries' k-th scores: (query row, score, candidate id).  The uids tell rows
    apart: a query skips the candidate of its own uid."""
    lead = lead or max(1, q.shape[1] // 4)
    qr, cr = q @ rotation, c @ rotation
    rest = lambda x: np.sqrt((x[:, lead:] ** 2).sum(1))
    norm = lambda x: np.sqrt((x ** 2).sum(1))
    q_rest, q_norm, c_norm = rest(qr), norm(q), norm(c)
    order = np.argsort(-c_norm, kind="stable")
    c, cr, c_uids, c_ids, c_norm = c[order], cr[order], c_uids[order], c_ids[order], c_norm[order]
    c_rest = rest(cr)
    limits = limits.astype(np.float64).copy()
    rows, scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(c), slice_rows):
        s = slice(at, at + slice_rows)
        slack = 1e-9 * (q_norm * c_norm[at] + 1.0)
        live = np.flatnonzero(q_norm * c_norm[at] + slack >= limits)
        if not len(live):
            break
        bound = qr[live, :lead] @ cr[s, :lead].T + q_rest[live, None] * c_rest[None, s]
        maybe = (bound + slack[live, None] >= limits[live, None]) & (q_uids[live, None] != c_uids[None, s])
        hit = maybe.any(1)
        live, maybe = live[hit], maybe[hit]
        cols = np.flatnonzero(maybe.any(0))
        if not len(live):
            continue
        product = exact_products(q[live], c[s][cols])
        i, j = np.nonzero(maybe[:, cols] & (product >= limits[live, None]))
        rows, scores, ids = best_of(np.concatenate([rows, live[i]]), np.concatenate([scores, product[i, j]]),
                                    np.concatenate([ids, c_ids[s][cols][j]]), k)
        full, n = np.unique(rows, return_counts=True)
        last = np.cumsum(n) - 1
        full, last = full[n == k], last[n == k]
        limits[full] = np.maximum(limits[full], scores[last].astype(np.float64))
    return rows, scores, ids


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, no_id, v (array<double>): every row whose vector takes part; a null id is 0 with ``no_id`` set."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (vectors.where(F.col(vector_col).isNotNull() & fine)
            .select(F.coalesce(F.col(id_col), F.lit(0)).alias("id"), F.col(id_col).isNull().alias("no_id"), v.alias("v")))


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query;
    ``is_query`` is a Column over ``id``; rows without an id are no queries."""
    spark = vectors.sparkSession
    ship_code(spark)
    v = clean(vectors, id_col, vector_col)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(x * 256).cast("double") * F.floor(x * 256).cast("double"))
    # ``place``: spreads equally long rows; the id, or where there is none the place in the input.
    place = F.when(F.col("no_id"), F.monotonically_increasing_id()).otherwise(F.col("id"))
    v = v.withColumn("norm", F.sqrt(square)).withColumn("place", place)
    # Blocks of candidates by descending length: range partitions, rows in order, fixed by the write.
    order = [F.desc("norm"), F.xxhash64("place"), F.col("id"), F.col("v")]
    at = F.monotonically_increasing_id()
    cand = written(v.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("uid", at).withColumn("block", F.shiftright(at, 33) * (1 << 21)
                               + F.floor(at.bitwiseAND((1 << 33) - 1) / CANDIDATE_BLOCK)), "topk-candidates")
    blocks = cand.groupBy("block").agg(F.max("norm").alias("longest"), F.max(F.size("v")).alias("dim")).collect()
    empty = "query_id long, rank int, vec_id long, score long"
    if not blocks:
        return spark.createDataFrame([], empty)
    dim = max(b["dim"] for b in blocks)
    by_length = sorted(((b["longest"], b["block"]) for b in blocks), key=lambda x: (-x[0], x[1]))
    longest, names = np.array([b[0] for b in by_length]), np.array([b[1] for b in by_length])
    seed_rows = cand.orderBy(F.desc("norm"), "id").limit(SEEDS).collect()
    seed_ids, seed_uids = (np.array([r[c] for r in seed_rows], np.int64) for c in ("id", "uid"))
    seeds = integer_vectors([r["v"] for r in seed_rows], dim)
    sample = cand.orderBy(F.xxhash64("place", F.lit(3)), "id").limit(SAMPLE).collect()
    sample = integer_vectors([r["v"] for r in sample], dim)
    values, axes = np.linalg.eigh(sample.T @ sample / max(1, len(sample)))
    rotation = axes[:, ::-1].copy()

    def thresholds(batches):
        from trendlake.llm import topk
        for pdf in batches:
            uids, q = pdf["uid"].to_numpy(), topk.integer_vectors(list(pdf["v"]), dim)
            limits = np.full(len(q), -np.inf)
            rows, scores, _ = topk.block_top(uids, q, limits, seed_uids, seed_ids, seeds, rotation, k)
            found, n = np.unique(rows, return_counts=True)
            last = np.cumsum(n) - 1
            limits[found[n == k]] = scores[last[n == k]]
            norm = np.sqrt((q ** 2).sum(1))
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(norm > 0, limits / norm, -np.inf) * (1 - 1e-9) - 1e-9
            need = np.where(limits < 0, -np.inf, need)
            met = np.searchsorted(-longest, -need, side="right")
            yield pd.DataFrame({"uid": uids, "id": pdf["id"], "v": pdf["v"], "lim": limits, "met": met.astype(np.int64)})

    queries = cand.where(is_query & ~F.col("no_id")).select("uid", "id", "v").mapInPandas(
        thresholds, "uid long, id long, v array<double>, lim double, met long")
    # Blocks of queries that meet about as many blocks (classes of the bit length of ``met``), split by hash.
    queries = written(queries.withColumn("cls", F.length(F.bin("met"))), "topk-queries")
    parts = [(r["cls"], -(-r["n"] // QUERY_BLOCK)) for r in
             queries.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()]
    split = F.coalesce(*[F.when(F.col("cls") == c, F.lit(n)) for c, n in parts], F.lit(1))
    queries = queries.withColumn("qblock", F.col("cls") * (1 << 40) + F.pmod(F.xxhash64("uid"), split)).drop("cls")
    # Pairs of blocks that can matter: block number i (by length) of the first ``met``.
    # Both sides of the cogroup need keys of one type: an int and an equal long hash to different partitions.
    number = F.array(*[F.lit(int(b)).cast("long") for b in names]) if len(names) <= 4096 else None
    meets = queries.groupBy("qblock").agg(F.max("met").alias("met")).where("met > 0").select(
        "qblock", F.explode(F.sequence(F.lit(0).cast("long"), F.col("met") - 1)).alias("i"))
    if number is not None:
        meets = meets.withColumn("block", F.element_at(number, (F.col("i") + 1).cast("int")))
    else:
        ranks = spark.createDataFrame([(i, int(b)) for i, b in enumerate(names)], "i long, block long")
        meets = meets.join(ranks, "i")
    meets = meets.select("qblock", "block")
    left = queries.join(meets, "qblock").select("qblock", "block", "uid", "id", "v", "lim")
    right = cand.join(meets, "block").select(F.col("qblock").alias("qb"), F.col("block").alias("cb"), "uid", "id", "no_id", "v")

    def search(q, c):
        from trendlake.llm import topk
        if not len(q) or not len(c):
            none = pd.DataFrame({"uid": [], "query_id": [], "vec_id": [], "no_id": [], "score": []})
            return none.astype("int64").astype({"no_id": bool})
        uids = q["uid"].to_numpy()
        c = c.sort_values(["no_id", "id"], kind="stable")  # ties go by the place in this order
        rows, scores, found = topk.block_top(
            uids, topk.integer_vectors(list(q["v"]), dim), q["lim"].to_numpy(), c["uid"].to_numpy(), np.arange(len(c)),
            topk.integer_vectors(list(c["v"]), dim), rotation, k)
        return pd.DataFrame({"uid": uids[rows], "query_id": q["id"].to_numpy()[rows], "vec_id": c["id"].to_numpy()[found],
                             "no_id": c["no_id"].to_numpy()[found], "score": scores})

    found = (left.groupBy("qblock", "block").cogroup(right.groupBy("qb", "cb"))
             .applyInPandas(search, "uid long, query_id long, vec_id long, no_id boolean, score long"))
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "no_id", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score"))


def op9_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_MODULUS == 0)


OP9_SQL = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.uid <> c.uid),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
