"""Text features and k-means clustering.

The original step embeds text with a pretrained sentence encoder; no weights
are available here, so C1 is re-aimed at dense TF-IDF features of the whole
texts (Unicode tokens -> hashed term frequencies -> IDF -> signed sums into
``dim`` dimensions, which keep inner products in expectation -> unit length),
or at an existing ``array<float>`` embedding column.

C2 is k-means on scaled integers, all restarts in lock-step.  Vectors become
integers by one power of two, centres are rounded to integers, so distances,
sums and costs are exact: equal rows give equal clusters whatever the input's
splits, the cluster's cores or the order of tasks.  Each iteration is one scan:
a task keeps restarts x k sums and returns them once; restarts whose centres stay put
leave the later scans.  The start of each restart is drawn from a bounded sample
with weights proportional to the squared distance from the centres so far.

Defined cases: texts that are null or without tokens are the zero vector; rows whose
vector is null or holds null or non-finite entries get a null cluster; shorter vectors count
as filled up with zeros; ties go to the smaller cluster number; fewer different
rows than clusters leave clusters empty; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions import event_ts
from trendlake.roles import YEAR_COL, Roles
from trendlake.session import ensure_checkpoint_dir, spread

# A token: a run of letters, combining marks, digits and underscores of any script.
TOKEN_GAPS = r"[^\p{L}\p{M}\p{N}_]+"
HASHES, DIM = 1 << 14, 256
IDF_UNIT = 1024             # IDF weights are whole numbers of 1/1024
UNIT = 1 << 15              # greatest size of a component
PRIME = (1 << 31) - 1
SEED_SAMPLE = 4096
MAX_ITER = 20


def tokens(text):
    """The one tokenizer of C1: lower-cased tokens of the whole text."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), TOKEN_GAPS, -1), lambda t: t != "")


def hashed(value):
    """31 to 32 bits of a string's md5 as a long."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def token_stats(df: DataFrame, text_col: str) -> DataFrame:
    """token, n_tokens, n_rows: occurrences of every token of C1 and the rows
    it occurs in: one scan and one partial aggregate.  Sorted words of a row
    lie side by side, so a word unlike the one before it starts a row's count."""
    words = spread(df.select(text_col)).select(F.sort_array(tokens(text_col)).alias("_w"))
    marked = F.transform("_w", lambda t, i: F.struct(
        t.alias("token"),
        F.when((i > 0) & (t == F.get("_w", i - 1)), 0).otherwise(1).cast("long").alias("first")))
    return (words.select(F.explode(marked).alias("_t")).groupBy("_t.token")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("_t.first").alias("n_rows")))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_features(df: DataFrame, text_col: str, out_col: str = "features", hashes: int = HASHES,
                  dim: int = DIM) -> DataFrame:
    """``out_col`` (array<int>) in place of the text.  Every text is
    tokenised once; the driver sees one document frequency per hash value."""
    h = F.transform(tokens(text_col), lambda t: (hashed(t) % hashes).cast("int"))
    rows = _stored(spread(df).withColumn("_h", h).drop(text_col), "text-hashes")
    n = rows.count()
    found = (rows.select(F.explode(F.array_distinct("_h")).alias("h")).groupBy("h")
             .agg(F.count(F.lit(1)).alias("n")).toArrow())
    weight = np.zeros(hashes)
    at = found["h"].to_numpy()
    weight[at] = np.floor(IDF_UNIT * np.log((n + 1) / (found["n"].to_numpy() + 1.0)) + 0.5)
    weight *= np.where(np.arange(hashes) // dim % 2 == 0, 1.0, -1.0)
    unit = UNIT

    def vectors(lists: pa.Array) -> pa.Array:
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        h = lists.flatten().to_numpy(zero_copy_only=False)
        cell = np.repeat(np.arange(len(size), dtype=np.int64), size) * dim + h % dim
        x = np.bincount(cell, weights=weight[h], minlength=len(size) * dim).reshape(len(size), dim)
        length = np.sqrt((x * x).sum(1))
        x = np.floor(unit * x / np.where(length > 0, length, 1.0)[:, None] + 0.5).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * dim), pa.array(x.ravel()))

    return rows.withColumn(out_col, F.arrow_udf(vectors, "array<int>")("_h")).drop("_h")


def cluster_texts(df: DataFrame, text_col: str, k: int | None = None, seed: int = 42, restarts: int = 10,
                  max_iter: int = MAX_ITER, out_col: str = "cluster_id", key: str | None = None) -> DataFrame:
    """C1 + C2 over the whole texts.  All columns but the text are kept."""
    key = key or next(c for c in df.columns if c != text_col)
    points = _stored(text_features(df, text_col, "_x").withColumn("_h", _draw_hash(key)), "points")
    n = points.count()
    return _assigned(points, n, n, k, seed, restarts, max_iter, out_col)


def default_k(n: int) -> int:
    """k = min(8, max(2, n // 10)) with n = all rows."""
    return min(8, max(2, n // 10))


def draw(seed: int, restart: int, step: int) -> tuple[int, int]:
    """Factor and offset of the random numbers (a * h + b) mod PRIME of a draw."""
    d = hashlib.md5(f"{seed}:{restart}:{step}".encode()).hexdigest()
    return int(d[:8], 16) % (PRIME - 1) + 1, int(d[8:16], 16) % PRIME


def first_centres(h: np.ndarray, x: np.ndarray, k: int, seed: int, restarts: int) -> np.ndarray:
    """(restarts, k, dim) start centres: rows of the sample, each drawn with a chance in
    proportion to its squared distance from the nearest one drawn before (the least of
    exponential variates of these rates)."""
    size = (x * x).sum(1)
    out = np.zeros((restarts, k, x.shape[1]))
    for r in range(restarts):
        near = np.ones(len(x))
        for j in range(k):
            a, b = draw(seed, r, j)
            wait = -np.log(((h * a + b) % PRIME + 0.5) / PRIME)
            with np.errstate(divide="ignore"):
                out[r, j] = x[np.argmin(np.where(near > 0, wait / near, np.inf))]
            d = size - 2.0 * (x @ out[r, j]) + out[r, j] @ out[r, j]
            near = d if j == 0 else np.minimum(near, d)
    return out


def integer_points(df: DataFrame, features_col: str, key: str) -> tuple[DataFrame, int, int]:
    """The rows with ``_x`` (array<int>, one length, null where the vector takes no
    part) and ``_h``, stored once; the number of rows and of those with a vector."""
    v = F.col(features_col).cast("array<double>")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    v = F.when(v.isNotNull() & fine, v)
    seen = df.select(v.alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("valid"), F.max(F.size("v")).alias("dim"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, e: F.greatest(a, F.abs(e)))).alias("top")).first()
    dim, top = max(0, seen["dim"] or 0), seen["top"] or 0.0
    scale = math.ldexp(float(UNIT), -math.frexp(top)[1])
    x = F.transform(v, lambda e: F.floor(e * F.lit(scale) + 0.5).cast("int"))
    x = F.concat(x, F.array_repeat(F.lit(0), F.lit(dim) - F.size(x)))
    points = spread(df).withColumn("_x", x).withColumn("_h", _draw_hash(key)).drop(features_col)
    return _stored(points, "points"), seen["n"], seen["valid"]


def _draw_hash(key: str):
    return F.coalesce(hashed(F.col(key).cast("string")) % PRIME, F.lit(0).cast("long"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def fit(points: DataFrame, k: int, seed: int, restarts: int, max_iter: int) -> np.ndarray:
    """The (k, dim) centres of the restart with the lowest cost (ties: the first)."""
    valid = points.where(F.col("_x").isNotNull())
    key = [c for c in points.columns if c not in ("_x", "_h")][:1]
    sample = valid.select("_h", *key, "_x").orderBy("_h", *key, "_x").limit(SEED_SAMPLE).toArrow()
    x = _matrix(sample["_x"].combine_chunks())
    centres = first_centres(sample["_h"].to_numpy(), x, k, seed, restarts)
    dim = x.shape[1]
    cost, live = [0] * restarts, list(range(restarts))
    for turn in range(max_iter + 1):
        sums = _sums(valid, centres[live]).toArrow()
        total = np.zeros((len(live) * k, dim + 3), dtype=np.int64)
        total[sums["c"].to_numpy(), sums["d"].to_numpy()] = sums["s"].to_numpy()
        total = total.reshape(len(live), k, dim + 3)
        moved = []
        for i, r in enumerate(live):
            cost[r] = (int(total[i, :, 1].sum()) << 24) + int(total[i, :, 2].sum())
            n = total[i, :, :1].astype(np.float64)
            new = np.where(n > 0, np.floor((2.0 * total[i, :, 3:] + n) / np.maximum(2.0 * n, 1.0)), centres[r])
            if turn < max_iter and not np.array_equal(new, centres[r]):
                centres[r] = new
                moved.append(r)
        live = moved
        if not live:
            break
    return centres[min(range(restarts), key=lambda r: (cost[r], r))]


def _sums(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """c (restart * k + cluster), d, s: the cell sums of one scan; d is 0 for the
    rows, 1 and 2 for the cost's upper part and lower 24 bits, 3 and on for the dimensions."""
    runs, k, dim = centres.shape
    flat = centres.reshape(runs * k, dim)
    size = (flat * flat).sum(1)

    def scan(batches):
        sums = np.zeros((runs, k, dim + 3), dtype=np.int64)
        for b in batches:
            column = b.column(0)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
            far = ((x * x).sum(1)[:, None] - 2.0 * (x @ flat.T) + size).reshape(len(x), runs, k)
            nearest = far.argmin(2)
            for r in range(runs):
                one = (nearest[:, r, None] == np.arange(k)).astype(np.float64)
                least = far[np.arange(len(x)), r, nearest[:, r]].astype(np.int64)
                extra = np.stack([np.ones(len(x)), least >> 24, least & 0xFFFFFF], axis=1)
                sums[r] += (one.T @ np.hstack([extra, x])).astype(np.int64)
        cell = np.nonzero(sums.reshape(runs * k, dim + 3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell[0].astype(np.int32)), pa.array(cell[1].astype(np.int32)),
             pa.array(sums.reshape(runs * k, dim + 3)[cell])], ["c", "d", "s"])

    return (points.select("_x").mapInArrow(scan, "c int, d int, s long")
            .groupBy("c", "d").agg(F.sum("s").alias("s")))


def cluster(df: DataFrame, features_col: str = "features", k: int | None = None, seed: int = 42,
            restarts: int = 10, max_iter: int = MAX_ITER, out_col: str = "cluster_id", key: str | None = None) -> DataFrame:
    """K-means cluster id per row (all columns but the features kept).
    ``key`` (default: the first column) feeds the draws of the start."""
    key = key or next(c for c in df.columns if c != features_col)
    return _assigned(*integer_points(df, features_col, key), k, seed, restarts, max_iter, out_col)


def _assigned(points: DataFrame, n: int, valid: int, k, seed, restarts, max_iter, out_col) -> DataFrame:
    if valid == 0:
        return points.drop("_x", "_h").withColumn(out_col, F.lit(None).cast("int"))
    centres = fit(points, max(1, min(k or default_k(n), valid)), seed, max(1, restarts), max_iter)
    size = (centres * centres).sum(1)
    dim = centres.shape[1]

    def nearest(column: pa.Array) -> pa.Array:
        there = column.is_valid().to_numpy(zero_copy_only=False)
        ids = np.zeros(len(column), dtype=np.int32)
        x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(int(there.sum()), dim)
        ids[there] = (size - 2.0 * (x @ centres.T)).argmin(1)
        return pa.array(ids, mask=~there)

    return points.withColumn(out_col, F.arrow_udf(nearest, "int")("_x")).drop("_x", "_h")


def cluster_projection(clustered: DataFrame, roles: Roles, cluster_col: str = "cluster_id") -> DataFrame:
    """Key, name, category, event time, measure, cluster id and the event
    year (lenient parse: a bad or missing time gives a null year).  Roles set
    to None are left out, except the year, which is then null."""
    cols = [c for c in (roles.key, roles.name, roles.category, roles.event_time, roles.measure) if c]
    year = F.year(event_ts(clustered, roles.event_time)) if roles.event_time else F.lit(None).cast("int")
    return clustered.select(*cols, cluster_col, year.alias(YEAR_COL))

