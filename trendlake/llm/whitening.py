"""Embedding whitening on leading covariance eigenvectors found by spectrum
slicing.

Entries c become f = floor(1024 * c), x = f + 100000.  Three passes over the
vectors: exact sums (f, rows); the exact matrix of d dᵀ with d = f - floor(mean f),
integers below one of the true mean, from which the rest of the mean is taken
exactly, so the covariance V of x (divisor n, centred) is rounded once, at the
end, and does not depend on the order of the tasks; the whitened values.  Tasks
send dim and dim * (dim + 1) / 2 integers (in 48-bit limbs) to a partial sum;
only the totals reach the driver.

Spectrum slicing: the inertia of V - s I, read off an LDLᵀ factorisation with
1x1 and 2x2 pivots, counts the eigenvalues above s (Sylvester).  Halving
isolates eigenvalue k between shifts with counts k and k - 1, Rayleigh quotient
iteration converges to it cubically, and two more counts around the result
certify that it is number k.  Eigenvalues that cannot be told apart in double
precision are taken as one cluster by block inverse iteration.

Bounds: the driver and each task hold one dim x dim matrix (dim: the longest
vector); everything else is in proportion to a batch of rows.

Defined cases: vectors that are null or hold null or non-finite entries are
dropped; shorter vectors count as filled up with zeros; rows are never merged,
whatever their ids (null and repeated ids stay); entries whose f is beyond
±2^62 are cut there and ``deviation`` is cut at the ends of a long; components
without variance (at rounding level of the first) are left out, as nothing can
be divided by their deviation: equal vectors, one vector or an empty table give
no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import dense, finite, ship_code, table, written

COMPONENTS = 8
SCALE, OFFSET = 1024.0, 100000
EPS = float(np.finfo(np.float64).eps)
LIMB = 48
_SAFE = 1 << 40
_LONG = (1 << 63) - 1


# --- exact integers --------------------------------------------------------------

def scaled(lists, dim: int) -> np.ndarray:
    """floor(1024 * c) as int64."""
    return np.clip(np.floor(SCALE * dense(lists, dim)), -(2.0 ** 62), 2.0 ** 62).astype(np.int64)


def exact_gram(d: np.ndarray) -> np.ndarray:
    """dᵀ d of integers, as Python integers."""
    top = int(np.abs(d).max(initial=0))
    if top * top * max(1, len(d)) < 1 << 53:
        return (d.T.astype(np.float64) @ d.astype(np.float64)).astype(np.int64).astype(object)
    return d.T.astype(object).dot(d.astype(object))


def limbs(value: int) -> tuple[int, int, int]:
    low = (1 << LIMB) - 1
    return value & low, (value >> LIMB) & low, value >> (2 * LIMB)


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sum of the parts (i, j, three limbs) by (i, j)."""
    add = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("i", "j").agg(add("a"), add("b"), add("c")).collect()
    return {(r["i"], r["j"]): int(r["a"]) + (int(r["b"]) << LIMB) + (int(r["c"]) << 2 * LIMB) for r in rows}


PART = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())])
PART_DDL = "i int, j int, a long, b long, c long"


def _part(cells) -> pa.RecordBatch:
    rows = [(i, j, *limbs(int(v))) for i, j, v in cells]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], PART.field(k).type) for k in range(5)], schema=PART)


def moments(vectors: DataFrame):
    """(n, sums of f, integer means m, sums of d = f - m, matrix of sums of d dᵀ)
    of the column ``v``; all Python integers."""

    def sums(batches):
        from trendlake.llm import whitening as w
        rows, total = 0, np.zeros(0, dtype=object)
        for batch in batches:
            lists = batch.column(0)
            longest = max((len(x) for x in lists), default=0)
            if longest > len(total):
                total = np.concatenate([total, np.zeros(longest - len(total), dtype=object)])
            f = w.scaled(lists, longest)
            rows += len(f)
            small = np.abs(f).max(initial=0) < w._SAFE
            total[:longest] += (f.sum(0) if small else f.astype(object).sum(0)).astype(object)
        yield w._part([(-1, -1, rows), *((i, -1, v) for i, v in enumerate(total))])

    found = _totals(vectors.select("v").mapInArrow(sums, PART_DDL))
    n, dim = found.get((-1, -1), 0), max((i for i, _ in found), default=-1) + 1
    total = [found[i, -1] for i in range(dim)]
    if not n or not dim:
        return n, total, [], [], np.zeros((0, 0), dtype=object)
    means = [t // n for t in total]

    def gram(batches):
        from trendlake.llm import whitening as w
        upper = np.triu_indices(dim)
        total = np.zeros((dim, dim), dtype=object)
        m = np.array(means, dtype=np.int64)
        for batch in batches:
            total = total + w.exact_gram(w.scaled(batch.column(0), dim) - m)
        yield w._part(zip(*upper, total[upper]))

    found = _totals(vectors.select("v").mapInArrow(gram, PART_DDL))
    squares = np.zeros((dim, dim), dtype=object)
    for (i, j), v in found.items():
        squares[i, j] = squares[j, i] = v
    return n, total, means, [t - n * m for t, m in zip(total, means)], squares


def covariance(n: int, rest, squares) -> np.ndarray:
    """Covariance of x, each entry rounded once: (n Σ d dᵀ - s sᵀ) / n²."""
    s = np.array(rest, dtype=object)
    exact = n * squares - np.outer(s, s)
    return np.array([[a / (n * n) for a in row] for row in exact], dtype=np.float64).reshape(exact.shape)


# --- spectrum slicing --------------------------------------------------------------

def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` lie above ``shift``: the
    positive part of the inertia of D in a - shift I = P L D Lᵀ Pᵀ (Bunch-Kaufman
    pivots)."""
    a = a - shift * np.eye(len(a))
    n, k, count, alpha = len(a), 0, 0, (1 + 17 ** 0.5) / 8

    def swap(i, j):
        if i != j:
            a[[i, j], :] = a[[j, i], :]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        biggest = below[r - k - 1] if len(below) else 0.0
        pair = False
        if biggest > 0 and abs(a[k, k]) < alpha * biggest:
            row = np.abs(a[k:, r])
            row[r - k] = 0
            widest = row.max()
            if abs(a[k, k]) * widest < alpha * biggest * biggest:
                if abs(a[r, r]) >= alpha * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    pair = True
        if pair:
            c = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
            count, k = count + 1, k + 2     # a 2x2 pivot has one eigenvalue of each sign
        else:
            pivot, c = a[k, k], a[k + 1:, k].copy()
            if pivot != 0:
                a[k + 1:, k + 1:] -= np.outer(c / pivot, c)
            count, k = count + (pivot > 0), k + 1
    return count


def _solve(a, shift, b):
    for nudge in (0.0, EPS, 8 * EPS, 64 * EPS):
        try:
            x = np.linalg.solve(a - (shift + nudge * (abs(shift) + np.abs(a).max())) * np.eye(len(a)), b)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all():
            return x
    return b


def _apart(x, basis):
    """x without its parts along the columns of ``basis``, twice for rounding."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def leading(v: np.ndarray, wanted: int = COMPONENTS):
    """(eigenvalues, unit eigenvectors as columns): the leading ones of the
    covariance ``v`` with variance, by falling eigenvalue, at most ``wanted``;
    the largest entry of each vector is positive."""
    dim = len(v)
    scale = np.abs(v).max(initial=0.0)
    if not dim or scale == 0:
        return np.zeros(0), np.zeros((dim, 0))
    a = v / scale
    top = float(np.abs(a).sum(1).max()) * (1 + EPS)
    tol = 8 * dim * EPS * top
    counts = {top: 0, -tol: dim}

    def count(s):
        if s not in counts:
            counts[s] = above(a, s)
        return counts[s]

    start = np.cos(np.arange(1, dim + 1) ** 2 * 0.7) + 0.01 / np.arange(1, dim + 1)
    values, vectors = [], np.zeros((dim, 0))
    while len(values) < min(wanted, dim):
        k = len(values) + 1
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        while True:
            while high - low > tol and (counts[high] != k - 1 or counts[low] != k):
                mid = (low + high) / 2
                low, high = (mid, high) if count(mid) >= k else (low, mid)
            members = max(1, counts[low] - counts[high])
            if high - low <= tol:
                # one value, or several that double precision cannot separate
                block = np.stack([start ** (i + 1) + np.roll(start, i) for i in range(min(members, dim - k + 1))], 1)
                for _ in range(4):
                    block = np.linalg.qr(_apart(_solve(a, (low + high) / 2 + tol, block), vectors))[0]
                found, turn = np.linalg.eigh(block.T @ a @ block)
                order = np.argsort(-found)
                values += list(found[order])
                vectors = np.concatenate([vectors, block @ turn[:, order]], 1)
                break
            x = _apart(_solve(a, (low + high) / 2, start), vectors)
            x = x / np.linalg.norm(x)
            last = np.inf
            for _ in range(12):
                rho = float(x @ a @ x)
                error = np.linalg.norm(a @ x - rho * x)
                if error <= 2 * EPS * top or (error <= tol and error >= last / 2):
                    break
                last = error
                y = _apart(_solve(a, rho, x), vectors)
                x = y / np.linalg.norm(y)
            rho = float(x @ a @ x)
            if low < rho <= high and error <= tol and count(rho - tol) >= k and count(rho + tol) < k:
                values.append(rho)
                vectors = np.concatenate([vectors, x[:, None]], 1)
                break
            # drawn to another eigenvalue: one more halving, then start nearer
            count((low + high) / 2)
            low = max(s for s, c in counts.items() if c >= k)
            high = min(s for s, c in counts.items() if c < k)
    values = np.array(values[:wanted])
    vectors = vectors[:, :len(values)]
    keep = values > tol
    values, vectors = values[keep] * scale, vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))]) if len(values) else np.zeros(0)
    return values, vectors * sign


# --- whitening -----------------------------------------------------------------------

def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: the id, component, n,
    deviation, whitened, explained and identity_error (the largest entry of the
    measured covariance of the whitened values minus the identity)."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.where(finite(F.col(vector_col))).select(F.col(id_col).alias("id"),
                                                            F.col(vector_col).cast("array<double>").alias("v"))
    n, _, means, rest, squares = moments(rows)
    v = covariance(n, rest, squares) if n and means else np.zeros((0, 0))
    values, axes = leading(v, components)
    k, dim = len(values), len(v)
    kind = vectors.select(id_col).schema[0]
    out = f"`{kind.name}` {kind.dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], out)
    turn, shares = axes / np.sqrt(values), [float(e / np.trace(v)) for e in values]
    s = np.array(rest, dtype=object)
    id_type = pa.field("id", rows_type(rows, "id"))

    def project(batches):
        from trendlake.llm import whitening as w
        m, small_rest = np.array(means, dtype=np.int64), np.array([float(x) / n for x in rest])
        wide = max(abs(int(x)) for x in s)
        for batch in batches:
            d = w.scaled(batch.column(1), dim) - m
            top = n * int(np.abs(d).max(initial=0)) + wide
            if top * top * dim <= w._LONG:
                deviation = ((n * d - s.astype(np.int64)) ** 2).sum(1)
            else:
                exact = ((n * d.astype(object) - s) ** 2).sum(1)
                deviation = np.array([min(int(x), w._LONG) for x in exact], dtype=np.int64)
            white = (d - small_rest) @ turn
            lists = pa.ListArray.from_arrays(np.arange(0, (len(d) + 1) * k, k, dtype=np.int32), white.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type.type), pa.array(deviation), lists],
                                             ["id", "deviation", "w"])

    white = written(rows.mapInArrow(project, f"id {kind.dataType.simpleString()}, deviation long, w array<double>"),
                    "whitened")
    at = lambda i: F.element_at("w", i + 1)
    mean = list(white.agg(*[F.avg(at(i)).alias(f"m{i}") for i in range(k)]).first())
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = white.agg(*[F.avg((at(i) - mean[i]) * (at(j) - mean[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))
    return white.select("id", "deviation", F.posexplode("w").alias("pos", "whitened")).select(
        F.col("id").alias(kind.name), (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(F.array(*[F.lit(x) for x in shares]), F.col("pos") + 1).alias("explained"),
        F.lit(round(error, 12)).alias("identity_error"))


def rows_type(df: DataFrame, column: str) -> pa.DataType:
    """The Arrow type Spark gives a column."""
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def op11_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
