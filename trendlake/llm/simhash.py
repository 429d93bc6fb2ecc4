"""SimHash near-duplicates, linked exactly through vantage-point trees.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words with repeats joined by one space (fewer words: the whole
sequence), XXH64 (UTF-8, seed 42) of each; a bit is set when more than half of
the hashes set it.  A text without words has fingerprint 0.

Linking: two fingerprints link at ``max_bits`` or fewer differing bits.  Only
distinct fingerprints are searched.

* By the pigeonhole principle two 64-bit fingerprints within 4 bits are within
  1 bit on at least one of three bit ranges (21, 21 and 22 bits).  Hamming
  distance on a bit range is a metric, so each range gets a vantage-point tree
  with the search radius ``r = max_bits // 3`` instead of ``max_bits``, which
  keeps few fingerprints near a boundary.
* A node sends fingerprints at distance <= mu from its vantage point inside,
  the others outside.  Every fingerprint has one home leaf.  A pair that a node
  separates has the inner one at distance > mu - r: those are sent to the
  outside as visitors too; visitors go wherever the triangle bound
  ``|d(v, x) - d(v, y)| <= r`` leaves partners possible.  So of each pair, one
  meets the other in that one's home leaf.
* A leaf compares its members on all 64 bits: homes are sorted by distance from
  a vantage point and each query only meets homes within ``max_bits`` of its
  own distance (triangle bound again).  It returns a star per local component
  instead of all pairs; connectivity, and so every component, is the same.

The trees are fitted on a bounded sample of fingerprints (``sample_rows``); the
sample only decides where the boundaries run, never what is found.  Their
depth grows with the number of fingerprints, so leaves keep their size; a leaf
with more than ``chunk`` members (one dense ball of fingerprints) is
split into a grid of query and home chunks, each a task of its own.

Components: alternating large-star / small-star steps over the star edges,
each written to the shared checkpoint folder; only aggregates and joins.

Defined cases: null and empty texts have fingerprint 0 and are linked like any
other; repeated rows are documents of their own; a null doc_id takes part in
linking, ``component_id`` is the smallest non-null doc_id (null when there is
none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import scratch_path, ship_code, spread, table, written
from trendlake.session import ensure_checkpoint_dir

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = (21, 21, 22)
LEAF_ROWS = 1024
MAX_DEPTH = 16
SAMPLE_ROWS = 1 << 16
CHUNK = 16384
_WORDS_AT_ONCE = 1 << 16


def fingerprint(text, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text as an unsigned integer."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, _WORDS_AT_ONCE):
        part = words[at:at + _WORDS_AT_ONCE + shingle - 1]
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = (ends - np.fromiter(map(len, part), np.int64, len(part)) - 1)[:len(part) - shingle + 1].tolist()
        ends = (ends[shingle - 1:] - 1).tolist()
        joined = b" ".join(part)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
        for k in range(0, len(h), 8192):
            bits = np.unpackbits(h[k:k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a (signed) long column."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        from trendlake.llm import simhash
        found = np.array([simhash.fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return docs.withColumn(out_col, fp(F.col(text_col)))


# --- vantage-point trees -------------------------------------------------

def _masks(segments=SEGMENTS):
    out, at = [], 0
    for n in segments:
        out.append(np.uint64(((1 << n) - 1) << at))
        at += n
    return out


def build_tree(sample: np.ndarray, mask: np.uint64, depth: int, radius: int, seed: int = 7):
    """(vantage, mu) arrays in heap order for a tree of ``depth`` levels over
    the bits of ``mask``, fitted on ``sample`` (uint64)."""
    rng = np.random.default_rng(seed)
    nodes = (1 << depth) - 1
    vantage, mu = np.zeros(nodes, np.uint64), np.zeros(nodes, np.int64)
    here = {0: sample}
    bits = int(mask).bit_count()
    for node in range(nodes):
        own = here.pop(node, None)
        own = sample[:0] if own is None else own
        if len(own) < 4:
            vantage[node], mu[node] = rng.integers(0, 1 << 63, dtype=np.uint64), bits // 2
            left, right = own, own[:0]
        else:
            best = None
            for v in rng.choice(own, min(6, len(own)), replace=False):
                d = np.bitwise_count((own ^ v) & mask).astype(np.int64)
                share = np.cumsum(np.bincount(d, minlength=bits + 1)) / len(d)
                for m in range(bits):
                    lost = abs(share[m] - 0.5) + (share[min(m + radius, bits)] - share[max(m - radius, 0)]) * 0.5
                    if best is None or lost < best[0]:
                        best = (lost, v, m, d)
            _, vantage[node], mu[node], d = best
            left, right = own[d <= mu[node]], own[d > mu[node]]
        if 2 * node + 2 < nodes:
            here[2 * node + 1], here[2 * node + 2] = left, right
    return vantage, mu


def route(fps: np.ndarray, tree, mask: np.uint64, depth: int, radius: int):
    """(row, leaf, home): the home leaf of each fingerprint and the leaves it visits."""
    vantage, mu = tree
    rows, leaves, homes = [], [], []
    stack = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
    first_leaf = (1 << depth) - 1
    while stack:
        node, idx, home = stack.pop()
        if not len(idx):
            continue
        if node >= first_leaf:
            rows.append(idx)
            leaves.append(np.full(len(idx), node - first_leaf, np.int32))
            homes.append(home)
            continue
        d = np.bitwise_count((fps[idx] ^ vantage[node]) & mask).astype(np.int64)
        m = mu[node]
        inner_home, outer_home = home & (d <= m), home & (d > m)
        go_in = inner_home | (~home & (d <= m + radius))
        go_out = outer_home | (inner_home & (d > m - radius)) | (~home & (d > m - radius))
        stack.append((2 * node + 1, idx[go_in], inner_home[go_in]))
        stack.append((2 * node + 2, idx[go_out], outer_home[go_out]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(leaves), np.concatenate(homes)


class _Labels:
    """Components of small integers by vectorised hooking and pointer jumping."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.of[a], self.of[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(self.of, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


def leaf_stars(queries: np.ndarray, homes: np.ndarray, max_bits: int, cells: int = 1 << 21):
    """Star edges (root, member) of the components of ``queries`` and
    ``homes`` under all links between a query and a home."""
    values, inverse = np.unique(np.concatenate([queries, homes]), return_inverse=True)
    q_id, h_id = inverse[:len(queries)], inverse[len(queries):]
    labels = _Labels(len(values))
    if len(queries) and len(homes):
        point = homes[0]
        hd = np.bitwise_count(homes ^ point).astype(np.int64)
        order = np.argsort(hd, kind="stable")
        homes, h_id, hd = homes[order], h_id[order], hd[order]
        qd = np.bitwise_count(queries ^ point).astype(np.int64)
        for d in np.unique(qd):
            lo, hi = np.searchsorted(hd, d - max_bits), np.searchsorted(hd, d + max_bits, side="right")
            if lo == hi:
                continue
            mine = np.flatnonzero(qd == d)
            step = max(1, cells // (hi - lo))
            for at in range(0, len(mine), step):
                some = mine[at:at + step]
                near = np.bitwise_count(queries[some][:, None] ^ homes[None, lo:hi]) <= max_bits
                i, j = np.nonzero(near)
                labels.add(q_id[some][i], h_id[lo:hi][j])
    member = np.flatnonzero(labels.of != np.arange(len(values)))
    return values[labels.of[member]], values[member]


def link_fingerprints(classes: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS,
                      sample_rows: int = SAMPLE_ROWS, chunk: int = CHUNK) -> DataFrame:
    """Star edges (a, b), a <> b, whose components are those of all links
    between the distinct fingerprints ``classes.fp``."""
    spark = classes.sparkSession
    ship_code(spark)
    n = classes.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(1, n / leaf_rows))))))
    sample = classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).collect()
    sample = np.array([r[0] for r in sample], np.int64).view(np.uint64)
    radius = max_bits // len(SEGMENTS)
    masks = _masks()
    trees = [build_tree(sample, m, depth, radius) for m in masks]

    def routed(batches):
        from trendlake.llm import simhash
        for pdf in batches:
            fps = pdf["fp"].to_numpy().view(np.uint64)
            for s, (tree, mask) in enumerate(zip(trees, masks)):
                row, leaf, home = simhash.route(fps, tree, mask, depth, radius)
                yield pd.DataFrame({"seg": np.full(len(row), s, np.int32), "leaf": leaf,
                                    "fp": fps[row].view(np.int64), "home": home})

    members = written(classes.select("fp").mapInPandas(routed, "seg int, leaf int, fp long, home boolean"), "vp-members")
    sizes = members.groupBy("seg", "leaf").agg(
        F.ceil(F.count(F.lit(1)) / chunk).alias("q_parts"), F.ceil(F.count_if("home") / chunk).alias("h_parts"))
    m = members.join(sizes, ["seg", "leaf"])
    part = lambda n: F.pmod(F.xxhash64("fp"), n)
    keys = [F.col("seg"), F.col("leaf")]
    queries = m.select(*keys, part(F.col("q_parts")).alias("qp"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("h_parts") - 1)).alias("hp"), "fp",
                       F.lit(False).alias("home")).where("h_parts > 0")
    homes = m.where("home").select(
        *keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_parts") - 1)).alias("qp"),
        part(F.col("h_parts")).alias("hp"), "fp", F.lit(True).alias("home"))

    def stars(pdf):
        from trendlake.llm import simhash
        fps, home = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy().astype(bool)
        a, b = simhash.leaf_stars(fps[~home], fps[home], max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (queries.unionByName(homes).groupBy("seg", "leaf", "qp", "hp")
            .applyInPandas(stars, "a long, b long").distinct())


# --- connected components ------------------------------------------------

def components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b longs): root is the
    smallest node of its component.  Alternating star contraction: after a
    large star every node points at the smallest neighbour of its neighbours,
    after a small star every node at its smallest; O(log n) rounds, until
    nothing changes.  With ``max_rounds`` an unfinished contraction is an error."""
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = e.checkpoint()
    state = None
    for done in itertools.count():
        if max_rounds is not None and done >= max_rounds:
            raise RuntimeError(f"components are not stable after {max_rounds} rounds")
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = small.distinct().checkpoint()
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()


def class_components(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp -> component (a fingerprint of the component) for all distinct fps."""
    comp = components(link_fingerprints(classes, max_bits)).withColumnRenamed("node", "fp")
    return classes.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``."""
    fps = written(fingerprints(spread(docs.select("doc_id", "text")), shingle=shingle).select("doc_id", "fp"), "simhash")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = class_components(classes, max_bits)
    names = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest doc_id (null
    ids last; ties: the smallest hash of the row), columns as given."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    row = F.xxhash64(F.struct(*cols))
    keyed = fingerprints(spread(docs.select("doc_id", "text", row.alias("_row"))), shingle=shingle)
    fps = written(keyed.select("doc_id", "_row", "fp"), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    classes = written(fps.groupBy("fp").agg(F.min(order).alias("first")), "simhash-classes")
    roots = class_components(classes, max_bits)
    best = roots.groupBy("root").agg(F.min("first").alias("best")).select(
        F.col("best.doc_id").alias("_id"), F.col("best._row").alias("_hash"))
    numbered = docs.select(F.struct(*cols).alias("_r")).withColumn("_h", F.xxhash64("_r"))
    kept = numbered.join(best, F.col("_r.doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left_semi")
    same = Window.partitionBy("_r.doc_id", "_h").orderBy(F.lit(1))
    return kept.withColumn("_i", F.row_number().over(same)).where("_i = 1").select("_r.*")


def op8_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
