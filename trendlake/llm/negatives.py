"""Hard-negative mining by a vertical scan (BOND: branch and bound on decomposed
data) over columns of integer vectors.

Components become floor(256 * x); scores are exact integer inner products.  An
anchor's positives are its best rows of the same label.  Each (anchor, positive)
opens a window of scores, low * positive <= 100 * score <= high * positive, and
takes the best rows of other labels inside it.

Vertical scan of one block of candidates, held as columns.  For each anchor the
dimensions are read in falling order of the anchor's magnitude; after each group
of columns the minimum and maximum that the remaining dimensions can still add
(from the block's column minima and maxima) bound every candidate's score.  A
candidate leaves the bitmap when in every window it lies surely outside, or
surely behind as many others surely inside as the window takes, or behind the
best of earlier rounds.  The few left get their exact scores.

Spread of the work.  Rows are dealt by hash to blocks of about ``BLOCK`` rows -
within labels for the positives, over all rows for the negatives - and anchors to
blocks of about ``ANCHOR_BLOCK``.  A task holds one block of each.  Candidate blocks
are taken in rounds, each ``GROWTH`` times as many as all before; after a round the
best rows so far per window are written and their last score becomes the floor
of the next round, so the rows a window receives grow with the number of rounds
(the logarithm of the blocks), not with the blocks.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is no anchor, counts after all others in ties
and stays null in the result; rows that repeat an id are rows of their own (an
anchor row skips itself only), equal ones included; shorter vectors count as
filled up with zeros; components and scores beyond a long are cut to its ends; a
negative positive score leaves its window empty, zero admits zero only; fewer
rows than asked for, one label only and empty tables give what there is; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import finite, ship_code, table, written

ANCHOR_MODULUS, RELABEL_MODULUS, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK, ANCHOR_BLOCK = 4096, 4096
GROUP, FIRST_ROUND, GROWTH = 8, 8, 8
_LONG = (1 << 63) - 1
_EXACT = 1 << 53


def columns_of(vectors, dim: int) -> np.ndarray:
    """Integer vectors (lists) as columns: a (dim, rows) array."""
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.ascontiguousarray(out.T)


def scan(anchor, cols, bottom, top, alive, windows, k: int, group: int | None = None):
    """Candidates (positions, exact scores) of the columns ``cols`` that may be among
    the ``k`` best (score, then position) inside one of the ``windows``, a
    list of (low, high, floor): scores from low to high, and from floor on.
    ``bottom`` and ``top`` are the columns' minima and maxima, ``alive`` the positions to begin with."""
    group = group or GROUP
    order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
    q = anchor[order]
    small = np.minimum(q * bottom[order], q * top[order])
    large = np.maximum(q * bottom[order], q * top[order])
    partial = np.zeros(len(alive), dtype=cols.dtype)
    at, dim = 0, len(order)
    while at < dim and len(alive):
        now = order[at:at + group]
        partial = partial + q[at:at + group] @ cols[np.ix_(now, alive)]
        at += group
        if at >= dim:
            break
        least, most = _cut(partial + small[at:].sum()), _cut(partial + large[at:].sum())
        keep = np.zeros(len(alive), dtype=bool)
        for low, high, floor in windows:
            sure = least[(least >= low) & (most <= high)]
            need = max(low, floor)
            if len(sure) >= k:
                need = max(need, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (most >= need) & (least <= high)
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
    return alive, _cut(partial)


def _cut(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long at its ends; only exact (object) ones get there."""
    return np.minimum(np.maximum(scores, -_LONG - 1), _LONG) if scores.dtype == object and len(scores) else scores


def search_block(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """The k best rows of one block per anchor and window: anchor (its row
    number), w, uid, id, no_id, score.  Anchors hold uid, label, x and windows (w, low,
    high, floor); rows hold uid, id, no_id, label and x."""
    empty = {"anchor": [], "w": [], "uid": [], "id": [], "no_id": [], "score": []}
    if not len(anchors) or not len(rows):
        return pd.DataFrame(empty)
    rows = rows.sort_values(["no_id", "id", "uid"], kind="stable")
    dim = max(max(map(len, rows["x"])), max(map(len, anchors["x"])))
    cols, q = columns_of(list(rows["x"]), dim), columns_of(list(anchors["x"]), dim).T
    reach = max(abs(int(cols.max(initial=0))), abs(int(cols.min(initial=0)))) * max(
        abs(int(q.max(initial=0))), abs(int(q.min(initial=0)))) * max(1, dim)
    kind = np.float64 if 2 * reach < _EXACT else object
    cols, q = cols.astype(kind), q.astype(kind)
    bottom = cols.min(1) if dim else np.zeros(0, kind)
    top = cols.max(1) if dim else np.zeros(0, kind)
    uid, label = rows["uid"].to_numpy(), rows["label"].to_numpy()
    by_label = {}
    out = []
    for i, (own, of, windows) in enumerate(zip(anchors["uid"], anchors["label"], anchors["windows"])):
        if of not in by_label:
            by_label[of] = np.flatnonzero((label == of) if same else (label != of))
        start = by_label[of]
        start = start[uid[start] != own]
        spans = [(w["low"], w["high"], w["floor"]) for w in windows]
        found, scores = scan(q[i], cols, bottom, top, start, spans, k)
        for w, (low, high, floor) in zip(windows, spans):
            inside = np.flatnonzero((scores >= max(low, floor)) & (scores <= high))
            order = inside[np.lexsort((found[inside], -scores[inside]))][:k] if kind is not object else np.array(
                sorted(inside, key=lambda j: (-scores[j], found[j]))[:k], dtype=np.int64)
            for j in order:
                out.append((own, w["w"], found[j], int(scores[j])))
    if not out:
        return pd.DataFrame(empty)
    anchor, w, position, score = zip(*out)
    position = np.array(position, dtype=np.int64)
    return pd.DataFrame({"anchor": anchor, "w": w, "uid": uid[position], "id": rows["id"].to_numpy()[position],
                         "no_id": rows["no_id"].to_numpy()[position], "score": np.array(score, dtype=np.int64)})


WINDOWS = "array<struct<w:int,low:bigint,high:bigint,floor:bigint>>"


def best_in_windows(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor, w, rank, uid, id, no_id, score: the k best rows of every anchor's every
    window over all blocks.  ``anchors``: uid, label, x, windows, grp, ablocks, blocks; ``rows``: uid, id, no_id,
    label, x, grp, ablocks, blocks (numbers of anchor and candidate blocks of the group)."""
    deal = lambda n: F.pmod(F.xxhash64("uid"), F.col(n))
    span = rows.agg(F.max("blocks")).first()[0] or 0
    anchors = anchors.withColumn("a", deal("ablocks"))
    rows = rows.withColumn("b", deal("blocks")).drop("blocks")
    id_type = rows.schema["id"].dataType.simpleString()

    def search(left, right):
        from trendlake.llm import negatives
        return negatives.search_block(left, right, k, same)

    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "no_id", "id", "uid")
    best, done = None, 0
    while done < span:
        until = min(span, max(FIRST_ROUND, done * GROWTH))
        left = anchors
        if best is not None:
            # the last of a full window's best so far is the least score that still counts
            floors = best.where(F.col("rank") == k).groupBy("anchor").agg(
                F.map_from_arrays(F.collect_list("w"), F.collect_list("score")).alias("floors"))
            left = left.join(floors.withColumnRenamed("anchor", "uid"), "uid", "left").withColumn("windows", F.transform(
                "windows", lambda w: w.withField("floor", F.greatest(w["floor"], F.coalesce(
                    F.element_at("floors", w["w"]), w["floor"]))))).drop("floors")
        last = F.least(F.col("blocks"), F.lit(until)) - 1
        left = (left.where(F.col("blocks") > done)
                .withColumn("b", F.explode(F.sequence(F.lit(done).cast("long"), last.cast("long"))))
                .select(*[F.col(c).alias(c) for c in ("grp", "a", "b", "uid", "label", "x", "windows")]))
        right = (rows.where((F.col("b") >= done) & (F.col("b") < until) & (F.col("ablocks") > 0))
                 .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ablocks") - 1)))
                 .select("grp", "a", "b", "uid", "id", "no_id", "label", "x"))
        found = (left.groupBy("grp", "a", "b").cogroup(right.groupBy("grp", "a", "b"))
                 .applyInPandas(search, f"anchor long, w int, uid long, id {id_type}, no_id boolean, score long"))
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "negatives-best")
        done = until
    return best if best is not None else rows.sparkSession.createDataFrame(
        [], f"anchor long, w int, uid long, id {id_type}, no_id boolean, score long, rank int")


def mine(vectors: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for
    every anchor (``is_anchor``: a Column over ``id``) and each of its positives."""
    spark = vectors.sparkSession
    ship_code(spark)
    v, kind = F.col(vector_col).cast("array<double>"), vectors.schema[id_col].dataType
    rows = written(vectors.where(F.col(label_col).isNotNull() & finite(F.col(vector_col)))
                   .select(F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col(id_col), F.lit("0").cast(kind)).alias("id"),
                           F.col(id_col).isNull().alias("no_id"), F.col(label_col).alias("label"), F.transform(v, lambda x: F.floor(x * 256)).alias("x")),
                   "negatives-rows")
    size = lambda n, per: F.ceil(F.col(n) / per).cast("long")
    is_anchor = F.coalesce(is_anchor, F.lit(False)) & ~F.col("no_id")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("m")).select(
        "label", size("n", BLOCK).alias("blocks"), size("m", ANCHOR_BLOCK).alias("ablocks"))
    everything = F.lit(-_LONG - 1).alias("low"), F.lit(_LONG).alias("high"), F.lit(-_LONG - 1).alias("floor")
    grouped = rows.join(counts, "label").withColumn("grp", F.col("label"))
    anchors = grouped.where(is_anchor).withColumn("windows", F.array(F.struct(F.lit(0).alias("w"), *everything)).cast(WINDOWS))
    found = best_in_windows(anchors, grouped, positives, same=True)

    # the window of a positive, in exact integers
    score = F.col("score").cast("decimal(38,0)")
    bounds = F.struct(F.col("rank").alias("w"), F.ceil(score * low / 100).cast("long").alias("low"),
                      F.floor(score * high / 100).cast("long").alias("high"), F.lit(-_LONG - 1).alias("floor"))
    windows = found.where("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(bounds)).cast(WINDOWS).alias("windows"))
    total = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    whole = lambda d: d.withColumns({"grp": F.lit(0), "blocks": F.lit(-(-total[0] // BLOCK)).cast("long"),
                                     "ablocks": F.lit(-(-total[1] // ANCHOR_BLOCK)).cast("long")})
    open_anchors = whole(rows.where(is_anchor).join(windows.withColumnRenamed("anchor", "uid"), "uid"))
    negative = best_in_windows(open_anchors, whole(rows), negatives, same=False)
    name_of = F.when(~F.col("no_id"), F.col("id"))
    name = rows.where(is_anchor).select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    chosen = found.select("anchor", F.col("rank").alias("w"), name_of.alias("positive_id"),
                          F.col("score").alias("positive_score")).join(name, "anchor")
    return negative.select("anchor", "w", "rank", name_of.alias("negative_id"), F.col("score").alias("negative_score")).join(
        chosen, ["anchor", "w"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """The table with the labels of every seventh id moved on by one."""
    moved = ((F.col(label_col) + 1) % LABELS).cast(vectors.schema[label_col].dataType)
    return vectors.withColumn(label_col, F.when(F.col(id_col) % RELABEL_MODULUS == 0, moved).otherwise(F.col(label_col)))


def op13_negatives(spark, sf_dir):
    return mine(relabelled(table(spark, sf_dir, "embeddings")), F.col("id") % ANCHOR_MODULUS == 0)


OP13_SQL = """
WITH e AS (SELECT row_number() OVER () AS uid, vec_id AS id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.uid AS auid, a.id AS anchor_id, a.label = c.label AS same, c.uid, c.id,
             CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
      FROM e a JOIN e c ON a.id % 100 = 0 AND a.uid <> c.uid),
p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY auid ORDER BY score DESC, id NULLS LAST, uid) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.auid, p.uid
               ORDER BY s.score DESC, s.id NULLS LAST, s.uid) AS INTEGER) AS rank,
             s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON p.auid = s.auid AND NOT s.same
       AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM n WHERE rank <= 10
"""
