"""Mixing sources to target weights by systematic sampling.

Method: every document of a source has the same expected number of copies
``rate = target / source_size``.  The expected copies are prefix-summed within
the source, a single random offset in [0, 1) is added, and the document is
emitted once per integer boundary its interval crosses.  A document therefore
gets ``floor(rate)`` or ``ceil(rate)`` copies, and with ``rate <= max_rate``
never more than ``ceil(max_rate)``.

Order of the prefix sum: documents are laid out by size class (bit length and
the next two bits of the size) and, inside a class, by a hash of the id.  The
sample then takes its share from every size class, so the words taken stay
near the target even with a few very long documents.

Scale: a prefix sum over one source is a prefix sum over ``ceil(sqrt(n))``
hash buckets per size class plus one inside each bucket, so both windows hold
about ``sqrt(n)`` rows of a source of ``n`` documents: a source with a third of
all rows is split over its buckets.  Only (source, size, hash) rows are
shuffled, never texts; the per-source table has one row per source.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; sources without words get target 0 and rate 0 (no copies);
repeated rows are separate documents; a null doc_id hashes as the empty
string; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import word_count

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SALT = "mix-1"
_STEPS = 1 << 20


def size_class(size):
    """Bit length of the size times 8 plus its two bits after the leading one."""
    bits = F.length(F.bin(size))
    return (bits * 8 + F.floor(size / F.pow(F.lit(2), F.greatest(bits - 3, F.lit(0))))).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, n, source_size, target, rate): the total size shared by weight,
    a target stopped at ``max_rate`` times its source's size and the excess
    reshared until none is above.

    Sources are sorted by cap per weight; the capped ones are a prefix of that
    order, and a source is capped iff the level that remains when all before
    it are capped exceeds its own cap per weight.  ``sizes``: source, size.
    The input is one row per source after the first aggregate."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    arr = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("_w", F.element_at(
        arr, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy((F.col("source_size") * max_rate / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("_total", F.sum("source_size").over(everything))
           .withColumn("_weights", F.sum("_w").over(everything))
           .withColumn("_left", F.col("_total") - max_rate * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
           .withColumn("_left_w", F.col("_weights") - F.coalesce(F.sum("_w").over(before), F.lit(0))))
    cap = F.col("source_size") * max_rate
    per = per.withColumn("_capped", F.col("_w") * F.col("_left") > cap * F.col("_left_w"))
    first_free = F.min_by(F.struct("_left", "_left_w"), F.when(~F.col("_capped"), F.struct(
        F.col("source_size") * max_rate / F.col("_w"), F.col("source").isNull(), F.col("source")))).over(everything)
    per = per.withColumn("_level", first_free)
    free = F.col("_w") * F.col("_level._left") / F.col("_level._left_w").cast("double")
    per = per.withColumn("target", F.when(F.col("_capped"), cap.cast("double")).otherwise(free))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "n", "source_size", "target", rate.alias("rate"))


def copies(sized: DataFrame, targets: DataFrame, salt: str = SALT) -> DataFrame:
    """``sized`` (source, size, order_key, ...) with source_size, target and
    the number of copies each row gets.  ``order_key`` is a string that puts
    the rows of one size class in random but repeatable order."""
    t = targets.select(F.col("source").alias("_s"), "n", "source_size", "target", "rate")
    rows = (sized.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_class", size_class(F.col("size")))
            .withColumn("_bucket", F.pmod(F.conv(F.substring("order_key", 1, 12), 16, 10).cast("long"),
                                          F.ceil(F.sqrt("n")).cast("long"))))
    keys = ["source", "_class", "_bucket"]
    blocks = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_in_block"))
    along = (Window.partitionBy("source").orderBy("_class", "_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(*[F.col(k).alias("_b" + k) for k in keys],
                           F.coalesce(F.sum("_in_block").over(along), F.lit(0)).alias("_before"))
    on = [F.col(k).eqNullSafe(F.col("_b" + k)) for k in keys]
    inside = Window.partitionBy(*keys).orderBy("order_key", "size")
    rows = rows.withColumn("_rank", F.row_number().over(inside)).join(blocks, on)
    offset = (F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(salt + "/"), F.coalesce("source", F.lit("")))), 1, 12),
                            16, 10).cast("long"), F.lit(_STEPS)) / float(_STEPS))
    end = F.col("_before") + F.col("_rank")
    n = F.floor(offset + F.col("rate") * end) - F.floor(offset + F.col("rate") * (end - 1))
    return (rows.withColumn("copies", n.cast("long"))
            .drop("n", "rate", "_class", "_bucket", "_rank", "_before", *["_b" + k for k in keys]))


def order_key(id_col, salt: str = SALT):
    return F.md5(F.concat(F.lit(salt + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, salt: str = SALT) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, copies."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        order_key("doc_id", salt).alias("order_key"))
    return copies(sized, source_targets(sized, weights, max_rate), salt).drop("order_key")


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, salt: str = SALT) -> DataFrame:
    """The mixed corpus: every document of ``docs`` as often as it was drawn
    (columns of ``docs``).  The draw is made on (source, size, key) rows; the
    texts meet it in one join on a hash of the whole row, rows that are equal
    in every column being interchangeable."""
    cols = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    ids = F.struct("_row.doc_id", "_row.source", F.xxhash64("_row"))
    keyed = keyed.select("_row", F.md5(F.to_json(ids).cast("binary")).alias("order_key"))
    sized = keyed.select(F.col("_row.source").alias("source"), "order_key",
                         word_count(F.col("_row.text")).alias("size"))
    drawn = copies(sized, source_targets(sized, weights, max_rate), salt)
    # Rows with one key are equal rows (or, with vanishing probability, of one id): number them on both sides.
    same = Window.partitionBy("order_key").orderBy(F.desc("copies"))
    drawn = (drawn.select("order_key", "copies").withColumn("_i", F.row_number().over(same))
             .where("copies > 0"))
    again = Window.partitionBy("order_key").orderBy(F.lit(1))
    out = (keyed.withColumn("_i", F.row_number().over(again)).join(drawn, ["order_key", "_i"])
           .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")))
    return out.select("_row.*")


def op10_mixing(spark, sf_dir):
    """Contract query: doc_id, size, source_size, target, taken per document."""
    plan = mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


# DuckDB: the same draw with one plain window per source instead of buckets.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
o AS (
  SELECT *, 3 * source_size / w AS cap_per_weight,
         (SELECT sum(source_size) FROM w) - coalesce(3 * sum(source_size) OVER before, 0) AS left_size,
         (SELECT sum(w) FROM w) - coalesce(sum(w) OVER before, 0) AS left_w
  FROM w
  WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, w * left_size > 3 * source_size * left_w AS capped FROM o),
l AS (SELECT left_size AS ls, left_w AS lw FROM c WHERE NOT capped ORDER BY cap_per_weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, n, source_size,
             CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
                  ELSE CAST(w * ls AS DOUBLE) / CAST(lw AS DOUBLE) END AS target
      FROM c LEFT JOIN l ON true),
b AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         length(bin(size)) * 8 + CAST(floor(size / pow(2, greatest(length(bin(size)) - 3, 0))) AS BIGINT) AS cls,
         CAST('0x' || k[1:12] AS BIGINT) % CAST(ceil(sqrt(t.n)) AS BIGINT) AS bucket
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY cls, bucket, k, size) AS i,
         (CAST('0x' || md5('mix-1/' || coalesce(source, ''))[1:12] AS BIGINT) % 1048576) / 1048576.0::DOUBLE AS u
  FROM b)
SELECT doc_id, size, source_size, target,
       CAST(floor(u + rate * i) - floor(u + rate * (i - 1)) AS BIGINT) * size AS taken
FROM r
"""
