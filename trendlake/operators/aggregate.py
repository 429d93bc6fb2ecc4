"""Aggregations, top-k, set operations and the top-category semi join
(A1-A19, O1-O8, U1, J1).

All grouping goes through ``groupBy().agg()`` with explicit aliases, so Spark
plans a partial (map-side) aggregate before the shuffle: a category or tag
that holds a third of all rows costs one partial row per map task, not a
third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.roles import (COUNT_COL, MONTH_COL, MONTH_METRIC, RAW_METRIC_PREFIX, TAG_METRIC,
                             TOTAL_COL, YEAR_COL, Roles)

COUNT = COUNT_COL
TOTAL = TOTAL_COL


def _sum(c: Column, digits: int | None) -> Column:
    s = F.sum(c)
    return F.round(s, digits) if digits is not None else s


def count_and_sum(df: DataFrame, keys: Sequence[str], measure: str, count_name: str = COUNT,
                  sum_name: str = TOTAL, null_as_zero: bool = False,
                  digits: int | None = None) -> DataFrame:
    """``count(*)`` and ``sum(measure)`` per key.

    ``digits`` rounds the sum (use it for double measures: the last bits of a
    double sum depend on the summation order, i.e. on the partitioning).
    """
    m = F.coalesce(F.col(measure), F.lit(0)) if null_as_zero else F.col(measure)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), _sum(m, digits).alias(sum_name))


def category_sum(df: DataFrame, roles: Roles, digits: int | None = None) -> DataFrame:
    """A1: total measure per category (null category skipped, null measure = 0)."""
    cat = roles.category
    return (df.where(F.col(cat).isNotNull())
            .groupBy(cat)
            .agg(_sum(F.coalesce(F.col(roles.measure), F.lit(0)), digits).alias(TOTAL)))


def yearly_counts(base: DataFrame, roles: Roles) -> DataFrame:
    """A4: ``repo_count`` per category x year."""
    return base.groupBy(roles.category, YEAR_COL).agg(F.count(F.lit(1)).alias(COUNT))


def category_year(base: DataFrame, roles: Roles, digits: int | None = None) -> DataFrame:
    """A2: count + sum per category x year."""
    return count_and_sum(base, [roles.category, YEAR_COL], roles.measure, digits=digits)


def category_month(base: DataFrame, roles: Roles, digits: int | None = None) -> DataFrame:
    """A3: count + sum per category x month of year (all years pooled)."""
    return count_and_sum(base, [roles.category, MONTH_COL], roles.measure, digits=digits)


def category_year_month(base: DataFrame, roles: Roles, digits: int | None = None) -> DataFrame:
    """Count + sum per year x month x category."""
    return count_and_sum(base, [YEAR_COL, MONTH_COL, roles.category], roles.measure, digits=digits)


def mean_by(df: DataFrame, keys: Sequence[str], measure: str, name: str = "avg_stars_per_repo",
            digits: int = 2) -> DataFrame:
    """A5 + O1: rounded mean per key, highest first (ties by key)."""
    return (df.groupBy(*keys).agg(F.round(F.avg(measure), digits).alias(name))
            .orderBy(F.desc(name), *[F.asc(k) for k in keys]))


def top(df: DataFrame, by: str | Sequence[str], n: int | None = None,
        tie_break: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """Explicit order (with tie-break columns) and optional limit.

    ``orderBy().limit(n)`` plans as ``TakeOrderedAndProject``: every task keeps
    its own top n and only those reach the final merge.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [F.asc(c) if ascending else F.desc(c) for c in by] + [F.asc(c) for c in tie_break]
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def top_categories(base: DataFrame, roles: Roles, n: int = 10, digits: int | None = None) -> DataFrame:
    """A6 + O2: the ``n`` categories with the largest total (ties by category)."""
    agg = count_and_sum(base, [roles.category], roles.measure, digits=digits)
    return top(agg, TOTAL, n, tie_break=[roles.category])


def exploded_tags(base: DataFrame, roles: Roles, keep: Sequence[str], tag_name: str = "topic") -> DataFrame:
    """one row per (item, tag); null and empty tag arrays produce no rows,
    a tag repeated in one item produces one row per occurrence."""
    return base.select(*keep, F.explode(F.col(roles.tags)).alias(tag_name))


def tag_stats(base: DataFrame, roles: Roles, keys: Sequence[str] = (), only: Iterable = (),
              tag_name: str = "topic", digits: int | None = None, ordered: bool = True) -> DataFrame:
    """A7 (+ O3) and A9: count + sum per tag (and per ``keys``), optionally only
    for the tags in ``only``.  The membership filter runs before the shuffle."""
    flat = exploded_tags(base, roles, list(keys) + [roles.measure], tag_name)
    only = list(only)
    if only:
        flat = flat.where(F.col(tag_name).isin(only))
    out = count_and_sum(flat, list(keys) + [tag_name], roles.measure, digits=digits)
    if ordered and not keys:
        out = top(out, COUNT, tie_break=[tag_name])
    return out


def category_compare(base: DataFrame, roles: Roles, categories: Iterable,
                     digits: int | None = None) -> DataFrame:
    """A10: count + sum for the chosen categories only."""
    cats = list(categories)
    return count_and_sum(base.where(F.col(roles.category).isin(cats)), [roles.category],
                         roles.measure, digits=digits)


def productivity(base: DataFrame, roles: Roles, digits: int | None = None) -> DataFrame:
    """Per category x year sums of the three measures, count and the two scores

    productivity_score   = round(sum(m) / n, 2)
    activity_proxy_score = round((sum(m) + 2 sum(m2) + sum(m3)) / n, 2)
    """
    m, m2, m3 = F.col(roles.measure), F.col(roles.measure2), F.col(roles.measure3)
    agg = base.groupBy(roles.category, YEAR_COL).agg(
        F.sum(m2).alias("_s2"), F.count(F.lit(1)).alias(COUNT),
        F.sum(m).alias("_s1"), F.sum(m3).alias("_s3"))
    n = F.col(COUNT)
    return agg.select(
        roles.category, YEAR_COL,
        (F.round("_s2", digits) if digits is not None else F.col("_s2")).alias("total_forks"),
        COUNT,
        (F.round("_s1", digits) if digits is not None else F.col("_s1")).alias(TOTAL),
        (F.round("_s3", digits) if digits is not None else F.col("_s3")).alias("total_open_issues"),
        F.round(F.try_divide(F.col("_s1"), n), 2).alias("productivity_score"),
        F.round(F.try_divide(F.col("_s1") + F.col("_s2") * 2 + F.col("_s3"), n), 2)
        .alias("activity_proxy_score"),
    )


def as_metric(df: DataFrame, metric: str, label_col: str, out_label: str) -> DataFrame:
    """Constant metric label and the label column renamed to the report's."""
    return df.select(F.lit(metric).alias("metric"), F.col(label_col).alias(out_label),
                     YEAR_COL, MONTH_COL, COUNT, TOTAL)


def long_report(base: DataFrame, roles: Roles, tags: Iterable = ("ai", "web", "blockchain"),
                min_measure=500, digits: int | None = None, tagged: DataFrame | None = None) -> DataFrame:
    """Month trend per category  UNION ALL  month trend per target tag
    UNION ALL  every row with measure >= ``min_measure`` as a count-1 row
    (``unionByName`` keeps duplicates).

    Three column-pruned reads of ``base``: two partial + final aggregates
    (shuffling only per-task partial rows) and one map-only branch.  For an
    item table that carries its tags this is cheaper than any single-pass
    form, which would have to shuffle every qualifying row to keep the three
    sections apart.  When the tags come from a join, pass the joined rows as
    ``tagged``: the other two sections then read ``base`` alone.
    """
    cat = roles.category
    month_trend = category_year_month(base, roles, digits)
    tag_trend = tag_stats(base if tagged is None else tagged, roles, keys=[YEAR_COL, MONTH_COL], only=tags,
                          tag_name="_tag", digits=digits, ordered=False)
    measure = F.col(roles.measure)
    rows = (base.where(measure >= F.lit(min_measure))
            .select(cat, YEAR_COL, MONTH_COL, F.lit(1).cast("long").alias(COUNT),
                    (F.round(measure, digits) if digits is not None else measure).alias(TOTAL)))
    return (as_metric(month_trend, MONTH_METRIC, cat, cat)
            .unionByName(as_metric(tag_trend, TAG_METRIC, "_tag", cat))
            .unionByName(as_metric(rows, f"{RAW_METRIC_PREFIX}{min_measure}", cat, cat)))


def rows_of_top_categories(df: DataFrame, category: str, n: int = 8, by: str = COUNT) -> DataFrame:
    """J1 + A12 + O4: rows of the ``n`` categories with the largest max(``by``).

    The right side of the semi join is a ``limit(n)`` result, so its size is
    bounded by ``n`` whatever the input size; broadcasting it is safe.
    """
    best = (df.groupBy(category).agg(F.max(by).alias("_best"))
            .orderBy(F.desc("_best"), F.asc(category)).limit(n).select(category))
    return df.join(F.broadcast(best), on=category, how="left_semi")


def with_min_points(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows of the groups (by ``keys``) that have at least ``n`` rows.

    A semi join with the qualifying keys of a partially aggregated count, not
    a window: a hot group is counted per task, never gathered into one, and
    AQE can split a skewed semi-join partition."""
    keep = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= n).select(*keys))
    return df.join(keep, on=list(keys), how="left_semi")


def quantile(df: DataFrame, col: str, q: float, approx: bool = False, accuracy: int = 10000) -> Column:
    """``q``-quantile of ``col`` as a scalar subquery column.

    Exact (``percentile``, linear interpolation between order statistics) by
    default, for aggregated tables: all distinct values meet in one task.
    For raw-sized inputs, ``quantile.exact_quantiles`` selects the same value in
    bounded memory, and ``approx=True`` gives a sketch's (``percentile_approx``).
    """
    agg = F.percentile_approx(col, q, accuracy) if approx else F.percentile(col, F.lit(q))
    return df.agg(agg).scalar()


def pivot_mean(df: DataFrame, index: str, columns: str, values: str, digits: int | None = 2) -> DataFrame:
    """``index`` x ``columns`` table of mean ``values``.

    The pivot values are the distinct ones of ``df``, in order (an aggregated
    table, so the distinct job is small); no value can be left out."""
    agg = F.avg(values)
    if digits is not None:
        agg = F.round(agg, digits)
    found = df.groupBy(index, columns).agg(agg.alias(values))
    names = [r[0] for r in found.select(columns).distinct().orderBy(columns).collect()]
    return found.groupBy(index).pivot(columns, names).agg(F.first(values))


def leader(totals: DataFrame, tags: DataFrame, category: str, total_col: str = TOTAL,
           tag_col: str = "topic", count_col: str = COUNT) -> DataFrame:
    """The leading category (largest total) and the leading tag (largest
    count), ties broken by name; one row per kind."""
    lead_cat = top(totals, total_col, 1, tie_break=[category]).select(
        F.lit("category").alias("kind"), F.col(category).cast("string").alias("leader"))
    lead_tag = top(tags, count_col, 1, tie_break=[tag_col]).select(
        F.lit("tag").alias("kind"), F.col(tag_col).cast("string").alias("leader"))
    return lead_cat.unionByName(lead_tag)


def run_metrics(spark: SparkSession, counts: Mapping[str, int], run_at: str) -> DataFrame:
    """Output name, row count and run time, one row per written output;
    the counts are those observed during the writes (``io.write_observed``)."""
    rows = [(name, int(n)) for name, n in counts.items()]
    return (spark.createDataFrame(rows, "output string, row_count long")
            .withColumn("timestamp_utc", F.lit(run_at).cast("timestamp_ntz")))
