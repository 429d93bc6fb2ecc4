"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions import event_ts
from trendlake.roles import MONTH_COL, TS_COL, YEAR_COL, Roles


def base_table(df: DataFrame, roles: Roles, keep_null_category: bool = False) -> DataFrame:
    """P1 + P2: rows with a category, plus ``created_ts``, ``year`` and ``month``.

    The null-category filter is a plain predicate, so Catalyst pushes it into
    the scan (``PushedFilters: [IsNotNull(category)]``) and prunes row groups.
    """
    out = df
    if roles.category and not keep_null_category:
        out = out.where(F.col(roles.category).isNotNull())
    if not roles.event_time:  # a table without an event time: null time columns
        return out.withColumns({TS_COL: F.lit(None).cast("timestamp"), YEAR_COL: F.lit(None).cast("int"),
                                MONTH_COL: F.lit(None).cast("int")})
    ts = event_ts(df, roles.event_time)
    return out.withColumns({TS_COL: ts, YEAR_COL: F.year(ts), MONTH_COL: F.month(ts)})


def keep_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Membership; an empty value list means no filtering."""
    values = list(values)
    return df.where(F.col(col).isin(values)) if values else df


def at_least(df: DataFrame, col: str, threshold) -> DataFrame:
    """``col >= threshold``."""
    return df.where(F.col(col) >= F.lit(threshold))


def filter_growth(growth: DataFrame, category: str, years: tuple[int, int] | None = None,
                  categories: Iterable = (), year: str = YEAR_COL,
                  growth_col: str = "growth_rate_pct") -> DataFrame:
    """P6 + P7 + P8: non-null growth, inclusive year range, optional categories."""
    out = growth.where(F.col(growth_col).isNotNull())
    if years is not None:
        out = out.where(F.col(year).between(years[0], years[1]))
    return keep_in(out, category, categories)


def filter_totals(totals: DataFrame, category: str, minimum=None, categories: Iterable = (),
                  total_col: str = "total_stars") -> DataFrame:
    """P9 + P8: minimum total, optional categories."""
    out = totals if minimum is None else at_least(totals, total_col, minimum)
    return keep_in(out, category, categories)


def filter_tags(tag_stats: DataFrame, tags: Iterable = (), tag_col: str = "topic") -> DataFrame:
    """P8 on the tag table: empty list keeps everything."""
    return keep_in(tag_stats, tag_col, tags)


def filter_domains(growth: DataFrame, totals: DataFrame, tag_stats: DataFrame, category: str,
                   year: str = YEAR_COL, total_col: str = "total_stars", tag_col: str = "topic",
                   count_col: str = "repo_count", n_tags: int = 50) -> DataFrame:
    """P10 + A13 + A15: one row with the value domains a filter form offers.

    min / max year of the growth table, min / max total of the totals table,
    the sorted distinct categories of the totals table and the first ``n_tags``
    tags of the ranked tag table, sorted.  Each part is a scalar subquery over
    an aggregate, so nothing is joined and nothing unbounded is collected:
    categories come from an already aggregated (per-category) table and the
    tag list is capped by its definition (a top-``n_tags`` list).
    """
    top_tags = (tag_stats.orderBy(F.desc(count_col), F.asc(tag_col)).limit(n_tags)
                .agg(F.array_sort(F.collect_list(tag_col))))
    return growth.agg(
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
        totals.agg(F.min(total_col)).scalar().alias("min_total"),
        totals.agg(F.max(total_col)).scalar().alias("max_total"),
        totals.agg(F.array_sort(F.collect_set(category))).scalar().alias("categories"),
        top_tags.scalar().alias("tags"),
    )
