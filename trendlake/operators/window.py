"""Window operators.

They run on per-category yearly aggregates (categories x years rows), never on
raw rows, so partitioning the window by category cannot concentrate raw data
in one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.roles import COUNT_COL, YEAR_COL

COUNT = COUNT_COL


def yoy_growth(yearly: DataFrame, category: str, year: str = YEAR_COL, count: str = COUNT,
               require_consecutive: bool = False) -> DataFrame:
    """W1 + W2: previous count in the category and growth in percent.

    ``prev_count`` is the count of the previous *present* year (a gap year is
    skipped) unless ``require_consecutive``.  Growth is null when the previous
    count is null or 0, else round((n - p) * 100 / p, 2) computed in decimal,
    returned as double.
    """
    w = Window.partitionBy(category).orderBy(F.col(year).asc_nulls_first())
    prev = F.lag(count).over(w)
    if require_consecutive:
        prev = F.when(F.lag(year).over(w) == F.col(year) - 1, prev)
    out = yearly.select(category, year, count, prev.alias("prev_count"))
    n, p = F.col(count), F.col("prev_count")
    growth = F.when(p.isNull() | (p == 0), F.lit(None)).otherwise(
        F.round((n - p).cast("decimal(20,0)") * F.lit(Decimal("100.0")) / p, 2)).cast("double")
    return out.withColumn("growth_rate_pct", growth)


def split_last(yearly: DataFrame, category: str, year: str = YEAR_COL,
               min_points: int = 1) -> tuple[DataFrame, DataFrame]:
    """W3 + A14: (train, test) where test is the last year of each category
    and only categories with at least ``min_points`` years are kept."""
    w_desc = Window.partitionBy(category).orderBy(F.col(year).desc())
    w_all = Window.partitionBy(category)
    ranked = (yearly.where(F.col(year).isNotNull())
              .withColumn("_rn", F.row_number().over(w_desc))
              .withColumn("_n", F.count(F.lit(1)).over(w_all))
              .where(F.col("_n") >= min_points))
    train = ranked.where(F.col("_rn") > 1).drop("_rn", "_n")
    test = ranked.where(F.col("_rn") == 1).drop("_rn", "_n")
    return train, test
