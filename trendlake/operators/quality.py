"""Data-quality and schema-drift report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions import pct


def _literal_array(values: Iterable[str]) -> F.Column:
    vals = list(values)
    return F.array(*[F.lit(v) for v in vals]).cast("array<string>")


def schema_drift(columns: Iterable[str], expected: Iterable[str]) -> tuple[F.Column, F.Column]:
    """Sorted missing (expected, not present) and extra (present, not
    expected) column names, as array expressions over two literal arrays."""
    have, want = _literal_array(sorted(set(columns))), _literal_array(sorted(set(expected)))
    return (F.array_sort(F.array_except(want, have)), F.array_sort(F.array_except(have, want)))


def quality_report(df: DataFrame, expected: Iterable[str] | None = None, key: str | None = "id",
                   category: str | None = "language") -> DataFrame:
    """Q1-Q3: one row

    * ``row_count``
    * ``duplicate_repo_ids``  rows - distinct keys, nulls counted as one key
                              (null when the key column is absent)
    * ``null_language_pct``   percent of rows with a null category, half-even
                              2 digits (null when the column is absent)
    * ``schema_missing_columns`` / ``schema_extra_columns`` against ``expected``
      (default: the frame's own columns, i.e. no drift).

    The distinct-key count is an exact two-phase aggregate: keys are
    de-duplicated map-side before the shuffle, so a key repeated in a third
    of all rows costs one row per map task.
    """
    cols = df.columns
    expected = cols if expected is None else list(expected)
    n = F.count(F.lit(1))
    aggs = [n.alias("row_count")]
    if key is not None and key in cols:
        k = F.col(key)
        distinct = F.count_distinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))
        aggs.append((n - distinct).cast("long").alias("duplicate_repo_ids"))
    else:
        aggs.append(F.lit(None).cast("long").alias("duplicate_repo_ids"))
    if category is not None and category in cols:
        aggs.append(pct(n - F.count(F.col(category)), n).alias("null_language_pct"))
    else:
        aggs.append(F.lit(None).cast("double").alias("null_language_pct"))
    missing, extra = schema_drift(cols, expected)
    return df.agg(*aggs).select("*", missing.alias("schema_missing_columns"),
                                extra.alias("schema_extra_columns"))
