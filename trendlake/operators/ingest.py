"""Ingest shaping (I1-I6): the data part of the extract step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType

from trendlake.functions import event_ts
from trendlake.roles import YEAR_COL, Roles

# The item record's fields, in the order the extract writes them.
ITEM_FIELDS = ("id", "name", "full_name", "language", "stars", "forks", "open_issues",
               "created_at", "updated_at", "description", "topics", "html_url")
COUNT_FIELDS = ("stars", "forks", "open_issues")

# Item field <- field of a repository-search API result item.
API_ITEM_FIELDS = {
    "id": "id",
    "name": "name",
    "full_name": "full_name",
    "language": "language",
    "stars": "stargazers_count",
    "forks": "forks_count",
    "open_issues": "open_issues_count",
    "created_at": "created_at",
    "updated_at": "updated_at",
    "description": "description",
    "html_url": "html_url",
}


def flatten_items(raw: DataFrame, mapping: Mapping[str, str | Column] | None = None,
                  zero_defaults: Sequence[str] = COUNT_FIELDS,
                  fields: Sequence[str] = ITEM_FIELDS) -> DataFrame:
    """One flat item record per raw row.

    ``mapping`` maps an output field to a raw column name or expression
    (nested fields as ``"owner.login"``); the default is the API result item
    (``API_ITEM_FIELDS``), where a field missing from the raw schema counts as
    absent.  Fields without a source are null, ``topics`` defaults to an
    empty array, and the count fields default to 0 both when absent and when
    null (keeping the mapped column's type).
    """
    if mapping is None:
        present = set(raw.columns)
        mapping = {k: v for k, v in API_ITEM_FIELDS.items() if v in present}
        if "topics" in present:
            mapping["topics"] = "topics"
    out = []
    for f in fields:
        src = mapping.get(f)
        c = (F.col(src) if isinstance(src, str) else src) if src is not None else None
        if f in zero_defaults:
            c = F.coalesce(c, F.lit(0)) if c is not None else F.lit(0).cast("long")
        elif f == "topics":
            c = F.coalesce(c, F.array().cast("array<string>")) if c is not None else F.array().cast("array<string>")
        elif c is None:
            c = F.lit(None).cast("string")
        out.append(c.alias(f))
    return raw.select(*out)


def _ts_literal(df: DataFrame, col: str, value) -> Column:
    dtype = df.schema[col].dataType
    target = "timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp"
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    v = str(value)
    if v.endswith("Z"):
        v = v[:-1]
    return F.lit(v.replace("T", " ")).cast(target)


def incremental_slice(df: DataFrame, roles: Roles, mark=None, min_measure=0) -> DataFrame:
    """Rows updated on or after the *date* of ``mark`` (day granularity)
    with measure strictly above ``min_measure``.  No mark: now - 1 day.

    Both predicates compare a raw column with a literal, so they are pushed
    into the Parquet scan (row-group skipping on the update time).
    """
    col = roles.update_time
    if isinstance(df.schema[col].dataType, StringType):
        t = event_ts(df, col)
        since = F.date_trunc("DAY", F.current_timestamp() - F.expr("INTERVAL 1 DAY")) if mark is None \
            else F.date_trunc("DAY", F.lit(str(mark)).cast("timestamp"))
    else:
        t = F.col(col)
        if mark is None:
            cast = "timestamp_ntz" if isinstance(df.schema[col].dataType, TimestampNTZType) else "timestamp"
            since = F.date_trunc("DAY", F.current_timestamp() - F.expr("INTERVAL 1 DAY")).cast(cast)
        else:
            since = F.date_trunc("DAY", _ts_literal(df, col, mark))
            since = since.cast(df.schema[col].dataType.simpleString())
    return df.where((t >= since) & (F.col(roles.measure) > F.lit(min_measure)))


def backfill_slice(df: DataFrame, roles: Roles, first_year: int, last_year: int,
                   min_measure=0) -> DataFrame:
    """Rows created in the inclusive year range with measure > ``min_measure``.

    The year range is written as a half-open range on the raw event time (not
    ``year(t) BETWEEN``) so that it is pushed into the scan.
    """
    col = roles.event_time
    if isinstance(df.schema[col].dataType, StringType):
        t = event_ts(df, col)
        lo = F.make_timestamp(F.lit(first_year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        hi = F.make_timestamp(F.lit(last_year + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    else:
        t = F.col(col)
        lo = _ts_literal(df, col, f"{first_year:04d}-01-01 00:00:00")
        hi = _ts_literal(df, col, f"{last_year + 1:04d}-01-01 00:00:00")
    return df.where((t >= lo) & (t < hi) & (F.col(roles.measure) > F.lit(min_measure)))


TOP_BUCKETS = 64


def top_n_per_year(df: DataFrame, roles: Roles, n: int) -> DataFrame:
    """I4: per event year, the ``n`` rows with the largest measure (ties by key).

    Two steps: the top n of every (year, hash bucket of the key), then the top
    n of those per year.  Both are planned with a partial ``WindowGroupLimit``
    before the shuffle (a map task sends at most ``n`` rows per group), so a
    year that holds most of the data is ranked by ``TOP_BUCKETS`` tasks and its
    last window sees at most ``TOP_BUCKETS * n`` rows.
    """
    t = event_ts(df, roles.event_time)
    order = [F.desc(roles.measure), F.asc(roles.key)]
    bucket = F.pmod(F.xxhash64(roles.key), F.lit(TOP_BUCKETS))
    in_bucket = Window.partitionBy(YEAR_COL, "_bucket").orderBy(*order)
    in_year = Window.partitionBy(YEAR_COL).orderBy(*order)
    return (df.withColumns({YEAR_COL: F.year(t), "_bucket": bucket})
            .withColumn("_rn", F.row_number().over(in_bucket)).where(F.col("_rn") <= n)
            .withColumn("_rn", F.row_number().over(in_year)).where(F.col("_rn") <= n)
            .drop("_rn", "_bucket"))


def dedupe_first(df: DataFrame, key: str, order: Sequence[str], descending: bool = False) -> DataFrame:
    """I5 (W4): one row per key - the first by ``order`` (the last with
    ``descending``); remaining columns break ties, so the result is
    deterministic (``dropDuplicates`` is not).

    Implemented as ``min``/``max`` of a struct per key: an aggregate with a
    map-side partial step, so a key repeated in a third of all rows is reduced
    to one row per map task before the shuffle (a window over the key would
    sort all of its rows in one task).
    """
    order = list(order)
    rest = [c for c in df.columns if c != key and c not in order]
    fields = order + rest
    s = F.struct(*[F.col(c) for c in fields])
    pick = F.max(s) if descending else F.min(s)
    return (df.groupBy(key).agg(pick.alias("_first"))
            .select(key, *[F.col("_first")[c].alias(c) for c in fields])
            .select(*df.columns))


def enrich_tags(df: DataFrame, tags: DataFrame, key: str, tags_col: str = "topics") -> DataFrame:
    """I6 (J2): attach the tag array of each item from a second source with a
    left outer equi-join; items without tags get ``[]``.

    ``tags`` must hold one row per key.  No broadcast hint: the tag source
    grows with the data, so AQE decides from its measured size.
    """
    t = tags.select(F.col(key), F.col(tags_col).alias("_tags"))
    base = df.drop(tags_col) if tags_col in df.columns else df
    return (base.join(t, on=key, how="left")
            .withColumn(tags_col, F.coalesce(F.col("_tags"), F.array().cast("array<string>")))
            .drop("_tags"))


def label_tags(labels: DataFrame, key: str, flags: Sequence[str], tags_col: str = "tags") -> DataFrame:
    """Tag array from 0/1 flag columns: the names of the flags set to 1."""
    arr = F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags])
    return labels.select(key, F.filter(arr, lambda x: x.isNotNull()).alias(tags_col))
