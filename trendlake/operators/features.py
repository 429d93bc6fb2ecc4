"""Derived feature table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from trendlake.functions import elapsed_days, min_max, per_day, safe_ratio
from trendlake.roles import TS_COL, Roles


def _as_of_literal(base: DataFrame, as_of) -> F.Column:
    ts_type = "timestamp_ntz" if isinstance(base.schema[TS_COL].dataType, TimestampNTZType) else "timestamp"
    if as_of is None:
        return F.current_timestamp().cast(ts_type)
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast(ts_type)


def features(base: DataFrame, roles: Roles, as_of=None) -> DataFrame:
    """Every input column plus

    * ``repo_age_days``   whole days from the event time to ``as_of``, at least 1
    * ``stars_per_day``   measure / age, half-even 4 digits
    * ``fork_star_ratio`` measure2 / measure (0 -> 1), half-even 4 digits
    * ``repo_age_norm``   (age - min age) / (max age - min age + 1e-9), 4 digits

    ``base`` is the output of ``base_table`` (it carries ``created_ts``).
    ``as_of`` fixes "now" so the table is reproducible.

    The age is a non-increasing function of the event time, so the global
    min / max age come from max / min of one timestamp column: a column-pruned
    scalar aggregate inlined as a literal, not a join and not a second pass
    over every column.
    """
    as_of_c = _as_of_literal(base, as_of)
    age = elapsed_days(F.col(TS_COL), as_of_c)
    ts_range = base.agg(F.min(TS_COL).alias("lo"), F.max(TS_COL).alias("hi"))
    max_age = ts_range.select(elapsed_days(F.col("lo"), as_of_c)).scalar()
    min_age = ts_range.select(elapsed_days(F.col("hi"), as_of_c)).scalar()
    out = base.withColumn("repo_age_days", age)
    a = F.col("repo_age_days")
    return out.withColumns({
        "stars_per_day": per_day(F.col(roles.measure), a),
        "fork_star_ratio": safe_ratio(F.col(roles.measure2), F.col(roles.measure)),
        "repo_age_norm": min_max(a, min_age, max_age),
    })
