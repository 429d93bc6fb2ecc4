"""Column -> Column helpers (F1-F16).  All built-in expressions: they stay in
whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType, DateType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_ts(df: DataFrame, col: str) -> Column:
    """event time as a timestamp; unparsable strings become null.

    Strings (ISO-8601, optional ``Z``) go through ``try_to_timestamp`` so a bad
    value yields null instead of failing the query under ANSI mode; timestamp
    columns (zoned or not) are used as they are.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.col(col)
    if isinstance(dtype, DateType):
        return F.col(col).cast("timestamp_ntz")
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(F.col(col))
    return F.try_to_timestamp(F.col(col).cast("string"))


def elapsed_days(ts, as_of) -> Column:
    """whole 24-hour periods from ``ts`` to ``as_of``, at least 1; null ts -> null.

    Counts elapsed time, not calendar dates (23:30 -> 00:30 is 0 days, so 1).
    ``as_of - ts`` is an exact day-time interval for zoned and zone-less
    timestamps alike (no session-zone conversion, so no DST hour is gained
    or lost); its DAY field is the whole days, truncated toward zero, which
    equals the floor wherever the result is not clipped to 1.
    """
    ts, as_of = _c(ts), _c(as_of)
    days = F.extract(F.lit("DAY"), as_of - ts).cast("long")
    return F.when(ts.isNotNull(), F.greatest(F.lit(1).cast("long"), days))


def exact_half_even(c, digits: int, scale: int = 18) -> Column:
    """Half-to-even rounding done in decimal arithmetic, returned as double.

    Doubles cannot hold most decimal ties exactly (0.045 is 0.04499...), so
    rounding them is engine-dependent; rounding the decimal value is not.
    """
    return F.bround(_c(c).cast(f"decimal(38,{scale})"), digits).cast("double")


# Exact half-even division without BigDecimal: for integers |n| < 2**52 and
# d > 0 the correctly rounded double n / d lies on k + 0.5 only when the
# true quotient does (a non-tie is at least 1 / (2d) away from it, more than
# the rounding error), so IEEE ``rint`` (round half to even) of it is exact.
_EXACT_LIMIT = float(2 ** 52)


def _units(c: Column, scale: int) -> Column:
    """``c`` in whole units of 1/scale, half-even (a whole number held in a
    double; ``rint`` stays in double arithmetic, unlike ``round``)."""
    return F.rint(c.cast("double") * F.lit(float(scale)))


def per_day(measure, days, digits: int = 4) -> Column:
    """measure per day, half-even to ``digits``; the measure is taken to
    ``digits`` decimals (half-even) first.  Exact, and codegen-friendly: one ``rint`` of a
    double quotient; decimal arithmetic only for values beyond 2**52 units."""
    m, d = _c(measure), _c(days)
    scale = 10 ** digits
    n = _units(m, scale)
    fast = F.rint(n / d.cast("double")) / F.lit(float(scale))
    slow = F.bround(F.try_divide(m.cast("decimal(24,4)"), d.cast("decimal(20,0)")), digits).cast("double")
    return F.when((F.abs(n) < F.lit(_EXACT_LIMIT)) & (d > 0), fast).otherwise(slow)


def safe_ratio(num, den, digits: int = 4) -> Column:
    """num / den with a zero denominator replaced by 1, half-even to
    ``digits`` (both taken to ``digits`` decimals first).  Exact, as
    ``per_day``."""
    n, d = _c(num), _c(den)
    d_fixed = F.when(d == 0, F.lit(1)).otherwise(d)
    scale = 10 ** digits
    n_units = _units(n, scale) * F.lit(float(scale))
    d_units = _units(d_fixed, scale)
    fast = F.rint(n_units / d_units) / F.lit(float(scale))
    slow = F.bround(F.try_divide(n.cast("decimal(24,4)"), d_fixed.cast("decimal(24,4)")), digits).cast("double")
    ok = (F.abs(n_units) < F.lit(_EXACT_LIMIT)) & (F.abs(d_units) < F.lit(_EXACT_LIMIT)) & (d_units != 0)
    return F.when(ok, fast).otherwise(slow)


def min_max(c, lo, hi, eps: float = 1e-9, digits: int = 4) -> Column:
    """(c - lo) / (hi - lo + eps), half-even to ``digits``.

    ``lo`` / ``hi`` are usually scalar subqueries (``df.select(F.min(c)).scalar()``),
    evaluated once and inlined as literals - no join, no cross product.
    """
    c, lo, hi = _c(c), _c(lo), _c(hi)
    scale = float(10 ** digits)
    x = (c - lo).cast("double") / ((hi - lo).cast("double") + F.lit(eps))
    # half-even on the double value; with eps > 0 the quotient is never an exact tie
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def join_text(name, description, tags) -> Column:
    """name, description and blank-joined tags separated by single blanks;
    nulls count as empty strings (``concat_ws`` would drop their separators)."""
    return F.concat(
        F.coalesce(_c(name).cast("string"), F.lit("")), F.lit(" "),
        F.coalesce(_c(description).cast("string"), F.lit("")), F.lit(" "),
        F.coalesce(F.array_join(_c(tags), " "), F.lit("")),
    )


def node_name(prefix: str, c, unknown: str | None = None) -> Column:
    """typed node name ``prefix:value``; with ``unknown`` set, null or empty
    values become that word."""
    v = _c(c).cast("string")
    if unknown is not None:
        v = F.coalesce(F.nullif(v, F.lit("")), F.lit(unknown))
    return F.concat(F.lit(prefix + ":"), v)


def pct(numerator, denominator, digits: int = 2) -> Column:
    """numerator / denominator * 100, exact decimal half-even to ``digits``."""
    num = _c(numerator).cast("decimal(38,0)") * F.lit(100)
    return F.bround(F.try_divide(num, _c(denominator).cast("decimal(38,0)")), digits).cast("double")


def band(c, pct_: float = 0.1, digits: int = 2) -> tuple[Column, Column]:
    """lower / upper band ``c * (1 -/+ pct)``, exact decimal half-even."""
    p = _c(c).cast("decimal(24,4)")
    lo = F.lit(Decimal(str(1 - pct_)))
    hi = F.lit(Decimal(str(1 + pct_)))
    return (F.bround(p * lo, digits).cast("double"), F.bround(p * hi, digits).cast("double"))
