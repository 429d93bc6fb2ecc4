"""Exact quantiles by distributed selection.

The rank that is asked for is bracketed between two values of the data, which
a mergeable sketch (``percentile_approx``) proposes and exact counts then
confirm; the next round looks only between them.  A round shrinks the bracket
by about ``accuracy / 4`` times however the values are distributed, as its
steps are in ranks, not in values.  A rank that falls on one of the two values
is done, so values that repeat without end cost nothing more.  At ``small``
rows or fewer the bracket is sorted as one array: no task and no driver step
ever holds more values than that, while ``percentile`` gathers all distinct
values into one task.

All quantiles of a call share two scans a round (three rounds for 10^11 rows);
give a table, not a costly plan.  Defined cases: nulls are left out, no values give None;
NaN is above all numbers, as Spark orders it; two equal neighbours (infinite
ones, too) are their own mean.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 10_000
ACCURACY = 1_000


class _Bracket:
    """Ranks still open (one or two neighbours) and the open interval of values
    that holds them: ``below`` rows are not above ``low``, ``left`` rows inside."""

    def __init__(self, ranks: Sequence[int], n: int):
        self.ranks, self.found = sorted(set(ranks)), {}
        self.low = self.high = None
        self.below, self.left = 0, n

    def inside(self) -> Column:
        x = F.col("x")
        above = F.lit(True) if self.low is None else x > self.low
        return above if self.high is None else above & (x < self.high)

    def values(self) -> Column:
        """The rows inside; null elsewhere, which aggregates leave out."""
        return F.when(self.inside(), F.col("x"))

    def shares(self, accuracy: int) -> list[float]:
        """Where in the bracket the ranks lie at the earliest and the latest."""
        slack = 2 / accuracy
        return [max(0.0, (self.ranks[0] - self.below) / self.left - slack),
                min(1.0, (self.ranks[-1] + 1 - self.below) / self.left + slack)]

    def counts(self, a: float, b: float) -> Column:
        x = self.values()
        return F.array(F.count_if(x < a), F.count_if(x == a), F.count_if((x > a) & (x < b)),
                       F.count_if((x == b) & F.lit(a != b)), F.count_if(x > b))

    def narrow(self, a: float, b: float, counts: Sequence[int]) -> None:
        """Take the part of the bracket that the ranks fall into; a rank that
        falls on ``a`` or ``b`` is done."""
        parts, end = [], self.below
        for size, value, bounds in zip(counts, (None, a, None, b, None),
                                       ((self.low, a), None, (a, b), None, (b, self.high))):
            parts.append((end, end + size, value, bounds))
            end += size
        hit = {k: next(p for p in parts if p[0] <= k < p[1]) for k in self.ranks}
        self.found |= {k: p[2] for k, p in hit.items() if p[2] is not None}
        self.ranks = [k for k in self.ranks if hit[k][2] is None]
        if self.ranks:
            first, last = hit[self.ranks[0]], hit[self.ranks[-1]]
            self.below, self.left = first[0], last[1] - first[0]
            self.low, self.high = first[3][0], last[3][1]


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], small: int = SMALL,
                    accuracy: int = ACCURACY) -> list[float | None]:
    """The quantiles ``qs`` of ``col`` with linear interpolation between
    neighbours, each equal to ``percentile``; all share the scans."""
    if not all(0 <= q <= 1 for q in qs):
        raise ValueError("q must lie between 0 and 1")
    x = df.select(F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    n, nans = x.agg(F.count("x"), F.count_if(F.isnan("x"))).first()
    if not n:
        return [None] * len(qs)
    numbers, x = n - nans, x.where(~F.isnan("x"))
    at = [q * (n - 1) for q in qs]
    brackets = [_Bracket([k for k in (math.floor(p), math.ceil(p)) if k < numbers], numbers) for p in at]
    while wide := [b for b in brackets if b.ranks and b.left > small]:
        ends = x.agg(*[F.percentile_approx(b.values(), b.shares(accuracy), accuracy) for b in wide]).first()
        counts = x.agg(*[b.counts(*e) for b, e in zip(wide, ends)]).first()
        for b, e, c in zip(wide, ends, counts):
            b.narrow(*e, c)
    if few := [b for b in brackets if b.ranks]:
        for b, values in zip(few, x.agg(*[F.sort_array(F.collect_list(b.values())) for b in few]).first()):
            b.found |= {k: values[k - b.below] for k in b.ranks}

    def between(p: float, found: dict[int, float]) -> float:
        lo, hi = math.floor(p), math.ceil(p)
        a, b = found.get(lo, math.nan), found.get(hi, math.nan)
        return a if a == b else (hi - p) * a + (p - lo) * b

    return [between(p, b.found) for p, b in zip(at, brackets)]


def exact_quantile(df: DataFrame, col: str, q: float, small: int = SMALL, accuracy: int = ACCURACY) -> float | None:
    """One quantile of ``col``."""
    return exact_quantiles(df, col, [q], small, accuracy)[0]
