"""Maintained aggregates (S6 with A2, A4, A8): group counts and sums that follow
a changing table by signed deltas instead of being recomputed.

An upsert takes an old row of a key away (sign -1) and puts a new one in (+1).
Counts and sums are additive, so the totals after it are the totals before plus
the sums of the signed rows; a group whose count falls to zero goes.  Means are
sums over counts.  Sums are kept in longs or decimals, never in doubles: what is
taken away is exactly what was put in, in whatever order batches and tasks come.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

COUNT = "row_count"


@dataclass(frozen=True)
class Totals:
    """What to maintain: ``by`` (group column -> SQL expression over a row) and
    ``sums`` (total column -> SQL expression); doubles and floats are summed as
    decimals with ``scale`` digits after the point (half up); ``absent`` names columns
    (with their types) that count as null while the table does not have them."""
    name: str
    by: Mapping[str, str]
    sums: Mapping[str, str] = field(default_factory=dict)
    scale: int = 6
    absent: Mapping[str, str] = field(default_factory=dict)

    def parts(self, rows: DataFrame, sign: int) -> DataFrame:
        """One row per group of ``rows``: signed count and signed sums."""
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in self.absent.items() if c not in rows.columns})
        d = rows.select(*[F.expr(e).alias(n) for n, e in self.by.items()],
                        *[F.expr(e).alias(n) for n, e in self.sums.items()])
        return d.groupBy(*self.by).agg(
            (F.count(F.lit(1)) * sign).alias(COUNT),
            *[self._signed(d, n, sign).alias(n) for n in self.sums])

    def _signed(self, d: DataFrame, name: str, sign: int) -> Column:
        kind, c = d.schema[name].dataType, F.col(name)
        if isinstance(kind, (DoubleType, FloatType)):
            c = c.cast(DecimalType(38, self.scale))
        elif isinstance(kind, DecimalType):
            c = c.cast(DecimalType(38, kind.scale))
        else:
            c = c.cast("long")
        total = F.coalesce(F.sum(c), F.lit(0).cast(DecimalType(38, self.scale) if isinstance(kind, (DoubleType, FloatType)) else
                                                   DecimalType(38, kind.scale) if isinstance(kind, DecimalType) else "long"))
        return total if sign > 0 else -total

    def deltas(self, removed: DataFrame | None, inserted: DataFrame) -> DataFrame:
        """Signed totals of one change of the table; groups that do not change
        are left out.  Rows are summed map-side before anything is shuffled."""
        new = self.parts(inserted, 1)
        return new if removed is None else self._added(new.unionByName(self.parts(removed, -1)), drop_empty=False)

    def apply(self, totals: DataFrame | None, deltas: DataFrame) -> DataFrame:
        """Totals after ``deltas``: only the totals table and the deltas are read."""
        return self._added(deltas if totals is None else totals.unionByName(deltas), drop_empty=True)

    def _added(self, parts: DataFrame, drop_empty: bool) -> DataFrame:
        types = {f.name: f.dataType for f in parts.schema.fields}
        out = parts.groupBy(*self.by).agg(F.sum(COUNT).alias(COUNT),
                                          *[F.sum(n).cast(types[n]).alias(n) for n in self.sums])
        if drop_empty:
            return out.where(F.col(COUNT) != 0)
        changed = F.col(COUNT) != 0
        for n in self.sums:
            changed = changed | (F.col(n) != 0)
        return out.where(changed)
