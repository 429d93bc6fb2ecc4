"""Selection equals ``percentile`` whatever the values, and holds few of them."""

import math

import pytest
from pyspark.sql import functions as F

from trendlake.operators.quantile import exact_quantile, exact_quantiles

N = 20_000
VALUES = {
    "spread": "double(hash(id))",
    "skewed": "exp(double(pmod(hash(id), 1400) - 700))",
    "one_outlier": "if(id = 7, 1e308, double(id) / 7)",
    "mostly_tied": "if(id % 10 < 7, 3.5D, double(id % 50))",
    "two_values": "if(id % 2 = 0, 1D, 2D)",
    "constant": "4D",
    "sorted_decimals": "cast(id as decimal(12,2)) / 8",
    "with_nulls": "if(id % 3 = 0, null, double(id))",
}


@pytest.mark.parametrize("name", VALUES)
def test_selection_equals_percentile(spark, name):
    df = spark.range(N).select(F.expr(VALUES[name]).alias("v")).repartition(7)
    qs = [0.0, 0.5, 0.9, 0.99995, 1.0]
    expected = df.agg(*[F.percentile(F.col("v").cast("double"), F.lit(q)) for q in qs]).first()
    for q, e, got in zip(qs, expected, exact_quantiles(df, "v", qs, small=50, accuracy=100)):
        assert math.isclose(got, e, rel_tol=1e-12, abs_tol=0), (q, got, e)


def test_small_bracket_is_never_exceeded(spark, monkeypatch):
    """Whatever reaches the one array is at most ``small`` values."""
    seen = []
    real = F.collect_list
    df = spark.range(N).select(F.expr(VALUES["skewed"]).alias("v"))

    def watched(c):
        seen.append(c)
        return F.when(F.count(c) <= 50, real(c)).otherwise(F.raise_error(F.lit("too many values")))

    monkeypatch.setattr(F, "collect_list", watched)
    assert exact_quantile(df, "v", 0.37, small=50, accuracy=100) > 0 and len(seen) <= 1


def test_awkward_values(spark):
    def q(values, at=0.5):
        return exact_quantile(spark.createDataFrame([(v,) for v in values], "v double"), "v", at)

    assert q([]) is None and q([None, None]) is None
    assert q([5.0]) == 5.0 and q([None, 1.0, 2.0]) == 1.5
    assert math.isnan(q([1.0, math.nan], 1.0)) and q([1.0, math.nan], 0.0) == 1.0
    assert q([math.inf, math.inf]) == math.inf and q([-math.inf, 1.0, math.inf]) == 1.0
    with pytest.raises(ValueError):
        q([1.0], 1.5)
