"""Scalar helpers: the integer fast path equals exact decimal rounding."""

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendlake.functions import per_day, safe_ratio

cents = st.integers(-10**9, 10**9).map(lambda c: c / 100)


def half_even(x: Decimal, digits=4) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN))


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cents, cents, st.integers(1, 5000)), min_size=1, max_size=200))
def test_per_day_and_ratio_exact(spark, rows):
    rows = rows + [(100.05, 0.0, 1000), (0.00125 * 8, 5.0, 8), (3.0, 0.0, 3), (1e13, 7.0, 3)]
    df = spark.createDataFrame(rows, "m double, m2 double, days long")
    got = df.select(per_day("m", "days").alias("p"), safe_ratio("m2", "m").alias("r")).collect()
    for (m, m2, days), g in zip(rows, got):
        dm, dm2 = Decimal(repr(m)), Decimal(repr(m2))
        assert g.p == half_even(dm / Decimal(days)), (m, days)
        den = dm if m != 0 else Decimal(1)
        assert g.r == half_even(dm2 / den), (m2, m)


def test_null_inputs(spark):
    df = spark.createDataFrame([(None, 1.0, 3), (2.0, None, None)], "m double, m2 double, days long")
    got = df.select(per_day("m", "days").alias("p"), safe_ratio("m2", "m").alias("r")).collect()
    assert got[0].p is None and got[1].p is None and got[1].r is None
    assert df.select(F.lit(1)).count() == 2


def test_broadcast_threshold_units(spark):
    from trendlake.session import broadcast_threshold
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for value, expected in [("10485760b", 10485760), ("20MB", 20 << 20), ("1g", 1 << 30), ("-1", -1),
                                ("4096", 4096)]:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert broadcast_threshold(spark) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
