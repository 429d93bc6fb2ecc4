"""The result columns shared with the original reports are the ones the operators make."""

from conftest import SMALL
from trendlake.plans import catalog
from trendlake.roles import RESULT_COLUMNS

QUERY_OF = {"yoy_growth": "yoy_growth", "mean_by": "category_mean", "productivity": "productivity", "features": "features",
            "quality_report": "quality_report", "forecast": "forecast_band"}


def test_result_columns(spark):
    for operator, query in QUERY_OF.items():
        assert set(RESULT_COLUMNS[operator]) <= set(catalog.QUERIES[query](spark, SMALL).columns)


def test_long_report_joins_part_once(spark):
    """Without broadcasting: one join, lineitem and part shuffled by part key once each."""
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = catalog.QUERIES["long_report"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall("SortMergeJoin|ShuffledHashJoin", plan)) == 1
    assert len(re.findall(r"hashpartitioning\(l_partkey", plan)) == 1
    assert len(re.findall(r"hashpartitioning\(p_partkey", plan)) == 1


def test_top_n_ranks_buckets_before_years(spark):
    plan = catalog.QUERIES["top_n_per_year"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hashpartitioning(year") < plan.rindex("_bucket")
    assert plan.count("WindowGroupLimit") >= 2
