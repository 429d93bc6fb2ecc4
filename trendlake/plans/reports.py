"""Every report of the original batch run, from one item table.

``write_reports`` reads the item records once (JSON arrays are parsed into
the bronze Parquet layer first, so every report scans Parquet in parallel
instead of re-parsing unsplittable JSON), writes the bronze / silver / gold
layers and each report, counts the rows of every output while it is written
and returns those run metrics.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from trendlake.functions import join_text
from trendlake.operators import aggregate as agg
from trendlake.operators import cluster as cl
from trendlake.operators import forecast as fc
from trendlake.operators import graph as gr
from trendlake.operators.features import features
from trendlake.operators.quality import quality_report
from trendlake.operators.window import yoy_growth
from trendlake.roles import REFERENCE_ROLES, Roles
from trendlake.sources import io

# The expected columns of the quality check and the report
# parameters of the original run.
EXPECTED_COLUMNS = ("id", "name", "full_name", "language", "stars", "forks", "created_at", "topics", "html_url")
TARGET_TAGS = ("ai", "web", "blockchain")
COMPARED_CATEGORIES = ("Python", "JavaScript")
MIN_MEASURE = 500
FORECAST_YEARS = (2025, 2026)


def build_reports(raw: DataFrame, silver: DataFrame, roles: Roles = REFERENCE_ROLES, as_of=None,
                  forecast_years: Sequence[int] = FORECAST_YEARS, tags: Sequence[str] = TARGET_TAGS,
                  compared: Sequence[str] = COMPARED_CATEGORIES, min_measure=MIN_MEASURE,
                  expected: Sequence[str] | None = EXPECTED_COLUMNS, clusters: bool = True,
                  graph: bool = True) -> dict[str, Callable[[], DataFrame]]:
    """Report name -> builder of its DataFrame.  ``raw`` is the full item
    table (null categories included), ``silver`` its clean base table."""
    cat = roles.category
    yearly = agg.yearly_counts(silver, roles)
    # The report names (output directories) of the original run,
    # so existing readers of those outputs find them under the same names.
    reports: dict[str, Callable[[], DataFrame]] = {
        "rdd_language_stars": lambda: agg.category_sum(raw, roles),
        "processed_language_year": lambda: agg.category_year(silver, roles),
        "processed_language_month": lambda: agg.category_month(silver, roles),
        "feature_engineering": lambda: features(silver, roles, as_of),
        "growth": lambda: yoy_growth(yearly, cat),
        "avg_stars": lambda: agg.mean_by(silver, [cat], roles.measure),
        "trends": lambda: agg.top_categories(silver, roles, n=10),
        "top_topics": lambda: agg.tag_stats(silver, roles),
        "advanced_analytics": lambda: agg.long_report(silver, roles, tags, min_measure),
        "language_comparison": lambda: agg.category_compare(silver, roles, compared),
        "developer_productivity": lambda: agg.productivity(silver, roles),
        "predicted_growth": lambda: fc.forecast(yearly, cat, years=forecast_years),
        "model_selection_report": lambda: fc.model_selection(yearly, cat),
        "data_quality_report": lambda: quality_report(raw, expected, roles.key, cat),
    }
    if clusters:
        def text_clusters() -> DataFrame:
            text = raw.withColumn("_text", join_text(roles.name, roles.description, roles.tags))
            return cl.cluster_projection(cl.cluster_texts(text, "_text"), roles)
        reports["nlp_topic_clusters"] = text_clusters
    if graph:
        reports["graph_metrics"] = lambda: gr.graph_metrics(gr.build_edges(raw, roles))
    return reports


def write_reports(spark: SparkSession, items_path: str, out_dir: str, roles: Roles = REFERENCE_ROLES,
                  source: str = "json", as_of=None, run_at=None, only: Sequence[str] | None = None,
                  parallel: int = 4, **options) -> DataFrame:
    """Read the items, write the layers under ``out_dir/data`` and every report
    under ``out_dir/output/<name>`` (CSV with header; the quality report as
    JSON); return the run metrics (output, row_count, timestamp_utc = ``run_at``).

    The reports are independent, so up to ``parallel`` of them are submitted
    as concurrent Spark jobs (small aggregates would otherwise leave most of
    a cluster idle)."""
    raw_in = io.load(spark, source, items_path, **options)
    paths = io.write_layers(raw_in, roles, os.path.join(out_dir, "data"))
    raw = spark.read.parquet(paths["bronze"])
    silver = spark.read.parquet(paths["silver"])
    todo = [(name, build) for name, build in build_reports(raw, silver, roles, as_of=as_of).items()
            if not only or name in only]

    def write(item) -> dict:
        name, build = item
        target = os.path.join(out_dir, "output", name)
        sink = io.write_json if name == "data_quality_report" else io.write_csv
        return io.write_observed(build(), lambda d: sink(d, target), name)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        metrics = list(pool.map(write, todo))
    run_at = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S") if run_at is None else str(run_at)
    return agg.run_metrics(spark, {m["output"]: m["row_count"] for m in metrics}, run_at)
