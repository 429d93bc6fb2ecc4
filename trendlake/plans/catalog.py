"""Query catalogue: the operators bound to the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables.  ``trendlake.plans.oracle`` holds the equivalent SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.functions import event_ts, join_text
from trendlake.operators import aggregate as agg
from trendlake.operators import cluster as cl
from trendlake.operators import graph as gr
from trendlake.operators import forecast as fc
from trendlake.operators import ingest as ing
from trendlake.operators import prepare as prep
from trendlake.operators.features import features
from trendlake.operators.quality import quality_report
from trendlake.operators.quantile import exact_quantiles
from trendlake.operators.totals import Totals
from trendlake.operators.window import yoy_growth
from trendlake.plans.tables import (DOCUMENTS, EMBEDDINGS, LINEITEM, ORDERS, PART,
                                    lineitem_with_tags, part_with_tags, table)
from trendlake.session import ensure_checkpoint_dir
from trendlake.sources import io
from trendlake.sources.keyed import KeyedTable
from trendlake.sources.upsert import upsert, upsert_stats

# Fixed parameters of the catalogue queries.
TARGET_TAGS = ("red", "hot", "gear")
LONG_REPORT_MIN = 50000
COMPARE_CATEGORIES = ("1-URGENT", "2-HIGH")
GROWTH_YEARS = (1996, 2000)
GROWTH_CATEGORIES = ("1-URGENT", "2-HIGH", "5-LOW")
TOTALS_MINIMUM = 85000
TOTALS_CATEGORIES = ("Brand#2", "Brand#3", "Brand#4", "Brand#10", "Brand#19")
FILTER_TAGS = ("red", "blue", "gear", "anvil")
ANOMALY_Q = 0.9
ANOMALY_N = 10
PRICE_QUANTILES = (0.1, 0.5, 0.9, 0.99)
TOP_TAGS = 10
FEATURES_AS_OF = "2002-01-01 00:00:00"
DOC_EXPECTED = ("doc_id", "text", "lang", "source", "quality", "toxic", "url")
LABEL_FLAGS = ("quality", "toxic")
INCREMENTAL_MARK = "2001-06-15T10:30:00Z"
SLICE_MIN = 100000
BACKFILL_YEARS = (1996, 1998)
TOP_PER_YEAR = 100
FORECAST_YEARS = (2002, 2003)
UPSERT_TARGET_BEFORE = "1999-01-01 00:00:00"
UPSERT_BATCH_FROM = "1998-01-01 00:00:00"
UPSERT_STALE_FROM = "2000-01-01 00:00:00"
INGESTED_AT = "2024-01-01 00:00:00"
BETWEENNESS_K = 100
GRAPH_SEED = 42
CLUSTER_SEED = 42
CLUSTER_RESTARTS = 10
RUN_AT = "2024-01-01 00:00:00"
RUN_METRIC_OUTPUTS = ("yoy_growth", "category_year", "tag_stats", "long_report", "features",
                      "forecast", "edges")

Query = Callable[[SparkSession, str], DataFrame]


def orders_base(spark: SparkSession, d: str) -> DataFrame:
    return prep.base_table(table(spark, d, "orders"), ORDERS)


def orders_growth(spark: SparkSession, d: str) -> DataFrame:
    return yoy_growth(agg.yearly_counts(orders_base(spark, d), ORDERS), ORDERS.category)


def part_base(spark: SparkSession, d: str) -> DataFrame:
    return part_with_tags(spark, d).where(F.col(PART.category).isNotNull())


def part_tag_stats(spark: SparkSession, d: str) -> DataFrame:
    return agg.tag_stats(part_base(spark, d), PART, digits=2)


def part_totals(spark: SparkSession, d: str) -> DataFrame:
    return agg.top_categories(part_base(spark, d), PART, n=10, digits=2)


# --- 2.5 / 2.6 / 2.7 / 2.8 -------------------------------------------------

def q_yoy_growth(spark, d):
    return orders_growth(spark, d)


def q_category_sum(spark, d):
    return agg.category_sum(table(spark, d, "orders"), ORDERS, digits=2)


def q_category_year(spark, d):
    return agg.category_year(orders_base(spark, d), ORDERS, digits=2)


def q_category_month(spark, d):
    return agg.category_month(orders_base(spark, d), ORDERS, digits=2)


def q_category_year_month(spark, d):
    return agg.category_year_month(orders_base(spark, d), ORDERS, digits=2)


def q_category_mean(spark, d):
    return agg.mean_by(orders_base(spark, d), [ORDERS.category], ORDERS.measure)


def q_top10_categories(spark, d):
    return part_totals(spark, d)


def q_tag_stats(spark, d):
    return part_tag_stats(spark, d)


def q_tag_month_trend(spark, d):
    base = prep.base_table(lineitem_with_tags(spark, d, only_tags=TARGET_TAGS), LINEITEM)
    return agg.tag_stats(base, LINEITEM, keys=["year", "month"], only=TARGET_TAGS, digits=2,
                         ordered=False)


def q_category_compare(spark, d):
    return agg.category_compare(orders_base(spark, d), ORDERS, COMPARE_CATEGORIES, digits=2)


def q_productivity(spark, d):
    return agg.productivity(prep.base_table(table(spark, d, "lineitem"), LINEITEM), LINEITEM, digits=2)


def q_long_report(spark, d):
    """Only the tag section needs part, cut to the wanted tags before the join;
    the other two sections read lineitem alone."""
    base = prep.base_table(table(spark, d, "lineitem"), LINEITEM)
    tagged = prep.base_table(lineitem_with_tags(spark, d, only_tags=TARGET_TAGS), LINEITEM)
    return agg.long_report(base, LINEITEM, tags=TARGET_TAGS, min_measure=LONG_REPORT_MIN, digits=2, tagged=tagged)


def brand_yearly_counts(spark, d):
    """repo_count per part brand x ship year.  Lines are counted per
    (part, year) before the join (partial aggregate, map-side), so the join
    with part sees one row per part and year instead of one per line; the
    brand totals are then summed from those counts."""
    li = table(spark, d, "lineitem")
    per_part = (li.groupBy("l_partkey", F.year(event_ts(li, LINEITEM.event_time)).alias("year"))
                .agg(F.count(F.lit(1)).alias("_n")))
    part = table(spark, d, "part").where(F.col("p_brand").isNotNull()).select("p_partkey", "p_brand")
    return (per_part.join(part, per_part["l_partkey"] == part["p_partkey"])
            .groupBy("p_brand", "year").agg(F.sum("_n").alias("repo_count")))


def q_top8_growth(spark, d):
    growth = yoy_growth(brand_yearly_counts(spark, d), "p_brand")
    return agg.rows_of_top_categories(prep.filter_growth(growth, "p_brand"), "p_brand", n=8)


def q_growth_filtered(spark, d):
    return prep.filter_growth(orders_growth(spark, d), ORDERS.category, years=GROWTH_YEARS,
                              categories=GROWTH_CATEGORIES)


def q_totals_filtered(spark, d):
    return prep.filter_totals(part_totals(spark, d), PART.category, minimum=TOTALS_MINIMUM,
                              categories=TOTALS_CATEGORIES)


def q_tags_filtered(spark, d):
    return prep.filter_tags(part_tag_stats(spark, d), FILTER_TAGS)


def q_filter_domains(spark, d):
    return prep.filter_domains(orders_growth(spark, d), part_totals(spark, d),
                               part_tag_stats(spark, d), PART.category)


def q_growth_pivot(spark, d):
    growth = prep.filter_growth(orders_growth(spark, d), ORDERS.category)
    return agg.pivot_mean(growth, "year", ORDERS.category, "growth_rate_pct")


def q_growth_anomalies(spark, d):
    g = prep.filter_growth(orders_growth(spark, d), ORDERS.category, years=GROWTH_YEARS)
    return fc.growth_anomalies(g, ORDERS.category, q=ANOMALY_Q, n=ANOMALY_N)


def q_price_quantiles(spark, d):
    lines = table(spark, d, "lineitem")
    rows = list(zip(PRICE_QUANTILES, exact_quantiles(lines, "l_extendedprice", PRICE_QUANTILES)))
    return spark.createDataFrame(rows, "q double, price double").withColumn("price", F.round("price", 4))


def q_top10_tags(spark, d):
    return agg.top(part_tag_stats(spark, d), "repo_count", TOP_TAGS, tie_break=["topic"])


def q_leader(spark, d):
    return agg.leader(part_totals(spark, d), part_tag_stats(spark, d), PART.category)


# --- 2.10 features and quality ---------------------------------------------

def documents_labeled(spark, d):
    """documents left-joined to labels (``quality`` null for unlabelled)."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), on="doc_id", how="left")


def documents_tagged(spark, d):
    """documents with ``tags`` = names of the label flags set to 1."""
    tags = ing.label_tags(table(spark, d, "labels"), "doc_id", LABEL_FLAGS)
    return ing.enrich_tags(table(spark, d, "documents"), tags, "doc_id", tags_col="tags")


def q_features(spark, d):
    base = prep.base_table(table(spark, d, "lineitem"), LINEITEM)
    return features(base, LINEITEM, as_of=FEATURES_AS_OF)


def q_quality_report(spark, d):
    return quality_report(documents_labeled(spark, d), expected=DOC_EXPECTED, key="doc_id",
                          category="quality")


def q_text_build(spark, d):
    docs = documents_tagged(spark, d)
    return docs.select("doc_id", join_text(DOCUMENTS.name, DOCUMENTS.description, "tags").alias("text_all"))


# --- 2.2 ingest shaping ------------------------------------------------------

def q_flatten_items(spark, d):
    ev = table(spark, d, "events")
    mapping = {"id": "event_id", "name": F.concat(F.lit("user-"), F.col("user_id").cast("string")),
               "language": "event_type", "stars": "value",
               "forks": F.get_json_object("props", "$.k").try_cast("long"), "created_at": "ts", "updated_at": "ts"}
    return ing.flatten_items(ev, mapping)


def q_dedupe_first(spark, d):
    return ing.dedupe_first(table(spark, d, "events"), "user_id", ["ts"])


def q_top_n_per_year(spark, d):
    return ing.top_n_per_year(table(spark, d, "orders"), ORDERS, TOP_PER_YEAR)


def q_incremental_slice(spark, d):
    return ing.incremental_slice(table(spark, d, "orders"), ORDERS, INCREMENTAL_MARK, SLICE_MIN)


def q_backfill_slice(spark, d):
    return ing.backfill_slice(table(spark, d, "orders"), ORDERS, BACKFILL_YEARS[0], BACKFILL_YEARS[1],
                              SLICE_MIN)


def q_enrich_tags(spark, d):
    return documents_tagged(spark, d).select("doc_id", "lang", "source", "n_chars", "tags")


def upsert_inputs(spark, d):
    """target = orders before 1999; batch = orders from 1998 with a new status
    and price, plus stale (30 days older) copies of the orders from 2000 that
    must lose against the fresh rows.  Together they cover the whole table."""
    o = table(spark, d, "orders")
    ts = lambda v: F.lit(v).cast("timestamp_ntz")
    target = o.where(F.col("o_orderdate") < ts(UPSERT_TARGET_BEFORE))
    fresh = o.where(F.col("o_orderdate") >= ts(UPSERT_BATCH_FROM)).select(
        "o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    stale = o.where(F.col("o_orderdate") >= ts(UPSERT_STALE_FROM)).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice",
        (F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS")).alias("o_orderdate"), "o_orderpriority")
    return target, fresh.unionByName(stale)


def q_upsert(spark, d):
    target, batch = upsert_inputs(spark, d)
    return upsert(target, batch, "o_orderkey", "o_orderdate", INGESTED_AT)


def q_upsert_stats(spark, d):
    target, batch = upsert_inputs(spark, d)
    return upsert_stats(target, batch, "o_orderkey", "o_orderdate")


# --- keyed table: three batches, schema history, maintained totals ----------------

PRIORITY_TOTALS = Totals("priority_year", {"o_orderpriority": "o_orderpriority", "year": "year(o_orderdate)"},
                         {"total_price": "CAST(o_totalprice AS DECIMAL(18,2))", "seasons": "season"},
                         scale=2, absent={"o_totalprice": "double"})


def keyed_batches(spark, d):
    """Three batches over all orders: those before 1999 without a price; from 1997
    on with the price (a new column), the season as a long (widened) and without the
    status (absent); from 2000 on again, a priority further and repriced."""
    o = table(spark, d, "orders")
    since = lambda year: o.where(F.col("o_orderdate") >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz"))
    before = o.where(F.col("o_orderdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp_ntz"))
    season = F.quarter("o_orderdate")
    return [
        before.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", season.cast("int").alias("season")),
        since(1997).select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", season.cast("long").alias("season")),
        since(2000).select("o_orderkey", "o_orderdate", F.concat(F.lit("late "), "o_orderpriority").alias("o_orderpriority"),
                           (F.col("o_totalprice") + 10).alias("o_totalprice"), (season + 4).cast("long").alias("season"))]


def keyed_orders(spark, d) -> KeyedTable:
    """A keyed table after the three batches (in a fresh folder of the shared directory)."""
    batches = keyed_batches(spark, d)
    t = KeyedTable(spark, f"{ensure_checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}", "o_orderkey", "o_orderdate",
                   totals=[PRIORITY_TOTALS])
    for epoch, batch in enumerate(batches):
        t.upsert(batch, INGESTED_AT, "batches", epoch)
    t.upsert(batches[1], INGESTED_AT, "batches", 1)      # a replay: skipped
    return t


def q_keyed_upsert(spark, d):
    return keyed_orders(spark, d).read()


def q_maintained_totals(spark, d):
    return keyed_orders(spark, d).read_totals(PRIORITY_TOTALS.name)


def q_schema_drift(spark, d):
    return keyed_orders(spark, d).drift(0, 2)


# --- forecasting --------------------------------------------------------------

def orders_yearly(spark, d):
    return agg.yearly_counts(orders_base(spark, d), ORDERS)


def q_forecast(spark, d):
    return fc.forecast(orders_yearly(spark, d), ORDERS.category, years=FORECAST_YEARS)


def q_forecast_band(spark, d):
    return fc.forecast_band(q_forecast(spark, d))


def q_holdout_linear(spark, d):
    return fc.holdout_linear(orders_yearly(spark, d), ORDERS.category, min_points=4)


def q_model_selection(spark, d):
    return fc.model_selection(orders_yearly(spark, d), ORDERS.category, min_points=4)


def q_selection_summary(spark, d):
    return fc.selection_summary(q_model_selection(spark, d), digits=6)


# --- graph ---------------------------------------------------------------------

def documents_graph_input(spark, d):
    """documents as items: category = language, tags = [source]."""
    return table(spark, d, "documents").select("doc_id", "lang", F.array("source").alias("tags"))


def q_edges(spark, d):
    return gr.build_edges(documents_graph_input(spark, d), DOCUMENTS)


def q_degree_centrality(spark, d):
    return gr.degree_centrality(q_edges(spark, d))


def q_graph_metrics(spark, d):
    return gr.graph_metrics(q_edges(spark, d), k=BETWEENNESS_K, seed=GRAPH_SEED, digits=10)


# --- clustering ------------------------------------------------------------------

def q_text_clusters(spark, d):
    docs = documents_tagged(spark, d)
    docs = docs.withColumn("_text", join_text(DOCUMENTS.name, DOCUMENTS.description, "tags"))
    out = cl.cluster_texts(docs.select("doc_id", "source", "lang", "n_chars", "_text"), "_text",
                           seed=CLUSTER_SEED, restarts=CLUSTER_RESTARTS)
    return cl.cluster_projection(out, DOCUMENTS)


def q_embedding_clusters(spark, d):
    out = cl.cluster(table(spark, d, "embeddings"), "embedding", seed=CLUSTER_SEED, restarts=CLUSTER_RESTARTS)
    return cl.cluster_projection(out, EMBEDDINGS)


# --- run metrics -------------------------------------------------------------------

def q_run_metrics(spark, d):
    """Writes every output of the run and reports the rows counted while writing."""
    base = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"

    def write(name: str) -> tuple[str, int]:
        done = io.write_observed(QUERIES[name](spark, d), lambda df: df.write.parquet(f"{base}/{name}"), name)
        return done["output"], done["row_count"]

    with ThreadPoolExecutor(max_workers=4) as pool:
        counts = dict(pool.map(write, RUN_METRIC_OUTPUTS))
    return agg.run_metrics(spark, counts, RUN_AT)


def q_text_tokens(spark, d):
    return cl.token_stats(table(spark, d, "documents"), "text")


QUERIES: dict[str, Query] = {
    "yoy_growth": q_yoy_growth,
    "category_sum": q_category_sum,
    "category_year": q_category_year,
    "category_month": q_category_month,
    "category_year_month": q_category_year_month,
    "category_mean": q_category_mean,
    "top10_categories": q_top10_categories,
    "tag_stats": q_tag_stats,
    "tag_month_trend": q_tag_month_trend,
    "category_compare": q_category_compare,
    "productivity": q_productivity,
    "long_report": q_long_report,
    "top8_growth": q_top8_growth,
    "growth_filtered": q_growth_filtered,
    "totals_filtered": q_totals_filtered,
    "tags_filtered": q_tags_filtered,
    "filter_domains": q_filter_domains,
    "growth_pivot": q_growth_pivot,
    "growth_anomalies": q_growth_anomalies,
    "price_quantiles": q_price_quantiles,
    "leader": q_leader,
    "top10_tags": q_top10_tags,
    "features": q_features,
    "quality_report": q_quality_report,
    "text_build": q_text_build,
    "flatten_items": q_flatten_items,
    "dedupe_first": q_dedupe_first,
    "top_n_per_year": q_top_n_per_year,
    "incremental_slice": q_incremental_slice,
    "backfill_slice": q_backfill_slice,
    "enrich_tags": q_enrich_tags,
    "upsert": q_upsert,
    "upsert_stats": q_upsert_stats,
    "keyed_upsert": q_keyed_upsert,
    "maintained_totals": q_maintained_totals,
    "schema_drift": q_schema_drift,
    "forecast": q_forecast,
    "forecast_band": q_forecast_band,
    "holdout_linear": q_holdout_linear,
    "model_selection": q_model_selection,
    "selection_summary": q_selection_summary,
    "edges": q_edges,
    "degree_centrality": q_degree_centrality,
    "graph_metrics": q_graph_metrics,
    "text_tokens": q_text_tokens,
    "text_clusters": q_text_clusters,
    "embedding_clusters": q_embedding_clusters,
    "run_metrics": q_run_metrics,
}
