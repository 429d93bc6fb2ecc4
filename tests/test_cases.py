"""Hand-made cases (FIXTURES.md section 4) on item-shaped frames."""

from datetime import datetime

from pyspark.sql import functions as F

from trendlake import REFERENCE_ROLES as R
from trendlake.operators import aggregate as agg
from trendlake.operators import forecast as fc
from trendlake.operators import graph as gr
from trendlake.operators import ingest as ing
from trendlake.operators import prepare as prep
from trendlake.operators.features import features
from trendlake.operators.quality import quality_report
from trendlake.operators.window import yoy_growth
from trendlake.sources.io import ITEM_SCHEMA
from trendlake.sources.upsert import upsert, upsert_stats


def item(i, lang="Python", stars=10, forks=1, created="2022-03-01T10:00:00Z", updated="2024-01-01T00:00:00Z",
         topics=(), open_issues=0, name=None):
    return (i, name or f"r{i}", f"o/r{i}", lang, stars, forks, open_issues, created, updated, None,
            list(topics) if topics is not None else None, None)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def yearly_of(spark, counts, lang="X"):
    rows = [(lang, y, c) for y, c in counts.items()]
    return spark.createDataFrame(rows, "language string, year int, repo_count long")


def test_forecast_exact_trend(spark):
    out = fc.forecast(yearly_of(spark, {2022: 1, 2023: 1, 2024: 3}, "MDX"), "language", years=(2025, 2026))
    got = {r.year: r.predicted_repo_count for r in out.collect()}
    assert got == {2025: 3.67, 2026: 4.67}


def test_growth_gap_year_counts_as_previous(spark):
    g = yoy_growth(yearly_of(spark, {2022: 5, 2024: 1}, "Lua"), "language").orderBy("year").collect()
    assert [(r.year, r.prev_count, r.growth_rate_pct) for r in g] == [(2022, None, None), (2024, 5, -80.0)]


def test_growth_consecutive_option(spark):
    g = yoy_growth(yearly_of(spark, {2022: 5, 2024: 1}), "language", require_consecutive=True)
    assert [r.prev_count for r in g.orderBy("year").collect()] == [None, None]


def test_growth_and_negative_forecast(spark):
    y = yearly_of(spark, {2022: 14, 2023: 4, 2024: 3}, "C++")
    g = [r.growth_rate_pct for r in yoy_growth(y, "language").orderBy("year").collect()]
    assert g == [None, -71.43, -25.0]
    f = {r.year: r.predicted_repo_count for r in fc.forecast(y, "language", years=(2025, 2026)).collect()}
    assert f == {2025: -4.0, 2026: -9.5}


def test_forecast_needs_three_points(spark):
    assert fc.forecast(yearly_of(spark, {2023: 1, 2024: 2}), "language").count() == 0


def test_null_category_absent_from_aggregates_unknown_in_graph(spark):
    df = items(spark, [item(1, lang=None), item(2, lang="Go"), item(3, lang="")])
    base = prep.base_table(df, R)
    assert {r.language for r in agg.category_year(base, R).collect()} == {"Go", ""}
    assert {r.language for r in agg.category_sum(df, R).collect()} == {"Go", ""}
    nodes = {r.dst if r.dst.startswith("repo") is False else r.src for r in gr.build_edges(df, R).collect()}
    assert "lang:Unknown" in nodes and "lang:Go" in nodes


def test_tags_null_empty_and_repeated(spark):
    df = items(spark, [item(1, topics=None), item(2, topics=()), item(3, topics=("ai", "ai"), stars=7)])
    base = prep.base_table(df, R)
    stats = agg.tag_stats(base, R).collect()
    assert [(r.topic, r.repo_count, r.total_stars) for r in stats] == [("ai", 2, 14)]
    edges = gr.build_edges(df, R).where(F.col("edge_type") == "repo-topic").collect()
    assert len(edges) == 1


def test_bad_created_at_gives_null_year(spark):
    base = prep.base_table(items(spark, [item(1, created="not a date"), item(2)]), R)
    assert sorted((r.id, r.year) for r in base.collect()) == [(1, None), (2, 2022)]


def test_features_zero_measure_and_young_item(spark):
    df = items(spark, [item(1, stars=0, forks=5, created="2024-05-31T23:30:00Z"),
                       item(2, stars=10, forks=4, created="2024-01-01T00:00:00Z")])
    out = {r.id: r for r in features(prep.base_table(df, R), R, as_of="2024-06-01 00:30:00").collect()}
    assert out[1].fork_star_ratio == 5.0
    assert out[1].repo_age_days == 1
    assert out[1].stars_per_day == 0.0
    assert out[2].repo_age_days == 152
    assert out[2].stars_per_day == round(10 / 152, 4)
    assert out[2].fork_star_ratio == 0.4
    assert out[1].repo_age_norm == 0.0 and out[2].repo_age_norm == 1.0


def test_features_half_even_rounding(spark):
    # 100.05 / 1000 = 0.10005 exactly: half-to-even gives 0.1000
    df = spark.createDataFrame([("a", 100.05, 1.0, datetime(2020, 1, 1))],
                               "c string, m double, m2 double, t timestamp_ntz")
    roles = R.with_(category="c", measure="m", measure2="m2", event_time="t")
    out = features(prep.base_table(df, roles), roles, as_of="2022-09-27 00:00:00").first()
    assert out.repo_age_days == 1000
    assert out.stars_per_day == 0.1


def test_dedupe_and_upsert_latest_wins_null_key_skipped(spark):
    target = items(spark, [item(1, stars=1), item(2, stars=2)])
    batch = items(spark, [item(1, stars=10, updated="2024-02-01T00:00:00Z"),
                          item(1, stars=99, updated="2024-01-15T00:00:00Z"),
                          item(None, stars=5), item(3, stars=3)])
    out = {r.id: r for r in upsert(target, batch, "id", "updated_at", "2024-03-01 00:00:00").collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].stars == 10 and out[1].ingested_at == datetime(2024, 3, 1)
    assert out[2].stars == 2 and out[2].ingested_at is None
    stats = upsert_stats(target, batch, "id", "updated_at").first()
    assert (stats.matched_count, stats.modified_count, stats.upserted_count, stats.skipped_count) == (1, 1, 1, 1)


def test_upsert_keeps_columns_absent_from_batch(spark):
    target = items(spark, [item(1, stars=1)])
    batch = spark.createDataFrame([(1, 50, "2024-05-01T00:00:00Z")], "id long, stars long, updated_at string")
    r = upsert(target, batch, "id", "updated_at", "2024-06-01 00:00:00").first()
    assert r.stars == 50 and r.name == "r1" and r.language == "Python"


def test_upsert_twice_equals_once(spark):
    target = items(spark, [item(i, stars=i) for i in range(5)])
    batch = items(spark, [item(i, stars=100 + i, updated="2024-02-01T00:00:00Z") for i in range(3, 8)])
    once = upsert(target, batch, "id", "updated_at", "2024-03-01 00:00:00")
    twice = upsert(once, batch, "id", "updated_at", "2024-04-01 00:00:00")
    strip = lambda df: sorted(tuple(r) for r in df.drop("ingested_at").collect())
    assert strip(once) == strip(twice)


def test_incremental_slice_day_granularity_and_strict_minimum(spark):
    df = items(spark, [item(1, updated="2024-03-10T01:00:00Z", stars=51),
                       item(2, updated="2024-03-09T23:59:59Z", stars=51),
                       item(3, updated="2024-03-10T08:00:00Z", stars=50)])
    got = ing.incremental_slice(df, R, mark="2024-03-10T12:00:00Z", min_measure=50).collect()
    assert [r.id for r in got] == [1]
    ge = prep.at_least(df, "stars", 50).count()
    assert ge == 3


def test_backfill_slice_inclusive_years(spark):
    df = items(spark, [item(1, created="2021-12-31T23:59:59Z"), item(2, created="2022-01-01T00:00:00Z"),
                       item(3, created="2023-12-31T23:59:59Z"), item(4, created="2024-01-01T00:00:00Z")])
    assert sorted(r.id for r in ing.backfill_slice(df, R, 2022, 2023).collect()) == [2, 3]


def test_top_n_per_year_ties_by_key(spark):
    df = items(spark, [item(i, stars=s, created=f"{y}-05-01T00:00:00Z")
                       for i, (y, s) in enumerate([(2022, 5), (2022, 9), (2022, 9), (2023, 1)])])
    got = sorted((r.year, r.id) for r in ing.top_n_per_year(df, R, 2).collect())
    assert got == [(2022, 1), (2022, 2), (2023, 3)]


def test_constant_series_selects_linear(spark):
    y = yearly_of(spark, {2021: 4, 2022: 4, 2023: 4, 2024: 4})
    r = fc.model_selection(y, "language", min_points=4).first()
    assert (r.linear_mae, r.linear_rmse, r.arima_mae, r.arima_rmse) == (0.0, 0.0, 0.0, 0.0)
    assert r.selected_model == "LinearTrend"


def test_arima_css_follows_a_straight_increase():
    import numpy as np
    nxt = fc.arima111_next(np.array([1.0, 2.0, 3.0, 4.0, 5.0]))
    assert abs(nxt - 6.0) < 0.05
    assert fc.arima111_next(np.array([1.0, 2.0])) is None


def test_empty_filter_lists_do_not_filter(spark):
    df = items(spark, [item(1), item(2, lang="Go")])
    assert prep.keep_in(df, "language", []).count() == 2
    assert prep.filter_tags(df, (), "language").count() == 2


def test_quality_report_duplicates_nulls_and_drift(spark):
    df = items(spark, [item(1), item(1), item(None), item(None, lang=None)])
    r = quality_report(df, expected={"id", "language", "stars", "url"}, key="id", category="language").first()
    assert r.row_count == 4
    assert r.duplicate_repo_ids == 2
    assert r.null_language_pct == 25.0
    assert r.schema_missing_columns == ["url"]
    assert "topics" in r.schema_extra_columns and "id" not in r.schema_extra_columns
    absent = quality_report(df.drop("id", "language"), key="id", category="language").first()
    assert absent.duplicate_repo_ids is None and absent.null_language_pct is None


def test_productivity_scores(spark):
    df = items(spark, [item(1, stars=10, forks=2, open_issues=1), item(2, stars=20, forks=4, open_issues=3)])
    r = agg.productivity(prep.base_table(df, R), R).first()
    assert (r.repo_count, r.total_stars, r.total_forks, r.total_open_issues) == (2, 30, 6, 4)
    assert r.productivity_score == 15.0 and r.activity_proxy_score == 23.0


def test_long_report_keeps_duplicates(spark):
    df = items(spark, [item(1, stars=600, topics=("ai",)), item(2, stars=600, topics=("ai",))])
    rep = agg.long_report(prep.base_table(df, R), R)
    assert rep.where("metric = 'stars_ge_500'").count() == 2
    assert rep.where("metric = 'topic_trend'").first().repo_count == 2


def test_band_and_anomalies(spark):
    fcst = spark.createDataFrame([("a", 2025, 12.35), ("b", 2025, 0.05)],
                                 "language string, year int, predicted_repo_count double")
    got = {r.language: (r.lower_ci, r.upper_ci) for r in fc.forecast_band(fcst).collect()}
    assert got == {"a": (11.12, 13.58), "b": (0.04, 0.06)}
    growth = spark.createDataFrame([("x", 2000 + i, float(i)) for i in range(11)],
                                   "language string, year int, growth_rate_pct double")
    top = fc.growth_anomalies(growth, "language", q=0.9).collect()
    assert [r.growth_rate_pct for r in top] == [10.0]


def test_sums_over_any_grouping_equal_total(spark):
    df = items(spark, [item(i, lang=["A", "B", "C"][i % 3], stars=i * 7,
                            created=f"{2020 + i % 4}-{1 + i % 12:02d}-01T00:00:00Z") for i in range(40)])
    base = prep.base_table(df, R)
    total = base.agg(F.sum("stars")).first()[0]
    for keys in (["language"], ["language", "year"], ["language", "month"], ["year", "month", "language"]):
        assert agg.count_and_sum(base, keys, "stars").agg(F.sum("total_stars")).first()[0] == total


def test_upsert_broadcast_and_shuffle_plans_agree(spark):
    target = items(spark, [item(i, stars=i) for i in range(20)] + [item(None, stars=-1)])
    batch = items(spark, [item(i, stars=100 + i, updated="2024-02-01T00:00:00Z") for i in range(15, 30)]
                  + [item(16, stars=7, updated="2023-01-01T00:00:00Z"), item(None, stars=5)])
    a = upsert(target, batch, "id", "updated_at", "2024-03-01 00:00:00", broadcast_keys=True)
    b = upsert(target, batch, "id", "updated_at", "2024-03-01 00:00:00", broadcast_keys=False)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert a.count() == 31


def test_with_min_points(spark):
    y = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2), ("a", 2022, 3), ("b", 2021, 5), ("b", 2022, 6)],
                              "language string, year int, repo_count long")
    assert sorted(r.language for r in agg.with_min_points(y, ["language"], 3).collect()) == ["a", "a", "a"]
    assert agg.with_min_points(y, ["language"], 2).count() == 5


def test_empty_inputs_give_typed_empty_results(spark):
    from trendlake.operators import cluster as cl
    empty = items(spark, [])
    base = prep.base_table(empty, R)
    assert fc.forecast(agg.yearly_counts(base, R), "language").count() == 0
    assert quality_report(empty, key="id", category="language").first().row_count == 0
    assert gr.betweenness(gr.build_edges(empty, R)).count() == 0
    out = cl.cluster(spark.createDataFrame([], "id long, e array<float>"), "e")
    assert out.columns == ["id", "cluster_id"] and out.count() == 0


def test_incremental_slice_default_mark_is_yesterday(spark):
    from datetime import timedelta, timezone
    now = datetime.now(timezone.utc)
    iso = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    df = items(spark, [item(1, updated=iso(now - timedelta(hours=2)), stars=60),
                       item(2, updated=iso(now - timedelta(days=3)), stars=60)])
    assert [r.id for r in ing.incremental_slice(df, R, mark=None, min_measure=50).collect()] == [1]


def test_base_table_without_event_time(spark):
    from trendlake.plans.tables import PART
    df = spark.createDataFrame([(1, "Brand#1", 9.5), (2, None, 1.0)], "p_partkey long, p_brand string, p_retailprice double")
    rows = prep.base_table(df, PART).collect()
    assert len(rows) == 1 and rows[0].year is None and rows[0].created_ts is None
