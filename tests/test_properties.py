"""Property tests: operators against plain-Python references on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trendlake import REFERENCE_ROLES as R
from trendlake.operators import aggregate as agg
from trendlake.operators import ingest as ing
from trendlake.operators import prepare as prep
from trendlake.operators.window import yoy_growth
from trendlake.sources.io import ITEM_SCHEMA
from trendlake.sources.upsert import upsert

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

series = st.dictionaries(
    st.sampled_from(["Go", "Rust", "C"]),
    st.dictionaries(st.integers(2015, 2024), st.integers(0, 50), min_size=1, max_size=6),
    min_size=1, max_size=3)


def growth_reference(counts):
    out = {}
    for lang, by_year in counts.items():
        prev = None
        for y in sorted(by_year):
            n = by_year[y]
            g = None
            if prev is not None and prev != 0:
                g = float((Decimal(n - prev) * 100 / Decimal(prev)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            out[(lang, y)] = (n, prev, g)
            prev = n
    return out


@SETTINGS
@given(series)
def test_growth_matches_reference(spark, counts):
    rows = [(lang, y, n) for lang, by_year in counts.items() for y, n in by_year.items()]
    df = spark.createDataFrame(rows, "language string, year int, repo_count long")
    got = {(r.language, r.year): (r.repo_count, r.prev_count, r.growth_rate_pct)
           for r in yoy_growth(df, "language").collect()}
    assert got == growth_reference(counts)


items_st = st.lists(
    st.tuples(st.integers(1, 30),                                      # id (repeats allowed)
              st.sampled_from(["Go", "Rust", None]),                    # category
              st.integers(0, 1000),                                     # measure
              st.sampled_from(["2022-01-05T00:00:00Z", "2023-07-01T12:00:00Z", "bad"]),
              st.integers(0, 5),                                        # update day
              st.one_of(st.none(), st.lists(st.sampled_from(["ai", "web", "db"]), max_size=4))),
    min_size=1, max_size=25)


def to_items(spark, rows):
    return spark.createDataFrame(
        [(i, f"n{i}", None, c, m, 1, 0, t, f"2024-01-0{1 + d}T00:00:00Z", None, tags, None)
         for i, c, m, t, d, tags in rows], ITEM_SCHEMA)


@SETTINGS
@given(items_st)
def test_tag_stats_and_group_sums(spark, rows):
    df = to_items(spark, rows)
    base = prep.base_table(df, R)
    expected = {}
    for _, c, m, _, _, tags in rows:
        if c is None:
            continue
        for t in tags or []:
            n, s = expected.get(t, (0, 0))
            expected[t] = (n + 1, s + m)
    got = {r.topic: (r.repo_count, r.total_stars) for r in agg.tag_stats(base, R).collect()}
    assert got == expected
    total = sum(m for _, c, m, _, _, _ in rows if c is not None)
    for keys in (["language"], ["language", "year"], ["year", "month", "language"]):
        assert sum(r.total_stars for r in agg.count_and_sum(base, keys, "stars").collect()) == total


@SETTINGS
@given(items_st)
def test_dedupe_first_and_upsert_match_reference(spark, rows):
    df = to_items(spark, rows)
    # dedupe: per id the smallest (updated_at, then the other columns in order)
    full = [(i, f"n{i}", None, c, m, 1, 0, t, f"2024-01-0{1 + d}T00:00:00Z", None, tags, None)
            for i, c, m, t, d, tags in rows]

    def order_key(r):
        rest = [r[0]] + list(r[1:7]) + list(r[8:])
        return (r[8], [(v is not None, v) for v in rest[1:]])
    first = {}
    for r in full:
        if r[0] not in first or order_key(r) < order_key(first[r[0]]):
            first[r[0]] = r
    got = {r.id: r.updated_at for r in ing.dedupe_first(df, "id", ["updated_at"]).collect()}
    assert got == {k: v[8] for k, v in first.items()}
    # upsert of the rows into an empty-ish target keeps one row per id: the latest update
    target = to_items(spark, [(99, "Go", 1, "2022-01-05T00:00:00Z", 0, None)])
    out = {r.id: r.updated_at for r in upsert(target, df, "id", "updated_at", "2024-02-01 00:00:00").collect()}
    latest = {}
    for r in full:
        latest[r[0]] = max(latest.get(r[0], r[8]), r[8])
    assert out == {**latest, 99: "2024-01-01T00:00:00Z"}
