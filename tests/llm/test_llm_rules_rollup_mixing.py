"""Quality rules, token rollups and source mixing on awkward rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_helpers import docs, plain
from trendlake.llm import mixing, rollup, rules

WORDS = "the of and a to in lantern meadow copper bridge winter harbour silent orchard engine paper".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) if rng.random() < .7 else rng.choice(WORDS[:6])
                    for _ in range(n))


def brute_rules(text):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(wins)
    covered = {i + k for i, w in enumerate(wins) if many[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rule_measures_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "a b a b a b a b", "x y z x y z\nx y z\n\nx y z", "### $$ || <a>", "é ñ 日本\r\nb",
             "a a a a", prose(rng, 400), prose(rng, 60) * 2, "w " * 30000, "l\n" * 500]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    df = docs(spark, texts + texts[9:10], extra=True)
    out = rules.apply_rules(df)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()}
    assert got == {i: brute_rules(t) for i, t in enumerate(texts + texts[9:10])}
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert kept[9] and kept[len(texts)] and not kept[0] and not kept[1] and not kept[11]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
    assert rules.apply_rules(df.limit(0)).count() == 0
    assert all(r.kept == (not r.base_failed) for r in rules.apply_rules(df, {}).collect())


def test_rollup_signed_changes_and_idempotence(spark, tmp_path):
    schema = "doc_id long, source string, lang string, tokenizer string, op string, n_tokens long, extra string"
    r = rollup.TokenRollup(spark, str(tmp_path / "r"))
    change = lambda *rows: spark.createDataFrame([x + ("x",) for x in rows], schema)
    assert r.totals().count() == 0
    first = change((1, "a", "en", "t", "insert", 10), (2, "a", None, "t", "insert", 5), (None, None, "en", "t", "insert", 7),
                   (3, "b", "en", "t", "insert", None), (1, "a", "en", "t", "insert", 10))
    assert r.commit("one", first) and not r.commit("one", first)
    total = lambda: plain(r.totals().collect())
    assert total() == plain([("a", "en", "t", 1, 10), ("a", None, "t", 1, 5), (None, "en", "t", 1, 7), ("b", "en", "t", 1, 0)])
    second = change((1, "a", "en", "t", "revise", 12), (2, "b", "en", "t", "revise", 6), (None, None, None, "t", "delete", 0),
                    (9, "z", "en", "t", "delete", 0), (4, "b", "en", "u", "insert", 3))
    assert r.commit("two", second)
    expected = plain([("a", "en", "t", 1, 12), ("b", "en", "t", 2, 6), ("b", "en", "u", 1, 3)])
    assert total() == expected
    assert not r.commit("two", second) and not r.commit("one", first)
    assert r.commit("nothing", change().limit(0)) and total() == expected
    # a torn attempt (no _SUCCESS) is neither read nor in the way
    (tmp_path / "r" / "log" / "v-000000000002").mkdir()
    assert total() == expected and r.commit("2026/03 = three", change((4, "b", "en", "u", "delete", 0)))
    assert total() == plain([("a", "en", "t", 1, 12), ("b", "en", "t", 2, 6)])
    assert not r.commit("2026/03 = three", second) and r.batches() == ["one", "two", "2026/03 = three"]
    # totals always equal a recount of the state
    state = r.state().groupBy("source", "lang", "tokenizer").agg(F.count("*"), F.sum("n_tokens"))
    assert plain(state.collect()) == total()


def test_a_commit_reads_and_writes_the_files_of_its_keys(spark, tmp_path):
    r = rollup.TokenRollup(spark, str(tmp_path / "r"), file_rows=50, filter_bits=1 << 18)
    load = spark.range(2000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'en' AS lang", "'t' AS tokenizer",
                                        "'insert' AS op", "id % 11 AS n_tokens")
    r.commit("load", load)
    before = {f.file for f in r.table.files().collect()}
    r.commit("some", load.where("doc_id BETWEEN 500 AND 510").selectExpr("doc_id", "'moved' AS source", "lang", "tokenizer",
                                                                       "'revise' AS op", "100 AS n_tokens"))
    after = {f.file for f in r.table.files().collect()}
    assert len(before) >= 40 and len(before - after) <= 2
    state = r.state().groupBy("source", "lang", "tokenizer").agg(F.count("*"), F.sum("n_tokens"))
    assert plain(state.collect()) == plain(r.totals().collect())
    assert ("moved", "en", "t", 11, 1100) in plain(r.totals().collect())


def water(sizes, weights=(1, 2, 3), cap=3):
    """Targets by repeated resharing, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > cap * sizes[s]}
        if not over:
            target |= {s: w[s] * level for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("n", [0, 1, 400])
def test_mixing(spark, n):
    rng = random.Random(n)
    texts = [prose(rng, rng.choice([1, 5, 40, 200])) if rng.random() < .95 else None for _ in range(n)]
    texts = texts[:-1] + ["w " * 20000] if n > 1 else texts
    sources = [rng.choice([None, "", "a", "a", "a", "b", "c", "Z"]) for _ in range(n)]
    ids = [rng.randint(0, n) if rng.random() < .9 else None for _ in range(n)]  # repeated and null ids
    df = docs(spark, texts, ids, sources, extra=True)
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == n and plain(plan) == plain(mixing.mix_plan(df.repartition(5)).collect())
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    expected = water(sizes)
    taken, rows = Counter(), Counter()
    for r in plan:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        rows[r.source] += 1
    for s in sizes:
        biggest = max(len((t or "").split()) for t, x in zip(texts, sources) if x == s)
        assert abs(taken[s] - expected[s]) <= max(3 * biggest, 0.35 * expected[s])
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    got = Counter(map(repr, mixed.select("text", "source").collect()))
    assert sum(got.values()) == sum(r.copies for r in plan)
    words = sum(len((r.text or "").split()) for r in mixed.select("text").collect())
    assert words == sum(taken.values()) or len(set(ids)) < n  # equal up to which of the rows of one id is drawn


def test_mixing_equal_rows_and_caps(spark):
    df = docs(spark, ["a b c"] * 30 + ["d e"], ids=[1] * 30 + [2], sources=["x"] * 30 + ["y"])
    plan = mixing.mix_plan(df).collect()
    assert {r.source: round(r.target, 6) for r in plan} == {"x": 86.0, "y": 6.0}
    assert mixing.mix(df).where("source = 'y'").count() == 3
