"""The pipeline stage by stage against plain Python versions."""

import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import ROOT, SMALL
from llm_helpers import docs, saved
from test_llm_rules_rollup_mixing import water
from test_llm_simhash import brute_components, brute_fingerprint
from test_llm_suffix import brute
from trendlake.llm import bpe, suffix, toxicity


def step(spark, tmp_path, k, frame, sf_dir):
    name, stage = P.STAGES[k]
    out = str(tmp_path / f"{k}-{name}")
    stage(spark, frame, sf_dir).write.parquet(out)
    return spark.read.parquet(out)


def test_stages_on_driver_tables(spark, tmp_path):
    from tokenizers import Tokenizer
    start = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in start.collect()}

    clean = step(spark, tmp_path, 0, start, SMALL)
    model = toxicity.fit(start, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert {r.doc_id for r in clean.collect()} == {i for i, r in rows.items() if model.score(r.text) < toxicity.THRESHOLD}

    single = step(spark, tmp_path, 1, clean, SMALL)
    left = sorted((r.doc_id, r.text) for r in clean.collect())
    comp = brute_components([brute_fingerprint(t) for _, t in left])
    assert sorted(r.doc_id for r in single.collect()) == sorted({left[c][0] for c in comp})

    cut = step(spark, tmp_path, 2, single, SMALL)
    texts = {r.doc_id: r.text for r in single.collect()}
    data, runs = brute(list(texts.values()))
    expected = {i: suffix.kept_bytes(x, suffix.whole_characters(x, r)).decode() for i, x, r in zip(texts, data, runs)}
    assert {r.doc_id: r.text for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    mixed = step(spark, tmp_path, 3, cut, SMALL)
    sizes, taken, n = Counter(), Counter(), Counter(r.doc_id for r in mixed.collect())
    for r in cut.collect():
        sizes[r.source] += len(r.text.split())
        taken[r.source] += len(r.text.split()) * n[r.doc_id]
    assert max(n.values()) <= 3
    for s, t in water(sizes).items():
        biggest = max(len(r.text.split()) for r in cut.collect() if r.source == s)
        assert abs(taken[s] - t) <= max(3 * biggest, 0.3 * t)

    final = step(spark, tmp_path, 4, mixed, SMALL)
    library = Tokenizer.from_file(bpe.vocabulary_path())
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in cut.collect()}
    got = final.collect()
    assert len(got) == sum(n.values()) and all(r.round_trip and list(r.ids) == ids[r.doc_id] for r in got)
    for frame in (clean, single, cut, mixed):
        assert frame.columns == start.columns


def test_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    text = " ".join(f"word{k * 7919 % 1000} of" for k in range(120))
    rows = docs(spark, [None, "", text, text, text + "more", "x" * 40_000, None], ids=[1, 2, 3, 3, None, 5, None],
                sources=[None, "a", "a", "a", "b", "b", None], extra=True)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = P.run(spark, saved(tmp_path / "some", documents=rows, labels=labels)).collect()
    assert out and all(r.round_trip for r in out)
    none = P.run(spark, saved(tmp_path / "none", documents=rows.limit(0), labels=labels))
    assert none.count() == 0 and "ids" in none.columns


def test_rest_works_without_the_subpackage(tmp_path):
    """A copy of the repository without it imports, and lists the other queries."""
    import shutil
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as E; print(len(E.queries()), 'pipeline' in E.queries(), len(E.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=env, timeout=120)
    assert done.returncode == 0, done.stderr
    n, has, m = done.stdout.split()
    assert int(n) >= 44 and has == "False" and int(m) >= 40


def test_stages_and_oracle():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "repeats", "mixing", "bpe"]
    assert P.ORACLE_SQL is None
