"""Quality of documents from a linear-chain CRF over their lines.

Every line of a text is labelled good or bad by a two-state conditional random
field.  A line's features are ratios of its own text plus those of the lines
before and after it; the transition scores tie neighbouring labels together.
Forward-backward marginals P(good) of the lines, weighted by line length, give
the document's score.

Training: the lines of a document labelled quality 1 (0) are good (bad)
examples; conditional log-likelihood with an L2 term, maximised in numpy by
Adam.  Only documents that are there, labelled and whose crc32(doc_id) mod 5 is not 0
are learned from; equal texts count once (good only if every label says so).  Of
those a bounded sample is taken: ``n_documents`` of each label by the hash of the
text, and of them as many as have ``n_lines`` lines together (sequences longer
than ``run_lines`` are learned as several).  Line features are computed on the
executors; the driver gets at most 2 x n_lines of them.

Long texts: features are made and scored ``LINES_AT_ONCE`` lines at a time, so a
text costs its lines and two numbers a line; chains of many lines are cut into
blocks whose transfer matrices are taken together (``crf.long_marginals``).

Defined cases: null and empty texts have no lines and score 0; blank lines are
lines of length 0 (no weight, but they pass the chain on); a training set
with one label only, or none, gives 0.5 for every text with lines; repeated
rows get equal scores; several labels of a document or text: the lowest counts;
an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import crc_remainder, discard, ship_code, spread, table, written
from trendlake.llm.crf import long_marginals, marginals, train
from trendlake.llm.rules import STOP_WORDS

MODULUS = 5
THRESHOLD = 0.3
N_DOCUMENTS, N_LINES, RUN_LINES = 2500, 100_000, 64
LINES_AT_ONCE = 20_000
LONG_CHAIN = 4096
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
_STOPS = frozenset(w.encode() for w in STOP_WORDS)
N_OWN = 12
N_NEXT = 7  # the first of a line's own features, also taken from its neighbours
N_FEATURES = N_OWN + 2 * N_NEXT + 3


def own_features(lines: list[str], seen: set) -> tuple[list, list]:
    """(features, lengths in code points) of each line by itself; ``seen`` holds
    the lines of the text before them and is added to."""
    own, lengths = [], []
    for line in lines:
        b = line.encode("utf-8", "surrogatepass")
        n, words = len(b), b.split()
        k = len(words)
        size, count = max(1, n), max(1, k)
        own.append((
            (n - len(b.translate(None, _SYMBOLS))) / count if n else 0.0,
            (n - len(b.translate(None, _UPPER))) / size,
            (n - len(b.translate(None, _MARKS))) / count,
            len(set(words)) / count if k else 1.0,
            sum(map(eq, words, words[1:])) / count,
            sum(map(_STOPS.__contains__, b.lower().split())) / count,
            min(n / count, 30.0) / 10.0,
            (n - len(b.translate(None, _DIGITS))) / size,
            np.log1p(n) / 8.0,
            1.0 if k < 5 else 0.0,
            1.0 if line in seen else 0.0,
            1.0 if b.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') else 0.0))
        seen.add(line)
        lengths.append(len(line))
    return own, lengths


def _beside(a: np.ndarray, before, after) -> np.ndarray:
    """All features of consecutive lines from their own; ``before`` and ``after``
    are those of the lines around them (None at the ends of the text)."""
    x = np.zeros((len(a), N_FEATURES), np.float32)
    x[:, :N_OWN] = a
    x[1:, N_OWN:N_OWN + N_NEXT] = a[:-1, :N_NEXT]
    x[:-1, N_OWN + N_NEXT:N_OWN + 2 * N_NEXT] = a[1:, :N_NEXT]
    if before is None:
        x[0, -3] = 1.0
    else:
        x[0, N_OWN:N_OWN + N_NEXT] = before[:N_NEXT]
    if after is None:
        x[-1, -2] = 1.0
    else:
        x[-1, N_OWN + N_NEXT:N_OWN + 2 * N_NEXT] = after[:N_NEXT]
    x[:, -1] = 1.0
    return np.minimum(x, 5.0)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths in code points) of the ``\\n``-split lines."""
    if not text:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0)
    own, lengths = own_features(text.split("\n"), set())
    return _beside(np.array(own, np.float32), None, None), np.array(lengths, np.float64)


def line_states(text: str | None, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores of the two labels, lengths) per line, features only of
    ``LINES_AT_ONCE`` lines at a time."""
    lines = text.split("\n") if text else []
    if len(lines) <= LINES_AT_ONCE:
        x, lengths = line_features(text)
        return x.astype(np.float64) @ weights, lengths
    seen, states, sizes = set(), [], []
    before, now = None, own_features(lines[:LINES_AT_ONCE], seen)
    for at in range(LINES_AT_ONCE, len(lines) + LINES_AT_ONCE, LINES_AT_ONCE):
        coming = own_features(lines[at:at + LINES_AT_ONCE], seen)
        x = _beside(np.array(now[0], np.float32), before, np.array(coming[0][0], np.float32) if coming[0] else None)
        states.append(x.astype(np.float64) @ weights)
        sizes.append(np.array(now[1], np.float64))
        if not coming[0]:
            break
        before, now = np.array(now[0][-1], np.float32), coming
    return np.concatenate(states), np.concatenate(sizes)


def document_scores(texts, weights: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Length-weighted mean of P(good) over the lines of each text."""
    found = [line_states(t, weights) for t in texts]
    out = np.zeros(len(found))
    mean = lambda size, good: np.round(np.clip(np.where(size > 0, good / np.maximum(size, 1e-12), 0.0), 0.0, 1.0), 9)
    for i, (state, lengths) in enumerate(found):
        if len(state) > LONG_CHAIN:
            good = long_marginals(state, trans)[:, 1]
            out[i] = mean(lengths.sum(), (lengths * good).sum())
    short = [i for i, (state, _) in enumerate(found) if 0 < len(state) <= LONG_CHAIN]
    if not short:
        return out
    starts = np.concatenate([[0], np.cumsum([len(found[i][1]) for i in short])]).astype(np.int64)
    lengths = np.concatenate([found[i][1] for i in short])
    _, node, _ = marginals(np.concatenate([found[i][0] for i in short]), starts, trans)
    # Sums per text (not differences of running sums), so that equal texts score alike.
    out[short] = mean(np.add.reduceat(lengths, starts[:-1]), np.add.reduceat(lengths * node[:, 1], starts[:-1]))
    return out


def fit(docs: DataFrame, labels: DataFrame, n_documents: int = N_DOCUMENTS, n_lines: int = N_LINES) -> tuple[np.ndarray, np.ndarray]:
    """CRF parameters from the learnable rows of ``docs`` (doc_id, text) and
    ``labels`` (doc_id, quality)."""
    spark = docs.sparkSession
    ship_code(spark)
    known = (labels.where((crc_remainder("doc_id", MODULUS) != 0) & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("y")))
    # joined before the sample is taken, so that labels of absent documents do not use it up
    lines_of = F.size(F.split("text", "\n", -1))
    texts = (docs.where("text <> ''").select("doc_id", F.xxhash64("text").alias("t"), lines_of.alias("n")).join(known, "doc_id")
             .groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.min("y").alias("y"), F.max("n").alias("n")))
    texts = written(texts, "quality-texts")
    chosen = []
    for y in (0, 1):
        room = n_lines
        part = texts.where(F.col("y") == y).orderBy(F.xxhash64("t", F.lit(23)), "t").limit(n_documents)
        for r in part.collect():
            if r["n"] <= room:
                room -= r["n"]
                chosen.append((r["t"], r["doc_id"], y))
    discard(texts)
    if len({y for _, _, y in chosen}) < 2:
        return np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    ids = spark.createDataFrame(sorted(chosen), "t long, doc_id long, y int")

    def lines(batches):
        from trendlake.llm import quality
        for pdf in batches:
            x = [quality.line_features(t)[0] for t in pdf["text"]]
            yield pd.DataFrame({"t": pdf["t"], "y": pdf["y"], "x": [a.ravel().tolist() for a in x]})

    sample = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.xxhash64("text") == F.col("t"))
              .dropDuplicates(["t"]))
    rows = sample.mapInPandas(lines, "t long, y int, x array<float>").collect()
    rows.sort(key=lambda r: r["t"])
    chains = [(np.array(r["x"], np.float32).reshape(-1, N_FEATURES), r["y"]) for r in rows]
    return train(chains, run_items=RUN_LINES)


def score(docs: DataFrame, model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the quality score of ``text_col``."""
    ship_code(docs.sparkSession)
    weights, trans = model

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        from trendlake.llm import quality
        parts = [quality.document_scores(texts.iloc[k:k + 1000], weights, trans) for k in range(0, len(texts), 1000)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out_col, run(F.col(text_col)))


def op1_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels)
    held_out = F.coalesce(crc_remainder("doc_id", MODULUS) == 0, F.lit(False))
    return (score(spread(docs.select("doc_id", "text")), model)
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
