"""Toxicity scores by non-negative positive-unlabelled learning.

Training data are confirmed toxic documents (label toxic = 1) and unlabelled
text; no document is ever taken as a negative.  The classifier is logistic over
binary lexical features (words and word beginnings) and minimises the
class-prior-corrected risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the sigmoid loss, in numpy; when the corrected negative part falls below
zero, the step goes against that part instead (the non-negative rule).
The prior is the toxic share of the labelled training texts, or a parameter.

Learning uses only rows whose crc32(doc_id) mod 4 is not 2, and of equal texts
(by their 64-bit hash) one: the prior, the samples and the document
frequencies all count distinct texts.  Features are the ``n_features`` of the largest
|z| between the positives' document frequencies and those of all learnable
texts.  Positives are a bounded sample of labelled rows (``n_positive``, the texts of
the smallest hash); the features frequent enough among them are the candidates,
and every learnable text is searched for those.  The risk's unlabelled part is a mean, taken
over ``n_unlabelled`` texts (again of the smallest hash).  So the driver gets the
candidates, at most (features of the positives) / (least frequency), and feature numbers of
the two samples; scoring reads every whole text.  A very long text costs memory for its
own distinct words.

Defined cases: null and empty texts have no features and get the score of the
bias alone; without any confirmed toxic document every score is 0, without
any telling feature it is the prior; an
empty table gives an empty result; repeated rows get equal scores; labels of unknown documents, null labels and null ids
are not learned from; several label rows of one document, or of documents with
the same text, count as toxic if any is; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import crc_remainder, discard, ship_code, spread, table, written

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
N_POSITIVE, N_UNLABELLED, N_FEATURES, MIN_Z = 3000, 9000, 2048, 3.0
MIN_POSITIVE, MIN_POSITIVE_SHARE = 4, 0.02
PREFIXES = (4, 5, 6)
_PUNCTUATION = ".,;:!?\"'()[]{}…«»“”‘’`~-_*"


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words without outer punctuation."""
    if not text:
        return set()
    return {w.strip(_PUNCTUATION) for w in set(text.lower().split())}


def features_of(text: str | None) -> set[str]:
    """Words, and their beginnings of 4 to 6 characters marked with ``*``."""
    words = words_of(text)
    out = set(words)
    for n in PREFIXES:
        out |= {w[:n] + "*" for w in words if len(w) > n}
    out.discard("")
    return out


def telling(text: str | None, wanted, starts) -> set[str]:
    """The features of the text that are in ``wanted``; ``starts`` holds the
    first four characters of all of these."""
    seen = set()
    for w in words_of(text):
        if w[:4] in starts:
            seen.add(w)
            for n in PREFIXES:
                if len(w) > n:
                    seen.add(w[:n] + "*")
    return {f for f in seen if f in wanted}


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def step_of(w: np.ndarray, xp: np.ndarray, xu: np.ndarray, prior: float, beta: float = 0.0) -> np.ndarray:
    """Gradient of the corrected risk at ``w``, or, where its negative part is
    below -beta, of minus that part.  Sigmoid loss: l(z, +1) = sigmoid(-z) and
    l(z, -1) = sigmoid(z); both have slope g (1 - g), of opposite sign."""
    gp, gu = _sigmoid(xp @ w.astype(xp.dtype)), _sigmoid(xu @ w.astype(xu.dtype))
    up = (gp * (1 - gp)) @ xp / max(1, len(xp))
    uu = (gu * (1 - gu)) @ xu / max(1, len(xu))
    d_negative = uu - prior * up
    return d_negative - prior * up if gu.mean() - prior * gp.mean() >= -beta else -d_negative


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int, prior: float,
          steps: int = 400, rate: float = 0.1, decay: float = 1e-5, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """(weights, bias) of the non-negative PU classifier; examples are arrays
    of feature numbers.  Sigmoid loss, full-batch Adam."""

    def dense(rows):
        x = np.zeros((len(rows), n_features + 1), np.float32)
        for i, r in enumerate(rows):
            x[i, r] = 1.0
        x[:, n_features] = 1.0
        return x

    xp, xu = dense(positive), dense(unlabelled)
    w = np.zeros(n_features + 1)
    w[-1] = -1.0
    m, s = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = step_of(w, xp, xu, prior, beta) + decay * np.append(w[:-1], 0.0)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


class ToxicityModel:
    """Feature weights and a bias."""

    def __init__(self, weights: dict[str, float], bias: float, prior: float):
        self.weights, self.bias, self.prior = weights, bias, prior
        self.starts = frozenset(f[:4] for f in weights)

    def score(self, text: str | None) -> float:
        if self.prior <= 0:
            return 0.0
        z = self.bias + sum(self.weights[f] for f in sorted(telling(text, self.weights, self.starts)))
        return float(1.0 / (1.0 + np.exp(-min(40.0, max(-40.0, z)))))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, n_positive: int = N_POSITIVE,
        n_unlabelled: int = N_UNLABELLED, n_features: int = N_FEATURES) -> ToxicityModel:
    """Train on the learnable rows of ``docs`` (doc_id, text) and ``labels``
    (doc_id, toxic)."""
    ship_code(docs.sparkSession)
    learnable = crc_remainder("doc_id", MODULUS) != HELD_OUT
    known = (labels.where(learnable & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    # Equal texts are one example, however many rows have them; toxic if any of the rows is.
    texts = written(docs.where(learnable).select("doc_id", F.xxhash64("text").alias("_t")).join(known, "doc_id", "left")
                    .groupBy("_t").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")), "toxicity-texts")
    n_known, n_toxic = texts.agg(F.count("toxic"), F.sum(F.col("toxic").cast("long"))).first()
    if prior is None:
        prior = (n_toxic or 0) / n_known if n_known else 0.0
    if not n_toxic:
        discard(texts)
        return ToxicityModel({}, 0.0, 0.0)
    by_hash = [F.xxhash64("_t", F.lit(17)), F.col("_t")]
    pos = {r[0]: r[1] for r in texts.where("toxic = 1").orderBy(*by_hash).limit(n_positive).collect()}
    unl = {r[0] for r in texts.orderBy(*by_hash).limit(n_unlabelled).collect()}
    n_all, n_pos = texts.count(), len(pos)
    discard(texts)
    # A bounded list of texts, each by one of its rows.
    chosen = docs.sparkSession.createDataFrame(sorted(pos.items()), "_t long, doc_id long")
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .where(F.xxhash64("text") == F.col("_t")).dropDuplicates(["_t"]))

    def count(batches):
        from trendlake.llm import toxicity
        p = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                p.update(toxicity.features_of(text))
        keys = list(p)
        for k in range(0, len(keys), 50_000):
            some = keys[k:k + 50_000]
            yield pd.DataFrame({"f": some, "p": [p[x] for x in some]})

    floor = max(MIN_POSITIVE, MIN_POSITIVE_SHARE * n_pos)
    found = (sample.mapInPandas(count, "f string, p long").groupBy("f").agg(F.sum("p").alias("p"))
             .where(F.col("p") >= floor).orderBy("f").collect())
    candidates, p = {r["f"]: i for i, r in enumerate(found)}, np.array([r["p"] for r in found], float)
    biased = ToxicityModel({}, float(np.log(prior / max(1 - prior, 1e-9))), float(prior))
    if not candidates:
        return biased
    starts = frozenset(f[:4] for f in candidates)

    @F.pandas_udf("array<int>")
    def numbers(column: pd.Series) -> pd.Series:
        from trendlake.llm import toxicity
        return pd.Series([sorted(candidates[f] for f in toxicity.telling(t, candidates, starts)) for t in column],
                         dtype=object)

    # The candidates in every learnable text, one row per text; only numbers are shuffled.
    rows = written(spread(docs.where(learnable).select("text")).select(F.xxhash64("text").alias("_t"), numbers("text").alias("f"))
                   .groupBy("_t").agg(F.first("f").alias("f")), "toxicity-features")
    u = np.zeros(len(candidates))
    for r in rows.select(F.explode("f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("u")).collect():
        u[r["f"]] = r["u"]
    share = (p + u) / (n_pos + n_all)
    z = np.abs(p / n_pos - u / n_all) / np.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_all) + 1e-12)
    names = [r["f"] for r in found]
    kept = sorted(np.flatnonzero(z >= MIN_Z), key=lambda i: (-z[i], names[i]))[:n_features]
    if not kept:
        discard(rows)
        return biased
    number = {int(i): k for k, i in enumerate(kept)}
    wanted = docs.sparkSession.createDataFrame([(t,) for t in sorted(pos.keys() | unl)], "_t long")
    examples = {r["_t"]: np.array(sorted(number[i] for i in r["f"] if i in number), np.int64)
                for r in rows.join(F.broadcast(wanted), "_t").collect()}
    discard(rows)
    w, bias = train([examples[t] for t in sorted(pos)], [examples[t] for t in sorted(unl)], len(number), float(prior))
    return ToxicityModel({names[i]: float(w[k]) for i, k in number.items()}, bias, float(prior))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic."""
    ship_code(docs.sparkSession)
    weights, bias, prior = model.weights, model.bias, model.prior

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        from trendlake.llm import toxicity
        m = toxicity.ToxicityModel(weights, bias, prior)
        return pd.Series([m.score(t) for t in texts], dtype="float64")

    return docs.withColumn(out_col, run(F.col(text_col)))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, columns as given."""
    model = fit(docs, labels)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("_r"), F.col("text").alias("_t"))
    return score(rows, model, "_t", "_s").where(F.col("_s") < threshold).select("_r.*")


def op4_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels)
    held_out = F.coalesce(crc_remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False))
    return (score(spread(docs.select("doc_id", "text")), model)
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
