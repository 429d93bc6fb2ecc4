"""Training-data pipeline over ``documents``: an ordered list of stages, each
reading the Parquet output of the one before.

Every stage but the last returns the columns of ``documents``; each works on
all rows its predecessor kept, and its decision is final.
"""

from __future__ import annotations

from trendlake.llm.bpe import encode_documents
from trendlake.llm.common import scratch_path, spread, table
from trendlake.llm.mixing import mix
from trendlake.llm.simhash import keep_one
from trendlake.llm.suffix import remove_repeats
from trendlake.llm.toxicity import keep_clean


def drop_toxic(spark, docs, sf_dir):
    """Toxicity: documents at or above the threshold go."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark, docs, sf_dir):
    """SimHash near-dedup: one document of each group stays, that of the
    smallest doc_id."""
    return keep_one(docs)


def drop_repeats(spark, docs, sf_dir):
    """Suffix-array dedup: bytes of repeated 200-byte strings are cut out of
    the texts (whole characters only); n_chars follows."""
    return remove_repeats(docs)


def mix_sources(spark, docs, sf_dir):
    """Mixing sources to target weights: documents as often as drawn."""
    return mix(docs)


def encode(spark, docs, sf_dir):
    """BPE encoding, decoded again as a check: n_tokens, ids, round_trip in
    place of the text."""
    return encode_documents(spread(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("repeats", drop_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Training, byte-string search and tokenization have no SQL form; tests/llm
# compares every stage with a plain Python version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; every stage's result is written to
    the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
