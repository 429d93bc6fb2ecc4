"""Token counts as delta-maintained rollups.

A rollup is a keyed table (``sources.keyed``) of the current count per (doc_id,
tokenizer), which keeps up totals by (source, lang, tokenizer).  A batch is a
DataFrame of changes

    doc_id, source, lang, tokenizer, op ('insert' | 'delete' | 'revise'),
    n_tokens (insert: the count; revise: the new count; delete: ignored)

``commit`` writes the new state of the changed keys, finds what they counted before
in the files that hold them, and adds the signed deltas (minus the old count in
its old cell, plus the new one in its new cell) to the stored totals; neither
texts nor other keys are counted again.  State, totals and the batch's id become
visible together, in one version.

* Idempotence: committing a batch id that a version holds changes nothing; a
  torn attempt is never read and the next one starts afresh.  Any text is a batch id.
* Within a batch the changes of one (doc_id, tokenizer) collapse to one: the
  largest by (n_tokens, op, source, lang) order, delete winning last.

Rules: an insert of a document that is present counts as a revision; a revise
of an absent one as an insert; a delete of an absent one as nothing (deleted keys
stay in the state as rows that count nothing).  A change of source or language
moves the count.  Nulls in doc_id, source, lang or tokenizer are values of their
own; a null n_tokens is 0.  Empty batches change nothing.  Extra columns are
ignored, whatever their names; texts of any length are counted by the caller.

Scale: state rows are (key, counts) only, sorted by doc_id; a commit aggregates the
changes by key (partial aggregates, a key has few rows) and reads and rewrites
the files that hold one of its keys; totals are small (one row per cell), and a
source with a third of the rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.common import scratch_path, table, word_count
from trendlake.operators.totals import Totals
from trendlake.sources.keyed import KeyedTable

CELL = ("source", "lang", "tokenizer")
CELLS = Totals("cells", {"source": "source", "lang": "lang", "tokenizer": "key.tokenizer"},
               {"n_docs": "CAST(present AS BIGINT)", "n_tokens": "n_tokens"})
# Letters, marks and digits of every script.
PIECE_PATTERN = r"[\p{L}\p{M}\p{N}]+"


class TokenRollup:
    """Totals of documents and tokens per (source, lang, tokenizer)."""

    def __init__(self, spark: SparkSession, path: str, **layout):
        self.table = KeyedTable(spark, path, "key", totals=[CELLS], **layout)
        self.spark = spark

    def batches(self) -> list[str]:
        """Ids of the committed batches in commit order."""
        facts = self.table.facts()
        return list(facts["epochs"]) if facts else []

    def state(self) -> DataFrame | None:
        """Current count per (doc_id, tokenizer)."""
        rows = self.table.read()
        return rows if rows is None else rows.where("present").select("key.*", "source", "lang", "n_tokens")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch; False (and no effect) when it is already committed."""
        if batch_id in self.batches():
            return False
        rank = F.struct((F.col("op") == "delete").alias("gone"),
                        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "op", "source", "lang")
        key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("tokenizer"))
        new = changes.groupBy(key.alias("key")).agg(F.max(rank).alias("c"))
        there = ~F.col("c.gone")
        new = new.select("key", F.when(there, F.col("c.source")).alias("source"), F.when(there, F.col("c.lang")).alias("lang"),
                         F.when(there, F.col("c.n_tokens")).otherwise(0).alias("n_tokens"), there.alias("present"))
        self.table.upsert(new, None, batch_id, 0)
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens: the stored totals."""
        found = self.table.read_totals(CELLS.name)
        if found is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        return found.where("n_docs <> 0 or n_tokens <> 0").select(*CELL, "n_docs", "n_tokens")


def first_lines(text):
    """The text without lines that repeat an earlier line."""
    return F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")


def op3_token_rollup(spark, sf_dir):
    """Totals over ``documents`` after a history of four batches: every
    document inserted under two tokenizer versions (words-1: words;
    pieces-1: runs of letters, marks and digits of any script); documents labelled low quality or
    toxic deleted; documents with repeated lines revised to the count without
    the repeats (words-1); and replays of all of them, which change nothing."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"))
    words = word_count(F.col("text"))
    pieces = F.coalesce(F.regexp_count("text", F.lit(PIECE_PATTERN)), F.lit(0)).cast("long")
    counts = docs.select("doc_id", "source", "lang", F.inline(F.array(
        F.struct(F.lit("words-1").alias("tokenizer"), words.alias("n_tokens")),
        F.struct(F.lit("pieces-1").alias("tokenizer"), pieces.alias("n_tokens")))))
    inserts = counts.withColumn("op", F.lit("insert"))
    bad = labels.where("quality = 0 or toxic = 1").select("doc_id").distinct()
    deletes = bad.select("doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
                         F.explode(F.array(F.lit("words-1"), F.lit("pieces-1"))).alias("tokenizer"),
                         F.lit(0).cast("long").alias("n_tokens"), F.lit("delete").alias("op"))
    lines = F.split("text", "\n", -1)
    repeats = (docs.where(F.size(F.array_distinct(lines)) < F.size(lines)).join(bad, "doc_id", "left_anti")
               .select("doc_id", "source", "lang", F.lit("words-1").alias("tokenizer"),
                       word_count(first_lines(F.col("text"))).alias("n_tokens"), F.lit("revise").alias("op")))
    batches = (("load", inserts), ("labels", deletes), ("repeats", repeats))
    for name, changes in batches:
        rollup.commit(name, changes)
    for name, changes in batches:
        rollup.commit(name, changes)
    return rollup.totals()


OP3_SQL = r"""
WITH bad AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0 OR toxic = 1),
good AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM bad)),
lines AS (
  SELECT doc_id, line, min(i) AS i
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM good)
  GROUP BY doc_id, line),
revised AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS n FROM lines GROUP BY doc_id),
c AS (
  SELECT source, lang, 'words-1' AS tokenizer, coalesce(n, 0) AS n FROM good LEFT JOIN revised USING (doc_id)
  UNION ALL
  SELECT source, lang, 'pieces-1', coalesce(len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}]+')), 0) FROM good)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM c GROUP BY source, lang, tokenizer
"""
