"""Quality rules: a threshold table compiled into Spark projections.

``RULES`` maps a rule name to (measure, comparison, threshold).  ``compile_rules``
turns the table into one boolean column per rule; ``apply_rules`` adds measures
and verdicts in built-in expressions only - no shuffle, no Python on the
executors.

Repeated 3-word windows of a text are found inside its row.  Distinct window
hashes prove that no window repeats; else all windows are sorted by hash, then by
their words, then by position, so that equal windows are neighbours: those whose
words equal a neighbour's are repeated (exact, whatever the hashes do), and their
sorted positions give the number of covered words.  A text of n words costs
O(n log n) whatever its repeats.  Windows refer to the words of the text; no
strings are built for them.

Defined cases: null and empty texts have no words, all counts 0, base_failed
true, kept false; an empty table gives no rows.  Ratios over an empty base are 0.
A very long text is one row's arrays of words and windows, in memory a few
dozen bytes a word.  Repeated rows and ties are judged one by one; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import SPACES, WORD_PATTERN, table

SYMBOLS = "#*$%&|<>"

# Base limits of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# measure, comparison that a kept text satisfies, threshold
RULES = {
    "words_long_enough": ("mean_word_chars", ">=", 2.5),
    "words_short_enough": ("mean_word_chars", "<=", 12.0),
    "few_symbols": ("symbol_ratio", "<=", 0.2),
    "few_exclamations": ("exclamation_ratio", "<=", 0.25),
    "mostly_lower_case": ("upper_ratio", "<=", 0.5),
    "has_stop_words": ("stop_word_ratio", ">=", 0.02),
    "few_repeated_lines": ("dup_line_ratio", "<=", 0.6),
    "varied_words": ("distinct_word_ratio", ">=", 0.1),
}

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he her his in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine er für ich im ist mit nicht sich sie und von zu "
    "au avec ce dans de des du elle en est et il la le les ne on par pas pour que qui se sur un une "
    "al como con del el es lo los las más no para por su una y").split()


def _let(value, body):
    """``body(value)`` with ``value`` computed once and handed on by reference: a
    column of its own would be copied into the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


SPACE = r"[\x20\x09-\x0D]"


def repeat_words(words):
    """How many words of the array lie in a 3-word window found twice or more."""
    count = F.greatest(F.size(words) - 2, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(words, F.lit(k), count).alias(x) for k, x in ((1, "a"), (2, "b"), (3, "c"))])
    digest = lambda x: F.xxhash64(x["a"], x["b"], x["c"])
    window = lambda x, i: F.struct(digest(x).alias("h"), x["a"].alias("a"), x["b"].alias("b"), x["c"].alias("c"),
                                   (i + 1).alias("i"))
    same = lambda p: ((p["x"]["h"] == p["y"]["h"]) & (p["x"]["a"] == p["y"]["a"])
                      & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]))
    # each window beside the next one in sorted order; the last has none
    pairs = lambda win: F.filter(F.arrays_zip(
        F.slice(win, F.lit(1), F.size(win) - 1).alias("x"), F.slice(win, F.lit(2), F.size(win) - 1).alias("y")), same)
    places = lambda hit: F.array_distinct(F.concat(F.transform(hit, lambda x: x["x"]["i"]),
                                                   F.transform(hit, lambda x: x["y"]["i"])))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end"))
    covered = lambda at: F.aggregate(F.sort_array(at), start, step, lambda a: a["n"])
    exact = lambda z: _let(F.sort_array(F.transform(z, window)), lambda win: _let(
        pairs(win), lambda hit: covered(places(hit))))
    return _let(zipped, lambda z: _let(F.transform(z, digest), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), exact(z)).otherwise(0)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the measures of the rule table."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t")).select(
        "doc_id", "_t", F.split("_t", SPACE, -1).alias("_s"))
    # one piece more than separators; words are the pieces that are not empty
    d = d.select("doc_id", "_t", F.array_remove("_s", "").alias("_w"), (F.size("_s") - 1).alias("_spaces"))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    plain = F.split(F.regexp_replace(F.lower("_t"), "[.,;:]+", ""), SPACE, -1)
    d = d.select(
        "doc_id", F.size("_w").cast("long").alias("n_words"), (F.length("_t") - F.col("_spaces")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
        _let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct"))).alias("_lines"),
        (F.length("_t") - F.length(F.replace("_t", F.lit("!"), F.lit("")))).alias("_bangs"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).alias("_upper"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        F.size(F.filter(plain, lambda w: w.isin(*sorted(set(STOP_WORDS))))).alias("_stops"))
    d = d.withColumns({"_n_lines": F.col("_lines.all"),
                       "n_dup_lines": (F.col("_lines.all") - F.col("_lines.distinct")).cast("long")})
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("word_chars", "n_words").alias("mean_word_chars"), per("n_symbols", "n_words").alias("symbol_ratio"),
        per("_bangs", "n_words").alias("exclamation_ratio"), per("_upper", "word_chars").alias("upper_ratio"),
        per("_stops", "n_words").alias("stop_word_ratio"), per("n_dup_lines", "_n_lines").alias("dup_line_ratio"),
        per("_distinct", "n_words").alias("distinct_word_ratio"))


def compile_rules(rules=None) -> list:
    """One boolean Column per rule of the table, aliased by the rule's name."""
    compare = {"<=": lambda c, v: c <= v, ">=": lambda c, v: c >= v}
    return [compare[op](F.col(m), F.lit(v)).alias(name) for name, (m, op, v) in (rules or RULES).items()]


def apply_rules(docs: DataFrame, rules=None) -> DataFrame:
    """Measures, one boolean per rule, base_failed and kept."""
    rules = RULES if rules is None else rules
    m = measures(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    out = m.select("*", failed.alias("base_failed"), *(compile_rules(rules) if rules else []))
    kept = ~F.col("base_failed")
    for name in rules:
        kept = kept & F.col(name)
    return out.withColumn("kept", kept)


def op2_quality_rules(spark, sf_dir):
    return apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    verdict = " AND ".join(f"{m} {op} {v}" for m, op, v in RULES.values())
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / {b}::DOUBLE ELSE 0.0 END"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD_PATTERN}') AS ws FROM d),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
windows AS (SELECT rid, i, concat_ws(' ', word, lead(word) OVER p, lead(word, 2) OVER p) AS win,
                   lead(word, 2) OVER p IS NOT NULL AS whole
            FROM words WINDOW p AS (PARTITION BY rid ORDER BY i)),
many AS (SELECT rid, i FROM windows WHERE whole QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM many, (VALUES (0), (1), (2)) x(o) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
        WHERE regexp_matches(line, '{WORD_PATTERN}') GROUP BY rid),
spread AS (SELECT rid, count(DISTINCT word) AS n_distinct,
                  count(*) FILTER (lower(translate(word, '.,;:', '')) IN ({stop})) AS n_stop FROM words GROUP BY rid),
b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, len(regexp_extract_all(t, '!')) AS bangs,
             len(regexp_extract_all(t, '\p{{Lu}}')) AS upper_chars, coalesce(n_distinct, 0) AS n_distinct, coalesce(n_stop, 0) AS n_stop
      FROM w LEFT JOIN covered USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN spread USING (rid)),
m AS (SELECT *, {ratio('word_chars', 'n_words')} AS mean_word_chars, {ratio('n_symbols', 'n_words')} AS symbol_ratio,
             {ratio('bangs', 'n_words')} AS exclamation_ratio, {ratio('upper_chars', 'word_chars')} AS upper_ratio,
             {ratio('n_stop', 'n_words')} AS stop_word_ratio, {ratio('n_dup_lines', 'n_lines')} AS dup_line_ratio,
             {ratio('n_distinct', 'n_words')} AS distinct_word_ratio,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {verdict} AS kept
FROM m
"""


OP2_SQL = _sql()
