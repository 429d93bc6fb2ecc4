"""Removal of repeated byte strings: hash counts of equal stretches, then an
interleave refinement by BWT symbols on the rest.

A byte is removed when a string of ``length`` (200) bytes that covers it also
starts anywhere else in the corpus.  That is the case for the string at x iff
the suffix at x has a common prefix of at least ``length`` bytes with a
neighbour in the merged suffix order of all shards.

Sorting every suffix of the corpus, or refining a byte-wise interleave of all
of them ``length`` times over the cluster, costs thousands of operations per
byte.  No shard transform is built or merged here.  Steps 2 and 3 and grams with
more than ``hot`` stretches are decided by hash counts; what is left is sorted
directly per gram and then refined as in the interleave: the order of the next
start to the left follows from the order of the last one by a stable partition
on the byte before it (the BWT symbol), and common prefixes follow from range
minima of the last ones.

1. *Anchors* (each shard alone).  A window is a string of ``length`` bytes; its
   anchor is its leftmost 32-byte gram of least hash.  Equal windows have their
   anchor at the same offset.  Consecutive windows share anchors: about one
   gram in 90 bytes is one.  An anchor owns a run of windows, which together
   cover one *stretch* of the text.
2. *Grams.*  Windows whose gram occurs once in the corpus are unique, and so
   dropped (a count with partial aggregation, a semi join).
3. *Classes.*  Anchors with the same gram, run and stretch are equal; a class of
   two or more has all its windows repeated.  One member stands for it below.
4. *Merge.*  What is left are grams with several different stretches, mostly the
   ends of copied passages.  The starts at the gram are sorted once; then the
   order of all starts one byte further left is refined from it, byte by byte,
   with its common prefixes; blocks whose common prefix is ``length`` or more
   are the repeated intervals.  Starts that can no longer reach ``length`` leave
   the interleave.
5. Spans come together per document, overlaps merged.

A gram with more than ``hot`` different stretches (a passage that a third of the
corpus quotes, each time with other text around it) is not brought to one
task: its windows are counted by a 128-bit hash instead, with partial
aggregation.

Documents are identified by (doc_id, hash of the text): equal rows repeat each
other whatever their number, and no row number has to survive a recomputation.

Defined cases: null and empty texts have no bytes; texts shorter than
``length`` keep everything and take no part; repeated rows lose everything that
is covered by windows (they repeat each other); a null doc_id is an id like any other;
very long texts are scanned in pieces; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import discard, ship_code, spread, table, written

LENGTH = 200
GRAM = 32
HOT = 20_000
_PIECE = 1 << 20
_MULT = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


# --- anchors of one text -----------------------------------------------------

def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Mixed polynomial hash (mod 2^64) of every ``gram``-byte string; ``gram``
    is a power of two, the hash of 2k bytes is built from those of k."""
    h = b.astype(np.uint64) + np.uint64(1)
    k, p = 1, _MULT
    while k < gram:
        h = h[:-k] * np.uint64(p) + h[k:]
        p, k = p * p & _MASK, 2 * k
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX)
    return h


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive hashes, from block prefix and suffix minima."""
    m, blocks = len(h) - w + 1, -(-len(h) // w)
    pad = np.full(blocks * w, _MASK, np.uint64)
    pad[:len(h)] = h
    rows = pad.reshape(blocks, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:m], before[w - 1:w - 1 + m])


def anchors(b: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(position, first window, last window, gram hash) of the anchors of one piece."""
    w = length - gram + 1
    h = gram_hashes(b, gram)
    low = window_minima(h, w)
    m = len(low)
    # A window that begins with its least gram has its anchor there; the other
    # anchors are those of the last window of a run of equal minima.
    ends = np.append(np.flatnonzero(low[1:] != low[:-1]), m - 1)
    found = [np.flatnonzero(low == h[:m])]
    for k in range(0, len(ends), 4096):
        e = ends[k:k + 4096]
        found.append(e + h[e[:, None] + np.arange(w)].argmin(axis=1))
    pos = np.unique(np.concatenate(found))
    g = h[pos]
    first = np.zeros(len(pos), np.int64)
    first[1:] = np.where(g[1:] < g[:-1], pos[1:] - w + 1, pos[:-1] + 1)
    last = np.append(first[1:] - 1, m - 1)
    return pos, first, last, g


def anchor_rows(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """(position, offset of the anchor in its first and last window, gram,
    stretch hash, repeats, step) of a whole text, piece by piece.

    Equal anchors at equal distances (text of a short period has one per
    period) are one row: ``repeats`` anchors, ``step`` bytes apart."""
    import xxhash
    digest, n = xxhash.xxh64_intdigest, len(data)
    for at in range(0, n - length + 1, _PIECE):
        piece = data[at:at + _PIECE + length - 1]
        pos, first, last, g = anchors(np.frombuffer(piece, np.uint8), length, gram)
        high, low = pos - first, pos - last
        seeds = (high * (length + 1) + low).tolist()
        c = np.array([digest(piece[a:z], s) for a, z, s in zip(first.tolist(), (last + length).tolist(), seeds)], np.uint64)
        d = np.diff(pos)
        like = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
        go_on = like.copy()
        go_on[1:] &= ~like[:-1] | (d[1:] == d[:-1])
        begin = np.append(0, np.flatnonzero(~go_on) + 1)
        repeats = np.diff(np.append(begin, len(pos)))
        step = np.append(d, 0)[begin] * (repeats > 1)
        yield pos[begin] + at, high[begin], low[begin], g[begin], c[begin], repeats, step


# --- merge ---------------------------------------------------------------------

def _range_minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) for each pair with lo < hi."""
    out = np.empty(len(lo), values.dtype)
    span = hi - lo
    level, width = values, 1
    while True:
        # ranges of width..2 width - 1: two overlapping blocks of ``width``
        some = np.flatnonzero((span >= width) & (span < 2 * width))
        out[some] = np.minimum(level[lo[some]], level[hi[some] - width])
        if not (span >= 2 * width).any():
            return out
        level = np.minimum(level[:-width], level[width:])
        width *= 2


def merge_starts(group: np.ndarray, right: np.ndarray, left: np.ndarray, high: np.ndarray, low: np.ndarray,
                 length: int = LENGTH) -> np.ndarray:
    """Which windows of aligned stretches are repeated within their group.

    ``group`` (m) ascending group numbers; ``right`` (m, length) the bytes from
    the anchor on, ``left`` (m, x) the bytes before it, nearest first (both
    padded with zeros); ``high`` and ``low`` the largest and smallest window
    offset of each.  Returns (m, max high + 1) booleans: window at offset a."""
    m, top = len(group), int(high.max()) if len(group) else 0
    hit = np.zeros((m, top + 1), bool)
    # Order of the starts at the anchor, over all shards' members of a group.
    key = np.ascontiguousarray(right).view(f"V{right.shape[1]}").ravel()
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    lcp = np.zeros(m, np.int32)  # with the start before it in the order
    for k in range(1, m, 1 << 14):
        i, j = order[k:k + (1 << 14)], order[k - 1:min(m, k + (1 << 14)) - 1]
        differ = right[i] != right[j]
        first = np.where(differ.any(1), differ.argmax(1), right.shape[1])
        lcp[k:k + len(i)] = np.where(group[i] == group[j], first, 0)
    for a in range(top + 1):
        if a:
            # One byte further left: stable partition of the order by the BWT symbol.
            symbol = group[order] * 256 + left[order, a - 1]
            by = np.argsort(symbol, kind="stable")
            same = np.flatnonzero(symbol[by[1:]] == symbol[by[:-1]]) + 1
            new = np.zeros(len(order), np.int32)
            new[same] = np.minimum(_range_minima(lcp, by[same - 1] + 1, by[same] + 1) + 1, length)
            order, lcp = order[by], new
        live = np.flatnonzero((low[order] <= a) & (a <= high[order]))
        if len(live) > 1:
            common = _range_minima(lcp, live[:-1] + 1, live[1:] + 1) >= length
            both = np.zeros(len(live), bool)
            both[1:] |= common
            both[:-1] |= common
            hit[order[live[both]], a] = True
        if a % 8 == 0:
            # Starts whose neighbours can no longer come to share ``length`` bytes leave.
            most = np.maximum(lcp, np.append(lcp[1:], 0))
            stay = np.flatnonzero((high[order] > a) & (most + (high[order] - a) >= length))
            if len(stay) < 2:
                break
            if len(stay) < len(order):
                kept = np.zeros(len(stay), np.int32)
                kept[1:] = _range_minima(lcp, stay[:-1] + 1, stay[1:] + 1)
                order, lcp = order[stay], kept
    return hit


def merged_windows(rows: pd.DataFrame, length: int = LENGTH):
    """(row, first byte, end) of the repeated runs of the target rows of whole
    gram groups; ``rows``: gram, pos, high, low, target, s."""
    group = np.cumsum(np.concatenate([[0], (np.diff(rows["gram"].to_numpy()) != 0).astype(np.int64)]))
    high, low = rows["high"].to_numpy().astype(np.int64), rows["low"].to_numpy().astype(np.int64)
    m, top = len(rows), int(high.max())
    right, left = np.zeros((m, length), np.uint8), np.zeros((m, max(1, top)), np.uint8)
    for i, (s, k) in enumerate(zip(rows["s"], high.tolist())):
        x = np.frombuffer(s, np.uint8)
        right[i, :len(x) - k] = x[k:]
        left[i, :k] = x[:k][::-1]
    hit = merge_starts(group, right, left, high, low, length)
    hit &= rows["target"].to_numpy().astype(bool)[:, None]
    # Runs of offsets a..a' are windows pos - a' .. pos - a.
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    i, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    pos = rows["pos"].to_numpy()[i]
    return i, pos - (end - 1), pos - begin + length


def _merge_batches(batches, length: int = LENGTH):
    """Whole gram groups of a partition sorted by gram, batch by batch."""
    rest = None

    def spans(pdf):
        i, lo, hi = merged_windows(pdf, length)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[i], "th": pdf["th"].to_numpy()[i], "lo": lo, "hi": hi})

    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        cut = int(np.searchsorted(pdf["gram"].to_numpy(), pdf["gram"].iloc[-1])) if len(pdf) else 0
        rest = pdf.iloc[cut:]
        if cut:
            yield spans(pdf.iloc[:cut].reset_index(drop=True))
    if rest is not None and len(rest):
        yield spans(rest.reset_index(drop=True))


# --- on Spark ------------------------------------------------------------------

def _once(batches):
    """The rows of a task without those that repeat both doc_id and text: they
    stand for nothing new (the join sorts them together, so a task or, after a
    skew split, a few tasks see them)."""
    seen = set()
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            key = (None if pd.isna(row.doc_id) else row.doc_id, row.th)
            if key not in seen:
                seen.add(key)
                yield row


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"),
                       text.cast("binary").alias("b"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, th (xxhash64 of the text), spans: array of [lo, hi) byte ranges,
    for the documents that have any; ranges may overlap."""
    ship_code(docs.sparkSession)
    keyed = _keyed(docs)

    def scan(batches):
        from trendlake.llm import suffix
        names = ["doc_id", "th", "at", "run", "gram", "cls"]
        for batch in batches:
            ids, ths = batch.column("doc_id"), batch.column("th").to_numpy()
            parts, who = [], []
            for k, data in enumerate(batch.column("b")):
                for pos, high, low, g, c, repeats, step in suffix.anchor_rows(data.as_py(), length):
                    who.append(np.full(len(pos), k))
                    parts.append((pos << 20 | high << 10 | low, repeats << 10 | step, g.view(np.int64), c.view(np.int64)))
            if parts:
                who = np.concatenate(who)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(who)), pa.array(ths[who]), *[pa.array(np.concatenate(x)) for x in zip(*parts)]], names)

    # at: position, and the largest and smallest window offset in 10 bits each;
    # run: number of anchors and, in 10 bits, the bytes between them (less than a window's).
    found = written(spread(keyed).mapInArrow(
        scan, "doc_id long, th long, at long, run long, gram long, cls long"), "sa-anchors")
    repeats, step = F.shiftright("run", 10), F.col("run").bitwiseAND(1023)
    again = found.groupBy("gram").agg(F.sum(repeats).alias("n")).where("n > 1").select("gram")
    shared = written(found.join(again, "gram", "left_semi"), "sa-shared")
    discard(found)
    classes = written(shared.groupBy("gram", "cls").agg(
        F.sum(repeats).alias("n"), *[F.first(c).alias(c) for c in ("doc_id", "th", "at")]), "sa-classes")

    pos, high, low = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023), F.col("at").bitwiseAND(1023)
    equal = shared.join(classes.where("n > 1").select("gram", "cls"), ["gram", "cls"], "left_semi")
    # The windows of a run of anchors follow each other.
    spans = equal.select("doc_id", "th", (pos - high).alias("lo"),
                         (pos + (repeats - 1) * step - low + length).alias("hi"))

    several = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("stretches")).where("stretches > 1")
    hard = (classes.join(several, "gram")
            .select("doc_id", "th", "gram", pos.alias("pos"), high.alias("high"), low.alias("low"),
                    (F.col("n") == 1).alias("target"), (F.col("stretches") > hot).alias("hot")))
    per_doc = hard.groupBy("doc_id", "th").agg(F.collect_list(F.struct(
        "gram", "pos", "high", "low", "target", "hot")).alias("h"))
    k = keyed.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "b")
    texts = k.join(per_doc, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_th") == F.col("th"))).select(
        "doc_id", "th", "b", *[F.col(f"h.{c}").alias(c) for c in ("gram", "pos", "high", "low", "target", "hot")])

    def stretches(batches):
        from trendlake.llm import suffix
        for row in suffix._once(batches):
            keep = ~np.asarray(row.hot, bool)
            if not keep.any():
                continue
            p, hi, lo = (np.asarray(x)[keep] for x in (row.pos, row.high, row.low))
            yield pd.DataFrame({
                "doc_id": pd.array([None if pd.isna(row.doc_id) else row.doc_id] * len(p), "Int64"),
                "th": np.full(len(p), row.th), "gram": np.asarray(row.gram)[keep], "pos": p, "high": hi, "low": lo,
                "target": np.asarray(row.target)[keep],
                "s": [row.b[a:z] for a, z in zip((p - hi).tolist(), (p - lo + length).tolist())]})

    def batched(batches):
        held, size = [], 0
        for pdf in stretches(batches):
            held.append(pdf)
            size += len(pdf)
            if size >= 4096:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    schema = "doc_id long, th long, gram long, pos long, high long, low long, target boolean, s binary"
    # Rows that stand for several can still come once per task (from repeated
    # documents); they are never targets, so that changes nothing.
    aligned = texts.mapInPandas(batched, schema)

    def merge(batches):
        from trendlake.llm import suffix
        yield from suffix._merge_batches(batches, length)

    exact = (aligned.repartition("gram").sortWithinPartitions("gram")
             .mapInPandas(merge, "doc_id long, th long, lo long, hi long"))
    spans = spans.unionByName(exact)
    if not several.where(F.col("stretches") > hot).isEmpty():
        spans = spans.unionByName(_hot_windows(texts, length))
    # A set: rows that repeat each other have the same spans.
    return spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _hot_windows(texts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of hot grams: counted by a 128-bit hash of the window."""
    def windows(batches):
        import xxhash
        from trendlake.llm import suffix
        for row in suffix._once(batches):
            for is_hot, p, hi, lo, target in zip(row.hot, row.pos, row.high, row.low, row.target):
                if is_hot:
                    at = np.arange(p - hi, p - lo + 1)
                    w = [row.b[x:x + length] for x in at.tolist()]
                    yield pd.DataFrame({
                        "doc_id": pd.array([None if pd.isna(row.doc_id) else row.doc_id] * len(at), "Int64"),
                        "th": np.full(len(at), row.th), "lo": at, "target": np.full(len(at), target),
                        "h1": np.array([xxhash.xxh64_intdigest(x, 1) for x in w], np.uint64).view(np.int64),
                        "h2": np.array([xxhash.xxh64_intdigest(x, 2) for x in w], np.uint64).view(np.int64)})

    found = written(texts.mapInPandas(windows, "doc_id long, th long, lo long, target boolean, h1 long, h2 long"),
                    "sa-hot-windows")
    twice = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return found.where("target").join(twice, ["h1", "h2"], "left_semi").select(
        "doc_id", "th", "lo", (F.col("lo") + length).alias("hi"))


def joined_spans(spans) -> list[tuple[int, int]]:
    """Maximal runs of a list of [lo, hi) ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def kept_bytes(data: bytes, runs) -> bytes:
    parts, at = [], 0
    for lo, hi in runs:
        parts.append(data[at:lo])
        at = hi
    parts.append(data[at:])
    return b"".join(parts)


def whole_characters(data: bytes, runs) -> list[tuple[int, int]]:
    """``runs`` without the bytes of characters that are only partly covered."""
    out = []
    for lo, hi in runs:
        while lo < hi and data[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi -= 1
        if hi > lo:
            out.append((lo, hi))
    return out


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` as one struct column ``_r`` plus lo and hi arrays (null: none)."""
    s = repeated_spans(docs.select("doc_id", "text"), length).select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th"),
        F.col("spans.lo").alias("_lo"), F.col("spans.hi").alias("_hi"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_r"))
    rows = rows.withColumn("_key", F.xxhash64(F.coalesce("_r.text", F.lit(""))))
    return rows.join(s, F.col("_r.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th")), "left")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def run(b: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        from trendlake.llm import suffix
        out = []
        for data, x, y in zip(b, lo, hi):
            data = bytes(data or b"")
            runs = [] if x is None else suffix.joined_spans(zip(x.tolist(), y.tolist()))
            out.append((len(data), sum(z - a for a, z in runs), len(runs),
                        hashlib.sha256(suffix.kept_bytes(data, runs)).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _with_spans(docs.select("doc_id", "text"), length)
    return found.select(F.col("_r.doc_id").alias("doc_id"),
                        run(F.coalesce("_r.text", F.lit("")).cast("binary"), "_lo", "_hi").alias("_d")).select("doc_id", "_d.*")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the repeated bytes; a character is removed only when
    all its bytes are.  ``n_chars``, if there, is counted anew."""
    @F.pandas_udf("string")
    def run(b: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        from trendlake.llm import suffix
        out = []
        for data, x, y in zip(b, lo, hi):
            if data is None:
                out.append(None)
                continue
            data = bytes(data)
            runs = [] if x is None else suffix.joined_spans(zip(x.tolist(), y.tolist()))
            out.append(suffix.kept_bytes(data, suffix.whole_characters(data, runs)).decode("utf-8"))
        return pd.Series(out, dtype=object)

    found = _with_spans(docs, length).withColumn("_text", run(F.col("_r.text").cast("binary"), "_lo", "_hi"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return found.select(*[(new[c] if c in new else F.col(f"_r.`{c}`")).alias(c) for c in docs.columns])


def op5_repeats(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
