"""Byte-level BPE as a bounded-lookahead streaming transducer.

Lookahead.  Merges apply in rank order.  Take two byte strings that agree on a
prefix and follow the furthest-left point where their tokenizations may differ:
rule r = (u, v) moves it left by at most |u|, and only when a token starting
there is the rule's right part v.  After that step both tokenizations have a
token starting with the string u at the new point, so the next rule that moves
it has a right part that begins with u, and a higher rank.  ``lookahead`` is
the largest sum of |u| over such chains: a boundary more than that many bytes
before the end of what has been read is final, whatever follows.

Encoder.  ``Encoder.feed(text)`` takes text in pieces of any size and returns
the ids that have become stable; ``finish()`` returns the rest.  The text is
split by the tokenizer's pattern.  Splits that cannot change any more go to the
merge transducer; the undecided tail is carried over, and a single split longer
than ``_SPLIT_CARRY`` bytes (a megabyte of one letter) is itself streamed:
its stable tokens are emitted and only the lookahead is kept.  Memory is the
piece plus constants.  Equal splits are encoded once per worker in a bounded
table of two halves (the older half is dropped when the recent one is full; it
only saves time).

Decoder.  ``Decoder.feed(ids)`` turns ids into bytes and runs them through an
incremental UTF-8 state machine that holds back an unfinished character;
invalid bytes become U+FFFD as in the library.

Defined cases: null and empty texts have no ids and decode to the empty text;
``<|endoftext|>`` in a text becomes the special id, as the library does by
default; repeated rows are encoded each; other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import sys
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StructType

from trendlake.llm.common import ship_code, spread, table

VOCABULARY = "byte_bpe_50k.json"
PIECE_CHARS = 1 << 16
CACHE_SPLITS = 400_000
_SPLIT_CARRY = 1 << 14
_ID_MASK = (1 << 32) - 1
_NO_RULE = 1 << 62


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 on, in byte order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _char_class(test) -> str:
    """Regular-expression class body of the code points that pass ``test``."""
    parts, start = [], None
    for c in range(sys.maxunicode + 2):
        ok = c <= sys.maxunicode and test(chr(c))
        if ok and start is None:
            start = c
        elif not ok and start is not None:
            parts.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(parts)


_SPLIT = None


def split_pattern() -> re.Pattern:
    """The published split pattern of the vocabulary, with Unicode letter,
    number and White_Space classes spelled out for the standard matcher (its
    own ``\\s`` also has U+001C..U+001F)."""
    global _SPLIT
    if _SPLIT is None:
        cat = unicodedata.category
        letter = _char_class(lambda c: cat(c)[0] == "L")
        number = _char_class(lambda c: cat(c)[0] == "N")
        space = _char_class(lambda c: c.isspace() and not "\x1c" <= c <= "\x1f")
        _SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                            f"|[{space}]+(?![^{space}])|[{space}]+")
    return _SPLIT


class Vocabulary:
    """Merge ranks over ids, token bytes, special tokens and the lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        ids = spec["model"]["vocab"]
        raw = lambda t: bytes(symbol[c] for c in t)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: raw(t) for t, i in ids.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [0] * 256
        for c, b in symbol.items():
            self.byte_id[b] = ids[c]
        self.id = list(range(max(self.bytes) + 1))  # one int object per id, shared by the table's entries
        self.ranks, rules = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[u], ids[v]] = rank << 32 | ids[u + v]
            rules.append((raw(u), raw(v)))
        self.longest = max(map(len, self.bytes.values()))
        self.lookahead = sufficient_lookahead(rules)
        self.table: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one split: the pair of lowest rank is merged first, leftmost
        first among equals."""
        get, none = self.ranks.get, _NO_RULE
        byte_id, shared = self.byte_id, self.id
        ids = [byte_id[b] for b in data]
        pairs = [get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i, new = pairs.index(best), shared[best & _ID_MASK]
            ids[i:i + 2] = (new,)
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], new), none)
            if i < len(pairs):
                pairs[i] = get((new, ids[i + 1]), none)
        return ids

    def stable(self, data: bytes) -> tuple[list[int], bytes]:
        """The ids of a split's first bytes that no continuation can change,
        and the bytes that remain."""
        ids, at, keep = self.merge(data), 0, len(data) - self.lookahead - self.longest
        for k, i in enumerate(ids):
            if at + len(self.bytes[i]) > keep:
                return ids[:k], data[at:]
            at += len(self.bytes[i])
        return ids, b""

    def split_ids(self, split: str):
        """Ids of a split that is not in the recent half of the table."""
        found = self.older.get(split)
        if found is None:
            data = split.encode("utf-8")
            if len(data) > _SPLIT_CARRY:
                return list(self._long(data))
            found = tuple(self.merge(data))
        if len(self.table) >= CACHE_SPLITS // 2:
            self.older = self.table.copy()
            self.table.clear()
        self.table[split] = found
        return found

    def _long(self, data: bytes):
        block = 4 * (self.lookahead + self.longest)
        rest = data[:block]
        at = len(rest)
        while at < len(data):
            ids, rest = self.stable(rest)
            yield from ids
            more = data[at:at + block]
            at += len(more)
            rest += more
        yield from self.merge(rest)


def sufficient_lookahead(rules: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a boundary that decide it, from the merge list alone: the
    longest chain of rules of rising rank in which each rule's right part
    begins with the left part of the one before, measured in left parts."""
    reach: dict[bytes, int] = {}
    most = 0
    for u, v in rules:
        before = max((reach[v[:k]] for k in range(1, len(v) + 1) if v[:k] in reach), default=0)
        total = len(u) + before
        if total > reach.get(u, 0):
            reach[u] = total
        most = max(most, total)
    return most


class Encoder:
    """Streaming encoder; see the module's text."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.tail = vocabulary, ""
        self.split = split_pattern()
        self.special = sorted(vocabulary.special, key=len, reverse=True)
        self.guard = max(map(len, self.special), default=1) - 1
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.inside: bytes | None = None  # unfinished long split: bytes not emitted yet
        self.inside_first = ""

    def feed(self, text: str, last: bool = False) -> list[int]:
        return self._run(self.tail + text, last)

    def finish(self) -> list[int]:
        return self._run(self.tail, True)

    def _run(self, text: str, last: bool) -> list[int]:
        out: list[int] = []
        self.tail = ""
        if self.special_re is not None and any(s in text for s in self.special):
            parts = self.special_re.split(text)
            for k in range(0, len(parts) - 1, 2):
                self._plain(parts[k], True, out)
                out.append(self.v.special[parts[k + 1]])
            text = parts[-1]
        held = ""
        if not last and self.guard:
            # the piece may end inside a special token
            for k in range(min(self.guard, len(text)), 0, -1):
                if any(s.startswith(text[-k:]) for s in self.special):
                    text, held = text[:-k], text[-k:]
                    break
        self._plain(text, last, out)
        self.tail += held
        return out

    def _plain(self, text: str, last: bool, out: list[int]) -> None:
        v = self.v
        table_get, split_ids = v.table.get, v.split_ids
        splits = self.split.findall(text)
        if last:
            keep = []
        else:
            # The last two splits may change with more text (a growing run, white
            # space giving up its last character, an apostrophe).
            keep, splits = splits[-2:], splits[:-2]
        for s in splits:
            found = table_get(s)
            out += split_ids(s) if found is None else found
        self.tail = "".join(keep)


class LongSplitEncoder(Encoder):
    """Encoder whose carried tail is bounded too: a run of one class that
    outgrows ``_SPLIT_CARRY`` is streamed through the merge transducer."""

    def _plain(self, text: str, last: bool, out: list[int]) -> None:
        if self.inside is not None:
            text = self._continue(text, last, out)
            if self.inside is not None:
                return
        super()._plain(text, last, out)
        if not last and len(self.tail) > _SPLIT_CARRY:
            *head, run = self.split.findall(self.tail)
            kind = self._kind(run)
            if len(run) > _SPLIT_CARRY and kind:
                for s in head:
                    out += self.v.split_ids(s)
                self.inside, self.inside_kind, self.tail = b"", kind, ""
                self._continue(run, False, out, first=True)

    def _kind(self, run: str):
        """Pattern of characters that continue the run (None: white space,
        which is only ever carried)."""
        c = run[-1]
        if c.isspace() and not "\x1c" <= c <= "\x1f":
            return None
        cat = unicodedata.category(c)[0]
        return cat if cat in "LN" else "O"

    def _same(self, c: str) -> bool:
        cat = unicodedata.category(c)[0]
        if self.inside_kind in "LN":
            return cat == self.inside_kind
        return cat not in "LN" and not (c.isspace() and not "\x1c" <= c <= "\x1f")

    def _continue(self, text: str, last: bool, out: list[int], first: bool = False) -> str:
        n = len(text)
        if not first:
            n = 0
            while n < len(text) and self._same(text[n]):
                n += 1
        data = self.inside + text[:n].encode("utf-8")
        block = 4 * (self.v.lookahead + self.v.longest)
        rest, at = data[:block], block
        while at < len(data):
            ids, rest = self.v.stable(rest)
            out += ids
            rest += data[at:at + block]
            at += block
        if n < len(text) or last:
            out += self.v.merge(rest)
            self.inside = None
            return text[n:]
        self.inside = rest
        return ""


class Decoder:
    """Incremental ids -> text."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = vocabulary.bytes
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids, last: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.bytes.__getitem__, ids)), last)


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    """The vocabulary of a file, once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(text: str | None, vocabulary: Vocabulary, piece: int = PIECE_CHARS):
    """Stable ids of ``text`` in lists, piece by piece."""
    if not text:
        return
    e = LongSplitEncoder(vocabulary)
    for at in range(0, len(text), piece):
        yield e.feed(text[at:at + piece], at + piece >= len(text))


def digest(text: str | None, vocabulary: Vocabulary) -> tuple[int, str, str]:
    """Number of ids, sha256 of the ids as little-endian uint32 and sha256 of
    the decoded text: one pass, nothing of the length of the text is kept."""
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    d = Decoder(vocabulary)
    for ids in encode(text, vocabulary):
        n += len(ids)
        ids_hash.update(np.array(ids, "<u4").tobytes())
        text_hash.update(d.feed(ids).encode("utf-8"))
    text_hash.update(d.feed([], True).encode("utf-8"))
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_ids(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` as array<int>."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        from trendlake.llm import bpe
        v = bpe.load(vocabulary or bpe.vocabulary_path())
        return pd.Series([np.array([i for ids in bpe.encode(t, v) for i in ids], np.int32) for t in texts], dtype=object)

    return docs.withColumn(out_col, run(F.col(text_col)))


def decode_ids(df: DataFrame, ids_col: str = "ids", vocabulary: str | None = None, out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` (null ids: the empty text)."""
    ship_code(df.sparkSession)

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        from trendlake.llm import bpe
        v = bpe.load(vocabulary or bpe.vocabulary_path())
        return pd.Series([bpe.Decoder(v).feed([] if x is None else x.tolist(), True) for x in lists], dtype=object)

    return df.withColumn(out_col, run(F.col(ids_col)))


_SLICE = 256  # rows of results held at a time


def _replace_text(docs: DataFrame, text_col: str, vocabulary: str | None, fields: StructType, make) -> DataFrame:
    """``docs`` with the columns ``fields`` made of the text (``make``: text and
    vocabulary to a tuple) in place of the text and of columns of those names."""
    ship_code(docs.sparkSession)
    new = fields.fieldNames()
    keep = [c for c in docs.columns if c != text_col and c not in new]
    schema = StructType([docs.schema[c] for c in keep] + fields.fields)
    names, types = keep + new, [to_arrow_type(f.dataType) for f in fields.fields]

    def run(batches):
        from trendlake.llm import bpe
        v = bpe.load(vocabulary or bpe.vocabulary_path())
        for batch in batches:
            for k in range(0, batch.num_rows, _SLICE):
                part = batch.slice(k, _SLICE)
                made = zip(*[make(t.as_py(), v) for t in part.column(len(keep))])
                arrays = [pa.array(list(x), t) for x, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(part.columns[:len(keep)] + arrays, names)

    return docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema)


def digests(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of ``text_col``."""
    fields = StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return _replace_text(docs, text_col, vocabulary, fields, digest)


def ids_and_check(text: str | None, vocabulary: Vocabulary) -> tuple[int, np.ndarray, bool]:
    """Number of ids, the ids, and whether they decode to the text."""
    parts = [np.array(ids, np.int32) for ids in encode(text, vocabulary)]
    ids, d = np.concatenate([np.zeros(0, np.int32), *parts]), Decoder(vocabulary)
    return len(ids), ids, "".join([d.feed(p.tolist()) for p in parts]) + d.feed([], True) == (text or "")


def encode_documents(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with the text replaced by its ids: n_tokens, ids array<int> and
    round_trip (the ids decode to the text)."""
    fields = StructType().add("n_tokens", "long").add("ids", ArrayType(IntegerType())).add("round_trip", "boolean")
    return _replace_text(docs, text_col, vocabulary, fields, ids_and_check)


def op6_bpe(spark, sf_dir):
    return digests(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
