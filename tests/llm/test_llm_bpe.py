"""BPE transducer against the public library: ids, decoding, streaming."""

import hashlib
import random

import numpy as np
import pytest

from llm_helpers import docs
from trendlake.llm import bpe

PIECES = ["don't", "<|endoftext|>", "  ", "\n\n", "hello", "WORLD", "'s", "''", "'", "...", "12345", "ñandú", "日本語",
          "a" * 300, "!" * 200, " " * 50, "é" * 100, "\r\n", " ", "ab'll", "x'", "<|end", "oftext|>", "'ve", "thth" * 60,
          "\x1c", " ", "½", "٣", "☃️", "é"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(bpe.vocabulary_path())


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) if rng.random() < .5 else rng.choice("ab 'te\n1.é") for _ in range(rng.randint(0, 40)))
            for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 3, 17, 1000])
@pytest.mark.parametrize("carry", [64, 1 << 14])
def test_any_pieces_give_the_library_ids(library, vocabulary, monkeypatch, piece, carry):
    monkeypatch.setattr(bpe, "_SPLIT_CARRY", carry)
    for t in texts(piece, 300):
        got = [i for part in bpe.encode(t, vocabulary, piece) for i in part]
        assert got == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert bpe.Decoder(vocabulary).feed(got, True) == library.decode(got, skip_special_tokens=False) == t


def test_memory_stays_constant_on_one_endless_split(vocabulary, library):
    e = bpe.LongSplitEncoder(vocabulary)
    total, held = 0, 0
    for _ in range(60):
        total += len(e.feed("ab" * 5000))
        held = max(held, len(e.tail) + len(e.inside or b""))
    total += len(e.finish())
    assert held <= bpe._SPLIT_CARRY + 20_000
    assert total == len(library.encode("ab" * 300_000, add_special_tokens=False).ids)


def test_lookahead_is_enough(vocabulary):
    """Stable ids of a prefix are a prefix of the ids of any continuation."""
    rng = random.Random(4)
    for _ in range(200):
        a = bytes(rng.choice(b"thea inr") for _ in range(1200))
        ids, rest = vocabulary.stable(a)
        assert ids and len(rest) <= vocabulary.lookahead + 2 * vocabulary.longest
        for _ in range(3):
            more = a + bytes(rng.choice(b"thea inr") for _ in range(rng.randint(1, 80)))
            assert vocabulary.merge(more)[:len(ids)] == ids


def test_lookahead_of_a_small_list():
    # ab waits for nothing; a rule whose right part begins with an earlier left part adds up
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"c", b"ab")]) == 2
    assert bpe.sufficient_lookahead([(b"c", b"ab"), (b"a", b"b")]) == 1


def test_decoder_holds_back_unfinished_characters(vocabulary):
    d = bpe.Decoder(vocabulary)
    data = "é日😀".encode()
    out = [d.feed([vocabulary.byte_id[b]]) for b in data]
    assert "".join(out) == "é日😀" and out[0] == ""
    assert d.feed([vocabulary.byte_id[0xE6]], True) == "�"


def test_digests_on_awkward_rows(spark, library):
    rows = [None, "", "a" * 200_000, " x" * 100_000, "<|endoftext|>", "same", "same"] + texts(9, 20)
    df = docs(spark, rows, extra=True)
    out = bpe.digests(df)
    assert out.columns == [c for c in df.columns if c != "text"] + ["n_tokens", "ids_sha256", "decoded_sha256"]
    for r in out.collect():
        t = rows[r.doc_id] or ""
        ids = library.encode(t, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    back = bpe.decode_ids(bpe.encode_ids(df, out_col="numbers"), "numbers").select("doc_id", "decoded").collect()
    assert {r.doc_id: r.decoded for r in back} == {i: t or "" for i, t in enumerate(rows)}
    last = bpe.encode_documents(df)  # a column called ids gives way to the result
    assert last.columns.count("ids") == 1 and all(r.round_trip for r in last.collect())
    assert bpe.digests(df.limit(0)).count() == 0
