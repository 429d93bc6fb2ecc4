"""Repeated byte strings against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from llm_helpers import docs
from trendlake.llm import suffix

L = suffix.LENGTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + L] for x in data for i in range(len(x) - L + 1))
    runs = [suffix.joined_spans([(i, i + L) for i in range(len(x) - L + 1) if seen[x[i:i + L]] > 1]) for x in data]
    return data, runs


def corpus(seed):
    rng = random.Random(seed)
    rnd = lambda n: "".join(rng.choice("abcdefghij klmnopé日\n") for _ in range(n))
    passages = [rnd(rng.randint(120, 700)) for _ in range(6)]
    texts = []
    for _ in range(60):
        t = rnd(rng.randint(0, 250))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            p = p[rng.randint(0, 60):len(p) - rng.randint(0, 60)]
            if rng.random() < .4 and p:
                k = rng.randrange(len(p))
                p = p[:k] + "X" + p[k + 1:]
            t += p + rnd(rng.randint(0, 120))
        texts.append(t)
    return texts + ["ab" * 300, "ab" * 300 + "c", "x" * 700, "x" * 199, "y" * 200, "y" * 200, None, "", texts[5], texts[5],
                    "z" * 50_000 + texts[7]]


def test_every_window_has_its_anchor():
    rng = random.Random(3)
    w = L - suffix.GRAM + 1
    for trial in range(60):
        alphabet = rng.choice([b"ab", b"abcdefgh", bytes(range(256))])
        data = bytes(rng.choice(alphabet) for _ in range(rng.randint(200, 900)))
        if trial % 3 == 0:
            data = (data[:rng.randint(1, 9)] * 900)[:len(data)]
        h = suffix.gram_hashes(np.frombuffer(data, np.uint8))
        pos, first, last, g = suffix.anchors(np.frombuffer(data, np.uint8))
        got = {j: p for p, a, z in zip(pos, first, last) for j in range(a, z + 1)}
        assert got == {j: j + int(np.argmin(h[j:j + w])) for j in range(len(data) - L + 1)}
        assert (h[pos] == g).all()


def test_pieces_of_a_long_text_lose_no_window(monkeypatch):
    rng = random.Random(8)
    data = bytes(rng.choice(b"abcd") for _ in range(3000))
    monkeypatch.setattr(suffix, "_PIECE", 256)
    for text in (data, data[:7] * 300, b"q" * 1500 + data[:900] + b"xyz" * 400):
        windows = [x + k * step for pos, high, low, _, _, n, d in suffix.anchor_rows(text)
                   for p, a, z, repeats, step in zip(pos, high, low, n, d) for k in range(repeats)
                   for x in range(p - a, p - z + 1)]
        assert sorted(windows) == list(range(len(text) - L + 1))
        assert len(text) < 3000 or text == data or len(windows) > 100
    rows = [len(r[0]) for r in suffix.anchor_rows(b"xyz" * 50)]
    monkeypatch.setattr(suffix, "_PIECE", 1 << 20)
    assert sum(len(r[0]) for r in suffix.anchor_rows(b"abcdefg" * 5000)) < 20 and rows == []


def test_merge_of_starts_against_pairs():
    """The interleave's repeated intervals are those of all pairs of windows."""
    rng = np.random.default_rng(1)
    for trial in range(30):
        m, length = 40, 12
        core = rng.integers(97, 99, 60).astype(np.uint8)
        group = np.sort(rng.integers(0, 4, m))
        left, right = np.tile(core[:20][::-1], (m, 1)), np.tile(core[20:20 + length], (m, 1))
        for i in range(m):
            left[i, rng.integers(0, 20):] = rng.integers(97, 99)
            right[i, rng.integers(0, length):] = rng.integers(97, 99)
        high = rng.integers(0, 20, m)
        low = np.maximum(0, high - rng.integers(0, 12, m))
        hit = suffix.merge_starts(group, right, left, high, low, length)
        seen = Counter()
        windows = {}
        for i in range(m):
            s = left[i][::-1].tobytes() + right[i].tobytes()
            for a in range(low[i], high[i] + 1):
                windows[i, a] = (group[i], a, s[20 - a:20 - a + length])
                seen[windows[i, a]] += 1
        assert {k for k, w in windows.items() if seen[w] > 1} == set(zip(*np.nonzero(hit)))


@pytest.mark.parametrize("hot", [suffix.HOT, 2])
def test_removed_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix.repeated_spans, "__defaults__", (L, hot))
    texts = corpus(hot)
    ids = list(range(len(texts)))
    ids[4] = None
    ids[-2] = ids[-3]  # two equal rows of one id
    df = docs(spark, texts, ids, extra=True)
    data, runs = brute(texts)
    expected = sorted([(i, len(x), sum(z - a for a, z in r), len(r), hashlib.sha256(suffix.kept_bytes(x, r)).hexdigest())
                       for i, x, r in zip(ids, data, runs)], key=repr)
    assert sorted([tuple(r) for r in suffix.digests(df).collect()], key=repr) == expected
    assert sum(e[2] for e in expected) > 10_000
    cut = suffix.remove_repeats(df)
    assert cut.columns == df.columns
    whole = sorted([(i, None if t is None else suffix.kept_bytes(x, suffix.whole_characters(x, r)).decode())
                    for i, t, x, r in zip(ids, texts, data, runs)], key=repr)
    rows = cut.collect()
    assert sorted([(r.doc_id, r.text) for r in rows], key=repr) == whole
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


def test_empty_table(spark):
    df = docs(spark, ["a"]).limit(0)
    assert suffix.digests(df).count() == 0 and suffix.remove_repeats(df).count() == 0


def test_whole_characters():
    data = "aé日b".encode()
    assert suffix.whole_characters(data, [(0, 2)]) == [(0, 1)]
    assert suffix.whole_characters(data, [(2, 5)]) == []
    assert suffix.whole_characters(data, [(2, 7)]) == [(3, 7)]
    assert suffix.joined_spans([(5, 9), (0, 2), (2, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_rows_that_repeat_id_and_text_share_their_spans(spark):
    """N equal rows: as many spans as one has, and one copy in a gram's group."""
    texts = [t for t in corpus(1) if t and len(t) > 300][:8]
    rows = lambda n: docs(spark, texts + [texts[0]] * n, ids=[*range(len(texts))] + [0] * n)
    spans = lambda n: {(r.doc_id, r.th): sorted(map(tuple, r.spans))
                       for r in suffix.repeated_spans(rows(n).select("doc_id", "text")).collect()}
    assert spans(30) == spans(1) and any(spans(1).values())
    pdf = pd.DataFrame({"doc_id": [1, 1, None, None, 2], "th": [7, 7, 7, 7, 7]})
    assert len(list(suffix._once([pdf, pdf]))) == 3
