"""Line CRF, PU toxicity and the page CRF: held-out quality and awkward rows."""

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_helpers import docs
from trendlake.llm import crf, html, quality, toxicity

SF001 = SMALL.replace("sf0.001", "sf0.01")
GOOD = "The meadow was quiet in the evening, and the bridge over the harbour was empty."
JUNK = "BUY!! NOW!! CHEAP!! STUFF!! BUY!! NOW!! CHEAP!! STUFF!!"


def brute_chain(state, trans):
    """log Z, marginals and best labels of one chain from all its labelings."""
    n = len(state)
    score = {y: sum(state[t, y[t]] for t in range(n)) + sum(trans[y[t], y[t + 1]] for t in range(n - 1))
             for y in product((0, 1), repeat=n)}
    z = np.logaddexp.reduce(list(score.values()))
    marg = np.zeros((n, 2))
    for y, s in score.items():
        for t in range(n):
            marg[t, y[t]] += np.exp(s - z)
    return z, marg, list(max(score, key=score.get))


def test_crf_against_all_labelings():
    rng = np.random.default_rng(0)
    lens = [3, 0, 1, 5, 4]
    starts = np.concatenate([[0], np.cumsum(lens)])
    state, trans = rng.normal(size=(sum(lens), 2)), rng.normal(size=(2, 2))
    log_z, node, pair = crf.marginals(state, starts, trans)
    for c, n in enumerate(lens):
        part = state[starts[c]:starts[c + 1]]
        if n:
            z, marg, best = brute_chain(part, trans)
            assert log_z[c] == pytest.approx(z) and np.allclose(node[starts[c]:starts[c + 1]], marg)
            assert crf.viterbi(part, trans) == best
    assert pair.sum() == pytest.approx(sum(max(0, n - 1) for n in lens))
    assert crf.viterbi(state[:0], trans) == []


def labelled(spark, n=60, extra=True):
    texts = [f"{GOOD} {i}\n{GOOD}" if i % 2 else f"{JUNK} {i}\n{JUNK}" for i in range(n)]
    df = docs(spark, texts, extra=extra)
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(n)] + [(None, 1, 1), (5, None, None), (9999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    return df, labels


def test_quality_on_awkward_rows(spark):
    df, labels = labelled(spark)
    model = quality.fit(df, labels)
    odd = docs(spark, [None, "", "\n\n", GOOD, JUNK, f"{GOOD}\n{JUNK}", (GOOD + "\n") * 5000, GOOD, "x" * 300_000], extra=True)
    got = {r.doc_id: r.score for r in quality.score(odd, model).collect()}
    assert got[0] == got[1] == got[2] == 0.0 and all(0 <= s <= 1 for s in got.values())
    assert got[3] > 0.8 and got[4] < 0.2 and got[6] > 0.8 and got[7] == got[3]
    assert quality.score(odd.limit(0), model).count() == 0
    untrained = quality.fit(df, labels.limit(0))
    assert {round(r.score, 9) for r in quality.score(odd.where("doc_id in (3, 4)"), untrained).collect()} == {0.5}
    assert quality.fit(df.limit(0), labels)[0].any() == False  # noqa: E712


def test_labels_of_absent_documents_do_not_use_up_the_sample(spark):
    df, labels = labelled(spark)
    absent = spark.range(10_000, 20_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    a, b = quality.fit(df, labels, n_documents=50), quality.fit(df, labels.unionByName(absent), n_documents=50)
    assert a[0].any() and np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_quality_sample_ignores_copies_order_and_long_texts(spark):
    """Repeated ids with different texts, copies and the layout leave reruns alike; the line bound holds."""
    df, labels = labelled(spark)
    more = df.unionByName(docs(spark, [GOOD + " other"], ids=[1], extra=True)).unionByName(df.where("doc_id % 3 = 0"))
    a, b = quality.fit(more, labels), quality.fit(more.repartition(7), labels)
    assert a[0].any() and np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
    long = df.unionByName(docs(spark, ["\n".join([JUNK] * 500)], ids=[62], extra=True))
    extra = labels.unionByName(spark.createDataFrame([(62, 0, 1)], labels.schema))
    assert np.array_equal(quality.fit(long, extra, n_lines=200)[0], quality.fit(df, labels, n_lines=200)[0])


def test_long_chains_and_sliced_features_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    trans, w = rng.normal(size=(2, 2)) * 2, rng.normal(size=(quality.N_FEATURES, 2))
    for n in (1, 2, 3, 10, 17, 400):
        state = rng.normal(size=(n, 2)) * 3
        assert np.allclose(crf.long_marginals(state, trans), crf.marginals(state, np.array([0, n]), trans)[1], atol=1e-12)
    texts = ["\n".join(f"line {rng.integers(9)} {'WOW!' * int(rng.integers(3))}" for _ in range(n)) for n in (1, 40, 41, 80, 99)]
    plain_scores = quality.document_scores([None, *texts, ""], w, trans)
    monkeypatch.setattr(quality, "LINES_AT_ONCE", 20)
    monkeypatch.setattr(quality, "LONG_CHAIN", 30)
    assert np.allclose(quality.document_scores([None, *texts, ""], w, trans), plain_scores, atol=2e-9)
    # brute force of the score: marginals by enumeration, weighted by length
    text = "good line\nBAD LINE!!\n\nshort\nanother good line here"
    x, lengths = quality.line_features(text)
    _, node, _ = brute_chain(x.astype(float) @ w, trans)
    assert quality.document_scores([text], w, trans)[0] == pytest.approx((lengths * node[:, 1]).sum() / lengths.sum(), abs=1e-8)


def test_many_lines_are_scored_in_reasonable_time():
    import time
    start = time.time()
    score = quality.document_scores([(JUNK[:4] + "\n") * 200_000], np.ones((quality.N_FEATURES, 2)), np.eye(2))
    assert 0 <= score[0] <= 1 and time.time() - start < 60


def test_neighbouring_lines_decide(spark):
    """A doubtful line is good among good lines and bad among bad ones."""
    df, labels = labelled(spark)
    w, tr = quality.fit(df, labels)
    marginal = lambda lines: crf.marginals(quality.line_features("\n".join(lines))[0].astype(float) @ w,
                                           np.array([0, len(lines)]), tr)[1][1, 1]
    assert marginal([GOOD, "Sold out", GOOD]) > marginal([JUNK, "Sold out", JUNK])


@pytest.mark.parametrize("module, column, modulus, held", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_held_out_rows_are_never_learned(spark, module, column, modulus, held):
    df, labels = labelled(spark, extra=False)
    out = zlib.crc32
    flipped = labels.collect()
    flipped = [(r.doc_id, *[None if v is None else (1 - v if r.doc_id is not None and out(str(r.doc_id).encode()) % modulus == held
                                                    else v) for v in (r.quality, r.toxic)]) for r in flipped]
    other = spark.createDataFrame(flipped, labels.schema)
    a, b = module.fit(df, labels), module.fit(df, other)
    same = (np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])) if module is quality else a.weights == b.weights
    assert same


@pytest.mark.parametrize("query, column, least", [("op1_quality", "quality", 0.93), ("op4_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, column, least):
    from trendlake.llm.queries import QUERIES
    got = QUERIES[query](spark, SF001)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    modulus, held = (5, 0) if column == "quality" else (4, 2)
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert len(test) > 50 and np.mean([r.predicted == r[column] for r in test]) >= least
    if column == "quality":
        assert all(r.predicted == 1 for r in rows if r.quality == 1)


def test_non_negative_risk_beats_taking_unlabelled_as_negative():
    """Half of the unlabelled examples are positive; the corrected risk still
    finds the border, and does not run away below zero."""
    rng = np.random.default_rng(0)
    make = lambda y, n: [np.flatnonzero(rng.random(20) < (0.5 if y else 0.02) * (np.arange(20) < 10) + 0.1)
                         for _ in range(n)]
    pos, unl = make(1, 200), make(1, 400) + make(0, 400)
    score = lambda m, rows: np.array([m[1] + m[0][r].sum() for r in rows])
    right = toxicity.train(pos, unl, 20, prior=0.5)
    test_pos, test_neg = make(1, 500), make(0, 500)
    assert np.mean(score(right, test_pos) > 0) > 0.9 and np.mean(score(right, test_neg) < 0) > 0.9
    assert np.abs(right[0]).max() < 100


def test_toxicity_on_awkward_rows(spark):
    df, labels = labelled(spark)
    m = toxicity.fit(df, labels)
    odd = docs(spark, [None, "", JUNK, GOOD, "cheap " * 50_000, JUNK], extra=True)
    got = {r.doc_id: r.score for r in toxicity.score(odd, m).collect()}
    assert got[0] == got[1] and got[2] == got[5] > 0.5 > got[3] and all(0 <= s <= 1 for s in got.values())
    assert toxicity.score(odd.limit(0), m).count() == 0
    none = toxicity.fit(df, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}
    assert toxicity.keep_clean(odd, labels.limit(0)).columns == odd.columns
    empty = toxicity.fit(df.limit(0), labels.limit(0))
    assert empty.prior == 0


def test_copies_of_one_toxic_text_do_not_hide_the_others(spark):
    """Nearly all confirmed toxic rows are one text; the rest is still found, and clean text kept."""
    texts = ["filthy spam of one kind"] * 2000 + [f"grubby insult number{i} for you" for i in range(24)]
    texts += [f"{GOOD} {i}" for i in range(200)]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 2024)) for i in range(len(texts))], "doc_id long, toxic int")
    m = toxicity.fit(df, labels)
    assert "grubby" in m.weights and m.prior < 0.3
    score = {r.doc_id: r.score for r in toxicity.score(df.where("doc_id >= 2000"), m).collect()}
    assert all((s >= toxicity.THRESHOLD) == (i < 2024) for i, s in score.items())


PAGE = """<html><head><title>no</title><script>var a = "</p><p>x";</script></head><body><nav><ul><li><a href="/a">Home</a>
<li><a href="/b">News</a></ul></nav><div class="ad">Buy this now</div><article><h1>A &amp; B</h1><p><b>First   paragraph of the
text,<br>with a line break, that is long enough to be prose in every sense of the word.<p>Second one &copy; 1 &lt; 2.</article>
<footer>&copy; 2020</footer>"""


def test_blocks_of_broken_markup():
    got = [b.text for b in html.blocks_of(PAGE)]
    assert got == ["Home", "News", "Buy this now", "A & B",
                   "First paragraph of the text, with a line break, that is long enough to be prose in every sense of the word.",
                   "Second one © 1 < 2.", "© 2020"]
    assert html.blocks_of(None) == html.blocks_of("") == html.blocks_of("<style>x{}</style>") == []
    deep = html.blocks_of("<div>" * 20_000 + "x" + "</div>" * 20_000 + "</p></li>y")
    assert [b.text for b in deep] == ["x", "y"]


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    model = html.fit(pages)
    assert html.main_text(PAGE, *model).split("\n")[0] == "A & B" and "2020" not in html.main_text(PAGE, *model)
    import re
    from html import unescape
    for r in html.extract(pages, model).collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        parts = (" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(x for x in parts if x)
    prose = "This is a long sentence of article text that goes on and on in the same manner. " * 4
    other = (f'<body><div class="top-nav"><a href="x">Home</a> <a href="y">News</a></div><div class="content"><h1>My title</h1><p>{prose}'
             f'</p><p>{prose}</p></div><div class="comment-list"><p>I liked it very much, thank you.</p></div>'
             '<form><label>Mail</label><button>Send</button></form><footer>(c) 2020</footer>')
    assert html.main_text(other, *model) == f"My title\n{prose.strip()}\n{prose.strip()}"


def test_pages_on_awkward_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", PAGE, "t"), (3, "u", PAGE, "t"), (None, "u", "just text", "t"),
            (4, "u", "<article><p>" + "word " * 100_000 + "</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    model = html.fit(pages)
    got = html.extract(pages, model).collect()
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert len({r.text for r in got if r.page_id == 3}) == 1
    assert [len(r.text) for r in got if r.page_id == 4] == [499_999]
    assert html.extract(pages.limit(0), html.fit(pages.limit(0))).count() == 0


def test_pages_that_label_themselves_are_found_among_others(spark):
    """The sample is one of self-labelling pages, however few there are."""
    n, by_hash = 3, F.xxhash64("id", F.lit(29))
    ids = [r.id for r in spark.range(200).orderBy(by_hash, "id").collect()]
    bare = "<body><div class='menu'><a href='/'>Home</a></div><p>Some text.</p></body>"
    rows = [(i, f"<!-- <article> -->{bare}" if k < 60 else bare if k < 195 else PAGE.replace("B</h1>", f"{k}</h1>"))
            for k, i in enumerate(ids)] + [(ids[-4], bare), (None, PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    alone = pages.where(F.col("page_id").isin(ids[195:195 + n]) & F.col("html").contains("<article><h1>"))
    model, expected = html.fit(pages, n), html.fit(alone, n)
    assert model[0] == expected[0] and np.array_equal(model[1], expected[1]) and model[1].any()
    assert "News" not in html.main_text(PAGE, *model)


@pytest.mark.parametrize("start", ["<body>", "<p>", "<span>", "", "<img src=x>", "<svg></svg>", "</body><div>"])
def test_head_without_end_tag_hides_no_text(start):
    head = "<html><head>\n<meta charset=u><title>no</title><script>var a;</script><noscript><img><p>no</p></noscript><link>\n"
    page = f"{head}{start}Text <b>of</b> the page.</p><footer>End</footer>"
    assert [b.text for b in html.blocks_of(page)] == ["Text of the page.", "End"]
    assert [b.text for b in html.blocks_of(PAGE.replace("</head>", ""))] == [b.text for b in html.blocks_of(PAGE)]
    assert [b.text for b in html.blocks_of(f"<head><noscript>no{'<body>'}Text")] == ["Text"]
    assert html.blocks_of(head) == html.blocks_of("<head><noframes>no</noframes><title>no") == []


SAID = "I am not sure about this at all because the author never says where the numbers come from. " * 6
PROSE = "The council met on Tuesday to talk about the bridge and the money that it would take to mend it. " * 5
ITEMS = "<ul><li>New rail</li><li>Old stones kept</li><li>Wider path</li></ul>"
# Pages laid out unlike any training page: {said} must go, all else that is marked with * stays.
UNSEEN = [
    "<header><h2>Daily</h2><p>{said}</p></header><article><h1>*Bridge</h1><p>*{prose}</p>{items}<p>*{prose}</p><div class='comments'>"
    "<div class='comment'><p>{said}</p></div><div class='comment'><p>{said}</p></div></div><article class='comment'><p>{said}</p></article>"
    "<div id='disqus_thread'><p>{said}</p></div></article><section id='responses'><p>{said}</p></section><footer>Imprint</footer>",
    "<body class='has-sidebar comments-open'><nav><a href='x'>Home</a></nav><article class='related-news top'><h1>*Bridge</h1><p>*{prose}</p>"
    "<blockquote>*{prose}</blockquote><table><tr><td>*Cost</td><td>*12</td></tr></table><aside><p>{said}</p></aside></article>"
    "<div class='right-rail'><p>{said}</p></div>",
    "<div class='site-header'><p>{said}</p></div><div id='content'><h1>*Bridge</h1><p>*{prose}</p>{items}<h2>*More</h2><p>*{prose}</p></div>"
    "<div class='widget-area'><p>{said}</p></div><div class='reader-comments'><ol><li><p>{said}</p></li></ol></div>"
    "<div class='footer-links'><p>{said}</p></div>",
    "<div class='topbar'><a href='x'>Home</a></div><div><div class='post'><h2>*Bridge</h2><div class='byline'>*By A. Writer</div><p>*{prose}</p>"
    "<p>*{prose}</p>{items}</div><section class='discussion'><div class='text'><p>{said}</p></div></section></div>"
    "<div class='cookie-banner'><p>{said}</p></div>",
    "<main><h1>*Bridge</h1><p>*{prose}</p><p>*Short.</p><pre>*a b c</pre><p>*{prose}</p><section class='related'>"
    "<article class='card'><p>{said}</p></article></section></main><form class='signup'><p>{said}</p></form>",
    "<div class='page with-sidebar'><div class='entry-content'><h1>*Bridge</h1><p>*{prose}</p><p>*{prose}</p></div><aside><p>{said}</p></aside></div>",
    "<form id='all'><div class='story-body'><h1>*Bridge</h1><p>*{prose}</p><ol><li>*One</li><li>*Two</li></ol><p>*{prose}</p></div>"
    "<div class='advertisement'><p>{said}</p></div></form>",
]


def test_main_text_of_layouts_that_are_not_trained_on(spark):
    model = html.fit(spark.read.parquet(f"{SF001}/pages.parquet"))
    right = kept = due = 0
    for layout in UNSEEN:
        page = layout.format(said=SAID, prose=PROSE, items=ITEMS.replace("<li>", "<li>*"))
        blocks = [b.text for b in html.blocks_of(page)]
        expected = [t for t in blocks if t.startswith("*")]
        # The marks are only for the eye: they are cut before the page is read.
        got = html.main_text(page.replace("*", ""), *model).split("\n")
        for t in expected:
            due += 1
            if t[1:] in got:
                right += 1
        kept += len(got)
        assert SAID.strip() not in got
    assert right >= 0.95 * due and right >= 0.95 * kept


def test_pages_of_very_many_blocks_are_read_but_not_learned_from(spark):
    many = "<article>" + "<p>word</p>" * (html.N_BLOCKS + 1) + "</article>"
    pages = spark.createDataFrame([(1, many), (2, PAGE)], "page_id long, html string")
    one = html.fit(pages.where("page_id = 2"))
    model = html.fit(pages)
    assert model[0] == one[0] and np.array_equal(model[1], one[1])
    assert html.main_text(many, *model).count("\n") == html.N_BLOCKS


def pu_risk(w, xp, xu, prior):
    """(positive part, corrected negative part) of the sigmoid-loss risk, row by row."""
    loss = lambda x, y: 1 / (1 + np.exp(y * float(x @ w)))
    mean = lambda rows, y: sum(loss(x, y) for x in rows) / len(rows)
    return prior * mean(xp, 1), mean(xu, -1) - prior * mean(xp, -1)


def test_pu_step_is_the_gradient_of_the_risk():
    """Central differences of the risk, and of its negative part once that is below zero."""
    rng = np.random.default_rng(8)
    signs = set()
    for scale in (0.1, 1.0, 3.0):
        for shift in (-2.0, 0.0, 2.0):
            xp, xu = rng.normal(size=(7, 4)) + shift, rng.normal(size=(11, 4)) - shift
            w, prior = rng.normal(size=4) * scale, 0.6
            below = pu_risk(w, xp, xu, prior)[1] < 0
            signs.add(below)
            part = (lambda v: -pu_risk(v, xp, xu, prior)[1]) if below else (lambda v: sum(pu_risk(v, xp, xu, prior)))
            slope = [(part(w + d) - part(w - d)) / 2e-6 for d in np.eye(4) * 1e-6]
            assert np.allclose(toxicity.step_of(w, xp, xu, prior), slope, atol=1e-8)
    assert signs == {True, False}


def plain_toxicity(texts, labels, n_features):
    """The model from plain Python sets: every learnable distinct text counts."""
    toxic = {}
    for i, t in labels:
        if t is not None and i is not None:
            toxic[i] = max(t, toxic.get(i, 0))
    seen = {}
    for i, text in texts:
        if i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            seen.setdefault(text, []).append(toxic.get(i))
    known = {t: [x for x in v if x is not None] for t, v in seen.items()}
    pos = [t for t, v in known.items() if v and max(v)]
    prior = len(pos) / sum(bool(v) for v in known.values())
    count = lambda some: Counter(f for t in some for f in toxicity.features_of(t))
    p, u = count(pos), count(seen)
    a, b, z = len(pos), len(seen), {}
    for f, n in p.items():
        if n >= max(toxicity.MIN_POSITIVE, toxicity.MIN_POSITIVE_SHARE * a):
            share = (n + u[f]) / (a + b)
            z[f] = abs(n / a - u[f] / b) / (share * (1 - share) * (1 / a + 1 / b) + 1e-12) ** 0.5
    names = sorted((f for f in z if z[f] >= toxicity.MIN_Z), key=lambda f: (-z[f], f))[:n_features]
    at = {f: i for i, f in enumerate(names)}
    rows = lambda some: [np.array(sorted(at[f] for f in toxicity.features_of(t) if f in at), np.int64) for t in some]
    w, bias = toxicity.train(rows(pos), rows(seen), len(names), prior)
    return lambda t: 1 / (1 + np.exp(-np.clip(bias + sum(w[at[f]] for f in toxicity.features_of(t) if f in at), -40, 40)))


def test_toxicity_equals_plain_python(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", "toxic")
    score = plain_toxicity([tuple(r) for r in df.collect()], [tuple(r) for r in labels.collect()], 200)
    model = toxicity.fit(df.repartition(5), labels, n_features=200)
    assert len(model.weights) > 20
    for r in toxicity.score(df, model).collect():
        assert abs(r.score - score(r.text)) < 1e-3


def test_frequencies_come_from_all_texts_whatever_the_risk_sample(spark):
    """A risk sample of 30 texts picks the features of the full counts."""
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", "toxic")
    few, full = (toxicity.fit(df, labels, n_unlabelled=n, n_features=100) for n in (30, 9000))
    assert set(few.weights) == set(full.weights)
