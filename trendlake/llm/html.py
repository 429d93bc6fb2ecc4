"""Main text of web pages: a linear-chain CRF over DOM leaf blocks.

A page is read by a tolerant event parser into leaf blocks: runs of text
between the starts and ends of block-level elements (inline elements and line
breaks do not end a block).  A block's features are properties of its text and
of its ancestors.  Inside the page's article (``article``, or ``main`` without
one) only ancestors below it count: the innermost one that is a menu, footer,
side text, notice, advert, comment, form or share bar by its tag or by words of
its class, id and role, and the block's own element.  What the article's own
class says, and what wraps it, is no sign against it (nor what the body's says).  Elsewhere the features
are all ancestor tags and word groups, and the innermost decisive one.  A
two-state CRF scores the chain of blocks, Viterbi decoding picks the main text.

Several articles: those without such words on or above them, if one has 40
words; otherwise also the longest that is no comment or advert.  Others (teasers,
comments) are told apart from the article by a feature.

Labelled pages: there is no table of labels, so the training set is made from
the pages themselves.  Pages whose markup names its article label themselves
(blocks inside it, outside notices, adverts, forms, comments and the like); of
all that do, and have at most ``N_BLOCKS`` blocks, a bounded sample is learned
from (``n_pages`` smallest hashes of the id).  Their texts are also laid out anew
in ``LAYOUTS``, pages in which every block's label is written next to it: with
lists, quotes and tables in the article and comments as long as its paragraphs,
most of them without an article element.  So the model also learns class names,
element kinds, text properties and the order of blocks.
Everything is learned by conditional log-likelihood; nothing of the labels is
used when a page is decoded.

Script, style, template and head content is never text; a head without end tag
ends at the body or at the first text or element that cannot stand in it.
Character references
are decoded, white space inside a block becomes one space (white space is what
``str.split`` takes for it: Unicode's, the no-break space included, and
U+001C to U+001F), blocks are joined by one line feed.

Defined cases: null and empty pages, and pages without text, give the empty
text; unclosed and stray tags are tolerated; any depth of nesting costs time in
proportion to the page; repeated rows are extracted each; other columns are
not read; pages without id are not learned from; with no page to learn from, every text block is kept.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm import crf
from trendlake.llm.common import ship_code, spread, table

N_PAGES = 100
N_BLOCKS = 2000
PROSE_WORDS = 40

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html iframe legend li main menu nav ol option "
    "p pre section select summary table tbody td textarea tfoot th thead tr ul video audio object label".split())
HIDDEN_TAGS = frozenset("head title script style template noscript svg math iframe object audio video canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What may stand in a head; a start of anything else, or text, ends an open one.
HEAD_TAGS = frozenset("html head title base basefont bgsound link meta script style template noscript noframes".split())
# A start of one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCK_TAGS - {"button", "label", "option", "select", "textarea", "canvas", "iframe", "object"}

ANCESTOR_TAGS = (
    "nav header footer aside article main section form fieldset label button select textarea ul ol li dl table td th "
    "h1 h2 h3 h4 h5 h6 p div blockquote pre figure figcaption details menu address dialog a").split()

# Word groups of class, id and role attributes.
GROUPS = {
    "content": "article post entry content story main body text prose page",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager links",
    "header": "header masthead banner hero branding logo top",
    "footer": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more popular trending tags teaser teasers",
    "notice": "cookie cookies notice consent gdpr alert popup modal overlay message warning disclaimer newsletter subscribe",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted banner",
    "comment": "comment comments commentlist reply replies respond discussion disqus reader readers reviews responses thread",
    "form": "form search login signup register contact input",
    "share": "share sharing social follow buttons",
    "byline": "byline author meta date",
}
_GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}
_WORD = re.compile(r"[a-z]+")

# Kinds that are no main text wherever they stand, most telling first, and tags that say so.
NOT_MAIN = ("comment", "advert", "notice", "form", "menu", "footer", "side", "share")
# Outside an article, elements of these kinds may hold the content (a form or a page "with-sidebar" around it all).
MAY_WRAP = (None, "form", "menu", "side", "header", "content")
KIND_OF_TAG = {"nav": "menu", "menu": "menu", "footer": "footer", "aside": "side", "form": "form", "button": "form",
               "select": "form", "textarea": "form", "dialog": "notice"}

FEATURES = ["bias", "first", "words<4", "words<12", "words>=12", "words>=40", "ends_sentence", "links>half",
            "copyright", "bar", "digits", "no_article_before", "prose_before",
            "at:article", "at:other_article", "at:page", "clean"]
FEATURES += [f"in:{t}" for t in ANCESTOR_TAGS] + [f"group:{g}" for g in GROUPS] + [f"own:{t}" for t in ANCESTOR_TAGS]
FEATURES += [f"inner:{k}" for k in NOT_MAIN] + [f"nearest:{k}" for k in (*NOT_MAIN, "header", "content")]
FEATURES += [f"article_own:{t}" for t in ANCESTOR_TAGS]
NUMBER = {f: i for i, f in enumerate(FEATURES)}


class Article:
    """An article or main element: its tag and the kind that its own words,
    or elements around it, give it (None: nothing speaks against it)."""

    __slots__ = ("tag", "kind")

    def __init__(self, tag: str, kind: str | None):
        self.tag, self.kind = tag, kind


class Block:
    """A leaf block: text, feature numbers of its ancestors, its own element,
    the article it is in, the innermost decisive kind (below the article, if it
    is in one), share of link text and, on training pages, a written label."""

    __slots__ = ("text", "above", "own", "article", "kind", "links", "label")

    def __init__(self, text: str, above: list[int], own: str, article: Article | None, kind: str | None, links: float, label):
        self.text, self.above, self.own, self.article = text, above, own, article
        self.kind, self.links, self.label = kind, links, label


class _Reader(HTMLParser):
    """Turns parser events into leaf blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple] = []          # (tag, feature numbers, hides, label, article, kind)
        self.block_tags: list[str] = []
        self.labels: list[int] = []
        self.open_tags: dict[str, int] = {}
        self.active = np.zeros(len(FEATURES), np.int64)
        self.hidden = 0
        self.parts: list[str] = []
        self.link_chars = self.chars = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                above = np.flatnonzero(self.active).tolist()
                own = self.block_tags[-1] if self.block_tags else ""
                article, kind = self.place()
                label = self.labels[-1] if self.labels else None
                self.blocks.append(Block(text, above, own, article, kind, self.link_chars / max(1, self.chars), label))
            self.parts = []
        self.link_chars = self.chars = 0

    def place(self) -> tuple:
        """The article that is open here and the innermost decisive kind."""
        return self.stack[-1][4:] if self.stack else (None, None)

    def place_in(self, tag: str, groups: set) -> tuple:
        """``place`` inside an element of ``tag`` with ``groups`` that starts here."""
        article, kind = self.place()
        words = next((k for k in NOT_MAIN if k in groups), None)
        if tag in ("article", "main") and (article is None or (tag == "article" and article.tag == "main")):
            around = kind if kind in NOT_MAIN else None
            return Article(tag, words or around), None
        found = KIND_OF_TAG.get(tag) or words
        if article is None and not found:
            found = "header" if tag == "header" or "header" in groups else None
            if not found and "content" in groups and kind in MAY_WRAP:
                found = "content"
        return article, found or kind

    def in_head(self) -> bool:
        """Directly inside a head, whose end tag may be left out."""
        return bool(self.stack) and self.stack[-1][0] == "head"

    def handle_starttag(self, tag, attrs):
        if self.open_tags.get("head") and (tag == "body" or tag not in HEAD_TAGS and self.in_head()):
            self._close("head")
        if tag in BLOCK_TAGS:
            self.flush()
            if tag in ENDS_PARAGRAPH and self.open_tags.get("p"):
                self._close("p")
            if tag in ("li", "option", "tr", "td", "th", "dt", "dd") and self.stack and self.stack[-1][0] == tag:
                self._close(tag)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        numbers = [NUMBER[f"in:{tag}"]] if f"in:{tag}" in NUMBER else []
        groups, label = set(), None
        for name, value in attrs:
            if name in ("class", "id", "role") and value and tag not in ("html", "body"):
                groups |= {_GROUP_OF[w] for w in _WORD.findall(value.lower()) if w in _GROUP_OF}
            elif name == "data-label" and value in ("0", "1"):
                label = int(value)
        numbers += [NUMBER["group:" + g] for g in groups]
        for k in numbers:
            self.active[k] += 1
        hides = tag in HIDDEN_TAGS
        self.hidden += hides
        self.stack.append((tag, numbers, hides, label, *self.place_in(tag, groups)))
        if tag in BLOCK_TAGS:
            self.block_tags.append(tag)
        if label is not None:
            self.labels.append(label)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        if self.open_tags.get(tag):
            self._close(tag)

    def _close(self, tag: str) -> None:
        """Close the innermost open ``tag`` and what is open inside it."""
        while self.stack:
            name, numbers, hides, label, _, _ = self.stack.pop()
            if name in BLOCK_TAGS:
                self.block_tags.pop()
            if label is not None:
                self.labels.pop()
            for k in numbers:
                self.active[k] -= 1
            self.hidden -= hides
            self.open_tags[name] -= 1
            if name == tag:
                return

    def handle_data(self, data):
        if self.in_head() and data.strip():
            self._close("head")
        if self.hidden:
            return
        self.parts.append(data)
        self.chars += len(data)
        if self.open_tags.get("a"):
            self.link_chars += len(data)


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks with text, in page order."""
    if not html:
        return []
    r = _Reader()
    r.feed(html)
    r.close()
    r.flush()
    return r.blocks


def main_articles(blocks: list[Block]) -> set[int]:
    """``id`` of the ``Article`` objects taken for the page's own article."""
    words, found = {}, {}
    for b in blocks:
        if b.article is not None:
            found[id(b.article)] = b.article
            words[id(b.article)] = words.get(id(b.article), 0) + (0 if b.kind else b.text.count(" ") + 1)
    plain = {k for k, a in found.items() if a.kind is None}
    if any(words[k] >= PROSE_WORDS for k in plain):
        return plain
    other = [k for k, a in found.items() if a.kind not in ("comment", "advert")] or ([] if plain else list(found))
    return plain | ({max(other, key=lambda k: words[k])} if other else set())


def block_features(blocks: list[Block]) -> list[list[int]]:
    """Feature numbers of each block; some look at the blocks before it."""
    out, article, prose = [], False, False
    chosen = main_articles(blocks)
    for k, b in enumerate(blocks):
        n = b.text.count(" ") + 1
        f = [NUMBER["bias"]]
        if id(b.article) in chosen:
            article = True
            f.append(NUMBER["at:article"])
            f.append(NUMBER[f"inner:{b.kind}" if b.kind else "clean"])
            own = f"article_own:{b.own}"
        else:
            f.append(NUMBER["at:other_article" if b.article else "at:page"])
            f += b.above
            if b.kind:
                f.append(NUMBER[f"nearest:{b.kind}"])
            own = f"own:{b.own}"
        if own in NUMBER:
            f.append(NUMBER[own])
        f.append(NUMBER["words<4" if n < 4 else "words<12" if n < 12 else "words>=12"])
        if n >= PROSE_WORDS:
            f.append(NUMBER["words>=40"])
        if k == 0:
            f.append(NUMBER["first"])
        if b.text[-1] in ".!?…\"”»":
            f.append(NUMBER["ends_sentence"])
        if b.links > 0.5:
            f.append(NUMBER["links>half"])
        if "©" in b.text or "all rights reserved" in b.text.lower():
            f.append(NUMBER["copyright"])
        if "|" in b.text or "·" in b.text:
            f.append(NUMBER["bar"])
        if b.text[:1].isdigit():
            f.append(NUMBER["digits"])
        if not article:
            f.append(NUMBER["no_article_before"])
        if prose:
            f.append(NUMBER["prose_before"])
        prose = prose or n >= PROSE_WORDS
        out.append(f)
    return out


# --- training pages --------------------------------------------------------

# Where the texts of a page go: {title}, {body} (a list of paragraphs), {rich}
# (with lists, quotes, tables), {menu} (list items), {x} (some boilerplate
# sentence) and {long} (as long as a paragraph).  data-label marks the truth.
LAYOUTS = (
    '<div class="navbar" data-label="0"><ul>{menu}</ul></div><div class="post-content" data-label="1"><h1>{title}</h1>{body}</div>'
    '<div class="sidebar" data-label="0"><h3>{x}</h3><p>{x}</p><ul>{menu}</ul></div><div id="footer" data-label="0"><p>{x}</p></div>',
    '<header data-label="0"><h2>{x}</h2><nav><ul>{menu}</ul></nav></header><main data-label="1"><h1>{title}</h1>{body}</main>'
    '<section id="comments" data-label="0"><h2>{x}</h2><div class="comment"><p>{x}</p><p>{long}</p></div></section>'
    '<footer data-label="0"><p>&copy; {x}</p><a href="/">{x}</a></footer>',
    '<div class="cookie-notice" data-label="0"><p>{x}</p><button>{x}</button></div><div id="header" data-label="0"><p>{x}</p></div>'
    '<section class="entry" data-label="1"><h2>{title}</h2>{body}</section>'
    '<form class="newsletter" data-label="0"><label>{x}</label><p>{x}</p><button>{x}</button></form><aside data-label="0"><p>{long}</p></aside>',
    '<nav data-label="0">{menu}</nav><article><header data-label="1"><h1>{title}</h1></header><div data-label="1">{body}</div>'
    '<aside class="related" data-label="0"><h4>{x}</h4><ul>{menu}</ul></aside><div class="advert" data-label="0"><p>{x}</p></div>'
    '<div data-label="1">{body}</div></article><div class="comments" data-label="0"><p>{long}</p><p>{x}</p></div><footer data-label="0">{x}</footer>',
    '<table><tr><td class="menu" data-label="0"><ul>{menu}</ul></td><td data-label="1"><h1>{title}</h1>{body}</td>'
    '<td class="sponsored" data-label="0"><p>{x}</p></td></tr></table><p class="copyright" data-label="0">&copy; {x}</p>',
    '<div data-label="0"><p>{x}</p><a href="/">{x}</a></div><div data-label="1"><h1>{title}</h1>{body}</div><div class="share" data-label="0">{x}</div>'
    '<ol class="commentlist" data-label="0"><li><p>{long}</p></li><li><p>{x}</p></li></ol><div class="alert" data-label="0">{x}</div>',
    '<header data-label="0"><h2>{x}</h2><p>{long}</p></header><article class="popular top" data-label="1"><h1>{title}</h1>{rich}'
    '<aside data-label="0"><p>{long}</p></aside><div class="comments" data-label="0"><div class="text"><p>{long}</p><ul><li>{x}</li></ul></div></div>'
    '<form data-label="0"><p>{long}</p></form><footer data-label="0"><p>{long}</p></footer></article><article class="teaser" data-label="0"><p>{x}</p></article>',
    '<div id="header" data-label="0"><p>{long}</p></div><main data-label="1"><article><h1>{title}</h1>{rich}'
    '<div class="advert" data-label="0"><p>{long}</p></div><div class="notice" data-label="0"><p>{long}</p></div>'
    '<nav data-label="0"><p>{long}</p></nav><div class="share" data-label="0"><p>{long}</p></div>{body}'
    '<article class="comment" data-label="0"><p>{long}</p></article></article></main><section class="responses" data-label="0"><p>{long}</p></section>',
    '<div class="menu" data-label="0"><ul>{menu}</ul></div><div data-label="1"><div class="story"><h1>{title}</h1>{rich}</div></div>'
    '<div class="side" data-label="0"><p>{long}</p><p>{long}</p><ul>{menu}</ul></div><div id="comments" data-label="0"><div class="content"><p>{long}</p></div></div>'
    '<footer data-label="0"><p>{long}</p><ul>{menu}</ul></footer>',
    '<div class="page" data-label="0"><header><p>{long}</p></header><div data-label="1"><h1>{title}</h1>{rich}{body}</div>'
    '<div class="promo"><p>{long}</p></div><aside><p>{long}</p><p>{x}</p></aside><div class="replies"><ul><li><p>{long}</p></li></ul></div></div>',
)


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page whose markup names its article, else None."""
    chosen = main_articles(blocks)
    return [int(id(b.article) in chosen and b.kind is None) for b in blocks] if chosen else None


def _rich(texts: list[str]) -> str:
    """Paragraphs with a list of short items, a heading, a quote and a table between them."""
    from html import escape
    words = max(texts, key=len).split()[:60]
    bits = [escape(" ".join(words[k:k + 5])) for k in range(0, len(words), 5)]
    parts = [f"<p>{escape(t)}</p>" for t in texts]
    extra = ["<ul>" + "".join(f"<li>{x}</li>" for x in bits[:6]) + "</ul>", f"<h2>{bits[0]}</h2>",
             f"<blockquote><p>{escape(texts[0])}</p></blockquote>",
             "<table>" + "".join(f"<tr><th>{x}</th><td>{x}</td></tr>" for x in bits[-3:]) + "</table>",
             "<ol>" + "".join(f"<li><p>{x}</p></li>" for x in bits[:3]) + "</ol>",
             f"<figure><figcaption>{bits[-1]}</figcaption></figure><pre>{bits[0]}</pre><dl><dt>{bits[0]}</dt><dd>{bits[-1]}</dd></dl>"]
    return "".join(p + x for p, x in zip(parts + [""] * len(extra), extra + [""] * len(parts)))


def laid_out(blocks: list[Block], labels: list[int]) -> list[str]:
    """The texts of a labelled page in each of ``LAYOUTS``."""
    from html import escape
    main = [b.text for b, y in zip(blocks, labels) if y]
    rest = [b.text for b, y in zip(blocks, labels) if not y]
    if not main or not rest:
        return []
    title, body = escape(main[0]), "".join(f"<p>{escape(t)}</p>" for t in main[1:] or main)
    menu = "".join(f'<li><a href="/x">{escape(t)}</a></li>' for t in rest[:8])
    # Nothing but their place tells these from the article: no copyright marks or bars, and as long as its paragraphs.
    short, long = (escape(re.sub("[©|·]", "", max(t, key=len)).strip()[:end]) for t, end in ((rest, 80), (main, None)))
    return [x.format(title=title, body=body, rich=_rich(main[1:] or main), menu=menu, x=short, long=long) for x in LAYOUTS]


def training_chains(pages) -> list[tuple[list[list[int]], list[int]]]:
    """(feature numbers per block, labels) of each training page."""
    chains = []
    for html in pages:
        blocks = blocks_of(html)
        labels = own_labels(blocks)
        if not labels:
            continue
        chains.append((block_features(blocks), labels))
        for page in laid_out(blocks, labels):
            own = blocks_of(page)
            if all(b.label is not None for b in own):
                chains.append((block_features(own), [b.label for b in own]))
    return chains


def train(chains, steps: int = 150, rate: float = 0.15, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """CRF weights (features, 2) and transitions from labelled pages."""
    lens = np.array([len(f) for f, _ in chains])
    starts = np.concatenate([[0], np.cumsum(lens)])
    x = np.zeros((starts[-1], len(FEATURES)))
    for row, f in enumerate(f for page, _ in chains for f in page):
        x[row, f] = 1.0
    y = np.concatenate([np.array(labels) for _, labels in chains])
    inner = np.ones(len(y), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)
    gold, gold_pair = np.eye(2)[y], np.zeros((2, 2))
    np.add.at(gold_pair, (y[at - 1], y[at]), 1.0)
    return crf.climb(x, starts, gold, gold_pair, steps, rate, l2)


def main_text(html: str | None, weights, trans: np.ndarray) -> str:
    """Main text of one page; ``weights`` as a list of pairs per feature."""
    blocks = blocks_of(html)
    if not blocks:
        return ""
    state = np.array([[sum(weights[k][0] for k in f), sum(weights[k][1] for k in f)] for f in block_features(blocks)])
    return "\n".join(b.text for b, y in zip(blocks, crf.viterbi(state, trans)) if y)


def _self_labelled(pages: DataFrame, n_pages: int) -> DataFrame:
    """page_id and html hash of the ``n_pages`` pages of the smallest hash of
    the id among all that label themselves."""
    h = F.xxhash64("page_id", F.lit(29))
    # Whatever has a block in article or main has such a tag in its text.
    able = pages.where(F.col("page_id").isNotNull() & F.col("html").rlike("(?i)<(article|main)")).select("page_id", "html")

    @F.pandas_udf("boolean")
    def labels_itself(html: pd.Series) -> pd.Series:
        from trendlake.llm import html as page
        found = (page.blocks_of(x) for x in html)
        return pd.Series([len(b) <= N_BLOCKS and page.own_labels(b) is not None for b in found], dtype=bool)

    def first(some: DataFrame) -> list:
        return (spread(some).where(labels_itself("html")).groupBy("page_id").agg(F.min(F.xxhash64("html")).alias("x"))
                .orderBy(h, "page_id").limit(n_pages).collect())

    # Pages of small hashes mostly suffice; else all pages are parsed.
    share = 4 * n_pages / max(1, able.count())
    found = first(able.where(h <= int(share * 2.0 ** 64) - 2 ** 63)) if share < 1 else []
    if len(found) < n_pages:
        found = first(able)
    return pages.sparkSession.createDataFrame([tuple(r) for r in found], "page_id long, x long")


def fit(pages: DataFrame, n_pages: int = N_PAGES):
    """CRF parameters from a bounded sample of the ``pages`` (page_id, html)
    that label themselves."""
    ship_code(pages.sparkSession)
    ids = _self_labelled(pages, n_pages)
    rows = (pages.select("page_id", "html").join(F.broadcast(ids), "page_id")
            .where(F.xxhash64("html") == F.col("x")).dropDuplicates(["page_id"]))

    def chains(batches):
        from trendlake.llm import html
        for pdf in batches:
            found = [(i, c) for i, page in zip(pdf["page_id"], pdf["html"]) for c in html.training_chains([page])]
            yield pd.DataFrame({"page_id": [i for i, _ in found], "f": [c[0] for _, c in found],
                                "y": [c[1] for _, c in found]})

    got = rows.mapInPandas(chains, "page_id long, f array<array<int>>, y array<int>").collect()
    got.sort(key=lambda r: (r["page_id"], len(r["f"]), r["f"]))
    if not got:
        return [[0.0, 1.0]] * len(FEATURES), np.zeros((2, 2))
    weights, trans = train([(r["f"], r["y"]) for r in got])
    return weights.tolist(), trans


def extract(pages: DataFrame, model, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col``."""
    ship_code(pages.sparkSession)
    weights, trans = model

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        from trendlake.llm import html as h
        return pd.Series([h.main_text(x, weights, trans) for x in html], dtype=object)

    return pages.withColumn(out_col, run(F.col(html_col)))


def op7_html(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = extract(spread(pages.select("page_id", "url", "html")), fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
