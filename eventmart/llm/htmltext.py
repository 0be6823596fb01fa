"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into flat blocks of text at block-level tags. A block is seen as
its word count and link density, those of its two neighbours, and whether the
innermost telling container around it is one for articles or one for menus,
adverts and the like. A decision tree trained on the labelled blocks of
``LABELLED_PAGES`` says which blocks are the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.textbytes import blocks as slices

# Scripts and the like end at their end tag or with the page. No pattern looks past the next "<"
# for the end of a tag, so a page takes time in proportion to its length.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|select|svg|iframe|title|object)\b[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:"[^"<]*"|'[^'<]*'|[^<>"'])*+)>"""
    r"|<[/!?a-zA-Z][^<>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul button".split()
)
_CONTAINER = set("article aside div dl fieldset footer form header main menu nav ol section table td ul dialog figure span button body".split())
_BOILER_TAG = set("nav footer aside form menu dialog button header".split())
_MAIN_TAG = {"article", "main"}
_BOILER_WORD = set(
    "ad ads advert advertisement sponsored promo banner sidebar side menu nav navbar navigation header footer cookie cookies "
    "consent notice popup modal overlay comment comments reply disqus share social related recommended newsletter subscribe "
    "signup breadcrumb breadcrumbs pagination login search widget toolbar copyright legal complementary contentinfo".split()
)
_MAIN_WORD = set("article main content post entry story maincontent".split())

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "boiler", "main")


def _telling(tag: str, attributes: str) -> str | None:
    """"b" or "m" if the element says what it holds."""
    words: set[str] = set()
    for found in _MARK.findall(attributes):
        words.update(re.split(r"[^a-z0-9]+", "".join(found).lower()))
    if tag in _BOILER_TAG or words & _BOILER_WORD:
        return "b"
    return "m" if tag in _MAIN_TAG or words & _MAIN_WORD else None


def text_blocks(page: str) -> list[tuple[str, int, float, bool, bool]]:
    """(text, words, link density, in boilerplate, in an article) of the blocks of text in page order."""
    found: list = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, str | None]] = []
    opened: dict[str, int] = {}
    kind: str | None = None
    links = at = 0

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            n = text.count(" ") + 1
            in_links = len(html.unescape(" ".join(linked)).split())
            found.append((text, n, min(1.0, in_links / n), kind == "b", kind == "m"))
        parts.clear()
        linked.clear()

    def take(text: str) -> None:
        if text:
            parts.append(text)
            if links:
                linked.append(text)

    for token in _TOKEN.finditer(page):
        take(page[at : token.start()])
        at = token.end()
        ending, tag = token[2], token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            close()
        elif tag == "br":
            take(" ")
        elif tag == "a":
            links = max(0, links - 1) if ending else links + 1
        if tag in _CONTAINER and tag != "span" or tag == "span" and stack and stack[-1][0] == "span":
            if not ending:
                told = _telling(tag, token[4])
                stack.append((tag, kind))
                opened[tag] = opened.get(tag, 0) + 1
                kind = told if told and not (tag == "header" and kind == "m" and told == "b") else kind
            elif opened.get(tag):
                while True:
                    open_tag, kind = stack.pop()
                    opened[open_tag] -= 1
                    if open_tag == tag:
                        break
    take(page[at:])
    close()
    return found


def features(found: list[tuple]) -> np.ndarray:
    n = len(found)
    own = np.array([b[1:5] for b in found], float).reshape(n, 4)
    around = np.zeros((n + 2, 2))
    around[1:-1] = own[:, :2]
    return np.column_stack([own[:, :2], around[:-2], around[2:], own[:, 2:]])


# Blocks that begin with "+" are the article, those with "-" are not.
LABELLED_PAGES = (
    """<body><nav><ul><li><a href="/">-Home</a></li><li><a href="/n">-News and views</a></li></ul></nav><div class="ad">-Buy two
    lamps now and pay for only one of them, this week in all our shops and on the web</div><article><h1>+Rain comes late</h1>
    <p>+The rain came late this year, and the fields along the river were dry until the second week of the month.</p><p>+Nobody
    minded.</p><p>+Farmers said that <a href="/x">the new canal</a> had carried enough water to keep the young plants alive.</p>
    <p>+Yes.</p><blockquote>+We had doubts about it for years, and then it simply worked.</blockquote></article><aside><p>-Most
    read stories of the week are listed here for all readers who missed them.</p></aside><footer>-All rights reserved</footer>""",
    """<body><header><div>-The Daily Sample</div><p>-Weather, traffic, markets and more, every hour of every day of the year</p>
    </header><main><h2>+A bridge opens</h2><p>+After four years of work the bridge was opened on a cold morning in March.</p>
    <ul><li>+It is long.</li><li><a href="/w">+It is wide.</a></li></ul><p>+Trains follow.</p><div class="comments"><p>-I have
    crossed it twice by now and I must say that it is a fine bridge for walking.</p><p>-First!</p></div></main><form>-Your
    e-mail address <button>-Send</button></form><footer><p>-Printed on paper made from trees that grew in the north, as always.
    </p></footer>""",
    """<body><div><a href="/a">-Start</a> <a href="/b">-About us</a> <a href="/c">-Contact</a></div><h1>+Old clocks keep time</h1>
    <p>+A clock that has been in the family for ninety years still loses less than a minute in a week, its owner says.</p>
    <p>+It is wound on Sundays, after breakfast, and nobody but the eldest is ever allowed to touch the key of it.</p><p>+The
    case was made of walnut in a small town, by a man whose other work was mostly doors, tables and window frames.</p>
    <div><a href="/d">-More about clocks</a></div><div><a href="/e">-Older stories from the archive</a></div><div>-Copyright
    1999</div>""",
    """<body><div class="cookie notice"><p>-We use cookies to make this site work and to count our readers, as the law lets us
    do.</p></div><div class="content"><p>+Short.</p><p>+The harbour was empty but for two boats and a dog asleep on the stones
    near the old wall.</p></div><div class="sidebar"><p>-Our authors write about harbours, boats, dogs and stones for readers
    in forty countries.</p><ul><li><a href="/1">-One</a></li><li><a href="/2">-Two</a></li></ul></div>""",
    """<body><p><a href="/l">-Log in</a></p><p>+In the hills above the lake there is a path that few people know, and fewer still
    have walked to its end in winter.</p><p>+It begins behind the mill.</p><p>+From there it climbs through pines for an hour
    before the trees give way to grass and the wind is heard.</p><p><a href="/m">-Maps</a> <a href="/s">-Shop</a></p>""",
    """<body><div class="menu"><a href="/m">-Menu</a></div><article><p>+Only this was written.</p></article>""",
    """<body><article><h1>+Two boats</h1><p>+One of them sank in the storm, and the other was painted green and sold in the spring.
    </p><p>+So it goes</p></article></body>""",
    """<body><main><p>+A page may hold one paragraph and nothing else at all, and it is still the article of that page.</p></main>""",
    """<body><div>-Page 3 of 9</div><p>+The last paragraph of a page without any marks may well be the last block of it, and long.</p>
    """,
    """<body><div>-Nothing here yet</div>""",
    """<body><div class="banner">-Shoes for all seasons and weathers</div><article><p>+It was late.</p><p>+We went home by the
    old road, as the new one was under water.</p></article><footer>-Made in a small office near the river</footer>""",
    """<body><div class="promo">-Win a trip</div><article><h1>+Bread</h1><p>+Flour, water, salt, time.</p></article>
    <div id="related">-Read next about butter and jam</div><footer>-The Bread Paper, second floor, Mill Lane 4</footer>""",
    """<body><aside>-Opinions of readers do not have to be those of this paper</aside><main><p>+Snow.</p></main><form>-Tell us
    what you think of it</form><footer>-Imprint, terms, privacy and jobs</footer>""",
    """<body><div class="notice">-This site will be closed on Sunday from noon until three</div><p>+On the last day of the year the
    bells of all nine churches were rung at the same time, which had never been done.</p><footer>-Bell News</footer>""",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1: article) of the blocks of the labelled pages."""
    xs, ys = [], []
    for page in LABELLED_PAGES:
        found = text_blocks(page)
        xs.append(features(found))
        ys += [b[0].startswith("+") for b in found]
    return np.vstack(xs), np.array(ys, int)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 5):
    """A decision tree by Gini impurity: a share of label 1, or (feature, threshold, at most, above)."""
    if depth == 0 or y.min() == y.max():
        return float(y.mean())
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            impurity = sum(2 * m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    if best is None:
        return float(y.mean())
    _, f, cut, low = best
    return f, cut, train_tree(x[low], y[low], depth - 1), train_tree(x[~low], y[~low], depth - 1)


def classify(tree, x: np.ndarray) -> np.ndarray:
    """Share of label 1 of the leaf each row falls in."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, classify(low, x), classify(high, x))


def main_text(page: str | None, tree) -> str:
    found = text_blocks(page or "")
    if not found:
        return ""
    keep = classify(tree, features(found)) >= 0.5
    return "\n\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (code points).

    White space inside a block becomes one space; blocks are joined by an empty
    line. A null or empty page, or one without an article, has an empty text.
    Pages are independent of each other: repeated rows give repeated results, an
    empty table an empty one. Other columns are not looked at.
    """
    tree = train_tree(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    key = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {key}, url string, text string, n_chars long")
