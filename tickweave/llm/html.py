"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node with two states, article or not. A node's potential comes from its own tag, names and text; an
edge potential ties it to its parent. Sum-product messages, upward from the leaves and downward from the root, give each node's
exact marginal, and the text of nodes whose marginal favours the article is the page's main text. The potentials are learned
from labelled pages. Messages of all pages of a batch are passed together, a level of depth at a time.
"""

from __future__ import annotations

import html
import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.html_pages import labelled_pages

#: Comments, elements whose content is never text of the page, tags, declarations.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|select|textarea|button|title|math|canvas|audio|video)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|<[a-zA-Z][^\s/>]*+[^>]*+>", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that an opening tag of the key closes, up to the nearest element of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}
KINDS = [{"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog", "legend"}, {"article"}, {"main"}, {"section"},
         {"h1", "h2"}, {"h3", "h4", "h5", "h6", "summary"}, {"p", "address"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tfoot", "tr"},
         {"td", "th"}, {"div", "center", "details"}, {"blockquote", "pre", "figure", "figcaption"}, {"body", "html"}, {"head"}]
VAGUE = ["div", "center", "details", "td", "th", "table", "section", "body", "html"]
#: Beginnings of the parts of class, id and role names that speak against or for the article.
AGAINST = ("nav", "menu", "sidebar", "side", "footer", "header", "masthead", "cookie", "consent", "notice", "alert", "banner", "comment", "share", "sharing", "social",
           "related", "recommend", "promo", "sponsor", "advert", "breadcrumb", "login", "signup", "subscri", "newsletter", "popup", "modal", "widget", "copyright", "contentinfo",
           "disqus", "respond", "reply", "replies", "toolbar", "pagination", "pager", "search", "complementary", "teaser", "outbrain", "legal", "disclaimer", "feedback")
AGAINST_WHOLE = frozenset("ad ads adv adsense tags meta".split())
FOR = ("content", "article", "post", "entry", "main", "story", "text", "body", "page")


def _flags(names: str) -> tuple[bool, bool]:
    parts = [p.lower() for p in _PARTS.findall(names)]
    against = any(p in AGAINST_WHOLE or p.startswith(AGAINST) for p in parts)
    return against, not against and any(p.startswith(FOR) for p in parts)


class Page:
    """Nodes of a page (parent, kind, names for and against, characters of text and in links, label) and its texts in order, each with its node."""

    def __init__(self, source: str):
        self.parent, self.tag, self.against, self.good, self.label = [-1], ["html"], [False], [False], [None]
        self.chars, self.linked = [0], [0]
        self.texts: list[tuple[int, str]] = []
        stack, run, link, last = [0], [], 0, 0

        def end_run() -> None:
            text = " ".join("".join(run).split())
            if text:
                self.texts.append((stack[-1], text))
                self.chars[stack[-1]] += len(text)
            run.clear()

        for m in _MARKUP.finditer(source):
            if m.start() > last:
                run.append(plain := html.unescape(source[last : m.start()]))
                if link:
                    self.linked[stack[-1]] += len(plain)
            last = m.end()
            tag = (m[3] or "").lower()
            if not tag:
                continue
            if tag in ("br", "hr"):
                end_run()
            elif tag == "a":
                link = 0 if m[2] else 1
            elif tag not in BLOCKS:
                continue
            elif m[2]:
                end_run()
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == tag:
                        del stack[depth:]
                        break
            else:
                end_run()
                link = 0
                if self.tag[stack[-1]] == "p":
                    stack.pop()
                shut, until = CLOSES.get(tag, ((), ()))
                for depth in range(len(stack) - 1, 0, -1):
                    if not shut or self.tag[stack[depth]] in until:
                        break
                    if self.tag[stack[depth]] in shut:
                        del stack[depth:]
                names = _NAMES.findall(m[4] or "")
                against, good = _flags(" ".join(a or b or c for k, a, b, c in names if k.lower() != "data-main"))
                self.parent.append(stack[-1])
                self.tag.append(tag)
                self.against.append(against)
                self.good.append(good)
                self.label.append(next((a or b or c for k, a, b, c in names if k.lower() == "data-main"), None))
                self.chars.append(0)
                self.linked.append(0)
                stack.append(len(self.tag) - 1)
        run.append(html.unescape(source[last:]))
        end_run()


_KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags}
assert BLOCKS == _KIND.keys(), BLOCKS ^ _KIND.keys()  # every node has a kind
_WIDTH = len(KINDS) + 8


def _features(page: Page) -> np.ndarray:
    n = len(page.tag)
    x = np.zeros((n, _WIDTH))
    x[np.arange(n), [_KIND[t] for t in page.tag]] = 1
    chars, linked = np.array(page.chars, float), np.array(page.linked, float)
    # Text and links of a node with all that lies in it; children come after their parents.
    all_chars, all_linked = chars.copy(), linked.copy()
    for i in range(n - 1, 0, -1):
        all_chars[page.parent[i]] += all_chars[i]
        all_linked[page.parent[i]] += all_linked[i]
    k = len(KINDS)
    x[:, k] = 1
    x[:, k + 1], x[:, k + 2] = page.against, page.good
    x[:, k + 3] = np.minimum(1.0, all_linked / np.maximum(all_chars, 1))
    # The amount of text speaks for elements without a meaning of their own; a paragraph follows its parent.
    vague = np.isin(page.tag, VAGUE)
    x[:, k + 4] = vague * np.log1p(np.minimum(all_chars, 2000)) / 8
    x[:, k + 5] = vague * (all_chars > 0)
    x[:, k + 6] = vague * np.log1p(np.minimum(chars, 500)) / 6
    # A header that belongs to an article is not the page's.
    within = np.zeros(n, bool)
    for i in range(1, n):
        within[i] = within[page.parent[i]] or page.tag[page.parent[i]] == "article"
    x[:, k + 7] = within & (x[:, _KIND["header"]] > 0)
    return x


def _edge_kinds(page: Page) -> np.ndarray:
    """1 for nodes whose name or tag speaks against the article, 2 for those where it speaks for it, else 0."""
    return np.array([1 if against or tag in ("nav", "menu", "header", "footer", "aside", "form", "dialog") else 2 if good or tag in ("article", "main") else 0
                     for tag, against, good in zip(page.tag, page.against, page.good, strict=True)])


class Model:
    """Weights of the node potentials; edge potentials by (kind of the child, parent's state, child's state)."""

    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        """Probability of the article state of every node, by two sweeps of messages over all pages together."""
        sizes = np.array([len(p.tag) for p in pages])
        base = np.cumsum(sizes) - sizes
        parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + b) for p, b in zip(pages, base, strict=True)])
        value = np.concatenate([_features(p) for p in pages]) @ self.weights
        own = np.stack([-value / 2, value / 2], 1)
        names = np.concatenate([_edge_kinds(p) for p in pages])
        edge = self.edges[names]  # node, parent's state, own state
        levels = [np.flatnonzero(parent < 0)]
        order = np.argsort(parent, kind="stable")
        sorted_parent = parent[order]
        while len(levels[-1]):
            low, high = np.searchsorted(sorted_parent, levels[-1]), np.searchsorted(sorted_parent, levels[-1], side="right")
            count = high - low
            levels.append(order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())])
        up = np.zeros((len(parent), 2))
        message = np.zeros((len(parent), 2))
        for level in reversed(levels[1:]):
            belief = (own[level] + up[level])[:, None, :] + edge[level]
            message[level] = np.logaddexp(belief[:, :, 0], belief[:, :, 1])
            np.add.at(up, parent[level], message[level])
        down = np.zeros((len(parent), 2))
        for level in levels[1:]:
            above = parent[level]
            rest = (own[above] + up[above] - message[level] + down[above])[:, :, None] + edge[level]
            down[level] = np.logaddexp(rest[:, 0], rest[:, 1])
        total = own + up + down
        p = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
        return np.split(p, base[1:])


def _labels(page: Page) -> np.ndarray:
    """1 inside a marked article and on the way to it, 0 elsewhere."""
    state = np.zeros(len(page.tag), np.int64)
    for i in range(len(page.tag)):
        above = state[page.parent[i]] if i else 0
        state[i] = int(page.label[i]) if page.label[i] is not None else above
    path = state.copy()
    for i in range(len(page.tag) - 1, 0, -1):
        if page.label[i] == "1" or (path[i] and not state[i]):
            path[page.parent[i]] = 1
    return path


@cache
def train(copies: int = 12, seed: int = 1, steps: int = 12, decay: float = 0.3) -> Model:
    """Node weights by logistic regression and edge potentials from counted pairs of states, on the labelled pages."""
    pages = [Page(s) for s in labelled_pages(copies, seed)]
    x, y = np.concatenate([_features(p) for p in pages]), np.concatenate([_labels(p) for p in pages]).astype(float)
    w = np.zeros(_WIDTH)
    for _ in range(steps):
        # Newton's step of the regularised likelihood.
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + decay * np.eye(_WIDTH), x.T @ (p - y) + decay * w)
    counts = np.full((3, 2, 2), 0.5)
    for page in pages:
        state, kinds = _labels(page), _edge_kinds(page)
        for i in range(1, len(page.tag)):
            counts[kinds[i], state[page.parent[i]], state[i]] += 1
    # What the pair says beyond the child alone, whose own potential holds that already.
    joint = counts / counts.sum((1, 2), keepdims=True)
    return Model(w, np.log(joint / (joint.sum(2, keepdims=True) * joint.sum(1, keepdims=True))))


def main_text(model: Model, sources: list[str]) -> list[str]:
    """Blocks in page order whose marginal favours the article, joined by one space."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    return [" ".join(text for node, text in page.texts if p[node] > 0.5) for page, p in zip(pages, model.marginals(pages), strict=True)]


def extract(pages: DataFrame, source: str = "html", batch_chars: int = 1 << 21) -> DataFrame:
    """All columns of ``pages`` but the source, ``text`` and ``n_chars`` of every row.

    A null page is empty and gives an empty text. Columns named ``text`` or ``n_chars`` are replaced; repeated rows are
    extracted alike; nothing is shuffled.
    """
    model = train()  # a few hundred weights
    own = [c for c in pages.columns if c not in (source, "text", "n_chars")]

    def run(frames):
        for frame in frames:
            sources = [s if isinstance(s, str) else "" for s in frame[source]]
            first = size = 0
            for i in range(len(sources) + 1):
                if i == len(sources) or (i > first and size + len(sources[i]) > batch_chars):
                    if i > first:
                        texts = main_text(model, sources[first:i])
                        yield frame.iloc[first:i][own].assign(text=texts, n_chars=[len(t) for t in texts])
                    first, size = i, 0
                if i < len(sources):
                    size += len(sources[i])

    kinds = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in own)
    return pages.select(*[f"`{c}`" for c in own], source).mapInPandas(run, f"{kinds}text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))
