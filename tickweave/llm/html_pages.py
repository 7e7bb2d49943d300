"""Labelled pages for the HTML model: templates whose main part is marked, filled with seeded text.

``data-main="1"`` opens the article and ``data-main="0"`` a part inside it that is not article; the marks are read as labels
and are no feature. ``{p}`` is a paragraph's text, ``{s}`` a few words, ``{n}`` a sentence, ``{l}`` a list of links.
"""

from __future__ import annotations

import numpy as np

TEMPLATES = [
    '<html><head></head><body><nav><ul>{l}</ul></nav><div class="ad">{n}</div><article data-main="1"><h1>{s}</h1><p>{p}</p><p>{p}</p><p>{n}</p></article><footer>{n}</footer></body></html>',
    '<html><body><header><h1>{s}</h1><ul>{l}</ul></header><main data-main="1"><h2>{s}</h2><p>{p}</p><blockquote><p>{n}</p></blockquote><p>{p}</p></main><aside><h3>{s}</h3><ul>{l}</ul></aside><footer><p>{n}</p></footer></body></html>',
    '<html><body><div id="header">{s}<div class="menu">{l}</div></div><div id="content" data-main="1"><h1>{s}</h1><p>{p}</p><ul><li>{n}</li><li>{n}</li></ul><p>{p}</p><div class="share" data-main="0">{l}</div></div><div id="sidebar"><p>{n}</p>{l}</div><div id="footer"><p>{n}</p></div></body></html>',
    '<html><body><div class="cookie-notice"><p>{n}</p><button>{s}</button></div><div class="wrapper"><div class="post" data-main="1"><h1>{s}</h1><div class="entry"><p>{p}</p><p>{p}</p><pre>{n}</pre></div></div><div class="comments"><h3>{s}</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{n}</p></div></div></div></body></html>',
    '<html><body><nav class="breadcrumb">{l}</nav><article data-main="1"><header><h1>{s}</h1></header><section><h2>{s}</h2><p>{p}</p></section><section><p>{p}</p><table><tr><td>{s}</td><td>{s}</td></tr></table></section><section class="comments" data-main="0"><h2>{s}</h2><p>{n}</p><p>{p}</p></section></article><footer>{l}</footer></body></html>',
    '<html><body><div class="banner"><p>{n}</p></div><form action="/search"><label>{s}</label><p>{s}</p></form><div class="story" data-main="1"><h2>{s}</h2><p>{p}</p><p>{n}</p><aside data-main="0"><p>{n}</p></aside><p>{p}</p></div><section class="newsletter"><p>{n}</p><form><p>{s}</p></form></section></body></html>',
    '<html><body><table><tr><td class="nav">{l}</td><td data-main="1"><h1>{s}</h1><p>{p}</p><p>{p}</p></td><td class="right"><div class="promo"><p>{n}</p></div></td></tr></table><div class="copyright">{n}</div></body></html>',
    '<html><body><div data-main="1"><h1>{s}</h1><p>{p}</p><p>{p}</p><div class="advert" data-main="0"><p>{n}</p></div><p>{p}</p><ol><li>{n}</li><li>{n}</li></ol></div><div class="related"><h4>{s}</h4><ul>{l}</ul></div></body></html>',
    '<html><body data-main="1"><h1>{s}</h1><p>{p}</p><p>{p}</p></body></html>',
    '<html><body data-main="1">{p}</body></html>',
    '<html><body><p data-main="1">{n}</p><p data-main="1">{p}</p></body></html>',
    '<p data-main="1">{n}<p data-main="1">{n}<br>{n}',
    '<body><nav>{l}</nav><p data-main="1">{n}</p><p data-main="1">{n}</p><div class="footer-links">{l}</div></body>',
    '<html><body><header><p>{n}</p></header><nav><ul>{l}</ul></nav><article data-main="1"><p>{n}</p><p>{n}</p></article><aside class="sidebar"><p>{p}</p></aside><footer><p>{p}</p></footer></body></html>',
    '<html><body><article data-main="1"><h1>{s}</h1><p>{n}</p><div class="comments" data-main="0"><p>{p}</p><p>{p}</p></div></article><form><p>{p}</p></form><footer>{p}</footer></body></html>',
    '<html><body><div class="notice"><p>{p}</p></div><div class="ad">{p}</div><article data-main="1"><h1>{s}</h1><p>{n}<br>{n}</p><p>{p}</p></article><section id="comments"><article><p>{p}</p></article></section></body></html>',
    '<html><body><div class="alert notice">{n}</div><main><article class="post-content" data-main="1"><h1>{s}</h1><figure><figcaption>{s}</figcaption></figure><p>{p}</p><div><p>{p}</p><p>{n}</p></div><div class="sponsored" data-main="0"><p>{n}</p></div></article><div id="respond"><form><p>{s}</p></form></div></main><div role="contentinfo"><p>{n}</p></div></body></html>',
    '<html><body><ul class="menu">{l}</ul><div class="page"><div class="main-column"><div class="text" data-main="1"><h1>{s}</h1><p>{p}</p><p>{p}</p><p>{p}</p></div><div id="disqus_thread"><p>{p}</p></div></div><div class="widget"><h3>{s}</h3><p>{n}</p></div></div><footer><div><p>{n}</p><ul>{l}</ul></div></footer></body></html>',
]
SYLLABLES = "an be ca do en fi ga ho in ja ko la mi no or pa qu re sa ti un va we xi yo za".split()


def labelled_pages(copies: int = 12, seed: int = 1) -> list[str]:
    """``copies`` fillings of every template."""
    rng = np.random.default_rng(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(rng.integers(low, high)))

    def links() -> str:
        return "".join(f'<li><a href="/x">{words(1, 4)}</a></li>' for _ in range(rng.integers(2, 8)))

    fill = {"{p}": lambda: words(15, 120) + ".", "{n}": lambda: words(5, 22 if rng.random() < 0.7 else 90) + ".", "{s}": lambda: words(1, 9), "{l}": links}
    out = []
    for _ in range(copies):
        for page in TEMPLATES:
            for mark, make in fill.items():
                while mark in page:
                    page = page.replace(mark, make(), 1)
            out.append(page)
    return out
