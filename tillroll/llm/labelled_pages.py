"""Labelled pages for training: every element that is not main text says so, or is in one that does.

The pages are put together from parts seen on the web: a container for the
main text, and menus, headers, footers, sidebars, notices, adverts, forms and
comments around and inside it. The words do not matter to the model; markup,
lengths and links do.
"""

from __future__ import annotations

import random
import re

MAIN = 'data-label="main"'
REST = 'data-label="rest"'
_WORDS = (
    "time year people way day thing world life hand part child eye place work week case point company number "
    "group problem fact water room money story month book night home study power house"
).split()
_CONTAINERS = (
    ("<article {m}>", "</article>"),
    ('<main id="main"><article class="post" {m}>', "</article></main>"),
    ("<main {m}>", "</main>"),
    ('<div id="content" {m}>', "</div>"),
    ('<div class="content" {m}>', "</div>"),
    ('<div class="post-body entry-content" {m}>', "</div>"),
    ('<div class="article-body" {m}>', "</div>"),
    ('<div class="wrapper"><div class="main"><div class="story text" {m}>', "</div></div></div>"),
    ('<section class="article" {m}>', "</section>"),
    ('<div role="main" {m}>', "</div>"),
    ("<div {m}>", "</div>"),
    ('<div id="story" {m}>', "</div>"),
    ('<div class="page-content body" {m}>', "</div>"),
    ("<section {m}>", "</section>"),
    ('<table class="layout"><tr><td class="body" {m}>', "</td></tr></table>"),
)
_OUTSIDE = (
    "<nav {r}>{links}</nav>",
    '<div class="menu" {r}>{links}</div>',
    '<div class="nav navbar navigation" {r}>{links}</div>',
    '<div id="menu" {r}><a href="/">{short}</a> <a href="/b">{short}</a></div>',
    '<header {r}><div class="logo">{short}</div><p>{sentence}</p></header>',
    '<div id="header" class="masthead top" {r}><h1><a href="/">{short}</a></h1><span>{sentence}</span></div>',
    '<div class="breadcrumbs breadcrumb" {r}><a href="/">{short}</a> &gt; <a href="/c">{short}</a></div>',
    "<aside {r}><h3>{short}</h3><p>{sentence}</p>{links}</aside>",
    '<div class="sidebar" {r}><h3>{short}</h3><p>{paragraph}</p></div>',
    '<div id="sidebar" class="widget side" {r}><p>{sentence}</p>{links}</div>',
    '<div class="cookie-notice cookies consent" {r}><p>{sentence}</p><button>{short}</button></div>',
    '<div class="notice" {r}>{sentence}</div>',
    '<div class="notice alert message" role="alert" {r}><p>{paragraph}</p></div>',
    '<div class="banner" role="banner" {r}>{sentence}</div>',
    '<div class="ad" {r}>{sentence}</div>',
    '<div class="ads advert advertisement" {r}><a href="/x">{sentence}</a></div>',
    '<div class="sponsored promo sponsor" {r}><p>{sentence}</p></div>',
    '<form action="/s" class="search" {r}><label>{short}</label><input name="q"><button>{short}</button></form>',
    '<form class="newsletter subscribe signup" {r}><p>{sentence}</p><select><option>{short}</option></select></form>',
    '<div class="popup modal overlay" {r}><p>{sentence}</p></div>',
    '<div class="related recommended more" {r}><h3>{short}</h3>{links}</div>',
    '<div class="social share sharing" {r}><a href="/f">{short}</a><a href="/t">{short}</a></div>',
)
_AFTER = (
    '<section id="comments" {r}><h2>{short}</h2><div class="comment"><b>{short}</b><p>{paragraph}</p></div></section>',
    '<div class="comments" {r}><ol class="comment-list"><li class="comment"><p>{sentence}</p></li></ol></div>',
    '<div class="comment-thread discussion replies" {r}><div class="reply comment-body"><p>{paragraph}</p></div></div>',
    "<footer {r}>&copy; {short} &middot; {sentence}</footer>",
    '<div class="footer" {r}><p>{sentence}</p>{links}</div>',
    '<div id="footer" class="copyright bottom" role="contentinfo" {r}>{sentence}</div>',
)
_INSIDE = (
    '<div class="ad" {r}>{sentence}</div>',
    '<aside class="related" {r}>{links}</aside>',
    '<div class="share social" {r}><a href="/f">{short}</a></div>',
    '<div class="advert promo" {r}><p>{sentence}</p></div>',
    '<div class="newsletter notice" {r}><p>{sentence}</p></div>',
    '<form {r}><input><button>{short}</button></form>',
)
_COMMENTS = (
    *_AFTER[:3],
    '<section class="comments" {r}><h2>{short}</h2><p>{sentence}</p><p>{sentence}</p></section>',
    '<div class="comments-area" {r}><h3>{short}</h3><ul><li>{short}: {sentence}</li><li>{short}: {paragraph}</li></ul></div>',
    '<aside id="comments" {r}><div class="comment"><a href="/u">{short}</a><p>{paragraph}</p></div><form><button>{short}</button></form></aside>',
)
_TEXTS = (
    "<p>{paragraph}</p>",
    "<p>{paragraph}</p>",
    "<p>{paragraph}</p>",
    "<p>{sentence}</p>",
    "<p>{short}.</p>",
    "<h2>{short}</h2><p>{paragraph}</p>",
    '<p>{sentence} <a href="/r">{short}</a> {sentence}</p>',
    "<p><b>{sentence}</b><br>{sentence}</p>",
    "<p><b>{sentence}<br>",
    "<p>{short}<br>{short}</p>",
    '<p>{short} <a href="/r">{short}</a> {short}.</p>',
    '<p><a href="/r">{sentence}</a> {short}</p>',
    '<p><em>{short}</em> <span>{sentence}</span> <a href="/r"><i>{short}</i></a></p>',
    "<ul><li>{short}<li>{short}<li>{sentence}</ul>",
    "<ol><li>{short}</li><li>{paragraph}</li></ol>",
    '<ul><li><a href="/r">{short}</a> {sentence}</li></ul>',
    "<h3>{short}</h3>",
    "<dl><dt>{short}<dd>{sentence}</dl>",
    "<table><tbody><tr><td>{short}</td><td>{short}</td></tr></tbody></table>",
    "<ul><li>{sentence}</li><li>{sentence}</li></ul>",
    "<blockquote><p>{sentence}</p></blockquote>",
    "<div>{paragraph}</div>",
    "<div><p>{paragraph}</p><p>{sentence}</p></div>",
    "<section><h3>{short}</h3><p>{paragraph}</p></section>",
    "<pre>{sentence}</pre>",
    "<table><tr><th>{short}</th><td>{sentence}</td></tr></table>",
    "<figure><figcaption>{sentence}</figcaption></figure>",
)


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join(rng.choices(_WORDS, k=rng.randint(low, high))).capitalize()


def _part(rng: random.Random, form: str) -> str:
    links = "".join(f'<li><a href="/{k}">{_words(rng, 1, 3)}</a></li>' for k in range(rng.randint(2, 8)))
    filled = form.replace("{m}", MAIN).replace("{r}", REST).replace("{links}", f"<ul>{links}</ul>")
    for name, low, high in (("{short}", 1, 4), ("{sentence}", 5, 20), ("{paragraph}", 20, 120)):
        while name in filled:
            filled = filled.replace(name, _words(rng, low, high) + "." * (name != "{short}"), 1)
    return filled


def labelled_pages(n: int = 800, seed: int = 7) -> list[str]:
    """``n`` pages, the same ones for a seed."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        begin, end = rng.choice(_CONTAINERS)
        texts = [_part(rng, rng.choice(_TEXTS)) for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14)))]
        if rng.random() < 0.7:
            texts.insert(0, _part(rng, rng.choice(("<h1>{short}</h1>", "<h1>{sentence}</h1>"))))
        for _ in range(rng.choice((0, 0, 1, 2))):
            texts.insert(rng.randint(0, len(texts)), _part(rng, rng.choice(_INSIDE)))
        body = [_part(rng, rng.choice(_OUTSIDE)) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.1:  # no container: the texts are in the page itself
            body += [re.sub(r"^<(\w+)", rf"<\1 {MAIN}", text) if REST not in text else text for text in texts]
        else:
            comments = [_part(rng, rng.choice(_COMMENTS))] if rng.random() < 0.25 else []
            body += [_part(rng, begin), *texts, *comments, end]
        body += [_part(rng, rng.choice(_OUTSIDE)) for _ in range(rng.choice((0, 0, 1, 2)))]
        body += [_part(rng, rng.choice(_AFTER)) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.5:
            body = ['<div class="page container">', *body, "</div>"]
        head = f"<head><title>{_words(rng, 2, 8)}</title><style>p{{}}</style><script>var a = 1;</script></head>"
        pages.append(f"<!DOCTYPE html><html>{head}<body>{''.join(body)}</body></html>")
    return pages
