"""Labelled pages from which the extractor learns its weights, built from rules instead of kept as files."""

from __future__ import annotations

import random

_SYLLABLES = ["ka", "lo", "mi", "ter", "an", "es", "ou", "ri", "ven", "du", "sha", "pol"]


def _words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n))


def labelled_pages(n: int = 120, seed: int = 11) -> list[tuple[str, list[str]]]:
    """Pages and the text of their main blocks, over several layouts that the web knows."""
    pages = []
    for k in range(n):
        r = random.Random(seed * 1000 + k)
        w = lambda low, high, r=r: _words(r, r.randint(low, high))
        links = lambda m, r=r: "".join(f'<li><a href="/{i}">{_words(r, r.randint(1, 3))}</a></li>' for i in range(m))
        blocks = [w(1, 9)] + [w(8, 90) if r.random() < 0.7 else w(1, 6) for _ in range(r.randint(2, 12))]
        inner = f"<h1>{blocks[0]}</h1>" + "".join(
            r.choice([f"<h2>{b}</h2>", f"<p>{b}</p>", f"<ul><li>{b}</li></ul>", f"<blockquote><p>{b}</p></blockquote>", f"<table><tr><td>{b}</td></tr></table>", f"<div>{b}</div>", f"<figure><img src=x><figcaption>{b}</figcaption></figure>", f"<pre>{b}</pre>", f"<section><h3>{b}</h3></section>"]) if len(b.split()) < 7 else f"<p><b>{b}<br>" if r.random() < 0.1 else f"<p>{b}</p>" if r.random() < 0.8 else f"<p>{b[: len(b) // 2]}<em>{b[len(b) // 2 :]}</em></p>" for b in blocks[1:]
        )
        if r.random() < 0.3:
            cut = inner.find("</p>") + 4
            inner = inner[:cut] + f'<div class="ad">{w(2, 20)}</div>' + inner[cut:] if cut > 3 else inner
        before = [f"<nav><ul>{links(r.randint(3, 9))}</ul></nav>", f"<div class=menu><a href=x>{w(1, 3)}</a> <a href=y>{w(1, 3)}</a></div>", f"<header><p>{w(3, 12)}</p></header>"]
        between = [f'<div class="ad">{w(4, 14)}.</div>', f"<div>{w(3, 8)}</div>", f"<p>{w(2, 6)}</p>", f"<aside><h3>{w(1, 3)}</h3><p>{w(8, 30)}</p></aside>", ""]
        after = [f"<footer>&copy; {w(4, 14)}</footer>", f"<div>{w(4, 20)}</div><footer><p>{w(5, 20)}</p></footer>", f"<section><h3>{w(1, 3)}</h3><p>{w(5, 25)}</p></section>", f"<form><label>{w(2, 5)}</label><input></form><p>{w(5, 15)}</p>"]
        open_, close = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="post-body">', "</div>"), ("<main><article>", "</article></main>")])
        page = f"<!DOCTYPE html><html><head><title>{blocks[0]}</title></head><body>{''.join(r.sample(before, r.randint(1, 3)))}{r.choice(between)}{open_}{inner}{close}{''.join(r.sample(after, r.randint(1, 2)))}</body></html>"
        pages.append((page, blocks))
    return pages
