"""Main text of pages by layout, exactly, and the labeller against a plain loop."""
import itertools
import random

import numpy as np
import pytest

from tabclass.llm import html_text

CONTAINERS = {
    "article": ("<article>", "</article>"), "main": ("<main>", "</main>"), "id": ("<div id=content>", "</div>"), "class": ('<div class="post-body">', "</div>"),
    "role": ('<div role="main">', "</div>"), "nested": ("<div><div>", "</div></div>"), "deep": ('<div class="wrapper"><div><div>', "</div></div></div>"),
    "body": ("", ""), "section": ("<section>", "</section>"), "cell": ("<table><tr><td>", "</td></tr></table>"),
}
AROUND = {
    "bare": ("", ""),
    "menu": ("<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>", "<footer><p>Copyright 2020, all rights reserved.</p></footer>"),
    "full": (
        '<div class="cookie-banner">We use cookies.</div><header><a href=/>Daily</a></header><div class="menu"><a href=/a>World</a><a href=/b>Sport</a></div>',
        '<div class="comments"><p>Nice post, thanks.</p><p>I do not agree.</p></div><aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>More</a></li></ul></aside><div id="footer">Imprint</div>',
    ),
}


def sentences(rng, n=12):
    word = lambda: "".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(1, 9)))
    return [" ".join(word() for _ in range(rng.randint(6, 30))).capitalize() + "." for _ in range(n)]


def article(style, rng):
    s = sentences(rng)
    if style == "br":
        return "<br><br>".join(s), [" ".join(s)]
    if style == "mixed":
        return f"<h1>{s[0]}</h1>" + "".join(f"<p>{x}</p>" for x in s[1:8]) + f"<ul><li>{s[8]}</li><li>{s[9]}</li></ul><p>{s[10]}<p>{s[11]}", s
    return "".join(f"<{style}>{x}</{style}>" for x in s), s


@pytest.mark.parametrize("container, around", list(itertools.product(CONTAINERS, AROUND)))
def test_article_is_whole_in_every_layout(container, around):
    pages, want = [], []
    for style in ("p", "div", "br", "mixed"):
        text, blocks = article(style, random.Random(f"{container} {around} {style}"))
        (a, b), (c, d) = CONTAINERS[container], AROUND[around]
        pages.append(f"<html><head><title>T</title></head><body>{c}{a}{text}{b}{d}</body></html>")
        want.append("\n\n".join(blocks))
    assert html_text.main_texts(html_text.trained(), pages) == want


def test_very_long_page():
    s = sentences(random.Random(1), 4000)
    page = "<body><nav><a href=/>Home</a></nav><article>" + "".join(f"<p>{x}</p>" for x in s) + "</article><footer>Imprint</footer>"
    assert html_text.main_texts(html_text.trained(), [None, page, ""]) == ["", "\n\n".join(s), ""]


def test_probabilities_equal_a_step_loop():
    rng = np.random.default_rng(2)
    n, k = html_text.HIDDEN, html_text.INPUT
    model = [rng.normal(0, 0.3, s).astype(np.float32) for s in ((k, 4 * n), (n, 4 * n), (4 * n,), (k, 4 * n), (n, 4 * n), (4 * n,), (2 * n,), (1,))]
    pages = [rng.normal(size=(m, k)).astype(np.float32) for m in (1, 3, 7)]
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def states(x, w, u, b):
        h, c, out = np.zeros(n), np.zeros(n), []
        for row in x:
            z = row @ w + h @ u + b
            i, f, o, g = sigmoid(z[:n]), sigmoid(z[n : 2 * n]), sigmoid(z[2 * n : 3 * n]), np.tanh(z[3 * n :])
            c = f * c + i * g
            h = o * np.tanh(c)
            out.append(h)
        return np.array(out)

    for x, got in zip(pages, html_text.probabilities(model, pages)):
        both = np.concatenate([states(x, *model[:3]), states(x[::-1], *model[3:6])[::-1]], axis=1)
        assert got == pytest.approx(sigmoid(both @ model[6] + model[7]), abs=1e-4)


def test_block_tags_end_an_open_paragraph():
    paths = [p for p, _, _ in html_text.blocks("<body><p>one<div>two</div><p>three<footer>four</footer><table><tr><td><p>five<ul><li>six</table>")]
    assert paths == [("body", "p"), ("body", "div"), ("body", "p"), ("body", "footer"), ("body", "table", "tr", "td", "p"), ("body", "table", "tr", "td", "ul", "li")]
