"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: the text between block-level tags, with inline
tags dropped and character references decoded.  Scripts, styles, comments and
other unseen content never become blocks.  A bidirectional LSTM in numpy reads
the sequence of a page's blocks (hashed vectors of the tag path with its class
and id words, hashed vectors of the block's words, and a few figures) and gives
each block the probability of being main text, from the whole page's context.
It is trained on pages that a small grammar of page layouts makes below.
"""
from __future__ import annotations

import functools
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import pick
from tabclass.llm.shingles import _LOWER, word_hashes, words

# Fixed values of the HTML standard: elements by how they lay out.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style noscript template svg math head iframe object canvas audio video select textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template svg".split())
#: What may stand in a head; any other tag, or text, ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript template noframes".split())
#: Tags that end svg and math that were left open, and the elements of these that may hold HTML.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Tags that end an open paragraph, and the elements whose paragraphs end inside them.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol pre section summary table ul".split())
P_SCOPE = frozenset("button caption object table td th".split())
HOLDS_HTML = frozenset("mi mo mn ms mtext annotation-xml".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?][^>]*>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SPACE = re.compile(r"[ \t\n\r\f\v]+")
UNQUOTED_END = re.compile(r"=\s*[^\s\"'>]*/$")  # the slash belongs to an attribute's value


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of characters inside links) of the leaf blocks of a
    page, in order.  Unclosed and wrongly nested tags are tolerated."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = at = 0
    hidden = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip(" \t\n\r\f\v")
            if text:
                out.append((tuple(w for _, ws in stack for w in ws), text, min(1.0, linked / len(text))))
            parts, linked = [], 0

    def cut(i: int) -> None:
        nonlocal hidden
        hidden -= sum(x in UNSEEN for x, _ in stack[i:])
        del stack[i:]

    def add(piece: str) -> None:
        nonlocal linked
        if stack and stack[-1][0] == "head" and piece.strip(" \t\n\r\f\v"):
            cut(len(stack) - 1)
        if piece and not hidden:
            parts.append(piece)
            if links:
                linked += len(piece.strip())

    while True:
        m = TOKEN.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        closing, name, attributes = m.group(1), m.group(2), m.group(3)
        if not name:
            continue
        name = name.lower()
        if not closing and hidden:  # a head, or foreign content, that ends without its own tag
            if stack[-1][0] == "head" and name not in IN_HEAD:
                cut(len(stack) - 1)
            elif name in BREAKOUT:
                foreign = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("math", "svg")), None)
                if foreign is not None and not any(x in HOLDS_HTML for x, _ in stack[foreign:]):
                    cut(foreign)
        if name == "a":
            links = 0 if closing else 1
        if name in INLINE:
            if name == "br":
                add(" ")
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
            continue
        links = 0
        if name in ENDS_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    cut(i)
                    break
                if stack[i][0] in P_SCOPE:
                    break
        if name in VOID:
            continue
        if name in ("p", "li", "dd", "dt", "tr", "td", "th", "option"):  # a new one ends an open one
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
                if stack[i][0] in ("div", "ul", "ol", "table", "article", "section", "dl", "object"):
                    break
        named = [w.lower() for x in NAMES.findall(attributes or "") for y in x for w in NAME_WORD.findall(y)]
        if name in ("html", "head") and any(x == "head" for x, _ in stack):
            continue
        if name in ("svg", "math") and attributes.endswith("/") and not UNQUOTED_END.search(attributes):
            continue
        if name in RAW:  # its content is no markup
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if name == "svg" and not end:  # hidden until a tag that ends it
                pass
            elif name == "title" or name in UNSEEN:
                at = end.end() if end else len(page)
                continue
        stack.append((name, (name, *(f".{w}" for w in named))))
        hidden += name in UNSEEN
    flush()
    return out


# ----------------------------------------------------------------- features
PATH, WORD, FIGURES = 256, 48, 5
INPUT, HIDDEN = PATH + WORD + FIGURES, 20


@functools.lru_cache(maxsize=50_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH, dtype=np.float32)
    for i, part in enumerate(path):
        data = np.frombuffer(part.encode(), dtype=np.uint8)
        h = int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])
        out[h % PATH] += 1.0 if i >= len(path) - 8 else 0.5
    return np.minimum(out, 2)


def block_vectors(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    x = np.zeros((len(page), INPUT), dtype=np.float32)
    if not page:
        return x
    data = np.frombuffer("\n".join(t for _, t, _ in page).encode(), dtype=np.uint8)
    size = np.array([len(t.encode()) + 1 for _, t, _ in page])
    offsets = np.concatenate([[0], np.cumsum(size)])
    offsets[-1] -= 1
    start, end, row = words(_LOWER[data], offsets)
    bucket = (word_hashes(_LOWER[data], start, end) % np.uint64(WORD)).astype(np.int64)
    count = np.bincount(row, minlength=len(page))
    bag = np.bincount(row * WORD + bucket, minlength=len(page) * WORD).reshape(len(page), WORD)
    x[:, PATH : PATH + WORD] = bag / np.maximum(1, count)[:, None]
    for i, (path, text, linked) in enumerate(page):
        x[i, :PATH] = _path_vector(path)
        x[i, PATH + WORD :] = (np.log1p(count[i]) / 4, linked, text.count(",") / 5, text[-1] in ".!?:;", i / len(page))
    return x


# --------------------------------------------------------------------- LSTM
def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scan(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """One direction over time x batch x INPUT; state stays where mask is 0."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((steps, n, HIDDEN), np.float32)
    inner = x @ w + b
    for t in range(steps):
        z = inner[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        c2 = f * c + i * g
        h2 = o * np.tanh(c2)
        m = mask[t][:, None]
        if keep is not None:
            keep.append((h, c, i, f, o, g, c2, m))
        h, c = m * h2 + (1 - m) * h, m * c2 + (1 - m) * c
        out[t] = h
    return out


def _back(grad: np.ndarray, x: np.ndarray, keep: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gw, gu, gb = np.zeros((INPUT, 4 * HIDDEN), np.float32), np.zeros_like(u), np.zeros(4 * HIDDEN, np.float32)
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(keep) - 1, -1, -1):
        h, c, i, f, o, g, c2, m = keep[t]
        dh = dh + grad[t]
        new, tc = dh * m, np.tanh(c2)
        dcell = dc * m + new * o * (1 - tc * tc)
        dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), new * tc * o * (1 - o), dcell * i * (1 - g * g)], axis=1)
        gw += x[t].T @ dz
        gu += h.T @ dz
        gb += dz.sum(axis=0)
        dh = dh * (1 - m) + dz @ u.T
        dc = dc * (1 - m) + dcell * f
    return gw, gu, gb


def _batch(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded time x page arrays, the same back to front, and their mask."""
    longest = max(len(p) for p in pages)
    x, r, mask = (np.zeros((longest, len(pages), *s), np.float32) for s in ((INPUT,), (INPUT,), ()))
    for j, p in enumerate(pages):
        x[: len(p), j], r[: len(p), j], mask[: len(p), j] = p, p[::-1], 1
    return x, r, mask


def _mirror(h: np.ndarray, size: list[int]) -> np.ndarray:
    out = np.zeros_like(h)
    for j, n in enumerate(size):
        out[:n, j] = h[:n, j][::-1]
    return out


def probabilities(model: list[np.ndarray], pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of main text for every block of pages of similar length."""
    wf, uf, bf, wb, ub, bb, v, c = model
    x, r, mask = _batch(pages)
    size = [len(p) for p in pages]
    h = np.concatenate([_scan(x, mask, wf, uf, bf), _mirror(_scan(r, mask, wb, ub, bb), size)], axis=2)
    p = _sigmoid(h @ v + c)
    return [p[: len(q), j] for j, q in enumerate(pages)]


# ------------------------------------------------------------ training pages
# Words that name the parts of a page in classes and ids (fixed values).
MAIN_NAMES = "content main post entry article story body text prose page-content post-body entry-content article-body".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc tabs links".split(), "header": "header masthead topbar site-header logo branding".split(),
    "footer": "footer site-footer copyright legal bottom colophon".split(), "side": "sidebar side aside widget related recommended popular trending".split(),
    "notice": "cookie consent notice banner alert popup modal gdpr message".split(), "advert": "ad ads advert sponsor sponsored promo promotion adsense banner-ad".split(),
    "form": "form search newsletter subscribe signup login".split(), "comments": "comments comment replies discussion disqus responses reader-comments".split(),
    "share": "share social follow tags meta byline pager pagination".split(),
}


@functools.lru_cache(maxsize=1)
def _made_words(number: int = 20_000, seed: int = 12) -> list[str]:
    """Words of random letters."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("aeionrstlhdcmué"))
    return ["".join(letters[rng.integers(0, len(letters), n)]) for n in rng.integers(1, 10, number)]


def training_page(rng: np.random.Generator) -> list[tuple[tuple[str, ...], str, float, int]]:
    """Blocks with labels of one made page: main text in named, unnamed or no
    containers, in paragraphs, plain boxes or parted by line breaks."""
    known = _made_words()
    text = lambda a, b: " ".join(known[int(u)] for u in len(known) * rng.random(rng.integers(a, b)) ** 3)
    sentence = lambda a, b: text(a, b).capitalize() + rng.choice([".", ".", ".", "", "!"])
    out: list[tuple[tuple[str, ...], str, float, int]] = []
    outer: tuple[str, ...] = ("html", "body") + (("div", "." + rng.choice(["wrapper", "container", "page", "site"])) if rng.random() < 0.4 else ())

    def other(kind: str) -> None:
        names = OTHER_NAMES[kind]
        tag = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind)
        path = outer + ((tag,) if tag and rng.random() < 0.6 else (rng.choice(["div", "section", "ul"]), *(f".{w}" for w in str(rng.choice(names)).split("-"))))
        items = rng.integers(1, 8 if kind in ("menu", "side", "comments", "share") else 3)
        for _ in range(items):
            if kind in ("menu", "share"):
                out.append((path + ("ul", "li") if rng.random() < 0.8 else path, text(1, 4), 1.0, 0))
            elif kind == "comments":
                out.append((path + (rng.choice(["li", "div", "p", "article"]),), sentence(3, 40), 0.0, 0))
            elif kind == "side":
                out.append((path + (rng.choice(["h3", "li", "p", "div"]),), sentence(2, 20), float(rng.random() < 0.6), 0))
            else:
                out.append((path + (() if rng.random() < 0.6 else ("p",)), sentence(1, 25), float(rng.random() < 0.2), 0))

    def container() -> tuple[str, ...]:
        kind = rng.random()
        if kind < 0.35:
            return outer + (("main",) if rng.random() < 0.2 else ()) + ("article",)
        if kind < 0.6:
            names = str(rng.choice(MAIN_NAMES)).split("-")
            return outer + (("main",) if rng.random() < 0.2 else ()) + (str(rng.choice(["div", "section", "main"])), *(f".{w}" for w in names))
        if kind < 0.8:  # one that nothing names
            return outer + tuple(str(rng.choice(["div", "div", "div", "section", "main"])) for _ in range(rng.integers(1, 4)))
        return outer if kind < 0.92 else outer + ("table", "tr", "td")

    def main() -> None:
        path = container()
        if rng.random() < 0.65:
            out.append((path + (rng.choice(["h1", "h1", "h2"]),), text(1, 14).capitalize() + rng.choice(["", ".", ""]), 0.0, 1))
        style = rng.random()
        if style < 0.25:  # sentences parted by line breaks only
            out.extend((path, " ".join(sentence(5, 30) for _ in range(rng.integers(2, 16))), 0.0, 1) for _ in range(rng.integers(1, 3)))
            return
        part = path + (("div",) if style < 0.45 else ("p",))
        for _ in range(rng.integers(1, 16) if rng.random() < 0.8 else rng.integers(10, 40)):
            kind = rng.random()
            if kind < 0.78:
                out.append((part, sentence(1, 90 if rng.random() < 0.6 else 12), 0.0, 1))
            elif kind < 0.84:
                out.append((path + (rng.choice(["h2", "h3"]),), text(1, 8).capitalize(), 0.0, 1))
            elif kind < 0.92:
                out.extend((path + (rng.choice(["ul", "ol"]), "li"), sentence(1, 20), float(rng.random() < 0.1), 1) for _ in range(rng.integers(1, 5)))
            elif kind < 0.96:
                out.append((path + ("blockquote", "p"), sentence(3, 40), 0.0, 1))
            elif kind < 0.98:
                out.append((path + ("table", "tr", "td"), text(1, 6), 0.0, 1))
            else:  # an advert or a share bar inside the article
                names = OTHER_NAMES[str(rng.choice(["advert", "share", "side"]))]
                out.append((path + ("div", *(f".{w}" for w in str(rng.choice(names)).split("-"))), sentence(1, 12), 1.0, 0))

    before, after = rng.choice([0.0, 0.2, 0.45], 2)  # many pages have nothing but main text and a menu or a footer
    for kind in ("notice", "header", "menu", "form", "advert"):
        if rng.random() < (0.7 if kind == "menu" else before):
            other(kind)
    main()
    for kind in ("share", "advert", "comments", "side", "form", "notice", "footer"):
        if rng.random() < (0.75 if kind == "footer" else after):
            other(kind)
    return out


@functools.lru_cache(maxsize=1)
def trained(pages: int = 1800, epochs: int = 12, seed: int = 11) -> list[np.ndarray]:
    """The labeller, by Adam on the made pages (backpropagation through time);
    the running mean of the last hundred steps or so."""
    rng = np.random.default_rng(seed)
    made = [training_page(rng) for _ in range(pages)]
    xs = [block_vectors([(p, t, s) for p, t, s, _ in page]) for page in made]
    for x in xs:  # the words of some blocks are hidden: real ones are none of these
        x[rng.random(len(x)) < 0.25, PATH : PATH + WORD] = 0
    ys = [np.array([y for *_, y in page], np.float32) for page in made]
    model = [
        rng.normal(0, s, shape).astype(np.float32)
        for shape, s in (((INPUT, 4 * HIDDEN), 0.1), ((HIDDEN, 4 * HIDDEN), 0.1), ((4 * HIDDEN,), 0), ((INPUT, 4 * HIDDEN), 0.1), ((HIDDEN, 4 * HIDDEN), 0.1), ((4 * HIDDEN,), 0), ((2 * HIDDEN,), 0.1), ((1,), 0))
    ]
    first, second, mean = ([np.zeros_like(p) for p in model] for _ in range(3))
    step = 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(pages), max(1, pages // 24)):
            wf, uf, bf, wb, ub, bb, v, c = model
            x, r, mask = _batch([xs[i] for i in part])
            size = [len(xs[i]) for i in part]
            y = np.zeros_like(mask)
            for j, i in enumerate(part):
                y[: size[j], j] = ys[i]
            kf: list = []
            kb: list = []
            h = np.concatenate([_scan(x, mask, wf, uf, bf, kf), _mirror(_scan(r, mask, wb, ub, bb, kb), size)], axis=2)
            share = mask / np.sqrt(mask.sum(axis=0))  # pages of few blocks count for more than their blocks
            wrong = ((_sigmoid(h @ v + c) - y) * share / share.sum()).astype(np.float32)
            dh = wrong[:, :, None] * v
            grads = [*_back(dh[:, :, :HIDDEN], x, kf, uf), *_back(_mirror(dh[:, :, HIDDEN:], size), r, kb, ub)]
            grads += [np.einsum("tnh,tn->h", h, wrong), wrong.sum(keepdims=True).reshape(1)]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = 0.015 * (1 - epoch / epochs) + 0.0005
                model[k] = model[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                mean[k] = 0.99 * mean[k] + 0.01 * model[k]
    return [(m / (1 - 0.99**step)).astype(np.float32) for m in mean]


# -------------------------------------------------------------------- pages
#: Blocks of one padded batch.
BATCH_BLOCKS = 20_000


def main_texts(model: list[np.ndarray], pages: list[str | None]) -> list[str]:
    """Main text of each page: blocks labelled main, joined by blank lines."""
    out = [""] * len(pages)
    cut = [blocks(p) if p else [] for p in pages]
    order = sorted((i for i in range(len(pages)) if cut[i]), key=lambda i: len(cut[i]))
    while order:
        take, longest = [], 0
        while order and (not take or max(longest, len(cut[order[0]])) * (len(take) + 1) <= BATCH_BLOCKS):
            longest = max(longest, len(cut[order[0]]))
            take.append(order.pop(0))
        for i, p in zip(take, probabilities(model, [block_vectors(cut[i]) for i in take])):
            out[i] = "\n\n".join(b[1] for b, q in zip(cut[i], p) if q >= 0.5)
    return out


def main_text(page: Column) -> Column:
    """Main text of a column of HTML; empty if there is none."""
    model = trained()

    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        out: list[str] = []
        for at in range(0, len(column), 500):
            out += main_texts(model, column.slice(at, 500).to_pylist())
        return pa.array(out, pa.string())

    return extract(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.  A page that is
    null, empty, or without main text has an empty text; rows that repeat an id
    are extracted on their own; other columns are ignored."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("text", main_text(F.col("html")))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
