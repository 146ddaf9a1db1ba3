"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks in order.  A bidirectional LSTM in numpy reads a
tag-path vector (hashed names, classes and ids of the open elements), a hashed-word
vector and a few shares for every block of the page, so each label sees the whole
document.  It is trained on at most ``TRAIN_PAGES`` pages by hash: blocks inside an
article or main element are text, those in menus, asides, forms and the like are not,
and further boilerplate and other wrappers, with words of other pages, are built in.

Defined cases: null or empty html, and pages without text, give an empty text; broken
markup is read as far as it goes; white space is that of Unicode; repeated rows are each extracted; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textops as tx
from .sampling import sampled

TRAIN_PAGES = 130
#: Blocks of a stretch that a longer training page is cut into, and those that padded pages have together, about.
TRAIN_BLOCKS, TOGETHER = 120, 8192
HIDDEN, PATH_DIMS, WORD_DIMS, OTHER = 16, 96, 24, 8
WIDTH = PATH_DIMS + WORD_DIMS + OTHER

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<([/]?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+|[^>]*+)>|<[!?][^>]*+>", re.S)
_UNCLOSED = re.compile(r"<!--()()().*", re.S)
_ATTRS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW = frozenset("script style noscript template textarea svg iframe object select option button".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_SCOPE = frozenset("article section div main body html table ul ol dl nav aside header footer form blockquote figure".split())
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


@dataclass
class _Open:
    name: str
    words: tuple[str, ...] = field(default_factory=tuple)


#: Elements nested deeper are read as content of the one at this depth, as browsers do.
MAX_DEPTH = 512


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked, at, n, last = 0, 0, len(page), page.rfind(">")
    opened: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(w for o in stack if o.name not in _INLINE for w in (o.name, *o.words)), linked))
            parts.clear()
            linked = 0

    def pop_to(names: frozenset | set, stop: frozenset) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                for o in stack[k:]:
                    opened[o.name] -= 1
                del stack[k:]
                return
            if stack[k].name in stop:
                return

    while at < n:
        m = (_TOKEN if at <= last else _UNCLOSED).search(page, at)  # after the last > there is no tag
        text = page[at : m.start() if m else n]
        if text:
            parts.append(text)
            if opened.get("a"):
                linked += len(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE:
            flush()
        if m[1]:
            if opened.get(name):
                pop_to({name}, frozenset())
            continue
        if name in _RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            parts.append(" ")
            continue
        if name in _ENDS_P and opened.get("p"):
            pop_to({"p"}, _SCOPE)
        if name in _CLOSES and name != "p":
            pop_to(_CLOSES[name], _SCOPE)
        if name not in _VOID and not m[3].endswith("/") and len(stack) < MAX_DEPTH:
            words = tuple(dict.fromkeys(f"{name}.{w}" for a in _ATTRS.finditer(m[3]) for w in _NAME.findall((a[1] or a[2] or a[3] or "").lower()))) if m[3] else ()
            opened[name] = opened.get(name, 0) + 1
            stack.append(_Open(name, words + tuple(w.split(".")[1] for w in words)))
    flush()
    return out


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row of WIDTH numbers a block."""
    x = np.zeros((len(blocks), WIDTH), np.float32)
    for k, b in enumerate(blocks):
        for w in set(b.path):
            x[k, zlib.crc32(w.encode()) % PATH_DIMS] = 1
        words = b.text.split()
        for w in words:
            x[k, PATH_DIMS + zlib.crc32(w.lower().encode()) % WORD_DIMS] += 1 / np.sqrt(len(words))
        n = len(b.text)
        x[k, PATH_DIMS + WORD_DIMS :] = (np.log1p(n) / 6, np.log1p(len(words)) / 5, min(1, b.linked / n), sum(map(b.text.count, ".,;!?")) / len(words), k / len(blocks), len(b.path) / 10, b.text[-1] in ".!?…:\"", 1 / (1 + k))
    return x


# --- the network

@dataclass
class Labeller:
    """Weights of a forward and a backward LSTM (input and state to four gates) and of the output."""

    gates: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float

    def run(self, x: np.ndarray, real: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Log-odds (page, block) of padded vectors; keep collects what the gradients need."""
        n, steps, _ = x.shape
        both = np.zeros((n, steps, 2 * HIDDEN), np.float32)
        for d in (0, 1):
            w = self.gates[d]
            into = x.reshape(n * steps, -1) @ w[:WIDTH] + self.bias[d]
            into = into.reshape(n, steps, -1)
            h = c = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                z = into[:, t] + h @ w[WIDTH:]
                i, f, o = (1 / (1 + np.exp(-z[:, k * HIDDEN : (k + 1) * HIDDEN])) for k in range(3))
                g = np.tanh(z[:, 3 * HIDDEN :])
                on = real[:, t, None]
                c2 = np.where(on, f * c + i * g, c)
                tc = np.tanh(c2)
                h2 = np.where(on, o * tc, h)
                if keep is not None:
                    keep.append((d, t, h, c, i, f, o, g, tc))
                h, c = h2, c2
                both[:, t, d * HIDDEN : (d + 1) * HIDDEN] = h
        if keep is not None:
            keep.append(both)
        return both @ self.out + self.out_bias


def _gradients(net: Labeller, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    kept: list = []
    score = net.run(x, real, kept)
    both = kept.pop()
    d_score = np.where(real, 1 / (1 + np.exp(-score)) - y, 0) / real.sum()
    d_both = d_score[..., None] * net.out
    grads = [[np.zeros_like(w) for w in net.gates], [np.zeros_like(b) for b in net.bias]]
    state = {d: [np.zeros((len(x), HIDDEN), np.float32)] * 2 for d in (0, 1)}
    for d, t, h, c, i, f, o, g, tc in reversed(kept):
        dh, dc = state[d]
        on = real[:, t, None]
        dh_all = dh + d_both[:, t, d * HIDDEN : (d + 1) * HIDDEN]
        dh_on = np.where(on, dh_all, 0)
        dc_on = np.where(on, dc, 0) + dh_on * o * (1 - tc**2)
        dz = np.concatenate([dc_on * g * i * (1 - i), dc_on * c * f * (1 - f), dh_on * tc * o * (1 - o), dc_on * i * (1 - g**2)], axis=1)
        grads[0][d][:WIDTH] += x[:, t].T @ dz
        grads[0][d][WIDTH:] += h.T @ dz
        grads[1][d] += dz.sum(axis=0)
        state[d] = [np.where(on, dz @ net.gates[d][WIDTH:].T, dh_all), np.where(on, dc_on * f, dc)]
    return [*grads[0], *grads[1], (both * d_score[..., None]).sum(axis=(0, 1)), np.array(d_score.sum())]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, real = np.zeros((len(pages), steps, WIDTH), np.float32), np.zeros((len(pages), steps), bool)
    for k, p in enumerate(pages):
        x[k, : len(p)], real[k, : len(p)] = p, True
    return x, real


def train(pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 14, size: int = 16, rate: float = 0.02, seed: int = 5) -> Labeller:
    """Adam on the cross-entropy of block labels, pages in small batches."""
    rng = np.random.Generator(np.random.PCG64(seed))
    wide = WIDTH + HIDDEN
    draw = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
    net = Labeller([draw(wide, 4 * HIDDEN) for _ in "fb"], [np.zeros(4 * HIDDEN, np.float32) for _ in "fb"], draw(2 * HIDDEN), 0.0)
    moments: list | None = None
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), size):
            part = order[at : at + size]
            x, real = _padded([pages[k] for k in part])
            y = np.zeros(real.shape, np.float32)
            for row, k in enumerate(part):
                y[row, : len(labels[k])] = labels[k]
            grads = _gradients(net, x, real, y)
            step += 1
            params = [*net.gates, *net.bias, net.out, np.array(net.out_bias)]
            moments = moments or [(np.zeros_like(p), np.zeros_like(p)) for p in params]
            new = []
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.99 * v + 0.01 * g * g
                new.append((p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32))
            net = Labeller(new[:2], new[2:4], new[4], float(new[5]))
    return net


# --- training pages

#: Elements and words of class names that mark what is and is not main text.
_MAIN = ("article", "main")
_NOT_MAIN = ("nav", "header", "footer", "aside", "form", "head", "menu", "dialog")
_NOT_WORDS = ("ad", "ads", "advert", "banner", "sponsored", "promo", "sidebar", "widget", "related", "cookie", "notice", "consent", "popup", "newsletter", "subscribe", "share", "social", "menu", "breadcrumb", "pagination", "comments", "comment", "respond", "replies", "login", "search", "footer", "header", "copyright", "tags", "toc")
_WRAPPERS = (("<article>", "</article>"), ("<main>", "</main>"), ("<article class=\"post\">", "</article>"), ("<div class=\"content\">", "</div>"), ("<div id=\"content\" class=\"entry\">", "</div>"), ("<section class=\"story\">", "</section>"), ("<div class=\"article-body\">", "</div>"), ("<main><article>", "</article></main>"), ("<div class=\"post-content\">", "</div>"))
_BOILER = tuple(f'<div class="{w}"><p>{{t}}</p></div>' for w in _NOT_WORDS) + tuple(f'<div id="{w}">{{t}}</div>' for w in _NOT_WORDS) + (
    "<nav><ul><li><a href='/'>{w}</a></li><li><a href='/x'>{t}</a></li></ul></nav>", "<header><h2>{w}</h2><p>{t}</p></header>", "<footer><p>{t}</p></footer>", "<aside><h3>{w}</h3><p>{t}</p></aside>",
    "<aside><ul><li><a href='/y'>{t}</a></li></ul></aside>", "<form><label>{w}</label><p>{t}</p><input type='text'></form>", "<section class='comments'><h3>{w}</h3><ul><li><p>{t}</p></li><li><p>{u}</p></li></ul></section>",
    "<section class='comments'><ul><li><p>{t}</p></li></ul></section>", "<section class='comments'><p>{t}</p><p>{u}</p></section>", "<div id='comments'><ul><li><p>{u}</p></li><li><p>{t}</p></li></ul></div>", "<ul class='comments'><li>{t}</li></ul>",
    "<ol class='comment-list'><li class='comment'><p>{t}</p></li><li class='comment'><p>{u}</p></li></ol>", "<div class='comments'><div class='comment'><b>{w}</b><p>{u}</p></div></div>", "<div class='cookie-notice'><p>{t}</p></div>", "<div role='dialog'><p>{t}</p></div>", "<div class='menu'><a href='/'>{w}</a> <a href='/'>{t}</a></div>",
)


#: How a page holds what is before its main text (b), that (m) and what is after (a): most pages in a row, some in layout tables.
_LAYOUTS = ("{b}{m}{a}",) * 4 + (
    "<table><tr><td>{b}</td></tr><tr><td>{m}</td></tr><tr><td>{a}</td></tr></table>", "<table width='100%'><tr><td colspan='2'>{b}</td></tr><tr><td>{m}</td><td>{a}</td></tr><tr><td>{f}</td></tr></table>", "{b}<table><tbody><tr><td>{m}</td></tr></tbody></table>{a}{f}", "<div class='page'>{b}<div>{m}</div>{a}{f}</div>",
)
_FOOTERS = ("<footer>{t}</footer>", "<footer><p>\u00a9 {w}</p></footer>", "<div class='footer'><p>{t}</p></div>", "<footer><p>{t}</p><p><a href='/'>{w}</a></p></footer>", "<p class='copyright'>\u00a9 {w}</p>", "")


def weak_labels(blocks: list[Block]) -> np.ndarray:
    """1 for blocks in an article or main element, or one of the wrappers built in, and in nothing that marks boilerplate."""
    wrapped = {"x-main"}
    return np.array([float(any(p in _MAIN or p in wrapped for p in b.path) and not any(p in _NOT_MAIN or p in _NOT_WORDS for p in b.path)) for b in blocks], np.float32)


def training_set(pages: list[str], seed: int = 11) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Every page built anew twice, with other wrappers and more boilerplate, and some as they are; labels stand for the page's own article."""
    rng = np.random.Generator(np.random.PCG64(seed))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    plain = [[b for b in blocks_of(p) if b.text] for p in pages]
    texts = [b.text for bs in plain for b in bs]
    x, y = [], []

    def put(rows: np.ndarray, labels: np.ndarray) -> None:
        for at in range(0, len(rows), TRAIN_BLOCKS):
            x.append(rows[at : at + TRAIN_BLOCKS])
            y.append(labels[at : at + TRAIN_BLOCKS])

    for k, blocks in enumerate(plain * 2):
        labels = weak_labels(blocks)
        if not labels.any():
            continue
        if k % 5 == 0:
            put(vectors(blocks), labels)
        body = [b.text for b, l in zip(blocks, labels, strict=True) if l]
        some = lambda: html.escape(pick(texts)[: int(rng.integers(20, 400))])
        boiler = lambda: pick(_BOILER).format(w=html.escape(pick(texts)[:20]), t=some(), u=some())
        before, after = ("".join(boiler() for _ in range(int(rng.integers(0, 5)))) for _ in "ba")
        opened, closed = pick(_WRAPPERS)
        inner = []
        for k, t in enumerate(body):
            tag = pick(("h1", "h2")) if not k else pick(("p", "p", "p", "p", "p", "h2", "blockquote", "ul", "ol", "div", "pre", "figcaption", "td"))
            t = html.escape(t)
            inner.append(f"<{tag}><li>{t}</li></{tag}>" if tag in ("ul", "ol") else f"<{tag}>{t}</{tag}>")
            if rng.random() < 0.08:
                inner.append(f"<div class=\"x-not\">{boiler()}</div>")
        for k in range(int(rng.integers(0, 3))):
            inner.append(f"<div class=\"x-not\">{boiler()}</div>")
        foot = pick(_FOOTERS).format(w=html.escape(pick(texts)[:40]), t=html.escape(pick(texts)[: int(rng.integers(10, 120))]))
        if rng.random() < 0.5:
            after += foot
        page = pick(_LAYOUTS).format(b=before, m=f"<x-main>{opened}{''.join(inner)}{closed}</x-main>", a=after, f=foot)
        made = blocks_of(f"<html><head><title>{some()}</title></head><body>{page}</body></html>")
        labels = np.array([float("x-main" in b.path and "div.x" not in b.path) for b in made], np.float32)
        hidden = {"x-main", "div.x", "x", "div.not", "not"}
        put(vectors([Block(b.text, tuple(p for p in b.path if p not in hidden), b.linked) for b in made]), labels)
    return x, y


def fit_labeller(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Labeller | None:
    """Trained on at most train_pages pages by hash; None where no page has an article."""
    sample = sampled(pages.where("html is not null").select("page_id", "html"), "page_id", train_pages, ("html",)).toPandas()
    x, y = training_set(sample["html"].tolist())
    return train(x, y) if x else None


def main_text(pages: DataFrame, net: Labeller | None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "html"):
            blocks = [blocks_of(p) if p else [] for p in batch.column("html").to_pylist()]
            texts = [""] * len(blocks)
            order = [k for k in sorted(range(len(blocks)), key=lambda k: len(blocks[k])) if blocks[k]]
            while order:  # pages of like length together; a very long one alone
                size = max(1, TOGETHER // len(blocks[order[min(63, len(order) - 1)]]))
                part, order = order[: min(64, size)], order[min(64, size) :]
                x, real = _padded([vectors(blocks[k]) for k in part])
                score = shared.value.run(x, real) if shared.value is not None else np.stack([np.pad(weak_labels(blocks[k]) - 0.5, (0, real.shape[1] - len(blocks[k]))) for k in part])
                for row, k in enumerate(part):
                    texts[k] = "\n\n".join(b.text for b, s in zip(blocks[k], score[row], strict=False) if s > 0)
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
