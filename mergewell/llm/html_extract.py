"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: the text between block-level tags, with the path of open elements and
their class and id words.  Tags are read by HTML's attribute rules: a quote opens a string only where a
value begins.  Hashed vectors of the path and of the words, with a few lengths, go through a bidirectional
LSTM in numpy, which labels every block main or boilerplate with the whole page in view.
The model is trained on the driver on page layouts made here by rule (menus, adverts, notices, forms,
side bars, comments, with and without telling tags), so its size and cost are fixed and no page's text is
needed to fit it.

Scale: one narrow pass; a worker holds a batch of pages and the weights (some 100 kB).  Cutting is linear
in the page however deep its elements: an open element carries the hashed path above it as one
integer.  A page of very many blocks is labelled in slices, so its vectors never stand in memory at once.

Defined results: null html is an empty page; a page without main blocks has an empty text; unclosed
elements end with the page, an unclosed script or comment swallows the rest as browsers do; a quoted
value that never ends is read as an unquoted one, and a tag that never ends is text, so neither loses any;
repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_BUCKETS = 64
WORD_BUCKETS = 24
NUMBERS = 6
INPUT = PATH_BUCKETS + WORD_BUCKETS + NUMBERS
HIDDEN = 20

#: Where markup may begin, and a whole tag: attributes are names with an optional value, quoted or not.
_MARKUP = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+|))?+)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"(?:^|[\s/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = frozenset(("script", "style", "template", "noscript", "svg", "iframe", "textarea", "head"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
#: Opening one of these ends an open paragraph.
_ENDS_P = frozenset("p div ul ol li table article aside section nav header footer main form h1 h2 h3 h4 h5 h6 blockquote pre hr dl dd dt figure fieldset address details".split())
_SPACE = re.compile(r"\s+")


#: Without an end tag these take the rest of the page; the others are then passed over.
_SWALLOWS = frozenset(("script", "style", "textarea"))


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(r"</head\s*>|<body\b" if tag == "head" else rf"</{re.escape(tag)}\s*>", re.I)


class Block:
    """A leaf block: its text, the buckets of its path as bits, and how much of it stands in links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: int, linked: int):
        self.text, self.path, self.linked = text, path, linked


_PART = re.compile(r"[a-z]+")


@lru_cache(maxsize=20_000)
def _step_bits(tag: str, words: str) -> int:
    """Buckets of an element's name and of its class, id and role words."""
    bits = 1 << crc32(tag.encode(errors="replace")) % PATH_BUCKETS
    for w in _PART.findall(words):
        bits |= 1 << crc32(b"." + w.encode()) % PATH_BUCKETS
    return bits


class _Open:
    """The open elements; each knows its path's bits and the paragraph or item that a new one would end."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.bits = [0]
        self.ends: list[tuple[int, int]] = []  # places of the p and the li with only inline elements above
        self.count: dict[str, int] = {}

    def push(self, tag: str, bits: int) -> None:
        place = len(self.tags)
        p, li = self.ends[-1] if self.ends and tag in _INLINE else (-1, -1)
        self.ends.append((place if tag == "p" else p, place if tag == "li" else li))
        self.tags.append(tag)
        self.bits.append(self.bits[-1] | bits)
        self.count[tag] = self.count.get(tag, 0) + 1

    def cut(self, place: int) -> None:
        while len(self.tags) > place:
            self.count[self.tags.pop()] -= 1
            self.bits.pop()
            self.ends.pop()

    def end(self, tag: str) -> None:
        """An end tag closes all down to its element, and nothing if there is none."""
        if self.count.get(tag):
            place = len(self.tags) - 1
            while self.tags[place] != tag:
                place -= 1
            self.cut(place)

    def begin(self, tag: str) -> None:
        """What a block element ends implicitly."""
        if self.ends:
            p, li = self.ends[-1]
            place = max(p, li) if tag == "li" else p
            if place >= 0:
                self.cut(place)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order; white space inside a block is one space, and empty blocks go."""
    out: list[Block] = []
    opened = _Open()
    held: list[str] = []
    linked = at = 0
    unclosed: set[str] = set()  # raw elements whose end does not come any more
    tag_at = _TAG

    def close() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", _html.unescape("".join(held))).strip()
            if text:
                out.append(Block(text, opened.bits[-1], linked))
            held.clear()
        linked = 0

    def read(text: str) -> None:
        nonlocal linked
        if text:
            held.append(text)
            if opened.count.get("a"):
                linked += len(text)

    n = len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if not m:
            read(page[at:])
            break
        start = m.start()
        read(page[at:start])
        if m[0] == "<!--":
            end = page.find("-->", start + 2)
            at = n if end < 0 else end + 3
            continue
        if m[0][1] in "!?":
            end = page.find(">", start)
            if end < 0:
                read(page[start:])
                break
            at = end + 1
            continue
        m = tag_at.match(page, start)
        if not m:
            # Its end lies beyond the page: from here on a tag ends at the next bracket, so that each is read once.
            tag_at = _PLAIN_TAG
            m = tag_at.match(page, start) if page.find(">", start) >= 0 else None
            if not m:
                read(page[start:])
                break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag not in _INLINE:
                close()
            opened.end(tag)
            continue
        if tag not in _INLINE:
            close()
        if tag in _RAW:
            end = None if tag in unclosed else _raw_end(tag).search(page, at)
            if end:
                at = end.end() if end[0][1] == "/" else end.start()
            elif tag in _SWALLOWS:
                at = n
            else:
                unclosed.add(tag)
            continue
        if tag == "br":
            held.append(" ")
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in _ENDS_P:
            opened.begin(tag)
        words = "" if tag in _INLINE else " ".join(x for found in _ATTRIBUTE.findall(m[3]) for x in found if x)
        opened.push(tag, 0 if tag in _INLINE else _step_bits(tag, words.lower()[:2000]))
    close()
    return out


def _hashed(word: str) -> int:
    return crc32(word.lower().encode(errors="replace")) % WORD_BUCKETS


#: Words of usual length are remembered; longer ones are hashed each time, so that the memory is bounded.
_remembered = lru_cache(maxsize=200_000)(_hashed)


@lru_cache(maxsize=20_000)
def _path_vector(bits: int) -> np.ndarray:
    return np.array([bits >> i & 1 for i in range(PATH_BUCKETS)], np.float32)


def features(blocks: list[Block], first: int = 0, last: int | None = None) -> np.ndarray:
    """A row for each block from ``first`` up to ``last``: hashed path, hashed words (unit length), and lengths."""
    chosen = blocks[first:last]
    x = np.zeros((len(chosen), INPUT), np.float32)
    for i, b in enumerate(chosen):
        x[i, :PATH_BUCKETS] = _path_vector(b.path)
        words = b.text.split(" ")
        counts = np.bincount([_remembered(w) if len(w) < 64 else _hashed(w) for w in words], minlength=WORD_BUCKETS)
        x[i, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = counts / max(1.0, float(np.sqrt((counts**2).sum())))
        n = len(b.text)
        x[i, -NUMBERS:] = (np.log1p(n) / 8, np.log1p(len(words)) / 6, min(1.0, b.linked / n), b.text[-1] in ".!?", (first + i) / max(1, len(blocks) - 1), sum(c in "|©·»›" for c in b.text[:80]) > 0)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """A bidirectional LSTM with a logistic output for every step, on padded batches ``(T, B, D)``."""

    def __init__(self, inputs: int = INPUT, hidden: int = HIDDEN, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for side in "fb":
            self.p["x" + side] = rng.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden)).astype(np.float32)
            self.p["h" + side] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
            self.p["b" + side] = np.zeros(4 * hidden, np.float32)
            self.p["b" + side][hidden : 2 * hidden] = 1
        self.p["o"] = rng.normal(0, 0.1, 2 * hidden).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        steps, batch, _ = x.shape
        k = self.hidden
        z_all = x @ self.p["x" + side] + self.p["b" + side]
        h, c = np.zeros((batch, k), np.float32), np.zeros((batch, k), np.float32)
        hs, trail = np.zeros((steps, batch, k), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = z_all[t] + h @ self.p["h" + side]
            i, f, o = _sigmoid(z[:, :k]), _sigmoid(z[:, k : 2 * k]), _sigmoid(z[:, 2 * k : 3 * k])
            g = np.tanh(z[:, 3 * k :])
            on = mask[t][:, None]
            new = f * c + i * g
            tc = np.tanh(new)
            if keep:
                trail.append((t, h, c, i, f, o, g, tc, on))
            c = np.where(on, new, c)
            h = np.where(on, o * tc, h)
            hs[t] = h
        return hs, trail

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(s, x, mask, False)[0] for s in "fb"], axis=2)
        return _sigmoid(both @ self.p["o"] + self.p["c"])

    def scores_in_slices(self, blocks: list[Block], size: int = 4096) -> np.ndarray:
        """Scores of one page, its vectors made for ``size`` blocks at a time, once for each direction."""
        n, k = len(blocks), self.hidden
        total = np.full(n, self.p["c"][0], np.float32)
        for d, side in enumerate("fb"):
            h, c = np.zeros(k, np.float32), np.zeros(k, np.float32)
            recur, out = self.p["h" + side], self.p["o"][d * k : (d + 1) * k]
            begins = range(0, n, size)
            for begin in begins if side == "f" else reversed(begins):
                z = features(blocks, begin, begin + size) @ self.p["x" + side] + self.p["b" + side]
                for t in range(len(z)) if side == "f" else range(len(z) - 1, -1, -1):
                    row = z[t] + h @ recur
                    gate = _sigmoid(row[: 3 * k])
                    c = gate[k : 2 * k] * c + gate[:k] * np.tanh(row[3 * k :])
                    h = gate[2 * k :] * np.tanh(c)
                    total[begin + t] += h @ out
        return _sigmoid(total)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {s: self._run(s, x, mask, True) for s in "fb"}
        both = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        d = (_sigmoid(both @ self.p["o"] + self.p["c"]) - y) * mask / max(1, mask.sum())
        g = {"o": np.einsum("tb,tbk->k", d, both), "c": np.array([d.sum()], np.float32)}
        k = self.hidden
        for n, side in enumerate("fb"):
            out = d[:, :, None] * self.p["o"][n * k : (n + 1) * k]
            gx, gh, gb = (np.zeros_like(self.p[a + side]) for a in "xhb")
            dh, dc = np.zeros((x.shape[1], k), np.float32), np.zeros((x.shape[1], k), np.float32)
            for t, h, c, i, f, o, cell, tc, on in reversed(runs[side][1]):
                dh = dh + out[t]
                live = dh * on
                dnew = dc * on + live * o * (1 - tc**2)
                dz = np.concatenate([dnew * cell * i * (1 - i), dnew * c * f * (1 - f), live * tc * o * (1 - o), dnew * i * (1 - cell**2)], axis=1)
                gx += x[t].T @ dz
                gh += h.T @ dz
                gb += dz.sum(0)
                dh = dz @ self.p["h" + side].T + dh * ~on
                dc = dnew * f + dc * ~on
            g |= {"x" + side: gx, "h" + side: gh, "b" + side: gb}
        return g


def batched(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(1, max((len(p) for p in pages), default=1))
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        mask[: len(p), i] = True
    return x, mask


class _Layouts:
    """Pages with known main blocks, in invented words."""

    def __init__(self, seed: int = 20):
        self.rng = np.random.default_rng(seed)
        parts = ["ka", "lo", "men", "ti", "ra", "sel", "vo", "pin", "dur", "es", "an", "or", "ith", "qua"]
        self.vocabulary = ["".join(self.rng.choice(parts, self.rng.integers(1, 4))) for _ in range(600)]

    def words(self, low: int, high: int) -> str:
        return " ".join(self.rng.choice(self.vocabulary, self.rng.integers(low, high + 1)))

    def sentence(self) -> str:
        return self.words(1, 18).capitalize() + "."

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.integers(1, 6)))

    def pick(self, *options: str) -> str:
        return str(self.rng.choice(options))

    def page(self) -> tuple[str, list[bool]]:
        """Markup, and whether each of its leaf blocks is main text."""
        r, pick = self.rng, self.pick
        out: list[str] = []
        labels: list[bool] = []

        def add(markup: str, *main: bool) -> None:
            out.append(markup)
            labels.extend(main)

        def menu(outer: str) -> None:
            n = int(r.integers(2, 9))
            add(f"<{outer}><ul>" + "".join(f'<li><a href="/x">{self.words(1, 2)}</a></li>' for _ in range(n)) + f"</ul></{outer.split(' ')[0]}>", *[False] * n)

        def side(outer: str, prose: bool) -> None:
            n = int(r.integers(1, 4))
            inner = [self.paragraph() if prose else self.words(1, 12) for _ in range(n)]
            p = pick("p", "div", "") if n == 1 else pick("p", "div")
            add(f"<{outer}>" + "".join(f"<{p}>{t}</{p}>" if p else t for t in inner) + f"</{outer.split(' ')[0]}>", *[False] * n)

        if r.random() < 0.8:
            menu(pick("nav", "nav", 'div class="menu"', 'div id="navigation"', 'header class="site-header"', 'div class="breadcrumb"'))
        if r.random() < 0.3:
            side(pick("header", 'div class="header"', 'div id="top"'), False)
        advert = ('div class="ad"', 'div class="advert"', 'div class="ads banner"', 'aside class="sponsored"', 'div id="ad-top"', 'section class="promo"')
        notice = ('div class="cookie-notice"', 'div class="notice"', 'div role="alert"', 'div id="consent"', 'div class="newsletter subscribe"')
        if r.random() < 0.6:
            side(pick(*advert), True)
        if r.random() < 0.3:
            side(pick(*notice), bool(r.random() < 0.6))
        main = pick("article", "article", "main", 'div class="content"', 'div id="article-body"', 'div class="post entry"', "div")
        deep = r.random() < 0.2
        add(("<section>" if deep else "") + f"<{main}>")
        if r.random() < 0.8:
            add(f"<h1>{self.words(2, 12)}</h1>", True)
        for _ in range(int(r.choice([1, 2, 3, 5, 8, 14, 25]))):
            kind = r.random()
            if kind < 0.72:
                add(f"<p>{pick('', '', '<b>')}{self.paragraph()}{pick('</p>', '</p>', '<br>')}", True)
            elif kind < 0.80:
                add(f"<{'h2'}>{self.words(1, 8)}</h2>", True)
            elif kind < 0.86:
                n = int(r.integers(1, 5))
                add("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(n)) + "</ul>", *[True] * n)
            elif kind < 0.91:
                add(f"<blockquote>{self.paragraph()}</blockquote>", True)
            elif kind < 0.95:
                side(pick(*advert), True)
            else:
                add(f'<p>{self.words(3, 9)} <a href="/y">{self.words(1, 4)}</a> {self.sentence()}</p>', True)
        add(f"</{main.split(' ')[0]}>" + ("</section>" if deep else ""))
        if r.random() < 0.3:
            n = int(r.integers(1, 5))
            box = pick('div class="comments"', 'section id="comments"', 'div class="reader-comments discussion"', 'ol class="comment-list"')
            item = pick("p", "div", "li")
            add(f"<{box}>" + "".join(f'<{item} class="comment">{self.paragraph()}</{item}>' for _ in range(n)) + f"</{box.split(' ')[0]}>", *[False] * n)
        if r.random() < 0.35:
            side(pick("aside", 'div class="sidebar"', 'aside class="related"', 'div id="sidebar"', 'div class="widget"'), bool(r.random() < 0.5))
        if r.random() < 0.25:
            n = int(r.integers(1, 4))
            add("<form>" + "".join(f"<div>{self.words(1, 5)}</div>" for _ in range(n)) + "</form>", *[False] * n)
        if r.random() < 0.8:
            side(pick("footer", "footer", 'div class="footer"', 'div id="foot"', 'div class="copyright"'), bool(r.random() < 0.5))
        shut = pick("</body></html>", "</body></html>", "")
        return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(out) + shut, labels


def train(pages: int = 700, rounds: int = 14, seed: int = 20) -> BiLstm:
    """The labeller, fitted with Adam on ``pages`` made layouts; the same weights every time."""
    made = _Layouts(seed)
    data = []
    for _ in range(pages):
        markup, labels = made.page()
        blocks = blocks_of(markup)
        if len(blocks) == len(labels):
            data.append((features(blocks), np.array(labels, np.float32)))
    model = BiLstm(seed=seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    rng = np.random.default_rng(seed)
    step = 0
    for r in range(rounds):
        order = rng.permutation(len(data))
        for i in range(0, len(order), 32):
            chosen = [data[j] for j in order[i : i + 32]]
            x, mask = batched([c[0] for c in chosen])
            y = np.zeros(mask.shape, np.float32)
            for j, (_, labels) in enumerate(chosen):
                y[: len(labels), j] = labels
            step += 1
            rate = 0.01 if r < rounds * 2 // 3 else 0.003
            for k, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


#: Blocks of a batch of pages; a page of more is labelled alone, in slices.
STEPS = 20_000


def main_text(pages: list[str], model: BiLstm, limit: float = 0.5) -> list[str]:
    """Main texts, pages of like length labelled together."""
    cut = [blocks_of(p) for p in pages]
    order = sorted(range(len(pages)), key=lambda i: len(cut[i]))
    out = [""] * len(pages)

    def write(i: int, scores: np.ndarray) -> None:
        out[i] = "\n".join(b.text for b, s in zip(cut[i], scores) if s >= limit)

    at = 0
    while at < len(order):
        size = max(1, min(256, STEPS // max(1, len(cut[order[min(at + 255, len(order) - 1)]]))))
        group = order[at : at + size]
        at += size
        if len(cut[group[-1]]) > STEPS:
            for i in group:
                write(i, model.scores_in_slices(cut[i]))
            continue
        scores = model.scores(*batched([features(cut[i]) for i in group]))
        for j, i in enumerate(group):
            write(i, scores[:, j])
    return out


def extract_main_text(pages: DataFrame, model: BiLstm | None = None) -> DataFrame:
    """``page_id, url, text, n_chars``, a row per row of ``pages``."""
    model = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = main_text(part.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
