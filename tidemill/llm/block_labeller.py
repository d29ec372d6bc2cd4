"""Main-text extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level tags, in page order.
Each block is a vector of its hashed tag path (tags, roles, and the parts of classes and ids of all
ancestors), its hashed words and a few figures. A bidirectional LSTM in numpy reads the whole sequence, and
so labels every block with the page around it in view; blocks labelled as main text are the result.

Reading a page takes one pass, whatever its markup: a block holds the set of its path's buckets as the bits of a
number, which its element hands down, and a tag whose end is not found is text. Scoring works through
the blocks in runs of bounded size, so that a page of any length needs a few numbers a block.

The network is trained here, on pages that ``sample_page`` invents with known labels; the same seed gives
the same weights.
"""

from __future__ import annotations

import html as html_lib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from . import textkernel as tk

PATH, WORDS, FIGURES = 192, 32, 8
EMBED, HIDDEN = 24, 16
#: Blocks that are turned into vectors at a time.
RUN = 8_000

OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
ENDS = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SPACE = re.compile(r"\s+")
#: Elements whose contents are not shown as text.
UNSHOWN = frozenset("script style noscript template title iframe select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay within a block; every other one begins and ends blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mstyle mspace mfenced semantics annotation svg g path text tspan use object canvas audio video".split())
#: What an opening tag closes, if it is open above the nearest container.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
CONTAINERS = frozenset("ul ol dl table div section article main aside header footer nav form blockquote body td th".split())
#: Opening one of these ends a paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


@lru_cache(maxsize=50_000)
def _bit(name: str) -> int:
    return 1 << zlib.crc32(name.encode()) % PATH


@lru_cache(maxsize=50_000)
def _names(tag: str, attributes: str) -> tuple[int, int]:
    """What an element adds to the path, its tag, role and parts of its class and id: their buckets as bits, and their number."""
    out = [tag]
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                out.append("@hidden")
        elif name == "hidden" or name == "aria-hidden":
            if name == "hidden" or value == "true":
                out.append("@hidden")
        else:
            out += [f".{p.lower()}" for p in PART.findall(value)]
    bits = 0
    for n in out:
        bits |= _bit(n)
    return bits, len(out)


class Tags:
    """Where the tags of a page end. A > between quotes ends none, a quote that nothing closes is a sign like any other, and
    a place from which no end was found is not searched from again, so that all tags together take one pass."""

    def __init__(self, page: str):
        self.page, self.last, self.lost = page, {q: page.rfind(q) for q in "\"'>"}, set()

    def end(self, at: int) -> int:
        """Behind the > that ends the tag whose name ends at a place, or -1."""
        page, seen = self.page, []
        while at <= self.last[">"] and at not in self.lost:
            seen.append(at)
            m = ENDS.search(page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.end()
            at = page.find(m[0], m.end()) + 1 if m.start() < self.last[m[0]] else m.end()
        self.lost.update(seen)
        return -1


@dataclass(slots=True)
class Element:
    """An open element: its tag, the buckets of all names of its path and their number, its depth."""

    tag: str
    bits: int
    names: int
    parent: Element | None


@dataclass(slots=True)
class Block:
    """A leaf block: the buckets of its path as bits, the number of names there, its text, and the share of it in links."""

    places: int
    names: int
    text: str
    linked: float


def _places(at: Element | None) -> tuple[int, int]:
    """Buckets of a path's names, of its last five tags and of the tag that holds the block; and the number of names."""
    if at is None:
        return _bit("bare"), 0
    bits, up = at.bits | _bit(f"leaf {at.tag}"), at
    for _ in range(5):
        bits |= _bit(f"near {up.tag}")
        up = up.parent
        if up is None:
            break
    return bits, at.names


def blocks(page: str) -> list[Block]:
    """Each leaf block with text; white space is one space."""
    out: list[Block] = []
    stack: list[Element] = []
    open_: Counter[str] = Counter()
    parts: list[str] = []
    holder: Element | None = None
    tags = Tags(page)
    closers: dict[str, re.Pattern] = {}
    linked = at = in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = SPACE.sub(" ", html_lib.unescape(raw) if "&" in raw else raw).strip(" ")
            if text:
                out.append(Block(*_places(holder), text, min(1.0, linked / max(1, len(raw)))))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked, holder
        if not text:
            return
        if not parts:
            if not text.strip():
                return
            holder = stack[-1] if stack else None
        parts.append(text)
        if in_link:
            linked += len(text)

    def pop(k: int) -> None:
        nonlocal in_link
        for e in stack[k:]:
            open_[e.tag] -= 1
            if e.tag == "a":
                in_link -= 1
            elif e.tag not in INLINE:
                flush()
        del stack[k:]

    end = len(page)
    while at < end:
        m = OPENS.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m[1]:
            close = page.find("-->", m.end())
            add(page[at : m.start()])
            at = close + 3 if close >= 0 else end
            continue
        behind = tags.end(m.end()) if m[4] else page.find(">", m.end()) + 1 if m.end() <= tags.last[">"] else -1
        if behind < 0:
            add(page[at : m.end()])
            at = m.end()
            continue
        add(page[at : m.start()])
        at = behind
        name = (m[4] or "").lower()
        if not name:
            continue
        if m[3]:
            if open_[name] > 0:
                k = len(stack) - 1
                while stack[k].tag != name:
                    k -= 1
                pop(k)
            elif name not in INLINE:
                flush()
            continue
        if name in UNSHOWN:
            closer = closers.setdefault(name, re.compile(rf"</{re.escape(name)}\s*>", re.I))
            close = closer.search(page, at)
            at = close.end() if close else end
            continue
        if name == "br":
            add(" ") if parts else None
            continue
        if name not in INLINE:
            flush()
        if name in ENDS_P or name in CLOSES:
            shut = CLOSES.get(name, {"p"})
            if any(open_[x] > 0 for x in shut):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in shut:
                        pop(k)
                    elif stack[k].tag in CONTAINERS:
                        break
        if name not in VOID and page[behind - 2] != "/":
            bits, names = _names(name, page[m.end() : behind - 1])
            above = stack[-1] if stack else None
            stack.append(Element(name, bits | (above.bits if above else 0), names + (above.names if above else 0), above))
            open_[name] += 1
            in_link += name == "a"
    flush()
    return out


@lru_cache(maxsize=50_000)
def _set_bits(places: int) -> tuple[int, ...]:
    return tuple(k for k in range(PATH) if places >> k & 1)


def vectors(run: list[Block], first: int, of: int) -> np.ndarray:
    """A row for each block of a run that begins at place first of a page of so many blocks."""
    n = len(run)
    out = np.zeros((n, PATH + WORDS + FIGURES), np.float32)
    words, size, signs, last = (np.zeros(n, np.int64) for _ in range(4))
    texts = pa.array([b.text for b in run], pa.large_string())
    for a, b, raw, off, _, _ in tk.windows(texts, 500_000):
        starts, ends, k = tk.word_spans(raw, off)
        doc = np.repeat(np.arange(b - a), k)
        place = (tk.word_hashes(raw, starts, ends) >> np.uint64(50)).astype(np.int64) % WORDS
        out[a:b, PATH : PATH + WORDS] += np.bincount(doc * WORDS + place, minlength=(b - a) * WORDS).reshape(-1, WORDS)
        words[a:b] += k
        size[a:b] += np.diff(off)
        marks = np.concatenate(([0], np.cumsum(np.isin(raw, np.frombuffer(b".,;:!?", np.uint8)))))
        signs[a:b] += marks[off[1:]] - marks[off[:-1]]
        last[a:b] = raw[off[1:] - 1]  # blocks have text
    one = np.maximum(words, 1)
    out[:, PATH : PATH + WORDS] /= one[:, None]
    out[:, PATH + WORDS] = np.log1p(words) / 4
    out[:, PATH + WORDS + 1] = np.log1p(size) / 6
    out[:, PATH + WORDS + 2] = signs / one
    out[:, PATH + WORDS + 3] = np.isin(last, np.frombuffer(b".!?", np.uint8))
    for i, b in enumerate(run):
        out[i, list(_set_bits(b.places))] = 1
        out[i, PATH + WORDS + 4] = b.linked
        out[i, PATH + WORDS + 5] = b.names / 20
    out[:, PATH + WORDS + 6] = (first + np.arange(n)) / max(1, of - 1)
    out[:, PATH + WORDS + 7] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Embedding, an LSTM in each direction, and a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        n = PATH + WORDS + FIGURES
        self.p = {"E": rng.normal(0, 0.1, (n, EMBED)), "o": rng.normal(0, 0.1, 2 * HIDDEN + EMBED), "b": np.zeros(1)}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.2, (EMBED + HIDDEN, 4 * HIDDEN))
            self.p["c" + d] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))

    def _pass(self, d: str, e: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        steps, n, _ = e.shape
        w, c0 = self.p["W" + d], self.p["c" + d]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out = np.zeros((steps, n, HIDDEN))
        given = e @ w[:EMBED] + c0
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = given[t] + h @ w[EMBED:]
            s = _sigmoid(a[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(a[:, 3 * HIDDEN :])
            new = f * c + i * g
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, new, m))
            c = m * new + (1 - m) * c
            h = m * o * np.tanh(new) + (1 - m) * h
            out[t] = h
        return out

    def embedded(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The embedding of each block of each page."""
        flat = [(b, k, len(p)) for p in pages for k, b in enumerate(p)]
        out = np.zeros((len(flat), EMBED), np.float32)
        for a in range(0, len(flat), RUN):
            part = flat[a : a + RUN]
            x = vectors([b for b, _, _ in part], 0, 1)
            x[:, PATH + WORDS + 6] = [k / max(1, n - 1) for _, k, n in part]
            out[a : a + RUN] = np.tanh(x @ self.p["E"])
        return np.split(out, np.cumsum([len(p) for p in pages])[:-1]) if pages else []

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The probability of main text for each block of each page."""
        e = self.embedded(pages)
        order = sorted(range(len(e)), key=lambda i: len(e[i]))
        out: list[np.ndarray] = [np.zeros(0)] * len(e)
        a = 0
        while a < len(order):
            b = min(len(order), a + 256)
            while b - a > 1 and len(e[order[b - 1]]) * (b - a) > RUN * 5:  # bounds the padded batch
                b = a + max(1, (b - a) // 2)
            pick = order[a:b]
            a = b
            steps = len(e[pick[-1]])
            if steps:
                given, mask = np.zeros((steps, len(pick), EMBED), np.float32), np.zeros((steps, len(pick)), np.float32)
                for k, i in enumerate(pick):
                    given[: len(e[i]), k], mask[: len(e[i]), k] = e[i], 1
                logit = given @ self.p["o"][2 * HIDDEN :] + self.p["b"][0] + self._read("f", given, mask) + self._read("b", given, mask)
                p = _sigmoid(logit)
                for k, i in enumerate(pick):
                    out[i] = p[: len(e[i]), k]
        return out

    def _read(self, d: str, e: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """What one direction adds to the output of each step; it keeps no more than the state and a run of steps."""
        w, c0 = self.p["W" + d], self.p["c" + d]
        o_w = self.p["o"][:HIDDEN] if d == "f" else self.p["o"][HIDDEN : 2 * HIDDEN]
        steps, n, _ = e.shape
        h, c, out = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros((steps, n))
        bounds = list(range(0, steps, 2048))
        for a in bounds if d == "f" else reversed(bounds):
            given = e[a : a + 2048] @ w[:EMBED] + c0
            for t in range(len(given)) if d == "f" else range(len(given) - 1, -1, -1):
                x = given[t] + h @ w[EMBED:]
                s = _sigmoid(x[:, : 3 * HIDDEN])
                new = s[:, HIDDEN : 2 * HIDDEN] * c + s[:, :HIDDEN] * np.tanh(x[:, 3 * HIDDEN :])
                m = mask[a + t][:, None]
                c = m * new + (1 - m) * c
                h = m * s[:, 2 * HIDDEN :] * np.tanh(new) + (1 - m) * h
                out[a + t] = h @ o_w
        return out

    def _forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None):
        e = np.tanh(x @ self.p["E"])
        tapes = ([], []) if keep is not None else (None, None)
        both = [self._pass(d, e, mask, tape) for d, tape in zip("fb", tapes, strict=True)]
        z = np.concatenate([*both, e], axis=2)
        p = _sigmoid(z @ self.p["o"] + self.p["b"])
        if keep is not None:
            keep |= {"e": e, "z": z, "f": tapes[0], "b": tapes[1]}
        return p, z

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the blocks that mask marks."""
        keep: dict = {}
        p, z = self._forward(x, mask, keep)
        d = (p - y) * mask / max(1, mask.sum())
        grads = {"o": np.einsum("tn,tnk->k", d, z), "b": np.asarray([d.sum()])}
        dz = d[:, :, None] * self.p["o"]
        de = dz[:, :, 2 * HIDDEN :].copy()
        for k, way in enumerate("fb"):
            w = self.p["W" + way]
            gw, gc = np.zeros_like(w), np.zeros(4 * HIDDEN)
            dh = np.zeros((x.shape[1], HIDDEN))
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, new, m in reversed(keep[way]):
                dh = dh + dz[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                th = np.tanh(new)
                dn = dc * m + dh * m * o * (1 - th * th)
                da = np.concatenate((dn * g * i * (1 - i), dn * c * f * (1 - f), dh * m * th * o * (1 - o), dn * i * (1 - g * g)), axis=1)
                gw[:EMBED] += keep["e"][t].T @ da
                gw[EMBED:] += h.T @ da
                gc += da.sum(0)
                de[t] += da @ w[:EMBED].T
                dh = da @ w[EMBED:].T + dh * (1 - m)
                dc = dn * f + dc * (1 - m)
            grads["W" + way], grads["c" + way] = gw, gc
        grads["E"] = np.tensordot(x, de * (1 - keep["e"] ** 2), axes=((0, 1), (0, 1)))
        return grads


def _padded(x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in x)
    out, mask = np.zeros((steps, len(x), PATH + WORDS + FIGURES), np.float32), np.zeros((steps, len(x)))
    for k, p in enumerate(x):
        out[: len(p), k], mask[: len(p), k] = p, 1
    return out, mask


#: Names that invented pages give to parts around the article and to wrappers of it.
AROUND = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav mainmenu pagination pager tabs toc",
    "header": "header masthead topbar branding logo banner site-header",
    "footer": "footer colophon copyright legal bottom site-footer credits",
    "aside": "sidebar widget related recommended popular trending side rail more-stories tags tagcloud",
    "div": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsense share social sharing follow cookie consent notice alert popup modal newsletter subscribe signup login paywall overlay disclaimer warning gdpr",
    "form": "form search searchform contact subscribe-form login-form poll",
    "section": "comments comment commentlist respond discussion replies reviews feedback disqus reader-comments comment-body",
}
WRAPS = "content main article post entry story body article-body entry-content post-content page-content text prose main-content hentry single blog-post".split()
NEUTRAL = "container wrapper row col inner outer clearfix page site block box grid section layout wrap module".split()


def sample_page(rng: random.Random) -> tuple[str, list[int]]:
    """An invented page and the label of each of its leaf blocks, in order."""
    stems = [["th", "er", "on", "an", "re", "ing", "ou", "ti"], ["en", "ei", "sch", "ung", "be", "ver", "ü"], ["é", "eau", "tion", "ment", "oi", "que"], ["ción", "os", "ar", "do", "ñ", "mente"]][rng.randrange(4)]
    labels: list[int] = []

    def words(low: int, high: int) -> str:
        w = ["".join(rng.choice(stems) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(low, high))]
        style = rng.random()
        if style < 0.04:
            w = [x.upper() + "!!" for x in w]
        elif style < 0.08:
            w = [x + rng.choice(["***", "###", "$$$"]) for x in w]
        return (" ".join(w).capitalize() + rng.choice([".", ".", ".", "", "!", "?", "…"])).replace("&", "&amp;")

    def inline(t: str) -> str:
        if rng.random() < 0.25:
            t = f"<{rng.choice(['b', 'em', 'strong', 'i', 'span'])}>{t}" + ("" if rng.random() < 0.3 else "</b></em></strong></i></span>")
        if rng.random() < 0.15:
            t += f' <a href="/{rng.randrange(99)}">{words(1, 4)}</a> {words(1, 6)}'
        return t + ("<br>" if rng.random() < 0.1 else "")

    def name(values: list[str]) -> str:
        kind = rng.choice(["class", "class", "id"])
        extra = f" {rng.choice(NEUTRAL)}" if rng.random() < 0.3 and kind == "class" else ""
        return f' {kind}="{rng.choice(values)}{extra}"'

    def block(tag: str, label: int, text: str) -> str:
        labels.append(label)
        return f"<{tag}>{text}" + ("" if tag in ("p", "li") and rng.random() < 0.15 else f"</{tag}>")

    def body(label: int, most: int) -> str:
        out = []
        for _ in range(rng.randrange(1, most)):
            r = rng.random()
            if r < 0.68:
                out.append(block("p", label, inline(words(1, rng.choice([4, 12, 40, 120])))))
            elif r < 0.78:
                out.append(block(rng.choice(["h2", "h3", "h4"]), label, words(1, 9)))
            elif r < 0.86:
                out.append("<ul>" + "".join(block("li", label, inline(words(1, 14))) for _ in range(rng.randrange(1, 6))) + "</ul>")
            elif r < 0.9:
                out.append("<blockquote>" + block("p", label, words(4, 40)) + "</blockquote>")
            elif r < 0.93:
                out.append(block("pre", label, words(3, 20)))
            elif r < 0.96:
                out.append("<table>" + "".join("<tr>" + block("td", label, words(1, 5)) + block("td", label, words(1, 5)) + "</tr>" for _ in range(rng.randrange(1, 4))) + "</table>")
            else:
                out.append("<figure><img src=x>" + block("figcaption", label, words(2, 12)) + "</figure>")
        return "".join(out)

    def part(kind: str) -> str:
        """Something around the article."""
        tag = kind if rng.random() < 0.6 else rng.choice(["div", "div", "section", "aside"])
        named = "" if tag == kind and kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6 else name(AROUND[kind].split())
        r = rng.random()
        if kind == "nav" or (kind in ("footer", "aside", "header") and r < 0.35):
            inside = "<ul>" + "".join(block("li", 0, f'<a href="/x">{words(1, 4)}</a>') for _ in range(rng.randrange(1, 9))) + "</ul>"
        elif kind == "form":
            inside = block("label", 0, words(1, 4)) if rng.random() < 0.3 else block("p", 0, words(1, 6))
            inside += '<input name="q">' + block("div", 0, f"<button>{words(1, 3)}</button>")
        elif kind == "section":
            inside = "".join(f'<div class="{rng.choice(["comment", "comment-body", "reply", "user-comment"])}">' + block("p", 0, words(1, 40)) + "</div>" for _ in range(rng.randrange(1, 5)))
            inside = (block("h3", 0, words(1, 3)) if rng.random() < 0.5 else "") + inside
        elif r < 0.6:
            labels.append(0)
            inside = inline(words(1, 25))
        else:
            inside = body(0, 4)
        if kind == "section" and tag == "section" and "label" in inside[:7]:
            tag = "div"
        return f"<{tag}{named}>{inside}</{tag}>"

    def some(kinds: str, chance: float) -> str:
        return "".join(part(k) for k in kinds.split() if rng.random() < chance)

    before = some("div header nav div", 0.45) if rng.random() < 0.9 else ""
    shape = rng.random()
    tag = "article" if shape < 0.45 else "main" if shape < 0.6 else "div" if shape < 0.92 else ""
    wrap = name(WRAPS) if tag == "div" or rng.random() < 0.3 else ""
    head = block("h1", 1, words(1, 12)) if rng.random() < 0.8 else ""
    if head and rng.random() < 0.2:
        head = f"<header>{head}</header>"
    main = head
    for _ in range(rng.randrange(1, 4)):
        main += body(1, 7)
        if tag and rng.random() < 0.25:
            main += part(rng.choice(["div", "aside", "form", "nav"]))
    if tag and rng.random() < 0.25:
        main += part(rng.choice(["section", "footer", "div"]))
    if tag:
        main = f"<{tag}{wrap}>{main}</{tag}>"
    if rng.random() < 0.3:
        main = f"<div{name(NEUTRAL)}>{main}</div>"
    after = some("aside section div form footer", 0.4)
    page = f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body><script>var a='<p>';</script>{before}{main}<!-- x -->{after}"
    return page + ("</body></html>" if rng.random() < 0.8 else ""), labels


@lru_cache(maxsize=2)
def trained(pages: int = 1500, epochs: int = 8, seed: int = 11) -> Network:
    """The network fitted on invented pages; equal arguments give equal weights."""
    rng = random.Random(seed)
    data = []
    while len(data) < pages:
        page, labels = sample_page(rng)
        found = blocks(page)
        if len(found) == len(labels):
            data.append((found, np.asarray(labels, float)))
    x = [vectors(d[0], 0, len(d[0])) for d in data]
    net = Network()
    moment, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step, picks, size = 0, np.random.default_rng(seed), 32
    by_length = sorted(range(pages), key=lambda i: len(x[i]))
    batches = [by_length[a : a + size] for a in range(0, pages, size)]
    for epoch in range(epochs):
        for b in picks.permutation(len(batches)):
            given, mask = _padded([x[i] for i in batches[b]])
            y = np.zeros_like(mask)
            for k, i in enumerate(batches[b]):
                y[: len(data[i][1]), k] = data[i][1]
            step += 1
            for k, g in net.gradients(given, mask, y).items():
                moment[k] += 0.1 * (g - moment[k])
                second[k] += 0.01 * (g * g - second[k])
                net.p[k] -= 0.01 * 0.75**epoch * (moment[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return net


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), network: Network | None = None) -> DataFrame:
    """The columns keep of pages with text and n_blocks, the number of leaf blocks of the page.

    Character references are decoded; white space of any kind inside a block is one space, a line break tag counts as
    one; blocks of main text are joined by two \\n. A null or empty page has no blocks and an empty text; a page of any length is read
    whole, rows that repeat are read each, and an empty table gives no rows. Columns of keep may not be named text or n_blocks; others are not read."""
    shared.ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(network or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, column = 0, batch.column("_html")
            while a < batch.num_rows:
                b, size = a, 0
                while b < batch.num_rows and b - a < 1000 and size < 4_000_000:
                    size += len(column[b].as_py() or "")
                    b += 1
                found = [blocks(p or "") for p in column[a:b].to_pylist()]
                scores = held.value.scores(found)
                texts = ["\n\n".join(x.text for x, s in zip(f, own, strict=True) if s >= 0.5) for f, own in zip(found, scores, strict=True)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(1, part.num_columns)), pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int64())], names=[*part.schema.names[1:], "text", "n_blocks"])
                a = b

    fields = [T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType())]
    return pages.select(F.col(html_col).cast("string").alias("_html"), *keep).mapInArrow(run, T.StructType([*pages.select(*keep).schema.fields, *fields]))


def op3_block_labeller(spark, sf_dir):
    """The main text of every page."""
    out = extract(shared.table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES = {"op3_block_labeller": op3_block_labeller}
ORACLES: dict[str, str] = {}
