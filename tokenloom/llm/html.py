"""Main text of web pages by a recurrent block labeller.

1. A page is cut into leaf blocks: runs of text between block-level tags, with the path of open elements.  Comments, scripts and styles
   hold no text.  Unclosed and misnested tags are repaired as browsers do for the usual cases.
2. A block is a vector: the sum of learned vectors of its path (hashed tag names and words of class, id and role), the mean of learned vectors of
   its hashed words, and a few measures.  A bidirectional LSTM reads all blocks of a page and labels each one, so a block is judged by the
   whole page around it, whatever its length.  The text is that of the blocks labelled main, in page order.
3. The labeller is trained here by back-propagation, on a sample of at most ``SAMPLE`` different pages of at most ``LONGEST`` characters.  Their blocks are labelled by the
   elements that say what they are (``article``, ``nav`` ...); each page is also laid out anew ``LAYOUTS`` times, with other elements and class names
   around its text and with menus, notices, adverts, forms, sidebars and reader comments from texts of other pages, so that the labeller does
   not rest on one way of writing pages.

Pages are labelled one by one within tasks; only the trained weights (under a megabyte, whatever the input) are sent to them.

Edge cases: null and empty pages have an empty text; a page cut off in a tag or a comment ends there; repeated rows get equal results; an
empty table gives an empty one; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import column, in_parts, map_arrow

SAMPLE, LONGEST, LAYOUTS = 256, 50_000, 3
TRAINED_BLOCKS = 160
PATHS, WORDS, WIDTH, MEASURES, HIDDEN = 4_096, 4_096, 16, 5, 24
EPOCHS, RATE, DECAY, PAGES_A_STEP = 10, 0.01, 1e-3, 32
#: Characters of pages held as objects at once, and blocks (with padding) labelled at once.
PART, AT_ONCE = 4 << 20, 16_384
#: A path is described by its outermost and innermost elements.
OUTER, INNER = 4, 12

# Elements of HTML by how they lay out text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = ("script", "style", "template", "iframe", "noembed", "noframes", "svg", "math", "object", "canvas")
#: An opening tag ends the open elements of the second set, up to one of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_NO_PARAGRAPH = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form header hr main menu nav ol p pre section table ul".split()
) | set(_HEADINGS)
_SCOPES = frozenset("html body div section article main aside nav header footer td th li blockquote form fieldset figure button".split())

_TAG = re.compile(
    # A quote opens a value only after an equals sign; one that never ends is a character like others.
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|([^>]*)(?:>|\Z))", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|data-main)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*(?:>|\Z)", re.I) for t in HIDDEN_TEXT}
MAIN_TAGS = frozenset(("article", "main"))
ASIDE_TAGS = frozenset("nav header footer aside form head title button select noscript".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement banner sponsored sponsor promo nav navbar menu breadcrumb header footer sidebar aside cookie notice consent "
    "popup newsletter subscribe comment comments share social related form login widget copyright".split()
)


@dataclass
class Block:
    text: str
    path: list[int]
    linked: int
    main: bool


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % size


@lru_cache(maxsize=1 << 14)
def _element(tag: str, attributes: str) -> tuple[tuple[int, ...], bool, bool, bool]:
    """Buckets of an element's names; whether it is marked, or holds main text or text beside it by its own word."""
    tokens, names, marked = [f"<{tag}>"], set(), False
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "data-main":
            marked = True
            continue
        words = [w.lower() for w in _NAME.findall(entities.unescape(value))[:16]]
        names.update(words)
        tokens += [f".{w}" for w in words]
    aside = tag in ASIDE_TAGS or bool(names & ASIDE_NAMES) and tag not in ("html", "body")
    return tuple(_bucket(t, PATHS) for t in tokens), marked, tag in MAIN_TAGS, aside


def blocks(page: str, marked: bool = False) -> list[Block]:
    """The leaf blocks of a page in order, those without text left out; ``main`` is as its elements say, or as they are ``marked``."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...], bool, bool]] = []
    count: dict[str, int] = {}
    text: list[str] = []
    linked = 0

    def push(tag: str, attributes: str) -> None:
        names, mark, main, aside = _element(tag, attributes)
        before = (stack[-1][2], stack[-1][3]) if stack else (False, False)
        stack.append((tag, names, before[0] or (mark if marked else main), before[1] or (aside and not marked)))
        count[tag] = count.get(tag, 0) + 1

    def pop() -> None:
        count[stack.pop()[0]] -= 1

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                shown = stack if len(stack) <= OUTER + INNER else stack[:OUTER] + stack[-INNER:]
                path = [n for _, names, _, _ in shown for n in names]
                inner = next((t for t, *_ in reversed(shown) if t not in INLINE), "")
                path.append(_bucket(f"in {inner}", PATHS))
                top = stack[-1] if stack else ("", (), False, False)
                out.append(Block(whole, path, linked, top[2] and not top[3]))
            text.clear()
        linked = 0

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            piece = page[at:end]
            text.append(piece)
            if count.get("a"):
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            if count.get(tag):
                inner = len(stack) - 1
                while stack[inner][0] != tag and (tag not in INLINE or stack[inner][0] in INLINE):
                    inner -= 1
                if stack[inner][0] == tag:  # else an inline element that a block inside it outlives
                    while len(stack) > inner:
                        pop()
            continue
        attributes = m[3] if m[3] is not None else m[4] or ""
        if tag in HIDDEN_TEXT:
            if tag not in INLINE:
                flush()
            if not attributes.endswith("/"):
                close = _RAW_END[tag].search(page, at)
                at = close.end() if close else len(page)
            continue
        if tag not in INLINE:
            flush()
            if tag in _NO_PARAGRAPH and count.get("p"):
                _close(stack, pop, {"p"}, _SCOPES)
            if tag in CLOSES:
                _close(stack, pop, *CLOSES[tag])
        if tag not in VOID and not attributes.endswith("/"):
            push(tag, attributes)
    flush()
    return out


def _close(stack: list, pop: Callable[[], None], what: set[str], until: frozenset | set) -> None:
    """Close the outermost element of ``what`` above the innermost of ``until``."""
    depth = None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in what:
            depth = i
        elif stack[i][0] in until:
            break
    if depth is not None:
        while len(stack) > depth:
            pop()


# --- the labeller -------------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def _word(word: str) -> int:
    return _bucket(word, WORDS)


def _measures(b: Block) -> list[float]:
    n = len(b.text)
    ends = b.text[-1] in ".!?…。।" or b.text[-1:] in "\"')"
    return [np.log1p(n) / 5, min(1.0, b.linked / n), float(ends), sum(map(b.text.count, ".,;:")) / (n / 40 + 1), float(n < 30)]


@dataclass
class Batch:
    """Blocks of several pages; ``at`` places block i at (step, page) of a padded grid."""

    paths: np.ndarray
    path_of: np.ndarray
    words: np.ndarray
    word_of: np.ndarray
    measures: np.ndarray
    steps: np.ndarray
    pages: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray

    @property
    def size(self) -> int:
        return len(self.steps)


def batch_of(pages: Sequence[Sequence[Block]]) -> Batch:
    every = [b for p in pages for b in p]
    words = [[_word(w) for w in b.text.lower().split()] for b in every]
    lengths = np.array([len(p) for p in pages])
    numbers = np.arange(len(every))
    starts = np.cumsum(lengths) - lengths
    page = np.repeat(np.arange(len(pages)), lengths)
    flat = lambda lists: np.fromiter((x for one in lists for x in one), np.int64)
    return Batch(
        flat(b.path for b in every), np.repeat(numbers, [len(b.path) for b in every]),
        flat(words), np.repeat(numbers, [len(w) for w in words]),
        np.array([_measures(b) for b in every], np.float32).reshape(-1, MEASURES),
        numbers - starts[page], page, lengths, np.array([b.main for b in every], np.float32),
    )


Weights = dict[str, np.ndarray]


def new_weights(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    inputs = 2 * WIDTH + MEASURES

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.normal(size=shape) * scale).astype(np.float32)

    w = {"paths": normal(PATHS, WIDTH, scale=0.3), "words": normal(WORDS, WIDTH, scale=0.1)}
    for side in ("forth", "back"):
        w[f"{side}_in"] = normal(inputs, 4 * HIDDEN, scale=inputs**-0.5)
        w[f"{side}_on"] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
        w[f"{side}_bias"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)  # the forget gate starts open
    w["out"] = normal(2 * HIDDEN, scale=HIDDEN**-0.5)
    w["direct"] = normal(inputs, scale=inputs**-0.5)
    w["bias"] = np.zeros(1, np.float32)
    return w


def _sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by block; ``of`` is ascending."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(of):
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        out[of[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def _inputs(w: Weights, b: Batch) -> tuple[np.ndarray, np.ndarray]:
    number = np.maximum(np.bincount(b.word_of, minlength=b.size), 1).astype(np.float32)[:, None]
    parts = [_sums(w["paths"][b.paths], b.path_of, b.size), _sums(w["words"][b.words], b.word_of, b.size) / number, b.measures]
    return np.hstack(parts), number


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _walk(x: np.ndarray, mask: np.ndarray, on: np.ndarray, keep: list | None) -> np.ndarray:
    """An LSTM over ``x`` (steps, pages, 4 * HIDDEN), whose inputs are multiplied already; masked steps change nothing."""
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
    for t in range(len(x)):
        z = x[t] + h @ on
        i, f, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN :])
        new = f * c + i * g
        tanh = np.tanh(new)
        m = mask[t][:, None]
        if keep is not None:
            keep.append((i, f, o, g, c, tanh, h, m))
        c, h = np.where(m, new, c), np.where(m, o * tanh, h)
        out[t] = h
    return out


def _back(d_out: np.ndarray, kept: list, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the multiplied inputs and of ``on``."""
    dx = np.zeros((*d_out.shape[:2], 4 * HIDDEN), np.float32)
    d_on = np.zeros_like(on)
    dh, dc = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
    for t in reversed(range(len(d_out))):
        i, f, o, g, before, tanh, h, m = kept[t]
        dh = dh + d_out[t]
        step_h, step_c = np.where(m, dh, 0), np.where(m, dc, 0)
        step_c = step_c + step_h * o * (1 - tanh**2)
        dz = np.hstack([step_c * g * i * (1 - i), step_c * before * f * (1 - f), step_h * tanh * o * (1 - o), step_c * i * (1 - g**2)])
        dx[t] = dz
        d_on += h.T @ dz
        dh = np.where(m, 0, dh) + dz @ on.T
        dc = np.where(m, step_c * f, dc)
    return dx, d_on


def _grids(b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The mask of a padded grid, and the steps of blocks forth and back."""
    longest = int(b.lengths.max(initial=0))
    mask = np.arange(longest)[:, None] < b.lengths[None, :]
    return mask, b.steps, b.lengths[b.pages] - 1 - b.steps


def scores(w: Weights, b: Batch, kept: dict | None = None) -> np.ndarray:
    """Log odds of each block being main text."""
    x, number = _inputs(w, b)
    mask, forth, back = _grids(b)
    total = x @ w["direct"] + w["bias"]
    for k, (side, steps) in enumerate((("forth", forth), ("back", back))):
        grid = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
        grid[steps, b.pages] = x @ w[f"{side}_in"] + w[f"{side}_bias"]
        states = [] if kept is not None else None
        h = _walk(grid, mask, w[f"{side}_on"], states)[steps, b.pages]
        total = total + h @ w["out"][k * HIDDEN : (k + 1) * HIDDEN]
        if kept is not None:
            kept[side] = (states, h, steps)
    if kept is not None:
        kept.update(x=x, number=number, mask=mask)
    return total


def gradients(w: Weights, b: Batch) -> tuple[float, Weights]:
    """Mean cross entropy of the labels and its gradient, by back-propagation through time."""
    kept: dict = {}
    z = scores(w, b, kept)
    p = _sigmoid(z)
    loss = float(np.mean(np.logaddexp(0, z) - b.labels * z))
    d = ((p - b.labels) / b.size).astype(np.float32)
    x = kept["x"]
    g: Weights = {"bias": np.array([d.sum()]), "direct": x.T @ d, "out": np.zeros_like(w["out"])}
    dx = np.outer(d, w["direct"])
    for k, side in enumerate(("forth", "back")):
        states, h, steps = kept[side]
        part = slice(k * HIDDEN, (k + 1) * HIDDEN)
        g["out"][part] = h.T @ d
        d_out = np.zeros((*kept["mask"].shape, HIDDEN), np.float32)
        d_out[steps, b.pages] = np.outer(d, w["out"][part])
        grid, g[f"{side}_on"] = _back(d_out, states, w[f"{side}_on"])
        dz = grid[steps, b.pages]
        g[f"{side}_in"], g[f"{side}_bias"] = x.T @ dz, dz.sum(axis=0)
        dx += dz @ w[f"{side}_in"].T
    g["paths"], g["words"] = np.zeros_like(w["paths"]), np.zeros_like(w["words"])
    np.add.at(g["paths"], b.paths, dx[b.path_of, :WIDTH])
    np.add.at(g["words"], b.words, (dx[:, WIDTH : 2 * WIDTH] / kept["number"])[b.word_of])
    return loss, g


def _without_words(b: Batch, rng: np.random.Generator) -> Batch:
    """Half of the blocks without their words, so that no text is learned by heart."""
    kept = (rng.random(b.size) < 0.5)[b.word_of]
    return replace(b, words=b.words[kept], word_of=b.word_of[kept])


def train(pages: list[list[Block]], seed: int = 7, epochs: int = EPOCHS) -> Weights:
    """Weights fitted to the labels of the blocks, by Adam over pages in turn."""
    w, rng = new_weights(seed), np.random.default_rng(seed)
    pages = [p for p in pages if 0 < len(p) <= TRAINED_BLOCKS]
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    order = np.argsort([len(p) for p in pages], kind="stable")
    groups = [batch_of([pages[i] for i in order[at : at + PAGES_A_STEP]]) for at in range(0, len(order), PAGES_A_STEP)]
    turn, turns = 0, epochs * len(groups)
    for _ in range(epochs):
        for i in rng.permutation(len(groups)):
            turn += 1
            _, g = gradients(w, _without_words(groups[i], rng))
            norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            rate = RATE * (1 - 0.9 * turn / turns)
            for k, v in g.items():
                v = v / max(1.0, norm) + (DECAY * w[k] if k == "words" else 0)
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return w


def label(w: Weights, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text; pages of like length are labelled at once."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= AT_ONCE:
            end += 1
        b = batch_of([pages[i] for i in order[at:end]])
        main = scores(w, b) > 0
        for i, part in zip(order[at:end], np.split(main, np.cumsum(b.lengths)[:-1]), strict=True):
            out[i] = part
        at = end
    return out


# --- pages laid out anew --------------------------------------------------------------

# Usual names of page parts.
MAIN_BOXES = (
    "article", "main", "div.content", "div#content", "div.post-content", "div.entry-content", "section.story", "div.article-body", "div#main",
    "div.post", "main#main-content", "div.text", "section#article", "div.page-content",
)
BOXES = {
    "menu": ("nav", "div.menu", "ul.navbar", "div#nav", "nav.main-nav", "div.breadcrumbs", "div#menu", "div.navigation"),
    "header": ("header", "div#header", "div.header", "div.site-header", "div.masthead", "div.top-bar"),
    "footer": ("footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.bottom"),
    "sidebar": ("aside", "div.sidebar", "div#sidebar", "aside.widget", "div.related", "div.right-column", "section.recommended", "div.popular"),
    "notice": ("div.cookie-notice", "div.notice", "div#cookie-banner", "div.consent", "div.popup", "div.alert", "div.gdpr", "div.newsletter"),
    "advert": ("div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "aside.ad", "div#banner", "div.adsbox"),
    "form": ("form", "form.search", "div.login", "form#subscribe", "div.subscribe"),
    "comments": ("div.comments", "div#comments", "section.comments", "ul.comment-list", "div.comment", "div.responses", "div#disqus", "section.discussion"),
    "share": ("div.share", "ul.social", "div.share-buttons", "div.tags", "div.author-box"),
}
INSIDE = ("sidebar", "advert", "notice", "form", "comments", "share")


def _open(box: str) -> tuple[str, str]:
    tag, mark, name = re.match(r"(\w+)([.#]?)(.*)", box).groups()
    attribute = {"": "", ".": f' class="{name}"', "#": f' id="{name}"'}[mark]
    return f"<{tag}{attribute}>", f"</{tag}>"


class Layout:
    """A page written anew around texts of the sample; what is main text is marked by an attribute that is no feature."""

    def __init__(self, main: list[str], other: list[str], short: list[str], rng: np.random.Generator):
        self.main, self.other, self.short, self.rng = main, other, short, rng

    def one(self, among: Sequence):
        return among[int(self.rng.integers(len(among)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def aside(self, kind: str) -> str:
        start, end = _open(self.one(BOXES[kind]))
        e, n = entities.escape, int(self.rng.integers(1, 8))
        if kind in ("menu", "share"):
            inner = "".join(f'<li><a href="/x">{e(self.one(self.short))}</a></li>' for _ in range(n))
            inner = inner if start.startswith("<ul") else f"<ul>{inner}</ul>"
        elif kind == "form":
            inner = f"<label>{e(self.one(self.short))}</label><input name=q><button>{e(self.one(self.short))}</button>"
            inner += f"<p>{e(self.one(self.other))}</p>" if self.chance(0.3) else ""
        elif kind in ("comments", "sidebar"):
            item = self.one(("p", "li", "div", "div.comment", "div.item"))
            o, c = _open(item)
            title = f"<h3>{e(self.one(self.short))}</h3>" if self.chance(0.6) else ""
            inner = title + "".join(f"{o}{e(self.one(self.main if self.chance(0.7) else self.other))}{c}" for _ in range(n))
        else:
            inner = e(self.one(self.other))
            inner = f"<p>{inner}</p>" if self.chance(0.5) else inner
            inner += f' <a href="#">{e(self.one(self.short))}</a>' if self.chance(0.4) else ""
        return start + inner + end

    def paragraph(self, text: str, heading: bool) -> str:
        e = entities.escape(text)
        if heading:
            return f"<h1 data-main>{e}</h1>"
        kind = self.one(("p", "p", "p", "p", "p.text", "div", "li", "blockquote", "pre", "td", "h2", "b"))
        if kind == "b":
            return f"<p data-main><b>{e}<br>"
        start, end = _open(kind)
        body = start.replace(">", " data-main>", 1) + e + end
        return {"li": f"<ul>{body}</ul>", "td": f"<table><tr>{body}</tr></table>"}.get(kind, body)

    def page(self, paragraphs: list[str]) -> str:
        before = [k for k in ("header", "menu", "notice", "advert", "form", "sidebar") if self.chance(0.5)]
        after = [k for k in ("share", "advert", "sidebar", "comments", "form", "notice", "footer") if self.chance(0.5)]
        body = [self.paragraph(t, i == 0 and self.chance(0.8)) for i, t in enumerate(paragraphs)]
        for kind in INSIDE:
            if self.chance(0.15):
                body.insert(int(self.rng.integers(len(body) + 1)), self.aside(kind))
        start, end = _open(self.one(MAIN_BOXES)) if self.chance(0.92) else ("", "")
        outer, close = ("<div>", "</div>") if self.chance(0.3) else ("", "")
        parts = [*map(self.aside, before), start, *body, end, *map(self.aside, after)]
        title = entities.escape(self.one(self.short))
        return f"<html><head><title>{title}</title></head><body>{outer}{''.join(parts)}{close}</body></html>"


def training_pages(pages: Sequence[str], layouts: int = LAYOUTS, seed: int = 7) -> list[list[Block]]:
    """Blocks with labels: of the pages that name their main text, and of all laid out anew."""
    rng = np.random.default_rng(seed)
    cut = [blocks(p) for p in pages]
    named = [c for c in cut if any(b.main for b in c)]
    texts = [b.text for c in cut for b in c]
    main = [b.text for c in named for b in c if b.main] or texts
    other = [b.text for c in named for b in c if not b.main] or texts
    short = [" ".join(t.split()[:3]) for t in other + main]
    if not texts:
        return []
    made = []
    for c in cut:
        for _ in range(layouts):
            own = [b.text for b in c if b.main] or [b.text for b in c]
            made.append(blocks(Layout(main, other, short, rng).page(own[:40] if own else [main[0]]), marked=True))
    return named + made


def fit(df: DataFrame, page: str = "html", key: Sequence[str] = ("page_id", "url"), seed: int = 7) -> Weights:
    """Train on the first ``SAMPLE`` pages in the order of a hash of ``key`` (pages over ``LONGEST`` characters are not used).

    Two jobs: the hashes of the sample, then its pages, so that no task sends more pages than are used.
    """
    text = column(page)
    rows = df.select(text.alias("page"), F.xxhash64(*[column(k) for k in key], text).alias("place"))
    rows = rows.filter(F.length("page").between(1, LONGEST))
    places = [r.place for r in rows.select("place").distinct().orderBy("place").limit(SAMPLE).collect()]
    if not places:
        return train([], seed)
    found = rows.filter(F.col("place") <= places[-1]).groupBy("place").agg(F.min("page").alias("page")).collect()
    return train(training_pages([r.page for r in sorted(found, key=lambda r: r.place)], seed=seed), seed)


def texts_of(w: Weights, pages: Sequence[str | None]) -> Iterator[str]:
    cut = [blocks(p or "") for p in pages]
    for c, main in zip(cut, label(w, cut), strict=True):
        yield " ".join(b.text for b, m in zip(c, main.tolist(), strict=True) if m)


def extract(df: DataFrame, weights: Weights | None = None, page: str = "html", key: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``(*key, text, n_chars)`` of each row; trains the labeller first unless ``weights`` are given."""
    shared = df.sparkSession.sparkContext.broadcast(fit(df, page, key) if weights is None else weights)
    names = [f"k{i}" for i in range(len(key))]
    kinds = ", ".join(f"{n} {df.schema[k].dataType.simpleString()}" for n, k in zip(names, key, strict=True))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found: list[str] = []
        for part in in_parts(b.column("page").to_pylist(), PART):
            found.extend(texts_of(shared.value, part))
        lengths = pa.array([len(t) for t in found], pa.int64())
        return pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(found, pa.string()), lengths], [*names, "text", "n_chars"])

    light = df.select(*[column(k).alias(n) for k, n in zip(key, names, strict=True)], column(page).alias("page"))
    out = map_arrow(light, batch, f"{kinds}, text string, n_chars long")
    return out.toDF(*key, "text", "n_chars")
