"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in page order: runs of text between block-level tags, with
the tags, classes and ids of their ancestors. The field labels each block as main text or
not; features are ancestors and simple facts about the text (length, links, punctuation,
marks of copyright), and the transition weights let neighbours agree. It is trained by the
log likelihood (forward-backward in numpy) on labelled pages and decoded by Viterbi.

Labelled pages: at most ``MOST_PAGES`` pages of the table, those of smallest hash, that mark
their article by ``article`` or ``main`` (a documented bound of the fit alone). A block is
main text if it is in there and in no menu, header, footer, aside, form or advert. Each is
also laid out anew in other containers and with the other kinds of surroundings in
``SURROUNDINGS``, labelled by construction, so that the field knows more than one template.

White space in a block becomes one space, character references are decoded, blocks are
trimmed and joined by one space. Null and empty html gives an empty text. Unclosed tags,
cut pages and broken references are read as browsers do: what is left open ends with its
parent or the page. Without any labelled page the field falls back on the laid-out examples
of a fixed text. Repeated rows give repeated results, null page_id and url are passed on, an
empty table gives an empty result, extra columns are left aside. Html of any length and any
nesting is read whole, one page at a time, in time and memory that follow its length. Of the
pages that labels come from, the fit takes those below 20,000 characters, and 40 blocks of
main text of each for new layouts.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PAGES = 400

#: Elements whose content is no page text, elements without content, and
#: elements that do not end a block.
SILENT = ["script", "style", "noscript", "template", "svg", "title", "textarea", "select", "iframe", "object", "canvas", "math", "audio", "video"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "label"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<silent>" + "|".join(SILENT) + r")\b[^>]*(?:>|\Z).*?(?:</(?P=silent)\s*[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)?"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]{2,}")


class Path:
    """The names of an element and its ancestors: a link to the parent, its own names and those new on the way down.

    Elements alike under the same parent share one path, and nothing is copied from the
    parent, so a page takes memory for its elements, however deeply they are nested.
    """

    __slots__ = ("below", "digest", "fresh", "names", "parent")

    def __init__(self, parent: Path | None = None, names: tuple[str, ...] = (), fresh: tuple[str, ...] = ()) -> None:
        self.parent, self.names, self.fresh = parent, names, fresh
        self.digest = blake2b("\x1f".join(names).encode(), key=parent.digest, digest_size=16).digest() if parent else b""
        self.below: dict[tuple[str, ...], Path] = {}

    def __iter__(self) -> Iterator[str]:
        way, here = [], self
        while here.parent is not None:
            way.append(here.names)
            here = here.parent
        return (name for names in reversed(way) for name in names)

    @property
    def last(self) -> str:
        return self.names[-1] if self.names else ""

    @classmethod
    def of(cls, names: tuple[str, ...]) -> Path:
        return cls(cls(), names, tuple(dict.fromkeys(names))) if names else cls()


class Block(NamedTuple):
    text: str
    around: Path
    linked: float


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    out: list[Block] = []
    root = Path()
    stack: list[tuple[str, Path]] = []
    tags: Counter[str] = Counter()
    above: Counter[str] = Counter()
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, stack[-1][1] if stack else root, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def leave() -> str:
        name, path = stack.pop()
        tags[name] -= 1
        above.subtract(path.names)
        return name

    for token in _TOKEN.finditer(html):
        if (text := token["text"]) is not None:
            parts.append(text)
            if links:
                linked += len(text)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if token["close"] else links + 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        links = 0
        if token["close"]:
            if tags[tag]:
                while leave() != tag:
                    pass
        elif tag not in VOID and not token["attrs"].endswith("/"):
            if stack and stack[-1][0] == "p":
                leave()
            if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                leave()
            names = [f"<{tag}>"]
            if "=" in token["attrs"]:
                for found in _NAMED.finditer(token["attrs"]):
                    names += _WORD.findall("".join(g for g in found.groups() if g).lower())
            parent, own = stack[-1][1] if stack else root, tuple(names)
            path = parent.below.get(own)
            if path is None:
                path = parent.below[own] = Path(parent, own, tuple(n for n in dict.fromkeys(own) if not above[n]))
            stack.append((tag, path))
            tags[tag] += 1
            above.update(own)
    flush()
    return out


def _size(n: int) -> int:
    return min(n.bit_length(), 10)


def text_features(block: Block) -> tuple[str, ...]:
    """Facts about a block's own text, few enough to be remembered together."""
    text = block.text
    return (
        f"length {_size(len(text))}",
        f"words {_size(text.count(' '))}",
        f"linked {round(4 * block.linked)}",
        f"ends {text[-1] in '.!?:;'}",
        f"stops {min(3, text.count('. '))}",
        f"owner {'©' in text}",
    )


def around_features(around: Path) -> tuple[str, ...]:
    return (*sorted({f"in {name}" for name in around}), *place_features(around))


def place_features(around: Path) -> tuple[str, str]:
    return f"last {around.last}", f"path {around.digest.hex()}"


@dataclass
class Field:
    """Weights: two labels per feature, two by two transitions."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    known: dict = field(default_factory=dict, repr=False)

    def _sum(self, key: tuple, made) -> np.ndarray:
        got = self.known.get(key)
        if got is None:
            got = self.weights[[self.index[f] for f in made() if f in self.index]].sum(axis=0)
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = got
        return got

    def _around(self, path: Path, inside: dict[int, tuple[float, float]]) -> tuple[float, float]:
        """The weights of a path's features. ``inside`` keeps those of its names, from the root down, for one page."""
        way, here = [], path
        while here.parent is not None and id(here) not in inside:
            way.append(here)
            here = here.parent
        zero, one = inside.get(id(here), (0.0, 0.0))
        for here in reversed(way):
            more = self._sum(("in", *here.fresh), lambda here=here: [f"in {name}" for name in here.fresh])
            zero, one = zero + float(more[0]), one + float(more[1])
            inside[id(here)] = zero, one
        place = self._sum(place_features(path), lambda: place_features(path))
        return zero + float(place[0]), one + float(place[1])

    def labels(self, page: list[Block]) -> list[int]:
        """Viterbi."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        back: list[tuple[int, int]] = []
        zero = one = 0.0
        inside: dict[int, tuple[float, float]] = {}
        for k, block in enumerate(page):
            own = text_features(block)
            e0, e1 = self._sum(own, lambda own=own: own).tolist()
            a0, a1 = self._around(block.around, inside)
            if k == 0:
                zero, one = e0 + a0, e1 + a1
                continue
            from0, from1 = int(one + m10 > zero + m00), int(one + m11 > zero + m01)
            back.append((from0, from1))
            zero, one = max(zero + m00, one + m10) + e0 + a0, max(zero + m01, one + m11) + e1 + a1
        out = [int(one > zero)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1][: len(page)]

    def main_text(self, html: str | None) -> str:
        page = blocks(html or "")
        return " ".join(b.text for b, keep in zip(page, self.labels(page), strict=True) if keep) if page else ""


def fit(pages: list[tuple[list[Block], list[int]]], steps: int = 250, rate: float = 0.2, l2: float = 1e-4) -> Field:
    """Maximum likelihood by forward-backward over all pages at once (Adam)."""
    pages = [(b, y) for b, y in pages if b]
    features = [[(*text_features(b), *around_features(b.around)) for b in page] for page, _ in pages]
    index = {f: k for k, f in enumerate(sorted({f for page in features for block in page for f in block}))}
    n, longest = len(pages), max(len(p) for p, _ in pages)
    mask = np.zeros((n, longest), bool)
    gold = np.zeros((n, longest), np.int64)
    where, what = [], []
    for i, (page, y) in enumerate(pages):
        mask[i, : len(page)] = True
        gold[i, : len(page)] = y
        for t, block in enumerate(features[i]):
            where += [i * longest + t] * len(block)
            what += [index[f] for f in block]
    where, what = np.array(where), np.array(what)
    gold_one = np.eye(2)[gold] * mask[..., None]
    pair_mask = mask[:, 1:]
    gold_moves = np.einsum("nta,ntb->ab", gold_one[:, :-1] * pair_mask[..., None], gold_one[:, 1:])
    params = [np.zeros((len(index), 2)), np.zeros((2, 2))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    total = mask.sum()
    for step in range(1, steps + 1):
        weights, moves = params
        emit = np.stack([np.bincount(where, weights[what, k], n * longest) for k in (0, 1)], axis=1).reshape(n, longest, 2)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(alpha[:, t - 1, 0, None] + moves[0], alpha[:, t - 1, 1, None] + moves[1]) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = emit[:, t + 1] + beta[:, t + 1]
            new = np.logaddexp(moves[:, 0] + ahead[:, 0, None], moves[:, 1] + ahead[:, 1, None])
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        norm = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        node = np.exp(alpha + beta - norm[:, None, None]) * mask[..., None]
        edge = np.exp(alpha[:, :-1, :, None] + moves + (emit + beta)[:, 1:, None, :] - norm[:, None, None, None]) * pair_mask[..., None, None]
        off = (node - gold_one).reshape(-1, 2)
        grads = [np.stack([np.bincount(what, off[where, k], len(index)) for k in (0, 1)], axis=1) / total + l2 * weights, (edge.sum(axis=(0, 1)) - gold_moves) / total + l2 * moves]
        for k, grad in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad**2
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Field(index, *params)


#: Containers of main text, and kinds of surroundings by their usual markup.
CONTAINERS = ["<article>", "<main>", '<main class="content">', '<div class="content">', '<div class="post">', '<div class="entry content">', '<div class="article body">', '<div id="main">', '<section class="story">', '<article class="post">', '<div role="main">']
SURROUNDINGS = {
    "menu": ["<nav>", '<div class="menu">', '<div class="navbar">', '<ul class="nav">', '<div class="breadcrumbs">', '<div role="navigation">'],
    "header": ["<header>", '<div class="header">', '<div id="masthead">', '<div class="site header">', '<div role="banner">'],
    "sidebar": ["<aside>", '<div class="sidebar">', '<div class="related">', '<div class="widget">', '<aside class="sidebar">', '<div class="recommended">'],
    "notice": ['<div class="notice">', '<div class="cookie">', '<div class="cookie banner">', '<div class="alert">', '<div class="consent">', '<div class="newsletter">', '<div class="popup">', '<div role="alert">'],
    "advert": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<div class="promo">', '<aside class="ad">'],
    "form": ["<form>", '<form class="search">', '<form class="subscribe">', '<div class="login">'],
    "comments": ['<div class="comments">', '<section class="comments">', '<div id="comments">', '<ol class="comment list">', '<div class="replies">', '<div class="discussion">', '<section id="comments">'],
    "footer": ["<footer>", '<div class="footer">', '<div class="copyright">', '<div class="legal">', '<div role="contentinfo">'],
}
_INSIDE = ("advert", "sidebar", "notice", "form", "comments", "header", "footer", "menu")
_SAMPLE = ["Some plain words make a sentence.", "Another sentence follows. It has two parts, and a few more words than the first one.", "The end."]


def _closing(opening: str) -> str:
    return "</" + re.match(r"<(\w+)", opening)[1] + ">"


def laid_out(main: list[str], other: list[str], seed: int) -> str:
    """A page around the texts ``main``; its blocks of main text end with U+2063, a mark to label by."""
    draw = random.Random(seed)
    say = entities.escape

    def surrounding(kind: str) -> str:
        opening = draw.choice(SURROUNDINGS[kind])
        lines = [say(draw.choice(other)) for _ in range(draw.randint(1, 4))]
        if kind == "menu":
            body = "".join(f'<li><a href="#">{" ".join(x.split()[:2])}</a></li>' for x in lines)
            body = body if opening.startswith("<ul") else f"<ul>{body}</ul>"
        elif kind == "form":
            body = "".join(f"<p><label>{x[:30]}</label> <input></p>" for x in lines) + "<button>Go</button>"
        elif kind == "footer":
            body = f"&copy; {lines[0][:60]} &middot; {lines[-1][:60]}"
        elif kind == "comments":
            body = "".join(f'<{t} class="comment"><p>{x}</p></{t}>' for x in lines for t in [draw.choice(["div", "li", "article"])])
        else:
            body = "".join(f"<p>{x}</p>" for x in lines) if draw.random() < 0.6 else lines[0]
        return opening + body + _closing(opening)

    opening = draw.choice(CONTAINERS)
    inner = []
    for k, text in enumerate(main):
        tag = "h1" if k == 0 and draw.random() < 0.7 else draw.choice(["p", "p", "p", "p", "blockquote", "li", "h2"])
        inner.append(f"<{tag}>{say(text)}⁣</{tag}>")
        if draw.random() < 0.15:
            inner.append(surrounding(draw.choice(_INSIDE)))
    if draw.random() < 0.3:
        inner.append(surrounding("comments"))
    before = [surrounding(k) for k in draw.sample(["menu", "header", "sidebar", "notice", "advert", "form"], draw.randint(1, 4))]
    after = [surrounding(k) for k in draw.sample(["comments", "sidebar", "footer", "notice", "advert", "form"], draw.randint(1, 4))]
    wrap = draw.random() < 0.4
    return "<html><body>" + '<div class="page">' * wrap + "".join(before) + opening + "".join(inner) + _closing(opening) + "".join(after) + "</div>" * wrap + "</body></html>"


def labelled(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article; None if it does not."""
    main = {"<article>", "<main>"}
    if not any(main & set(b.around) for b in page):
        return None
    no = {"<nav>", "<aside>", "<footer>", "<header>", "<form>", "ad", "ads", "advert", "sidebar", "comments", "comment", "menu", "notice", "cookie"}
    return [int(bool(main & set(b.around)) and not no & set(b.around)) for b in page]


def examples(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: the given ones that mark their article, and two layouts of each."""
    out, seed = [], 0
    for html in [*pages, "".join(["<article>", *[f"<p>{t}</p>" for t in _SAMPLE], "</article><footer>&copy; nobody</footer>"])]:
        page = blocks(html)
        labels = labelled(page)
        if labels is None:
            continue
        out.append((page, labels))
        main = [b.text for b, y in zip(page, labels, strict=True) if y][:40]
        other = [b.text for b, y in zip(page, labels, strict=True) if not y] + [t[:80] for t in main[:3]]
        for _ in range(2):
            seed += 1
            new = blocks(laid_out(main or _SAMPLE, other or _SAMPLE, seed))
            out.append(([b._replace(text=b.text.replace("⁣", "")) for b in new], [int("⁣" in b.text) for b in new]))
    return [([b for b in page if b.text], [y for b, y in zip(page, labels, strict=True) if b.text]) for page, labels in out]


def train(pages: DataFrame, most: int = MOST_PAGES) -> Field:
    """Fit on a bounded sample of the pages, those of smallest hash."""
    marked = pages.filter(F.col("html").isNotNull() & (F.length("html") < 20_000) & F.lower("html").rlike("<(article|main)[ >]"))
    hashed = marked.select("html", F.xxhash64("html").alias("h"))
    # The cut is found on hashes alone; then only the sample's pages reach the driver.
    cut = hashed.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    sample = hashed.filter(F.col("h") <= F.lit(cut)).dropDuplicates(["h"]) if cut is not None else hashed.limit(0)
    return fit(examples([r["html"] for r in sorted(sample.collect(), key=lambda r: r["h"])]))


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.main_text(h.as_py()) for h in batch.column("html")]
            yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select("page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string, n_chars long")
