"""HTML extraction: gradient-boosted trees over DOM nodes with hierarchical decoding.

A page becomes a tree of block elements. Each node is described by its own and its subtree's text
and link density, tag, attribute tokens, depth, and how it compares with its siblings. Boosted
trees give the probability that a node holds main text. Decoding picks the likeliest labelling of
the whole tree in which nothing below a dropped node is kept, so ancestors and descendants never
contradict each other.

The trees are fitted on a bounded sample of pages. Where a page marks its article, those marks
are the labels; every sampled page is also rebuilt several times from its own parts with other
tags, attribute names and orders, and with side bars, notices, forms, share lists and comments, so
that the trees rely on more than one sign. What is never text (scripts, styles, comments, head) is
dropped by the parser. The model only reads html: equal pages give equal text.

Null and empty html give an empty text, as do pages without any kept text; repeated rows repeat;
unclosed and crossed tags are repaired; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ratingloom.llm.common import bounded_sample, collected, slices

SAMPLE = 150
VARIANTS = 4
SAMPLE_PAGE_CHARS = 50_000
TREES, DEPTH, RATE, BINS = 50, 4, 0.3, 24
MIN_LEAF = 8
MAX_TOKENS = 120
PAGES_AT_ONCE = 64
SCHEMA = "text string, n_chars long"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?/][^>]*+>", re.S
)
ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
PART = re.compile(r"[a-z]+")
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main header footer nav aside "
    "form fieldset blockquote pre figure figcaption address details summary hr button select option label center".split()
)
SKIPPED = frozenset("script style noscript template svg iframe object textarea title head math canvas".split())
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in SKIPPED}
VOID = frozenset("hr br img input meta link".split())
# an opening tag of the key closes an open element of the values, up to the nearest of the last set
CLOSED_BY = {
    "li": ({"li", "p"}, {"ul", "ol"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KINDS = (
    "html body div p h ul ol li table tr td section article main header footer nav aside form blockquote pre figure button label other"
).split()
KIND_PLACE = {k: n for n, k in enumerate(KINDS)}
SIGNS = frozenset(",.;:!?")


@dataclass
class Page:
    """Block elements in order of their start tags, and the text runs they own."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    mark: list[str | None] = field(default_factory=list)  # label in rebuilt training pages
    span: list[list[int]] = field(default_factory=list)  # inner start and end in the source
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # owner, text, characters inside links


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    buffer: list[str] = []
    state = {"link": 0, "linked": 0}

    def flush():
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                page.runs.append((stack[-1], text, min(state["linked"], len(text))))
            buffer.clear()
        state["linked"] = 0

    def start(tag, attributes, at):
        flush()
        found, mark = [], None
        for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
            name = name.lower()
            if name in ("class", "id", "role", "itemprop"):
                found += PART.findall((a or b or c).lower())
            elif name == "data-mark":
                mark = a or b or c
        page.tag.append(tag)
        page.parent.append(stack[-1] if stack else -1)
        page.tokens.append(tuple(found))
        page.mark.append(mark)
        page.span.append([at, len(source)])
        stack.append(len(page.tag) - 1)

    def close(depth, at):
        flush()
        for n in stack[depth:]:
            page.span[n][1] = at
        del stack[depth:]
        state["link"] = 0

    start("html", "", 0)
    position, size = 0, len(source)
    while position < size:
        m = TAG.search(source, position)
        if m is None:
            buffer.append(source[position:])
            if state["link"]:
                state["linked"] += size - position
            break
        if m.start() > position:
            buffer.append(source[position : m.start()])
            if state["link"]:
                state["linked"] += m.start() - position
        position = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag, closing = name.lower(), m.group(1)
        if tag in SKIPPED:
            if not closing and not m.group(3).endswith("/"):
                if tag == "head":  # its parts are skipped one by one; text in between is none of the page's
                    continue
                end = RAW_END[tag].search(source, position)
                position = end.end() if end else size
            continue
        if tag == "a":
            state["link"] = 0 if closing else 1
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        if tag in ("html", "body") and any(page.tag[n] == tag for n in stack):
            if closing and tag == "body":
                flush()
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if page.tag[stack[depth]] == tag:
                    close(depth, m.start())
                    break
            continue
        if tag == "hr":
            flush()
            continue
        closes, until = CLOSED_BY.get(tag, ({"p"}, {"td", "th", "li", "button"}))
        for depth in range(len(stack) - 1, 0, -1):
            here = page.tag[stack[depth]]
            if here in until:
                break
            if here in closes:
                close(depth, m.start())
                if tag not in CLOSED_BY:
                    break
            elif tag not in CLOSED_BY and here not in ("h1", "h2", "h3", "h4", "h5", "h6"):
                break
        start(tag, m.group(3), m.end())
    flush()
    return page


def node_features(page: Page, tokens: dict[str, int]) -> np.ndarray:
    """One row of numbers per node."""
    n = len(page.tag)
    k = len(KINDS)
    chars, linked, words, signs = (np.zeros(n) for _ in range(4))
    for owner, text, inside in page.runs:
        chars[owner] += len(text)
        linked[owner] += inside
        words[owner] += text.count(" ") + 1
        signs[owner] += sum(map(text.count, SIGNS))
    sub = [chars.copy(), linked.copy(), words.copy(), signs.copy(), np.ones(n)]
    paragraphs, first_child, n_children, depth, nth, position = (np.zeros(n) for _ in range(6))
    own, above = np.zeros((n, k + len(tokens)), np.float32), np.zeros((n, k + len(tokens)), np.float32)
    so_far = 0.0
    for v in range(n):
        p, tag = page.parent[v], page.tag[v]
        own[v, KIND_PLACE.get("h" if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else tag, k - 1)] = 1
        for t in page.tokens[v]:
            place = tokens.get(t)
            if place is not None:
                own[v, k + place] = 1
        if p >= 0:
            depth[v] = depth[p] + 1
            nth[v] = n_children[p]
            n_children[p] += 1
            above[v] = np.maximum(above[p], own[p])
        paragraphs[v] = tag == "p"
        position[v] = so_far
        so_far += chars[v]
    for v in range(n - 1, 0, -1):
        p = page.parent[v]
        for s in sub:
            s[p] += s[v]
        paragraphs[p] += paragraphs[v]
    total = max(1.0, sub[0][0])
    up = np.maximum(page.parent, 0)
    siblings = n_children[up]
    siblings[0] = 1
    rest = np.maximum(1.0, (sub[0][up] - sub[0]) / np.maximum(1, siblings - 1))
    numbers = [
        np.log1p(chars), np.log1p(sub[0]), linked / np.maximum(1, chars), sub[1] / np.maximum(1, sub[0]),
        sub[0] / sub[4], np.log1p(sub[4]), sub[3] / np.maximum(1, sub[2]), sub[0] / np.maximum(1, sub[2]), sub[0] / total, position / total,
        depth, siblings, nth / np.maximum(1, siblings), np.log1p(sub[0]) - np.log(rest), np.log1p(paragraphs), n_children,
        np.log1p(sub[0][up]), sub[1][up] / np.maximum(1, sub[0][up]), np.log1p(paragraphs[up]), sub[0][up] / total,
    ]
    return np.hstack([np.stack(numbers, 1).astype(np.float32), own, above])


# --- boosted trees ---------------------------------------------------------------------------


@dataclass
class Trees:
    """Complete binary trees: splits by level order, values of the leaves."""

    base: float
    features: np.ndarray  # trees x (2**depth - 1)
    cuts: np.ndarray
    leaves: np.ndarray  # trees x 2**depth

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Logistic boosting with histograms; equal gains go to the first feature and cut."""
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(f)], 1)
    offset = np.arange(f) * (BINS + 1)
    mean = float(np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3))
    base = math.log(mean / (1 - mean))
    score = np.full(n, base)
    inner = 2**DEPTH - 1
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        feature, cut, where = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, 10**6)
        for level in range(DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 2 * MIN_LEAF:
                    continue
                flat = (binned[rows] + offset).ravel()
                size = f * (BINS + 1)
                hist_g = np.bincount(flat, np.repeat(g[rows], f), size).reshape(f, BINS + 1).cumsum(1)
                hist_h = np.bincount(flat, np.repeat(h[rows], f), size).reshape(f, BINS + 1).cumsum(1)
                hist_n = np.bincount(flat, minlength=size).reshape(f, BINS + 1).cumsum(1)
                total_g, total_h = hist_g[0, -1], hist_h[0, -1]
                gain = hist_g**2 / (hist_h + 1) + (total_g - hist_g) ** 2 / (total_h - hist_h + 1) - total_g**2 / (total_h + 1)
                gain[(hist_n < MIN_LEAF) | (len(rows) - hist_n < MIN_LEAF)] = -np.inf
                best = int(np.argmax(np.round(gain, 9)))
                j, b = divmod(best, BINS + 1)
                if gain[j, b] > 1e-6 and b < len(cuts[j]):
                    feature[node], cut[node], where[node] = j, cuts[j][b], b
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > where[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        score += value[leaf]
        all_features.append(feature)
        all_cuts.append(cut)
        all_leaves.append(value)
    return Trees(base, np.array(all_features), np.array(all_cuts), np.array(all_leaves))


@dataclass
class Model:
    tokens: dict[str, int]
    trees: Trees


# --- training pages ----------------------------------------------------------------------------

# fixed values: names that authors commonly give to parts of a page
CONTENT_NAMES = ("content", "post", "entry", "article", "story", "main", "post-body", "entry-content", "text", "article-body")
OTHER_NAMES = {
    "menu": ("menu", "nav", "navbar", "navigation", "links", "topnav", "breadcrumb"),
    "head": ("header", "masthead", "top", "banner", "site-header", "branding"),
    "foot": ("footer", "bottom", "copyright", "site-footer", "colophon"),
    "side": ("sidebar", "aside", "widget", "related", "side", "recommended", "popular"),
    "notice": ("notice", "cookie", "alert", "message", "consent", "warning"),
    "advert": ("ad", "ads", "advert", "sponsor", "promo", "banner-ad", "sponsored"),
    "form": ("subscribe", "login", "search", "newsletter", "signup"),
    "comments": ("comments", "comment", "responses", "discussion", "replies", "comment-list"),
    "share": ("share", "social", "tags", "meta", "byline"),
}
OTHER_TAGS = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "notice": "div", "advert": "div", "form": "form", "comments": "section", "share": "div"}
ARTICLE_TAGS = ("article", "main")
BOILERPLATE_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "button", "select"))
BOILERPLATE_NAMES = frozenset(p for names in OTHER_NAMES.values() for name in names for p in PART.findall(name)) - {"top", "text", "main", "meta"}


def labels_of(page: Page) -> np.ndarray:
    """1 for nodes that hold main text: by marks of rebuilt pages, else by the author's own tags."""
    n = len(page.tag)
    y = np.zeros(n, np.int64)
    if any(page.mark):
        for v in range(n):
            own = page.mark[v]
            y[v] = int(own) if own else (y[page.parent[v]] if v else 0)
    else:
        root = article_of(page)
        inside = np.zeros(n, bool)
        for v in range(n):
            p = page.parent[v]
            inside[v] = v == root or (p >= 0 and inside[p] and page.tag[v] not in BOILERPLATE_TAGS and not BOILERPLATE_NAMES & set(page.tokens[v]))
        y[inside] = 1
    for v in range(n - 1, 0, -1):
        if y[v]:
            y[page.parent[v]] = 1
    return y


def article_of(page: Page) -> int:
    """The article element, or the node whose own paragraphs hold the most text."""
    for tag in ARTICLE_TAGS:
        if tag in page.tag:
            return page.tag.index(tag)
    held = np.zeros(len(page.tag))
    for owner, text, linked in page.runs:
        if page.tag[owner] == "p":
            held[max(0, page.parent[owner])] += len(text) - linked
    return int(np.argmax(held))


def _other_part(kind: str, rng: random.Random, lines: list[str], links: str) -> str:
    """A marked part that is not main text, made from the page's own words."""
    line = lambda most: " ".join(rng.choice(lines).split()[: rng.randint(2, most)])
    link = lambda: f'<a href="/{rng.randint(1, 99)}">{line(6)}</a>'
    if kind == "menu":
        inner = links or "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 8))) + "</ul>"
    elif kind == "head":
        inner = f"<h2>{line(4)}</h2>" + (f"<p>{line(8)}</p>" if rng.random() < 0.5 else link())
    elif kind == "foot":
        inner = rng.choice([f"&copy; {line(12)}", f"<p>{line(12)}</p>" + link(), "".join(f"<p>{line(9)}</p>" for _ in range(3))])
    elif kind == "side":
        inner = f"<h3>{line(4)}</h3>" + rng.choice(["<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 6))) + "</ul>", f"<p>{line(25)}</p>", f"<div>{link()}<p>{line(15)}</p></div>"])
    elif kind == "comments":
        inner = f"<h3>{line(3)}</h3>" + "".join(
            rng.choice([f"<div><b>{line(2)}</b><p>{line(40)}</p></div>", f"<p>{line(30)}</p>", f"<ul><li><p>{line(40)}</p></li></ul>"]) for _ in range(rng.randint(1, 5))
        )
    elif kind == "form":
        inner = f"<label>{line(3)}</label><input name=q><button>{line(2)}</button>" + (f"<p>{line(12)}</p>" if rng.random() < 0.5 else "")
    else:
        inner = rng.choice([line(20), f"<p>{line(20)}</p>", f"{line(8)} {link()}"])
    tag = OTHER_TAGS[kind] if rng.random() < 0.5 else rng.choice(("div", "div", "section", "ul" if kind == "menu" else "div"))
    named = rng.random() < (0.6 if tag in BOILERPLATE_TAGS else 0.95)
    name = f' {rng.choice(("class", "id"))}="{rng.choice(OTHER_NAMES[kind])}"' if named else ""
    return f'<{tag}{name} data-mark="0">{inner}</{tag}>'


def rebuilt(source: str, seed: int) -> str | None:
    """The page's article in a new page of other parts, all marked; None if it has no article text."""
    page = parse(source)
    root = article_of(page)
    inner = source[slice(*page.span[root])]
    owners = {n for n in range(len(page.tag)) if n == root}
    for n in range(len(page.tag)):
        if page.parent[n] in owners:
            owners.add(n)
    lines = [t for _, t, _ in page.runs if len(t) > 1]
    if not lines or not any(o in owners for o, _, _ in page.runs):
        return None
    lines = [re.sub(r"[<>&]", " ", t) for t in lines]
    lines = [t for t in lines if t.split()] or ["text"]
    rng = random.Random(seed)
    links = next((source[slice(*page.span[n])] for n, t in enumerate(page.tag) if t == "nav"), "")
    part = lambda kind: _other_part(kind, rng, lines, links if rng.random() < 0.5 else "")
    some = lambda kind, chance: part(kind) if rng.random() < chance else ""
    pieces = re.split(r"(?=<p>)", inner)
    if rng.random() < 0.25:  # a short article
        pieces = pieces[: rng.randint(1, 2)]
    if len(pieces) > 2:
        for kind in ("advert", "share", "side"):
            if rng.random() < 0.3:
                place = rng.randrange(1, len(pieces) + 1)
                pieces.insert(place, part(kind))
    inner = "".join(pieces)
    if rng.random() < 0.25:
        inner += part("comments")
    tag = rng.choice(("article", "main", "div", "div", "section"))
    name = f' class="{rng.choice(CONTENT_NAMES)}"' if rng.random() < 0.7 else ""
    body = f'<{tag}{name} data-mark="1">{inner}</{tag}>'
    around = [some("side", 0.5), body, some("side", 0.3), some("comments", 0.5), some("form", 0.4), some("share", 0.2)]
    if rng.random() < 0.3:
        around.insert(0, some("advert", 0.7))
    middle = "".join(around)
    if rng.random() < 0.6:
        wrap = rng.choice(("wrapper", "page", "container", "row", "layout"))
        middle = f'<div class="{wrap}">{middle}</div>'
    return (
        "<!DOCTYPE html><html><body>" + some("notice", 0.3) + some("head", 0.6) + some("menu", 0.8) + some("advert", 0.5) + middle
        + some("advert", 0.2) + some("form", 0.2) + some("foot", 0.9) + some("notice", 0.2) + "</body></html>"
    )


def shortened(source: str, words: bool = False) -> str:
    """The page as it is, its article cut down to the first heading or paragraphs, or each text to its first word."""
    page = parse(source)
    start, end = page.span[article_of(page)]
    pieces = re.split(r"(?=<p>)", source[start:end])
    inner = "".join(pieces[: 1 + len(source) % 3])
    if words:
        inner = re.sub(r">([^<\s]+)\s[^<]*", r">\1", inner)
    return source[:start] + inner + source[end:]


def train(sources: list[str], variants: int = VARIANTS) -> Model:
    """A model from the html of sample pages."""
    pages = []
    for source in sources:
        pages += [parse(source), parse(shortened(source)), parse(shortened(source, True))]
        for v in range(variants):
            other = rebuilt(source, 1_000_003 * v + len(source))
            if other:
                pages.append(parse(other))
    counts = Counter(t for page in pages for own in page.tokens for t in set(own))
    names = {t: n for n, (t, c) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:MAX_TOKENS]) if c >= 5}
    x = [node_features(page, names) for page in pages]
    if not x:
        x, pages = [node_features(parse(""), names)], [parse("")]
    y = [labels_of(page) for page in pages]
    # nodes count by their text, so that a hundred menu links do not outweigh a paragraph
    weight = [1 + np.minimum(3, a[:, 0] / 2) for a in x]
    return Model(names, boost(np.vstack(x), np.concatenate(y), np.concatenate(weight)))


# --- decoding ------------------------------------------------------------------------------------


def decoded(page: Page, score: np.ndarray) -> np.ndarray:
    """The likeliest labelling in which nothing below a dropped node is kept; the root is kept."""
    n = len(page.tag)
    score = np.clip(score, -30, 30)
    keep, drop = -np.log1p(np.exp(-score)), -np.log1p(np.exp(score))
    children = np.zeros(n)
    below = np.zeros(n)  # all dropped
    for v in range(n - 1, 0, -1):
        below[v] += drop[v]
        p = page.parent[v]
        below[p] += below[v]
        children[p] += max(keep[v] + children[v], below[v])
    kept = np.zeros(n, bool)
    kept[0] = True
    for v in range(1, n):
        kept[v] = kept[page.parent[v]] and keep[v] + children[v] >= below[v]
    return kept


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    """The main texts of some pages; their nodes are scored together."""
    pages = [parse(s or "") for s in sources]
    features = [node_features(page, model.tokens) for page in pages]
    scores = model.trees.score(np.vstack(features)) if pages else np.zeros(0)
    out, at = [], 0
    for page in pages:
        kept = decoded(page, scores[at : at + len(page.tag)])
        at += len(page.tag)
        out.append("\n\n".join(text for owner, text, _ in page.runs if kept[owner]))
    return out


def main_text(source: str | None, model: Model) -> str:
    return main_texts([source], model)[0]


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = SAMPLE) -> Model:
    """Trees from at most ``2 * sample`` pages, each of at most SAMPLE_PAGE_CHARS characters."""
    some = bounded_sample(pages.select(key, html).filter(F.length(html) <= SAMPLE_PAGE_CHARS), key, sample)
    return train([r[1] for r in collected(some)])


def extract(pages: DataFrame, model: Model, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep``, the main text and its length in code points; no shuffle."""
    given = pages.select(*[pages[c] for c in keep], pages[html].alias("_html"))
    out = StructType([*given.schema.fields[:-1], *StructType.fromDDL(SCHEMA)])
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)
        for piece in slices(batches, PAGES_AT_ONCE):
            texts = main_texts(piece.column(n_keep).to_pylist(), model)
            made = [pa.array(texts, arrow.field(n_keep).type), pa.array([len(t) for t in texts], pa.int64())]
            kept = [piece.column(n).cast(arrow.field(n).type) for n in range(n_keep)]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return given.mapInArrow(run, out)
