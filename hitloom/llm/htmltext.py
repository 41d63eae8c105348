"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded from the root down.

A page is parsed into a tree.  Trees boosted on features of each element (tag,
attribute tokens of itself and its ancestors, depth, subtree text and its density
of links, paragraphs and punctuation, place among its siblings) give the
probability that an element belongs to the main text or holds it.  The decoding
maximises the likelihood of all elements together under one rule: below a dropped
element everything is dropped.  So an ancestor and its descendants never contradict.

Training uses a bounded sample of pages (``SAMPLE``).  Their elements are labelled
where the markup says plainly what they are, and the sampled text is also laid out
in generated page frames (divisions in place of article, headers, sidebars, notices,
adverts, forms, comments), in which every element's label is known.

Defined results
    null and empty pages, and pages without main text, give an empty text; unclosed
    and stray tags are repaired as the tree is built, in time linear in the page's
    length, however broken it is, and a tag whose quote never closes is text; formulas (``math``) and drawings (``svg``) are read like other
    elements, but for their annotations and metadata; long pages are read whole; character references are
    decoded once; repeated rows are extracted each; an empty table gives an empty
    result; other columns are carried along, and a new column whose name clashes
    gets a leading ``_``.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.bpe import slices
from hitloom.llm.common import fresh, ship, small_batches, text_or_empty, with_fields

ship(__name__)

#: Pages that the trees are trained on, at most; generated frames; characters handled at a time.
SAMPLE, FRAMES, CHARS_AT_ONCE = 200, 600, 4_000_000
#: Boosting: trees, depth, learning rate, bins of a feature.
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 16

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template annotation annotation-xml metadata select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag of the key closes open elements of these kinds, up to the nearest boundary.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
NEVER = frozenset(
    "head script style noscript template iframe annotation annotation-xml metadata textarea select button input label form nav footer aside dialog menu object canvas audio video".split()
)

# Tokens of class, id and role attributes that say what an element is.
OFF_TOKENS = (
    "ad ads advert advertisement adslot alert banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies copyright "
    "disclaimer disqus footer form gdpr header hero login masthead menu modal nav navbar navigation newsletter notice notification overlay "
    "pager pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags teaser toolbar topbar warning widget"
).split()
ON_TOKENS = "article articlebody body content entry main post story text".split()
TAGS = "a article aside b blockquote body div figure footer form h1 h2 h3 head header html i li main nav ol p section span strong table td ul".split()

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/<>]*+)", re.S)
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_STEP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_LONG_NUMBER = re.compile(r"&#([0-9]{9,})")


def unescape(text: str) -> str:
    """Character references decoded; a number beyond the last code point, however long, is one bad character."""
    return entities.unescape(_LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), text))


class TagEnds:
    """Where the tags of a page end: past the first ``>`` that stands outside quotes."""

    def __init__(self, page: str):
        self.page, self.at, self.ends = page, None, None

    def end(self, start: int) -> int:
        """The end of the tag whose attributes begin at ``start``; -1 if it has none."""
        if self.at is None:
            found = _REST.match(self.page, start)
            if found:
                return found.end()
            # Once a tag is left open, every quote and bracket of the page is resolved, from its end to its start.
            self.at = [m.start() for m in _STEP.finditer(self.page)]
            self.ends = [-1] * (len(self.at) + 1)
            following: dict[str, int] = {}
            for i in range(len(self.at) - 1, -1, -1):
                step = self.page[self.at[i]]
                if step == ">":
                    self.ends[i] = self.at[i] + 1
                else:
                    if step in following:
                        self.ends[i] = self.ends[following[step] + 1]
                    following[step] = i
        return self.ends[bisect.bisect_left(self.at, start)]


class OpenElements:
    """The open elements of a page, and at what depths each tag and the blocks stand."""

    def __init__(self):
        self.nodes, self.tags, self.depths, self.blocks = [0], ["#root"], {}, []

    def push(self, node: int, tag: str) -> None:
        self.depths.setdefault(tag, []).append(len(self.nodes))
        if tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)

    def pop(self) -> str:
        self.nodes.pop()
        tag = self.tags.pop()
        self.depths[tag].pop()
        if tag in BLOCK:
            self.blocks.pop()
        return tag

    def deepest(self, tags) -> int:
        """The depth of the innermost open element of these tags; 0 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)


@dataclass
class Page:
    """Elements in page order (index 0 is the root) and the runs of text between tags."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    tokens: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])
    runs: list[tuple[int, str]] = field(default_factory=list)  # (element, text); a text of None ends a block


def parse(page: str) -> Page:
    """A tree of elements; what is left open is closed, what is closed twice is passed over."""
    out, open_, ends, at = Page(), OpenElements(), TagEnds(page), 0

    def text(upto: int) -> None:
        if upto > at:
            out.runs.append((open_.nodes[-1], unescape(page[at:upto])))

    def close_to(depth: int) -> None:
        while len(open_.nodes) > depth:
            if open_.pop() in BLOCK:
                out.runs.append((open_.nodes[-1], None))

    look = 0
    while True:
        found = _TAG.search(page, look)
        if not found:
            text(len(page))
            break
        name, end = (found[2] or "").lower(), found.end()
        if name:
            end = ends.end(found.end())
            if end < 0:  # no tag: its text goes on
                look = found.start() + 1
                continue
        text(found.start())
        at = look = end
        if not name:
            continue
        attributes = page[found.end() : end - 1]
        if found[1]:
            if open_.depths.get(name):
                close_to(open_.depths[name][-1])
            continue
        if name == "br":
            out.runs.append((open_.nodes[-1], " "))
            continue
        block = name in BLOCK and not (name == "title" and open_.depths.get("svg"))  # a drawing's title is not shown
        if name in CLOSES:
            gone, stop = CLOSES[name]
            boundary = open_.deepest(stop)
            while (depth := open_.deepest(gone)) > boundary:
                close_to(depth)
        elif block and open_.blocks and open_.tags[open_.blocks[-1]] == "p":
            close_to(open_.blocks[-1])
        if block:
            out.runs.append((open_.nodes[-1], None))
        words = frozenset(w for a in _ATTR.finditer(attributes) for w in _TOKEN.findall((a[2] or a[3] or a[4] or "").lower()))
        out.tags.append(name)
        out.parents.append(open_.nodes[-1])
        out.tokens.append(words)
        if name in RAW:
            closing = _RAW_END[name].search(page, at)
            bracket = page.find(">", closing.end()) if closing else -1
            at = look = bracket + 1 if bracket >= 0 else len(page)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            open_.push(len(out.tags) - 1, name)
    close_to(1)
    return out


N_FEATURES = len(TAGS) + len(OFF_TOKENS) + len(ON_TOKENS) + 20
_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_TOKEN_AT = {t: len(TAGS) + i for i, t in enumerate([*OFF_TOKENS, *ON_TOKENS])}
_OFF, _ON = frozenset(OFF_TOKENS), frozenset(ON_TOKENS)


def features(page: Page) -> np.ndarray:
    """One row of features for each element of a page."""
    n = len(page.tags)
    chars, links, stops, paragraphs, elements = (np.zeros(n) for _ in range(5))
    parents = page.parents
    for node, text in page.runs:
        if text:
            plain = text.strip()
            chars[node] += len(plain)
            stops[node] += plain.count(".") + plain.count(",")
    own = chars.copy()
    in_link = [False] * n
    depth = [0] * n
    off_above, on_above, never_above = [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        p = parents[i]
        in_link[i] = in_link[p] or page.tags[i] == "a"
        depth[i] = depth[p] + 1
        off_above[i] = off_above[p] + bool(page.tokens[p] & _OFF)
        on_above[i] = on_above[p] + bool(page.tokens[p] & _ON or page.tags[p] in ("article", "main"))
        never_above[i] = never_above[p] + (page.tags[p] in NEVER or page.tags[p] == "header")
        if in_link[i]:
            links[i] = chars[i]
        paragraphs[i] = page.tags[i] == "p"
        elements[i] = 1
    for i in range(n - 1, 0, -1):
        p = parents[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        paragraphs[p] += paragraphs[i]
        elements[p] += elements[i]
    siblings, place, like = [0] * n, [0] * n, [0] * n
    seen: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        place[i] = siblings[parents[i]]
        siblings[parents[i]] += 1
        key = (parents[i], page.tags[i])
        seen[key] = seen.get(key, 0) + 1
    out = np.zeros((n, N_FEATURES), np.float32)
    for i in range(n):
        t = _TAG_AT.get(page.tags[i])
        if t is not None:
            out[i, t] = 1
        for w in page.tokens[i]:
            if w in _TOKEN_AT:
                out[i, _TOKEN_AT[w]] = 1
        like[i] = seen.get((parents[i], page.tags[i]), 1)
    whole = max(1.0, chars[0])
    up = np.maximum(parents, 0)
    base = len(TAGS) + len(OFF_TOKENS) + len(ON_TOKENS)
    brothers = np.array(siblings)[up]
    measures = [
        depth, np.log1p(chars), chars / whole, links / np.maximum(chars, 1), stops / np.maximum(chars, 1), np.log1p(paragraphs),
        np.log1p(elements), chars / np.maximum(elements, 1), own / np.maximum(chars, 1), np.log1p(own), off_above, on_above, never_above,
        place, brothers, np.array(place) / np.maximum(brothers, 1), like, [len(t & _OFF) for t in page.tokens],
        [len(t & _ON) for t in page.tokens], [t in NEVER or t == "header" for t in page.tags],
    ]
    for k, m in enumerate(measures):
        out[:, base + k] = m
    return out


@dataclass
class Trees:
    """Boosted trees of one depth: a feature and a cut for each inner node, a value for each leaf."""

    start: float
    which: np.ndarray  # trees x (2**depth - 1)
    cuts: np.ndarray
    leaves: np.ndarray  # trees x 2**depth

    def odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for which, cuts, leaves in zip(self.which, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, which[node]] > cuts[node])
            total += leaves[node - (2**DEPTH - 1)]
        return total


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss with binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    cuts = [np.unique(np.append(c, (x[:, j].min() + x[:, j].max()) / 2)) for j, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    bins = int(binned.max()) + 1
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    total, inner = np.full(len(x), start), 2**DEPTH - 1
    which, values, leaves = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            local = node - first
            best, at = np.full(count, 1e-6), [(0, np.inf)] * count
            all_g, all_h = np.bincount(local, slope, count), np.bincount(local, curve, count)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                key = local * bins + binned[:, j]
                g = np.bincount(key, slope, count * bins).reshape(count, bins).cumsum(1)
                h = np.bincount(key, curve, count * bins).reshape(count, bins).cumsum(1)
                rest_g, rest_h = all_g[:, None] - g, all_h[:, None] - h
                gain = g**2 / (h + 1) + rest_g**2 / (rest_h + 1) - (all_g**2 / (all_h + 1))[:, None]
                gain = gain[:, : len(c)]
                top = gain.argmax(1)
                for k in np.flatnonzero(gain[np.arange(count), top] > best):
                    best[k], at[k] = gain[k, top[k]], (j, c[top[k]])
            for k, (j, cut) in enumerate(at):
                which[t, first + k], values[t, first + k] = j, cut
            node = 2 * node + 1 + (x[np.arange(len(x)), which[t, node]] > values[t, node])
        leaf = node - inner
        leaves[t] = RATE * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + 1)
        total += leaves[t, leaf]
    return Trees(start, which, values.astype(np.float32), leaves)


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Keep or drop each element: the likeliest choice in which nothing is kept below a dropped element."""
    n = len(page.tags)
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    with_self, without = keep.copy(), drop.copy()
    for i in range(n - 1, 0, -1):
        with_self[page.parents[i]] += max(with_self[i], without[i])
        without[page.parents[i]] += without[i]
    out = np.zeros(n, bool)
    out[0] = with_self[0] > without[0]
    for i in range(1, n):
        out[i] = out[page.parents[i]] and with_self[i] > without[i]
    return out


def main_text(page: Page, kept: np.ndarray) -> str:
    """The text of kept elements: blocks in page order, white space inside each one space."""
    blocks, line = [], []
    for node, text in page.runs:
        if text is None:
            blocks.append("".join(line))
            line = []
        elif kept[node]:
            line.append(text)
    blocks.append("".join(line))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def plain_labels(page: Page) -> np.ndarray | None:
    """Labels of a page that marks its main text with article or main: what lies in it, and what leads to it."""
    n = len(page.tags)
    core = [i for i in range(n) if page.tags[i] in ("article", "main")]
    if not core:
        return None
    y = np.zeros(n, bool)
    for i in range(1, n):
        off = page.tags[i] in NEVER or page.tags[i] in ("header", "title") or bool(page.tokens[i] & _OFF)
        y[i] = not off and (page.tags[i] in ("article", "main") or y[page.parents[i]])
    for i in core:
        while y[i] and i > 0:
            i = page.parents[i]
            y[i] = True
    return y


def frame(pieces: list[str], random: np.random.Generator) -> str:
    """A generated page around pieces of text; ``data`` marks in ids tell main text ("on") from the rest ("off")."""
    pick = lambda options: options[int(random.integers(len(options)))]
    some = lambda low, high: [pick(pieces) for _ in range(int(random.integers(low, high + 1)))]
    few = lambda: " ".join(pick(pieces).split()[: int(random.integers(1, 12))])
    chance = lambda p: random.random() < p
    links = lambda: "<ul>" + "".join(f'<li><a href="#">{few()}</a></li>' for _ in range(int(random.integers(2, 8)))) + "</ul>"

    def off(kind: str) -> str:
        name = pick({
            "menu": ["nav", "menu", "navbar", "navigation", "topbar"], "header": ["header", "masthead", "banner"],
            "side": ["sidebar", "widget", "related", "recommended"], "notice": ["notice", "cookie", "consent", "alert", "popup", "modal"],
            "ad": ["ad", "ads", "advert", "sponsor", "promo", "sponsored"], "form": ["newsletter", "signup", "subscribe", "search"],
            "comments": ["comments", "comment", "replies", "disqus"], "footer": ["footer", "copyright"], "share": ["share", "social", "tags", "breadcrumb"],
        }[kind])
        inside = {
            "menu": links, "header": lambda: f"<h1>{few()}</h1>" if chance(0.5) else links(), "side": lambda: f"<h3>{few()}</h3>" + (links() if chance(0.6) else f"<p>{pick(pieces)}</p>"),
            "notice": lambda: f"<p>{few()}</p>" if chance(0.5) else few(), "ad": few, "form": lambda: f"<label>{few()}</label><input><button>{few()}</button>",
            "comments": lambda: "".join(f'<{pick(["div", "li", "p"])} class="{pick(["comment", "reply", "c"])}">{t}' for t in some(1, 4)), "footer": few,
            "share": links,
        }[kind]()
        plain = {"menu": "nav", "header": "header", "side": "aside", "footer": "footer", "form": "form"}.get(kind)
        if plain and chance(0.5):
            return f'<{plain} data-off="1">{inside}</{plain}>'
        tag = pick(["div", "section", "div"] + (["p"] if kind in ("ad", "notice") and "<" not in inside else []))
        attr = pick([f'class="{name}"', f'id="{name}"', f'class="{name} {few().split()[0] if few().split() else "x"}"', f'class="site-{name}"'])
        return f'<{tag} {attr} data-off="1">{inside}</{tag}>'

    body = [f"<h1>{few()}</h1>"] if chance(0.8) else []
    if chance(0.15):
        body.append(off("share"))
    for t in some(1, 12):
        body.append(pick([f"<p>{t}</p>"] * 6 + [f"<p>{t}", f"<p><b>{t}<br>", f"<h2>{few()}</h2><p>{t}</p>", f"<blockquote><p>{t}</p></blockquote>", f"<ul><li>{t}</li><li>{few()}</li></ul>", f"<div>{t}</div>"]))
        if chance(0.06):
            body.append(off(pick(["ad", "share", "notice", "form", "side"])))
    if chance(0.2):
        body.append(off("comments"))
    tag, attr = pick([("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="main"'), ("div", 'class="post entry"'), ("section", 'class="article-body"'), ("div", "")])
    core = f'<{tag} {attr} data-on="1">{"".join(body)}</{tag}>'
    if chance(0.3):
        core = f"<{pick(['main', 'div', 'section'])}>{core}"
    before = "".join(off(k) for k in ("notice", "header", "menu", "ad", "side", "share") if chance(0.45))
    after = "".join(off(k) for k in ("comments", "ad", "side", "form", "notice", "footer") if chance(0.45))
    return f"<!DOCTYPE html><html><head><title>{few()}</title><style>p{{}}</style></head><body>{before}{core}{after}</body></html>"


_MARK = re.compile(r"data-(on|off)=")


def frame_labels(text: str) -> tuple[Page, np.ndarray]:
    """A generated page without its marks, and the labels that they stand for."""
    marked = parse(_MARK.sub(lambda m: f"role=mark{m[1]} data=", text))
    n = len(marked.tags)
    y = np.zeros(n, bool)
    for i in range(1, n):
        if "markoff" not in marked.tokens[i] and marked.tags[i] not in NEVER:
            y[i] = "markon" in marked.tokens[i] or y[marked.parents[i]]
        if "markon" in marked.tokens[i]:
            up = i
            while up > 0:
                up = marked.parents[up]
                y[up] = True
    marked.tokens = [t - {"markon", "markoff"} for t in marked.tokens]
    return marked, y


def train(pages: list[str], seed: int = 3) -> Trees:
    """Fit the trees on sampled pages and on their text in generated frames."""
    random = np.random.default_rng(seed)
    xs, ys, pieces = [], [], []
    for text in pages:
        page = parse(text)
        y = plain_labels(page)
        if y is None:
            continue
        xs.append(features(page))
        ys.append(y)
        if len(pieces) < 5000:
            pieces += [entities.escape(b, quote=False) for b in main_text(page, y).split("\n") if b][:25]
    pieces = pieces or ["A line of text, for pages that have none."]
    for _ in range(FRAMES):
        page, y = frame_labels(frame(pieces, random))
        xs.append(features(page))
        ys.append(y)
    return boost(np.concatenate(xs), np.concatenate(ys).astype(float))


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Trees:
    """Train on at most ``sample`` pages, chosen by a hash of their markup."""
    rows = pages.select(text_or_empty(html_col).alias("html")).where("html != ''")
    chosen = rows.select(F.xxhash64("html").alias("order")).orderBy("order").limit(sample)
    found = rows.join(F.broadcast(chosen.distinct()), F.xxhash64("html") == F.col("order"), "left_semi").distinct().limit(sample)
    return train(sorted(r["html"] for r in found.collect()))


def extract(pages: DataFrame, trees: Trees, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each."""
    (name,) = fresh(pages, text_col)
    (given,) = fresh(pages.withColumn(name, F.lit("")), "html_in")
    columns = pages.columns
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for whole in batches:
            for batch in slices(whole, pc.utf8_length(whole.column(given)).to_numpy(zero_copy_only=False), CHARS_AT_ONCE):
                parsed = [parse(t) for t in batch.column(given).to_pylist()]
                odds = trees.odds(np.concatenate([features(p) for p in parsed]))
                ends = np.cumsum([len(p.tags) for p in parsed])
                texts = [main_text(p, decode(p, o)) for p, o in zip(parsed, np.split(odds, ends[:-1]))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(texts, pa.string())], names=[*columns, name])

    return small_batches(pages.withColumn(given, text_or_empty(html_col))).mapInArrow(run, with_fields(pages, **{name: "string"}))
