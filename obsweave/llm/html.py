"""Main text of web pages: blocks labelled by a minimum cut.

A page is read once into blocks, the runs of text between block-level tags, with what is known of each:
its containers, links, words, punctuation.  A logistic model gives each block the cost of either label; the costs are the
capacities from source and to sink.  Blocks next to each other, and blocks under one parent, are tied by
smoothness edges, stronger the nearer they are in the DOM.  The minimum cut, found by maximum flow, is the
labelling of least total cost.  Blocks whose own costs outweigh all their edges are settled before
(which cannot change the cut), so the flow runs over the doubtful ones only.

The model is trained on a bounded sample of pages (``sample_pages``, those with the least hash of their address).
Labels come from pages that say what is what by tags (article, nav, footer ...); while learning, such features
are often hidden, so that the text's own features learn to decide pages without them.

Scripts, styles, templates and the like never become blocks.  Character references are decoded, white
space in a block becomes one space, blocks are joined by line feeds.

Defined cases: NULL or empty html has no text; a page cut off inside a tag ends before that tag; nothing to learn
from leaves fixed starting weights; repeated rows are answered each; a NULL id stays NULL; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import over_texts, table

# Tags by their role in a page.
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
tbody td tfoot th thead tr ul caption""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template iframe object svg canvas head select textarea datalist".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
OUTSIDE_TAGS = frozenset("nav aside footer form menu dialog button search".split())
INSIDE_TAGS = frozenset("article main".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
HINTS = re.compile(
    r"(?<![a-z])(?:ad|ads|advert|advertisement|adverts|banner|breadcrumb|breadcrumbs|comment|comments|consent|cookie|cookies|"
    r"disqus|footer|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|pagination|popup|promo|related|respond|"
    r"reply|replies|share|sharing|sidebar|signup|social|sponsor|sponsored|subscribe|toolbar|topbar|widget)(?![a-z])")
# An open tag that a new one of the group ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
        "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table body html div article section main".split())

_markup = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
# a quote opens a value only right after the equals sign
_value = r"""\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))"""
_attribute = re.compile(rf"([^\s/>][^\s/>=]*+)(?:{_value})?")
_tag_end = re.compile(rf"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_value})?)*+>")
_sentence = re.compile(r"[.!?…。:;\"”»)][\s\"'”»)]*$")

SMOOTHNESS = 0.8
FAR = 0.35
MAX_COST = 8.0
FEATURES = 11
SAMPLE_PAGES = 400
SAMPLE_CHARS = 200_000


class Block:
    __slots__ = ("text", "words", "linked", "tag", "inside", "outside", "hinted", "parent")

    def __init__(self, text, linked, tag, inside, outside, hinted, parent):
        self.text, self.linked, self.tag = text, linked, tag
        self.words = text.count(" ") + 1
        self.inside, self.outside, self.hinted, self.parent = inside, outside, hinted, parent


class _Open:
    __slots__ = ("tag", "inside", "outside", "hinted", "hidden", "link", "number", "up", "block")

    def __init__(self, tag, inside, outside, hinted, hidden, link, number, up):
        self.tag, self.inside, self.outside, self.hinted = tag, inside, outside, hinted
        self.hidden, self.link, self.number, self.up = hidden, link, number, up  # up: number of the block around
        self.block = self


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; linear in the page but for wrongly nested tags."""
    out: list[Block] = []
    root = _Open("", False, False, False, False, False, 0, 0)
    stack = [root]
    pieces: list[str] = []
    linked = [0]
    count = 0

    def text(raw: str) -> None:
        top = stack[-1]
        if raw and not top.hidden:
            raw = entities.unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            if top.link:
                linked[0] += len(raw.strip())

    def close() -> None:
        if pieces:
            joined = " ".join("".join(pieces).split())
            if joined:
                top = stack[-1].block
                out.append(Block(joined, linked[0], top.tag, stack[-1].inside, stack[-1].outside, stack[-1].hinted, top.up))
            pieces.clear()
        linked[0] = 0

    def pop_to(index: int) -> None:
        if any(e.tag in BLOCK_TAGS for e in stack[index:]):
            close()
        del stack[index:]

    at = 0
    size = len(page)
    while at < size:
        m = _markup.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        if m.group(1):
            end = page.find("-->", m.end())
            at = size if end < 0 else end + 3
            continue
        tag = m.group(3)
        if tag is None:
            end = page.find(">", m.end())
            at = size if end < 0 else end + 1
            continue
        whole = _tag_end.match(page, m.end())
        if whole is None:
            end = page.find(">", m.end())
            if end < 0:
                break  # cut off inside a tag
            stop = end + 1
        else:
            stop = whole.end()
        attributes = page[m.end():stop - 1]
        at = stop
        tag = tag.lower()
        if m.group(2):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
            else:
                if tag in BLOCK_TAGS:
                    close()
            continue
        if tag in BLOCK_TAGS:
            close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in BLOCK_TAGS:
                    break
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[tag]:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag == "br":
            text(" ")
        if tag in VOID_TAGS:
            continue
        top = stack[-1]
        hinted, role = False, ""
        if attributes and tag not in ("body", "html", "article", "main"):
            for a in _attribute.finditer(attributes):
                name, value = a.group(1).lower(), (a.group(2) or a.group(3) or a.group(4) or "").lower()
                if name == "role":
                    role = value
                elif name in ("class", "id") and HINTS.search(value.replace("_", " ")):
                    hinted = True
        outside = top.outside or tag in OUTSIDE_TAGS or role in OUTSIDE_ROLES or (tag == "header" and not top.inside)
        count += 1
        entry = _Open(tag, top.inside or tag in INSIDE_TAGS or role == "main", outside, top.hinted or hinted,
                      top.hidden or tag in HIDDEN_TAGS, top.link or tag == "a", count, top.block.number)
        if tag not in BLOCK_TAGS:
            entry.block = top.block
        stack.append(entry)
        if tag == "body":  # a head that was never closed ends here
            entry.hidden = False
        if tag in RAW_TAGS:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if end is None:
                at = size
            else:
                text(page[at:end.start()] if tag == "title" else "")
                at = end.start()
    close()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """[block, feature]; columns 1, 2, 3 and 8 say what the tags say."""
    out = np.zeros((len(blocks), FEATURES))
    any_inside = any(b.inside for b in blocks)
    for i, b in enumerate(blocks):
        heading = len(b.tag) == 2 and b.tag[0] == "h"
        apart = b.outside or b.hinted
        out[i] = (1.0, b.inside and not apart, b.outside, b.hinted, min(1.0, b.linked / len(b.text)),
                  np.log1p(b.words) / 4, _sentence.search(b.text) is not None, heading, any_inside and not b.inside,
                  b.tag == "li", min(1.0, 10 * b.text.count(",") / len(b.text)))
    return out


_TOLD = (1, 2, 3, 8)
#: Where training starts, and what is used if nothing can be learned.
START_WEIGHTS = np.array([0.0, 3.0, -4.0, -4.0, -3.0, 1.5, 1.0, 0.5, -3.0, -0.5, 1.0])


def fit(pages: list[str], steps: int = 300, rate: float = 0.3, seed: int = 3, decay: float = 1e-3) -> np.ndarray:
    """Logistic weights from the pages whose tags label their blocks."""
    rows, labels = [], []
    for page in pages:
        blocks = blocks_of(page)
        if not any(b.inside for b in blocks):
            continue
        x = features(blocks)
        rows.append(x)
        labels.append(np.array([b.inside and not b.outside and not b.hinted for b in blocks], float))
    w = START_WEIGHTS.copy()
    if not rows:
        return w
    x, y = np.concatenate(rows), np.concatenate(labels)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    rng = np.random.default_rng(seed)
    for _ in range(steps):
        masked = x.copy()
        for column in _TOLD:
            masked[rng.random(len(x)) < 0.4, column] = 0
        p = 1 / (1 + np.exp(-np.clip(masked @ w, -30, 30)))
        w -= rate * (masked.T @ ((p - y) * weight) * 4 + decay * (w - START_WEIGHTS))
    return w


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours, and the next block under the same parent when others lie between."""
    out = []
    latest: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, SMOOTHNESS * (1.0 if blocks[i - 1].parent == b.parent else FAR)))
        before = latest.get(b.parent)
        if before is not None and before < i - 1:
            out.append((before, i, SMOOTHNESS / 2))
        latest[b.parent] = i
    return out


def minimum_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (True: content) of least cost: a block costs ``gain`` if it is not content, -gain if it is (where positive).

    Blocks that outweigh their edges are settled first; Dinic's maximum flow does the rest.
    """
    n = len(gain)
    label = gain > 0
    gain = gain.astype(float).copy()
    open_ = np.ones(n, bool)
    ties: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        ties[a].append((b, w))
        ties[b].append((a, w))
    weight = np.array([sum(w for _, w in t) for t in ties])
    queue = deque(np.flatnonzero(np.abs(gain) > weight).tolist())
    while queue:
        i = queue.popleft()
        if not open_[i]:
            continue
        open_[i] = False
        label[i] = gain[i] > 0
        for j, w in ties[i]:
            if open_[j]:  # a settled neighbour pulls with the edge's weight
                gain[j] += w if label[i] else -w
                weight[j] -= w
                if abs(gain[j]) > weight[j]:
                    queue.append(j)
    left = np.flatnonzero(open_).tolist()
    if left:
        number = {i: k + 2 for k, i in enumerate(left)}
        flow = Flow(len(left) + 2)
        for i in left:
            if gain[i] > 0:
                flow.add(0, number[i], gain[i], 0.0)
            elif gain[i] < 0:
                flow.add(number[i], 1, -gain[i], 0.0)
        for a, b, w in edges:
            if open_[a] and open_[b]:
                flow.add(number[a], number[b], w, w)
        side = flow.source_side(0, 1)
        for i in left:
            label[i] = side[number[i]]
    return label


class Flow:
    """Maximum flow by blocking flows in level graphs."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def add(self, a: int, b: int, there: float, back: float) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-12 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        while True:
            level = self._levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            turn = [0] * len(self.out)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, a = [], source
                    continue
                while turn[a] < len(self.out[a]):
                    e = self.out[a][turn[a]]
                    if self.room[e] > 1e-12 and level[self.to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                if turn[a] < len(self.out[a]):
                    path.append(self.out[a][turn[a]])
                    a = self.to[path[-1]]
                elif path:
                    back = path.pop()
                    a = self.to[back ^ 1]
                    turn[a] += 1
                else:
                    break


def main_text(page: str | None, w: np.ndarray) -> str:
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    gain = np.clip(features(blocks) @ w, -MAX_COST, MAX_COST)  # log p / (1 - p): the difference of the two costs
    label = minimum_cut(gain, edges_of(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, label, strict=True) if keep)


def train(df: DataFrame, key: str = "url", html: str = "html", sample_pages: int = SAMPLE_PAGES,
          sample_chars: int = SAMPLE_CHARS) -> np.ndarray:
    """Weights from at most ``sample_pages`` pages of at most ``sample_chars`` characters."""
    used = df.select(F.xxhash64(F.col(f"`{key}`")).alias("h"), F.col(f"`{html}`").alias("html")).where(
        (F.length("html") > 0) & (F.length("html") <= sample_chars))
    least = [r.h for r in used.select("h").distinct().orderBy("h").limit(sample_pages).collect()]  # hashes only
    if not least:
        return fit([])
    drawn = used.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html"))
    return fit([r.html for r in sorted(drawn.collect())])


def extract(df: DataFrame, weights: np.ndarray, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def each(rows):
        texts = [main_text(h, shared.value) for h in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    used = df.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.col(f"`{html}`").alias("html"))
    return over_texts(used, "html", each, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
