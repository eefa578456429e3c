"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level markup. A linear classifier of
a block's surroundings and text gives the cost of calling it boilerplate (its
capacity from the source) or content (to the sink); neighbouring blocks, and
blocks next to each other under one parent, are joined by edges that are the
stronger the nearer they are in the document tree. The minimum cut, found by
maximum flow, labels all blocks together.

Pages carry no labels, so the part of the classifier that judges a block's own
text is trained on the blocks whose surroundings leave no doubt (an article, a
menu, a footer): a logistic regression, drawn towards stated starting weights,
on the counts of those blocks in a bounded sample of pages. Where markup says
little, the text decides by what it learned there.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

# The markup that the labelling knows.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is between these and their end tag is not shown as the page's text. Only the first two go on to the page's end without one.
RAW_TAGS = frozenset("script style template textarea iframe select head title".split())
ENDLESS_TAGS = frozenset("script style".split())
#: A start tag that ends an open element of these kinds, up to the nearest container.
IMPLIED_END = {t: frozenset(["p"]) for t in BLOCK_TAGS} | {
    "li": frozenset(["p", "li"]), "dd": frozenset(["p", "dt", "dd"]), "dt": frozenset(["p", "dt", "dd"]),
    "tr": frozenset(["p", "tr", "td", "th"]), "td": frozenset(["p", "td", "th"]), "th": frozenset(["p", "td", "th"]),
    "option": frozenset(["option"]),
}
CONTAINERS = frozenset("article aside blockquote body div dl fieldset footer form header html main menu nav ol section table ul".split())
#: Weights of the classifier (positive: content), by the tags around a block and by words in their class, id and role.
TAG_WEIGHTS = {
    "article": 3.0, "main": 2.0, "p": 0.6, "h1": 0.8, "h2": 0.4, "blockquote": 0.4, "pre": 0.6, "td": -0.2, "figcaption": 0.2,
    "nav": -4.0, "footer": -4.0, "aside": -4.0, "form": -4.0, "menu": -4.0, "dialog": -4.0, "button": -4.0, "label": -3.0,
    "header": -4.0, "fieldset": -3.0, "details": -0.5, "address": -3.0, "caption": -0.2,
}
#: What a list item speaks for where no box is around it: short ones are no less text than paragraphs, links count against them.
FREE_ITEM = 0.7
#: An element of this weight or less is a box of boilerplate; of boxes in each other only the strongest counts.
BOX = -3.0
CONTENT_NAME = re.compile(r"^(article|articlebody|post|entry|story|content|main|maincontent|prose|text|body|markdown)$")
COMMENT_NAME = re.compile(r"^(comments?|commentlist|respond|responses|replies|reply|disqus|discussion|reactions|feedback|forum)$")
COMMENT_BOX = -5.0
BOX_NAMES = [
    (re.compile(
        r"^(nav|navbar|navigation|menu|menubar|breadcrumbs?|pagination|pager|footer|foot|masthead|banner|sidebar|sidenav|aside|"
        r"complementary|contentinfo|search|login|signup|toolbar|topbar)$"), -4.0),
    (re.compile(
        r"^(ads?|adverts?|advertisements?|advertising|sponsor(ed|s)?|promo(tion|s)?|teasers?|outbrain|taboola|cookies?|consent|gdpr|"
        r"notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|paywall|disclaimer|copyright|legal)$"), -4.0),
    (COMMENT_NAME, COMMENT_BOX),
    (re.compile(r"^(share|sharing|social|related|recommended|recommendations|more|widgets?|tags?|meta|byline|toc|skip|hidden|sr)$"), -3.0),
]
#: A name's role is its last word, these left out; names that begin with a word of the second kind say what a page has or is about.
_TRAILING = frozenset("area box buttons inner item items link links list only posts slot unit".split())
_LEADING = frozenset("has with without no is show hide category tag topic term type format status".split())
#: Elements that names never make a box, and boxes that never hold a whole page.
NO_BOX = frozenset("html body main".split())
SURE_BOX = frozenset("nav footer aside menu dialog button label header".split())
#: Boxes with over half of a page's text, but those of comments, don't count while less than this share of it is outside all boxes.
LEAST_OUTSIDE = 0.1
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
#: What short lines at a page's foot say; in longer blocks it is a topic.
LEGAL = re.compile(
    r"©|\(c\) ?(19|20)\d\d|all rights reserved|tous droits réservés|alle rechte vorbehalten|todos los derechos reservados|"
    r"\b(privacy|cookie) (policy|settings|notice)\b|\bterms of (use|service)\b"
)
LEGAL_WORDS = 25


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the elements around it, from the root
    weight: float  # of the elements around it
    link_chars: int
    in_heading: bool


class _Element:
    __slots__ = ("tag", "number", "hidden", "inside")

    def __init__(self, tag: str, number: int, hidden: bool, inside: bool) -> None:
        self.tag, self.number, self.hidden, self.inside = tag, number, hidden, inside


def _box_name(name: str, tag: str) -> float:
    """Cost of one class, id or role: 0 unless it names a box of boilerplate, by itself or by the role at its end."""
    parts = _NAME.findall(name)
    if tag in NO_BOX or not parts or (len(parts) > 1 and parts[0] in _LEADING):
        return 0.0
    if tag == "article":  # an article in an article's discussion
        return COMMENT_BOX if len(parts) == 1 and COMMENT_NAME.match(parts[0]) else 0.0
    while len(parts) > 1 and parts[-1] in _TRAILING:
        parts.pop()
    return min((w for r, w in BOX_NAMES if r.match(parts[-1])), default=0.0)


def _judge(tag: str, attributes: str, inside_article: bool) -> tuple[float, float, bool]:
    """Weight of an element, its cost as a box (0 if it is none) and whether it is not shown."""
    weight = TAG_WEIGHTS.get(tag, 0.0)
    if tag == "header" and inside_article:
        weight = 0.0  # an article's own heading
    box = 0.0
    if weight <= BOX:
        weight, box = 0.0, weight
    hidden = False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id", "role", "itemprop"):
                cost = min((_box_name(word, tag) for word in value.split()), default=0.0)
                box = min(box, cost)
                if not cost and any(CONTENT_NAME.match(part) for part in _NAME.findall(value)):
                    weight += 1.5
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
    return weight, box, hidden


def _weigh(blocks: list[Block], judged: list[tuple[str, float, float]]) -> None:
    """Set the blocks' weights from (tag, weight, box) of the elements around them.

    A box takes away what the elements around it speak for. Boxes that hold the
    page itself (see ``LEAST_OUTSIDE``) are passed over, the outermost first.
    """
    total = sum(len(b.text) for b in blocks)
    boxes = {i for i, (_, _, box) in enumerate(judged) if box}
    within: Counter[int] = Counter()
    for b in blocks:
        for e in b.path:
            if e in boxes:
                within[e] += len(b.text)
    # elements are numbered as they open, so outer ones come first
    wide = [i for i in sorted(boxes) if judged[i][0] not in SURE_BOX and judged[i][2] > COMMENT_BOX and 2 * within[i] > total]
    for i in wide:
        if sum(len(b.text) for b in blocks if boxes.isdisjoint(b.path)) >= LEAST_OUTSIDE * total:
            break
        boxes.discard(i)
    for b in blocks:
        speaks, cost = 0.0, 0.0
        for e in b.path:
            _, weight, box = judged[e]
            if e in boxes:
                speaks, cost = 0.0, min(cost, box)
                if weight > 0:
                    continue
            speaks += weight
        b.weight = speaks + (cost or FREE_ITEM * any(judged[e][0] == "li" for e in b.path))


def _end_of(page: str, tag: str, at: int) -> int | None:
    """Where the element that was opened just before ``at`` ends, elements of its kind within counted; None if it doesn't."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return None


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order; scripts, styles, the head and hidden elements have none."""
    out: list[Block] = []
    open_: list[_Element] = [_Element("", 0, False, False)]
    judged: list[tuple[str, float, float]] = [("", 0.0, 0.0)]
    parts: list[str] = []
    linked = 0
    in_link = 0

    def flush() -> None:
        nonlocal parts, linked, in_link
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            heading = any(e.tag in ("h1", "h2", "h3", "h4", "h5", "h6") for e in open_[-3:])
            out.append(Block(text, tuple(e.number for e in open_), 0.0, min(linked, len(text)), heading))
        parts, linked, in_link = [], 0, 0

    at, size = 0, len(page)
    while at <= size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at and not open_[-1].hidden:
            piece = page[at:stop]
            parts.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                parts.append(html.escape(m[0][9:-3]))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW_TAGS and not closing:
            if tag == "head" or m[3].rstrip().endswith("/"):
                if tag == "head":  # its own elements are raw; text goes on after it
                    end = re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
                    if end:
                        at = end.end() if end[0][1] == "/" else end.start()
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size if tag in ENDLESS_TAGS else at
            if tag in ("title", "textarea", "select"):
                flush()
            continue
        if tag == "a":
            in_link = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS and tag not in TAG_WEIGHTS:
            if not closing and m[3] and tag not in VOID_TAGS and _judge(tag, m[3], False)[2]:
                at = _end_of(page, tag, at) or at  # an inline element that is not shown
            continue
        flush()
        if closing:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
            continue
        ends = IMPLIED_END.get(tag, frozenset())
        k = len(open_) - 1
        while k > 0 and open_[k].tag not in CONTAINERS:
            if open_[k].tag in ends:
                del open_[k:]
            k -= 1
        if tag in VOID_TAGS:
            continue
        up = open_[-1]
        weight, box, hidden = _judge(tag, m[3], up.inside)
        open_.append(_Element(tag, len(judged), up.hidden or hidden, up.inside or tag in ("article", "main")))
        judged.append((tag, weight, box))
    flush()
    _weigh(out, judged)
    return out


#: Weights of ``features`` before training, and how strongly training is drawn to them (against a mean loss).
START = (-0.7, 1.0, -4.0, 0.5, 0.5, -3.0)
PULL = 0.05
#: Weights of surroundings that label a block for training: at most the first is boilerplate, at least the second content.
SURE = (-4.0, 3.0)
_BINS = "content int, words int, linked int, ended int, heading int, legal int"


def binned(b: Block) -> tuple[int, int, int, int, int]:
    """What a block's own text is like: words (to 30), eighths in links, ends like a sentence, in a heading, a short legal line."""
    words = min(30, b.text.count(" ") + 1)
    return (
        words, round(8 * b.link_chars / len(b.text)), int(b.text[-1] in ".!?…\"'”’»:;。！？"), int(b.in_heading),
        int(words <= LEGAL_WORDS and LEGAL.search(b.text.lower()) is not None),
    )


def features(words: int, linked: int, ended: int, heading: int, legal: int = 0) -> tuple[float, ...]:
    return (1.0, words / 20, linked / 8, ended, heading, legal)


def fit(counts: Sequence[tuple[int, ...]], start: Sequence[float] = START, pull: float = PULL) -> tuple[float, ...]:
    """Weights by logistic regression on (content, *binned, number of blocks), both classes weighing the same.

    ``start`` comes back if a class is missing.
    """
    rows = sorted(counts)
    y = np.array([r[0] for r in rows], float)
    n = np.array([r[-1] for r in rows], float)
    if not (y == 1).any() or not (y == 0).any():
        return tuple(start)
    x = np.array([features(*r[1:-1]) for r in rows], float)
    share = np.where(y == 1, n / n[y == 1].sum(), n / n[y == 0].sum()) / 2
    prior = np.array(start, float)
    w = prior.copy()
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (share * (p - y)) + pull * (w - prior)
        step = np.linalg.solve((x.T * (share * p * (1 - p))) @ x + pull * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(np.round(w, 4).tolist())


def learn(df: DataFrame, id_col: str = "page_id", html_col: str = "html", max_train_pages: int = 5_000) -> tuple[float, ...]:
    """Weights from the pages of at most ``max_train_pages`` ids, those of the smallest hashes.

    Only counts of blocks that look alike reach the driver (at most 4,284 rows).
    Pages with a null id or null html don't train; without sure blocks of both
    kinds the weights stay as they start.
    """
    pages = df.select(F.col(id_col).cast("long").alias("_id"), F.col(html_col).alias("_html")).where("_id is not null")
    chosen = pages.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(max_train_pages)
    schema = f"{_BINS}, n long"
    arrow = S.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[int, ...]] = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for b in blocks_of(page) if page else []:
                    if b.weight <= SURE[0] or b.weight >= SURE[1]:
                        seen[(int(b.weight > 0), *binned(b))] += 1
        yield S.batch_of([(*k, n) for k, n in seen.items()], arrow)

    rows = S.map_rows(pages.join(F.broadcast(chosen), "_id"), {"html": F.col("_html")}, run, schema)
    counts = rows.groupBy("content", "words", "linked", "ended", "heading", "legal").agg(F.sum("n").alias("n"))
    return fit([tuple(r) for r in counts.collect()])


def leaning(b: Block, weights: Sequence[float] = START) -> float:
    """The classifier: positive for content, from where the block stands and what its text is like."""
    return max(-20.0, min(6.0, b.weight)) + sum(w * x for w, x in zip(weights, features(*binned(b)), strict=True))


def _nearness(a: tuple[int, ...], b: tuple[int, ...]) -> float:
    """1 for the same or sibling elements, falling with the steps between them in the tree."""
    common = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        common += 1
    return 1.0 / (1 + max(0, len(a) + len(b) - 2 * common - 2))


def min_cut(lean: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """Which blocks stay on the source's side (content) in the minimum cut; by Dinic's maximum flow in whole units."""
    n = len(lean)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        at[a].append(len(to))
        at[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((round(1000 * there), round(1000 * back)))

    for i, x in enumerate(lean):
        edge(source, i, x, 0) if x > 0 else edge(i, sink, -x, 0)
    for a, b, w in edges:
        edge(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []  # edges from the source to where we stand
        while True:
            a = to[path[-1]] if path else source
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                path = path[: next(k for k, e in enumerate(path) if not room[e])]
                continue
            while following[a] < len(at[a]):
                e = at[a][following[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    path.append(e)
                    break
                following[a] += 1
            else:
                if not path:
                    break
                level[a] = -1
                path.pop()


def label(blocks: Sequence[Block], weights: Sequence[float] = START, smoothness: float = 0.8) -> list[bool]:
    """Content or not, for all blocks of a page together."""
    lean = [leaning(b, weights) for b in blocks]
    if all(x > 0 for x in lean) or all(x <= 0 for x in lean):
        return [x > 0 for x in lean]
    edges = [(i, i + 1, smoothness * _nearness(a.path, b.path)) for i, (a, b) in enumerate(zip(blocks, blocks[1:], strict=False))]
    under: dict[tuple[int, ...], int] = {}
    for i, b in enumerate(blocks):  # the block before under the same parent, if others lie between
        k = under.get(b.path[:-1])
        if k is not None and k < i - 1:
            edges.append((k, i, smoothness / 2))
        under[b.path[:-1]] = i
    return min_cut(lean, edges)


def main_text(page: str | None, weights: Sequence[float] = START) -> str:
    """Content blocks joined by empty lines; empty for null, empty or wholly dropped pages."""
    blocks = blocks_of(page) if page else []
    return "\n\n".join(b.text for b, content in zip(blocks, label(blocks, weights), strict=True) if content)


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_train_pages: int = 5_000
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    The classifier is trained first on at most ``max_train_pages`` ids. Null html gives an empty text; null ids and urls stay null; repeated rows
    are returned as often as given; an empty table gives an empty result.
    """
    weights = learn(df, id_col, html_col, max_train_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, weights) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    columns = {"page_id": F.col(id_col).cast("long"), "url": F.col(url_col).cast("string"), "html": F.col(html_col)}
    return S.map_rows(df, columns, run, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(S.read_table(spark, sf_dir, "pages"))
