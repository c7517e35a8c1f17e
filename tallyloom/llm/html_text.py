"""HTML extraction by minimum-cut labelling of text blocks.

A page is read into text blocks, each with the elements it stands in. A linear classifier over names,
lengths and links gives each block a cost for being content and one for being boilerplate; these are the
capacities to the two terminals. Blocks that follow one another are tied, more strongly the closer they
are in the document tree, and blocks of one container are tied through a node of their own. The minimum
cut of this graph, found by maximum flow, separates content from boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.base import table
from tallyloom.llm.registry import query

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page, up to their end tag.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the key ends where one of the same set starts, unless one of the walls lies between.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
        "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
P_WALLS = ("button", "td", "th", "table", "caption", "body")

# What an element says about the text inside it: a name for each kind of place.
TAG_KIND = {"nav": "menu", "menu": "menu", "footer": "footer", "header": "header", "aside": "sidebar", "form": "form", "button": "form", "select": "form", "fieldset": "form", "label": "form", "dialog": "notice",
            "svg": "hidden", "template": "hidden", "object": "hidden", "canvas": "hidden", "audio": "hidden", "video": "hidden", "article": "article", "main": "main"}
ROLE_KIND = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "sidebar", "search": "form", "form": "form", "alert": "notice", "alertdialog": "notice", "dialog": "notice", "main": "main", "article": "article"}
TOKENS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip",
    "footer": "footer foot copyright colophon legal imprint",
    "header": "header masthead topline",
    "sidebar": "sidebar aside rail widget widgets related recommended recommendations popular trending share sharing social tags toc",
    "notice": "notice notices cookie cookies consent gdpr banner alert popup modal overlay newsletter subscribe subscription signup paywall disclaimer promo promotion",
    "advert": "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors commercial dfp",
    "comments": "comment comments commentlist disqus reply replies respond discussion responses feedback",
    "form": "form login search searchbox signin register",
    "hidden": "hidden invisible",
    "content": "article content post entry story text prose",
}
TOKEN_KIND = {token: kind for kind, tokens in TOKENS.items() for token in tokens.split()}

#: Weight of each kind of place, in log odds of content.
WEIGHTS = {"article": 3.0, "main": 1.5, "content": 1.0, "menu": -8.0, "footer": -8.0, "header": -7.0, "sidebar": -8.0, "form": -8.0, "notice": -8.5, "advert": -9.0, "comments": -10.0, "hidden": -12.0}
#: What weak evidence counts for.
WEAK = 1 / 3
BIAS, OUTSIDE, LINKED, LONG, LONGER, HEADING, PARAGRAPH = -0.6, -2.5, -3.0, 1.5, 1.5, 0.3, 1.0
#: Ties between neighbours at tree distance 0 and between a container and its blocks.
ADJACENT, CONTAINER = 0.8, 0.25
#: Log odds are turned into whole capacities.
UNIT = 1000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|</?[A-Za-z].*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Place:
    """An element that is not inline, in the document tree."""

    __slots__ = ("number", "parent", "depth")

    def __init__(self, number: int, parent: Place | None) -> None:
        self.number, self.parent, self.depth = number, parent, parent.depth + 1 if parent else 0

    @staticmethod
    def of(path: tuple[int, ...]) -> Place:
        found = None
        for number in path:
            found = Place(number, found)
        return found or Place(0, None)


def apart(a: Place, b: Place) -> int:
    """Steps between two places in the tree, up to the nearest element around both and down again."""
    steps = 0
    while a.number != b.number or a.depth != b.depth:
        if a.depth >= b.depth and a.parent:
            a, steps = a.parent, steps + 1
        elif b.parent:
            b, steps = b.parent, steps + 1
        else:  # two roots
            return steps + 2
    return steps


class Block:
    __slots__ = ("link", "place", "kinds", "tag", "text")

    def __init__(self, text: str, link: int, place: Place | tuple[int, ...], kinds: frozenset[str], tag: str) -> None:
        self.text, self.link, self.kinds, self.tag = text, link, kinds, tag
        self.place = place if isinstance(place, Place) else Place.of(place)


def named_kinds(tag: str, attribute: str, value: str) -> Iterator[str]:
    """Kinds of place that a class or id speaks of, marked by ? where it is weak evidence.

    The words of a paragraph's, heading's or section's names often tell what it is about: its id, and words
    before the last one of a compound class, are weak.
    """
    spoken = tag in HEADINGS or tag in ("p", "section")
    for name in value.split():
        words = [w.lower() for w in _TOKEN.findall(name)]
        for i, word in enumerate(words):
            if word in TOKEN_KIND:
                weak = spoken and (attribute == "id" or i < len(words) - 1)
                yield TOKEN_KIND[word] + ("?" if weak else "")


def kinds_of(tag: str, attributes: str) -> set[str]:
    found = {TAG_KIND[tag]} if tag in TAG_KIND else set()
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return found
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role":
            found.add(ROLE_KIND.get(value.strip().lower(), ""))
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            found.add("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            found.add("hidden")
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            found.update(named_kinds(tag, name, value))
    found.discard("")
    return found


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. Elements that are never closed, or closed out of order, end with their parents."""
    out: list[Block] = []
    # Name, kinds of place, the innermost element that is not inline, and its name.
    stack: list[tuple[str, frozenset[str], Place, str]] = [("", frozenset(), Place(0, None), "")]
    count: dict[str, int] = {}
    pieces: list[str] = []
    linked = numbered = 0
    at, low = 0, None

    def flush() -> None:
        nonlocal linked, pieces
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, linked, owner[2], owner[1], owner[3]))
            pieces, linked = [], 0

    owner = stack[0]

    def add(text: str) -> None:
        nonlocal linked, owner
        if not pieces:
            if not text.strip():
                return
            owner = stack[-1]
        text = html.unescape(text)
        pieces.append(text)
        if count.get("a"):
            linked += len(text)

    def pop() -> None:
        count[stack.pop()[0]] -= 1

    def close(names: tuple[str, ...], walls: tuple[str, ...]) -> None:
        """Ends the innermost open element of these names and all inside it, if no wall is nearer."""
        if any(count.get(n) for n in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in names:
                    while len(stack) > i:
                        pop()
                    return
                if stack[i][0] in walls:
                    return

    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, ends, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        block = name not in INLINE and name not in RAW
        if block:
            flush()
        if ends:
            if count.get(name):
                close((name,), ())
            continue
        if name in RAW:
            low = page.lower() if low is None or len(low) != len(page) else low
            if len(low) != len(page):  # a letter whose lower case is longer: look in the page itself
                found = re.compile(f"</{name}", re.I).search(page, at)
                end = found.start() if found else -1
            else:
                end = low.find(f"</{name}", at)
            at = len(page) if end < 0 else end
            continue
        if block and count.get("p"):
            close(("p",), P_WALLS)
        if name in ENDS:
            close(*ENDS[name])
        if name in VOID or attributes.endswith("/") and name in ("path", "g", "use"):
            continue
        numbered += 1
        own, above = kinds_of(name, attributes), stack[-1][1]
        if "form" in above and own & {"article", "main"}:  # a form around the whole page says nothing
            above = above - {"form"}
        place, tag = stack[-1][2:] if name in INLINE else (Place(numbered, stack[-1][2]), name)
        stack.append((name, above | own if own - above else above, place, tag))
        count[name] = count.get(name, 0) + 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def log_odds(block: Block, has_article: bool) -> float:
    """The classifier: how much more likely the block is content than boilerplate."""
    kinds = block.kinds
    heading = block.tag in HEADINGS
    score = BIAS
    weak = [0.0]
    for kind in kinds:
        plain = kind.rstrip("?")
        # A headline in an article's own header belongs to the article.
        if plain == "header" and heading and kinds & {"article", "main"}:
            continue
        if plain == kind:
            score += WEIGHTS[kind]
        elif plain not in kinds:
            weak.append(WEAK * WEIGHTS[plain])
    score += min(weak) + max(weak)  # of several weak signs against, and for, the strongest counts
    if has_article and not kinds & {"article", "main"}:
        score += OUTSIDE
    words = block.text.count(" ") + 1
    score += LONG * (words >= 8) + LONGER * (words >= 25) + HEADING * heading + PARAGRAPH * (block.tag in ("", "p"))
    return score + LINKED * (block.link > 0.5 * len(block.text))


def min_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source side of a minimum cut. edges: undirected (a, b, capacity). Flow by levels."""
    n = len(source)
    # What a node can pass on straight away from source to sink cuts nothing.
    left = [a - min(a, b) for a, b in zip(source, sink)]
    right = [b - min(a, b) for a, b in zip(source, sink)]
    if not any(left) or not any(right):
        return [x > 0 for x in left] if any(right) else [True] * n if any(left) else [False] * n
    s, t = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        if left[i]:
            edge(s, i, left[i], 0)
        if right[i]:
            edge(i, t, right[i], 0)
    for a, b, c in edges:
        edge(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                turn[a] += 1
            else:
                if a == s:
                    break
                back = path.pop()
                a = to[back ^ 1]
                turn[a] += 1


def label(found: list[Block]) -> list[bool]:
    """Whether each block is content."""
    has_article = any("article" in b.kinds or "main" in b.kinds for b in found)
    source, sink, edges, hubs = [], [], [], {}
    for b in found:
        score = max(-30.0, min(30.0, log_odds(b, has_article)))
        # -log(1 - p) and -log(p) of the logistic p: what calling it boilerplate, or content, costs.
        source.append(round(UNIT * math.log1p(math.exp(score))))
        sink.append(round(UNIT * math.log1p(math.exp(-score))))
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, round(UNIT * ADJACENT / (1 + apart(found[i - 1].place, b.place)))))
        # The container: the parent of the block's own element.
        hub = b.place.parent.number if b.place.parent else 0
        at = hubs.setdefault(hub, len(found) + len(hubs))
        edges.append((i, at, round(UNIT * CONTAINER)))
    nothing = [0] * len(hubs)
    return min_cut(source + nothing, sink + nothing, edges)[: len(found)]


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by line feeds; empty for a null or empty page."""
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, kept in zip(found, label(found)) if kept)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (page_id, url, html).

    Whole pages are read, however long; a tag cut off at the end is dropped. A null or empty page has
    an empty text. Repeated rows are returned as often as given, other columns are ignored, an empty
    table gives an empty result.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
