"""Main text of web pages by composite text density.

Each page's tags become a tree. Every node has the density of its text:
characters per tag, adjusted by how much of it is link text. Among the nodes
that hold blocks, the one whose children's densities have the largest sum is
the content, and the smallest density on the path from the body to it is the
page's threshold: neighbours of the path above it (a heading beside the text,
a second article) belong to the content.

Elements that are no article text by their kind (scripts, buttons, hidden
parts) never enter the tree. Menus, footers, forms and elements named like
such parts do, and are taken out before the densities decide - but not one
that holds an article, nor, on a page without any article, a form or a named
element that holds most of the text that is no link.

Pages are handled in one map; a page is never split between tasks.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg xmp noembed noframes".split())
LEFT_OUT = frozenset("head button select option label menu object video audio canvas".split())
NAMED = frozenset("nav footer aside form fieldset dialog header".split())
NEVER_WRAPS = NAMED - {"form", "fieldset"}
BLOCK = frozenset(("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SCOPE = frozenset("html body article section main div td th table blockquote ul ol dl aside nav form header footer button".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "thead": set(), "tfoot": {"tbody", "thead", "tr", "td", "th"}}
ITEM_SCOPE = frozenset("html body ul ol dl table article section main".split())
WHOLE = frozenset("html body article main".split())
# Our choice: class names and ids of page parts; a name of several words counts by its last one that says
# what it is, so post-comments-list does, share-price does not. Words in ALONE count only by themselves.
MARKS = frozenset(("ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner sidebar sidebars rail "
                   "comment comments commentlist disqus respond replies nav navbar navigation menu menus breadcrumb breadcrumbs pagination "
                   "pager footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup share "
                   "sharing social related recommended recommendations widget widgets toolbar paywall").split())
ALONE = frozenset("widget widgets social rail promotion modal overlay pager".split())
TAILS = frozenset("list box bar block area section container wrapper wrap inner slot unit panel links items left right top bottom".split())
UNLESS = frozenset("has no not with without hide".split())
CONTAINERS = frozenset("div section ul ol dl table center span details".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
# a name begins where no other character of a name stands before it, so long runs are read once
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


KEEP, PART, NEVER = 0, 1, 2


class Node:
    __slots__ = ("tag", "parent", "children", "part", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, part: bool = False) -> None:
        self.tag, self.parent, self.children, self.part = tag, parent, [], part
        self.clear()

    def clear(self) -> None:
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _marked(names: str) -> bool:
    """Does a class attribute or an id name a part of a page that is no article?"""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        while len(words) > 1 and words[-1] in TAILS:
            words.pop()
        if words and words[-1] in MARKS and (len(words) == 1 or words[-1] not in ALONE and words[0] not in UNLESS):
            return True
    return False


def _kind(tag: str, attributes: str, inside_article: bool) -> int:
    """NEVER: no text of the page; PART: perhaps a part that is no article."""
    if tag in LEFT_OUT:
        return NEVER
    found = PART if tag in NAMED and not (tag == "header" and inside_article) else KEEP
    if not attributes or tag in WHOLE:
        return found
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            return NEVER
        if name == "role" and value in ROLES or name in ("class", "id") and tag in CONTAINERS and _marked(value):
            found = PART
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes), re.I):
        return NEVER
    return found


def _parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree (its root is the body) and the text runs as (node, raw text),
    with (node, None) where a block begins or ends."""
    root = node = Node("body", None)
    runs: list[tuple[Node, str | None]] = []
    dropping: list[str] = []  # open elements under one that is left out
    at, end = 0, len(page)
    lower = None
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not dropping:
            runs.append((node, page[at:stop]))
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), (m[1] if m[2] else m[4]) == "/", (m[3] if m[2] else m[6])
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                lower = page.lower() if lower is None else lower
                if len(lower) != end:  # a few letters grow in lower case
                    lower = re.sub(r"[A-Z]+", lambda x: x[0].lower(), page)
                at = lower.find(f"</{tag}", at)
                if at < 0:
                    break
                at = page.find(">", at) + 1 or end
            continue
        if dropping:
            if closing:
                if tag in dropping:
                    while dropping.pop() != tag:
                        pass
                elif tag in ("body", "html"):
                    dropping.clear()
            elif tag in ("body", "article", "main") and dropping[0] == "head":
                dropping.clear()
            elif tag not in VOID:
                if tag == "p" and dropping[-1] == "p" or tag in SIBLINGS and dropping[-1] == tag:
                    dropping.pop()
                dropping.append(tag)
            if dropping or closing or tag in VOID:
                continue
        if tag in ("html", "body"):
            continue
        if closing:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                while node is not up:
                    node = node.parent
                node = up.parent
            if tag in BLOCK:
                runs.append((node, None))
            continue
        if tag in CLOSES_P or tag in SIBLINGS:
            ends, walls = ({"p"}, SCOPE) if tag in CLOSES_P else (SIBLINGS[tag], ITEM_SCOPE)
            if tag in SIBLINGS:
                ends, walls = SIBLINGS[tag] | {"p"}, ITEM_SCOPE
            up, found = node, None
            while up is not root and up.tag not in walls - ends:
                if up.tag in ends:
                    found = up
                up = up.parent
            if found is not None:
                node = found.parent
        inside = False
        if tag == "header":
            up = node
            while up is not root and not inside:
                inside, up = up.tag in ("article", "main"), up.parent
        if tag in BLOCK:
            runs.append((node, None))
        kind = _kind(tag, attributes, inside)
        if kind == NEVER:
            if tag not in VOID and not attributes.endswith("/"):
                dropping.append(tag)
            continue
        if tag == "br":
            runs.append((node, " "))
        child = Node(tag, node, kind == PART)
        node.children.append(child)
        if tag not in VOID:
            node = child
    return root, runs


def _measure(root: Node, runs: list) -> list[Node]:
    """Fill the counts, densities and sums of the nodes below ``root``; all of
    them, parents first. Text of nodes that were taken out counts nowhere."""
    order = [root]
    for node in order:
        node.clear()
        order.extend(node.children)
    there = {id(node) for node in order}
    for node, text in runs:
        if text and id(node) in there:
            node.chars += len("".join(text.split()))
    for node in reversed(order):
        if node.tag == "a":
            node.link_chars = node.chars
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a")
    body_links = root.link_chars / max(1, root.chars)
    for node in order:
        node.density = _density(node, body_links)
    for node in order:
        node.total = sum(child.density for child in node.children)
    return order


def _density(node: Node, body_links: float) -> float:
    """Characters per tag, less the more of them are link text."""
    c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), max(1, node.link_tags)
    if not c:
        return 0.0
    own = math.log(c / max(1, lc) * t / lt + 1e-9)
    base = math.log(c / max(1, c - lc) * lc + body_links * c + math.e)
    return c / t * own / math.log(base + 1e-9) if base > 1.0000001 else c / t * max(1.0, own)


def _articles(order: list[Node]) -> dict[int, bool]:
    """Whether each node is or holds an article or main element with text."""
    held = {id(node): node.tag in ("article", "main") and node.chars > 0 for node in order}
    for node in reversed(order):
        if node.parent is not None:
            held[id(node.parent)] |= held[id(node)]
    return held


def _take_out(root: Node, runs: list) -> None:
    """Take the page's parts that are no article out of the tree."""
    order = _measure(root, runs)
    held = _articles(order)
    plain = root.chars - root.link_chars
    for node in order:  # a part whose parent is out is not reached through the tree
        wraps = node.tag not in NEVER_WRAPS and not held[id(root)] and 2 * (node.chars - node.link_chars) > plain
        if node.part and not held[id(node)] and not wraps:
            node.parent.children = [x for x in node.parent.children if x is not node]


def _content(root: Node, runs: list) -> set[int]:
    """ids of the nodes whose text is content."""
    _take_out(root, runs)
    order = _measure(root, runs)
    blocks = [x for x in order if any(y.tag in BLOCK and y.chars for y in x.children)]
    best = max(blocks, key=lambda x: x.total, default=root)  # ties: the earlier, so the outer, node
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    own = next((x for x in path if x.tag == "article"), next((x for x in path if x.tag == "main"), best))
    above = path[path.index(own) + 1:]
    on_path = {id(x) for x in path}
    held = _articles(order)
    inside = {id(x) for x in above}
    tops = [own]
    # beside an article only other articles are content, else whatever is dense enough
    alone = own.tag not in ("article", "main")
    tops += [y for x in above for y in x.children if id(y) not in on_path and y.chars
             and (y.density >= threshold if alone else held[id(y)] and 2 * y.density >= threshold)]
    for node in tops:
        inside.add(id(node))
        tops.extend(node.children)
    return inside


def main_text(page: str | None) -> str:
    """The page's content blocks, joined by an empty line; '' without any."""
    if not page:
        return ""
    root, runs = _parse(page)
    content = _content(root, runs)
    blocks, block = [], []
    for node, text in [*runs, (root, None)]:
        if text is None:
            words = html.unescape("".join(block)).split()
            if words:
                blocks.append(" ".join(words))
            block = []
        elif id(node) in content:
            block.append(text)
    return "\n\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) per row of ``pages``; ids and urls come back as
    they are. NULL, empty and text-free pages have ''; repeated rows are each
    handled; unclosed and stray tags end where HTML's rules end them."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    out = src.withColumnRenamed("html", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x.as_py()) for x in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], ["page_id", "url", "text"])

    return src.mapInArrow(run, out.schema)
