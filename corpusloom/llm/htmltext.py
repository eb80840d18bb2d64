"""Main text of HTML pages by composite text density.

Every node of the page's tree has characters C and tags T, and of these those inside links, LC and LT. Its
composite density is C / T times the logarithm of (C / LC) (T / LT), to a base that grows with the node's link
characters and the page's share of them: long text between few tags counts, links count against it. A node's
density sum adds its children's densities. The subtree of the largest sum is the article (the enclosing article
element, where there is one); the smallest density on its way to body is the threshold: the subtree grows to its
parent while other blocks there reach the threshold and hold much text, and lists of links below it leave.

Elements around an article (menus, headers and footers outside it, forms, asides, and those whose class, id or role
names adverts, notices, comments or sidebars) are cut before densities are taken, but never one that encloses the
page's main article element or nearly all of its unlinked text: a wrapper that names its sidebar, a form around the
whole page and an aside that is not closed keep what they hold. Names of layouts (no-sidebar, with-sidebar,
has-header-image) name no such part.

Null html is empty and an empty table gives an empty result; a page of any length is read whole; repeated rows are
read each; columns other than page_id, url and html are ignored. Broken or unclosed markup is read as browsers do in
outline: block starts close paragraphs, an end tag closes what it can. Of densities that tie, the first in page order
of the walk counts.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import texts

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*)[^>]*(?:>|\Z)", re.S)
MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements without text for readers, skipped with all they hold.
SKIPPED = frozenset("script style noscript template head title iframe object svg math canvas audio video map datalist".split())
#: Elements around the article rather than of it.
AROUND = frozenset("nav footer aside form button select textarea fieldset menu dialog label input".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Words in a class, id or role that name a part which is no article text.
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr
    notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall sidebar side aside rail widget widgets
    nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar footer foot copyright comment comments
    commentlist disqus reply replies discussion respond related recommended recommendations share sharing social tags search toc
    complementary contentinfo dialog hidden""".split()
)
#: Names of a page's head, which an article may have too.
HEADS = frozenset("header masthead".split())
#: With such a word, a name tells of a layout and not of the part itself.
LAYOUT = frozenset("no not has have with without is wrap wrapper wrapping container layout fixed page content body main two three left right col cols column columns".split())
PARTS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
CLOSE = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: A part is kept if the text outside it is less than this share of its own.
OUTSIDE = 0.1
#: Other blocks of this share of the article's text bring in the parent that holds them.
BESIDE = 0.3


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "in_article", "around")

    def __init__(self, tag: str, parent: "Node | None", around: bool = False):
        self.tag, self.parent, self.children, self.around = tag, parent, [], around
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)


@functools.lru_cache(100_000)
def _named(value: str, in_article: bool) -> bool:
    """Whether a class, id or role names a part around the article."""
    for token in value.lower().split():
        parts = PARTS.findall(token)
        told = NAMES.intersection(parts) or (not in_article and HEADS.intersection(parts))
        if told and (len(parts) == 1 or not LAYOUT.intersection(parts)):
            return True
    return False


def _around(tag: str, attributes: str, parent: Node) -> bool:
    """Whether an element looks like a part around the article; ``prune`` decides."""
    if tag in AROUND or (tag == "header" and not parent.in_article):
        return True
    if attributes and tag not in VOID:
        return any(_named(m[1] or m[2] or m[3] or "", parent.in_article) for m in MARK.finditer(attributes))
    return False


def parse(page: str) -> Node:
    """The tree under body; text stands among the children as strings."""
    root = Node("body", None)
    at, skip, depth, end = root, "", 0, 0
    for m in TOKEN.finditer(page):
        if m.start() < end:
            continue
        if not skip and m.start() > end:
            at.children.append(page[end : m.start()])
        end = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not skip:
                at.children.append(m[0][9:-3])
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if skip:
            if tag == skip and tag not in VOID:
                depth += -1 if closing else 1
                if not depth:
                    skip = ""
            elif closing and tag in ("body", "html"):
                skip, at = "", root
            continue
        if closing:
            x = at
            while x is not None and x.tag != tag:
                # an inline end tag does not reach out of its block, nor a block's out of the article
                if tag in INLINE and x.tag not in INLINE or x is root:
                    x = None
                    break
                x = x.parent
            if x is not None and x is not root:
                at = x.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in SKIPPED or tag in RAW:
            if tag in RAW:
                close = CLOSE[tag].search(page, end)
                end = close.end() if close else len(page)
            elif not m[3].rstrip().endswith("/"):
                skip, depth = tag, 1
            continue
        if tag not in INLINE:
            # a block start ends an open paragraph, and inline elements that were left open in it
            x = at
            while x is not root and x.tag in INLINE:
                x = x.parent
            if x.tag == "p" or (x.tag == tag and tag in ("li", "dt", "dd", "option")):
                at = x.parent
            elif tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "div", "section", "ul", "ol", "table") and x is not at:
                at = x
        node = Node(tag, at, _around(tag, m[3], at))
        at.children.append(node)
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            at = node
    if not skip and end < len(page):
        at.children.append(page[end:])
    return root


def walk(root: Node) -> list[tuple[Node, bool]]:
    """Nodes with whether they stand in a link, parents before children."""
    order, stack = [], [(root, False)]
    while stack:
        x, linked = stack.pop()
        linked = linked or x.tag == "a"
        order.append((x, linked))
        stack += [(c, linked) for c in x.children if isinstance(c, Node)]
    return order


def count(order: list[tuple[Node, bool]]) -> None:
    """Characters and tags of every node, and those in links; without recursion."""
    for x, linked in reversed(order):
        x.chars = x.tags = x.link_chars = x.link_tags = 0
        for c in x.children:
            if isinstance(c, Node):
                x.chars += c.chars
                x.tags += c.tags + 1
                x.link_chars += c.link_chars
                x.link_tags += c.link_tags + (c.tag == "a")
            else:
                n = len(c) - c.count(" ") - c.count("\n")
                x.chars += n
                x.link_chars += n * linked


def prune(root: Node) -> None:
    """Takes the parts around the article out of the tree; the tree is counted anew if any went."""
    order = walk(root)
    count(order)
    if not any(x.around for x, _ in order):
        return
    plain = lambda x: x.chars - x.link_chars
    # the main article: of the elements outside any named part, else of all, the one with most unlinked text
    beside, best = set(), None
    for x, _ in order:
        if x.around or (x.parent is not None and id(x.parent) in beside):
            beside.add(id(x))
        if x.tag in ("article", "main") and not x.around:
            rank = (id(x) not in beside, plain(x))
            if rank[1] and (best is None or rank > best[0]):
                best = (rank, x)
    kept = set()
    x = best[1] if best else None
    while x is not None:
        kept.add(id(x))
        x = x.parent
    every, cut = plain(root), False
    stack = [root]
    while stack:
        x = stack.pop()
        here = []
        for c in x.children:
            if isinstance(c, Node):
                if c.around and id(c) not in kept and (best is not None or every - plain(c) >= OUTSIDE * plain(c)):
                    cut = True
                    here.append(" ")
                    continue
                stack.append(c)
            here.append(c)
        x.children = here
    if cut:
        count(walk(root))


def measure(root: Node) -> None:
    """Composite density and density sum of every node of a counted tree."""
    order = walk(root)
    c_body, lc_body = max(root.chars, 1), root.link_chars
    for x, _ in order:
        c, t, lc, lt = x.chars, max(x.tags, 1), x.link_chars, max(x.link_tags, 1)
        if not c:
            continue
        base = math.log(c / max(c - lc, 1) * lc + lc_body / c_body * c + math.e)
        # e - 1 more in the base and 1 in the ratio keep both logarithms positive on pages without links
        x.density = c / t * math.log1p(c / max(lc, 1) * t / lt) / math.log(base + math.e - 1)
    for x, _ in order:
        x.total = sum(c.density for c in x.children if isinstance(c, Node))


def chosen(root: Node) -> tuple[Node, float]:
    """The article's subtree and the threshold.

    It is the node of largest density sum, taken up to an enclosing article element; without one, up to the parent
    while the other blocks there that reach the threshold hold enough text.
    """
    best, stack = root, [root]
    while stack:
        x = stack.pop()
        if x.total > best.total:
            best = x
        stack += [c for c in x.children if isinstance(c, Node)]
    threshold, x, top = math.inf, best, best
    while x is not None:
        threshold = min(threshold, x.density)
        if x.tag in ("article", "main"):
            top = x
        x = x.parent
    while top.tag in INLINE or top.tag in ("p", "h1", "h2", "h3"):
        top = top.parent
    at = top
    while not top.in_article and at.parent is not None:
        others = sum(c.chars - c.link_chars for c in at.parent.children if isinstance(c, Node) and c is not at and c.density >= threshold and 2 * c.link_chars <= c.chars)
        at = at.parent
        if others >= BESIDE * max(top.chars - top.link_chars, 1):
            top = at
    return top, threshold


def extract(page: str) -> str:
    """The article's text: blocks in page order, joined by one space."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    if not root.chars:
        return ""
    measure(root)
    top, threshold = chosen(root)
    out, stack = [], [top]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x is not top:
            # a block of several links and nothing else, below the threshold, is a menu or a list of related pages
            if x.tag not in INLINE and x.density < threshold and x.link_tags > 2 and x.link_chars > 0.9 * x.chars:
                continue
            if x.tag not in INLINE or x.tag == "wbr":
                out.append(" ")
                stack.append(" ")
        stack += reversed(x.children)
    return SPACE.sub(" ", entities.unescape("".join(out))).strip()


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row, whole pages, one pass without a shuffle."""

    def run(batches):
        for batch in batches:
            out = [extract(t.decode("utf-8", "replace")) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, type=pa.string())], names=["page_id", "url", "text"])

    found = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
