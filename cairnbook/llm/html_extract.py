"""Main text of web pages, by wrapper induction.

Pages of a host are dealt by layout, the set of sections, boxes and menus their blocks stand in (layouts of fewer than
``LEAST`` pages are one). Of each, the DOM trees of ``SAMPLE`` distinct pages are aligned by simple tree matching: the
largest mapping that keeps roots, order and ancestry, equal texts counting extra. The aligned slots give two things.

* The wrapper: slots whose text varies, is not linked and is longer than a label are prose (of pages whose markup names an
  article, only slots in it). The content is the smallest box that holds nearly all prose, but no part of an article that
  the markup names, and widened while the boxes around it hold nearly nothing but varying unlinked text and headings: a
  lead, a body and a closing section in boxes of their own belong together. It is written down as the way to it: at each
  level the siblings (with their constant texts) and which of them to enter. Slots below it that are always linked are menus. In any page of the layout the way is followed by
  aligning each level's children with the wrapper's; what lies outside, whether constant or varying, goes. Headings of the first
  rank outside stay. Only if a page's markup names an article and the way misses it is the markup followed.
* Template: blocks that stand in the same place with the same text on any two pages are proposed; a layout with fewer
  than two pages small enough to align proposes all. All pages then decide: proposed blocks are counted over every
  distinct page of the host, and a block is template if it stands on ``NEARLY`` percent of the pages of those layouts at
  least half of whose pages have it. It is left out of pages of these layouts only. A template is only trusted from
  ``LEAST`` pages on, and where most of the text of its layout varies (mirrored pages have no visible template).

A page's blocks are then read in order: inside the content (of pages without a wrapper: inside their articles or main
element, or the body, where they have neither), without template blocks and without what markup names as menu, header,
footer, sidebar, notice, advert, form, script, style or reader comments. Character references are decoded, white space
in a block becomes one space, blocks are joined by two line ends. Unclosed, unended and stray tags are tolerated, to any
depth; reading a page takes time and memory in proportion to it.

Null or empty html: empty text. Pages without a host share the empty host; repeated pages are extracted each; other
columns are not read. Pages of equal html count once.
"""

from __future__ import annotations

import collections
import hashlib
import html as entities
import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .shared import Scratch, free_name, prepare, sent_if_small

SAMPLE, LEAST = 4, 3
#: Share, in percent, of the pages of its layouts on which a template block stands.
NEARLY = 95
#: Rows of a few numbers a layout, and hosts with a wrapper, up to which they are sent to all executors; more are joined.
LAYOUTS_SENT, HOSTS_SENT = 100_000, 20_000
#: Bytes of all hosts' template keys and wrappers up to which they are sent.
KNOWN_SENT = 32_000_000
#: Characters from which unlinked varying text is prose; share of it, in percent, that the content holds; share of a
#: text's characters in links from which it is linked.
PROSE, HELD, LINKED = 60, 80, 80
#: Pages of more blocks are not aligned (they are counted and extracted like others; another page is aligned instead).
ALIGNED_BLOCKS = 1500

#: Elements by their role in a page.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary hr nav header footer aside form fieldset dialog".split()
)
SECTIONS = frozenset("article main section div nav header footer aside form".split())
DROPPED = frozenset("nav footer aside form fieldset button select dialog svg canvas object video audio menu head".split())
BOXES = frozenset("html body article main section div td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words in class, id and role that name parts beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar rail widget related recommended share sharing social cookie cookies "
    "consent notice notification alert popup modal overlay newsletter subscribe subscription paywall comment comments "
    "commentlist disqus respond replies footer masthead skip toolbar complementary contentinfo".split()
)

#: A tag's attributes; one without its ">" ends before the next "<".
_ATTRIBUTES = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<(script|style|textarea|title|noscript|template|iframe)\b{_ATTRIBUTES}>(?:.*?</\1\s*>|.*)"
    r"|<[!?][^<>]*+(?:>|(?=<)|\Z)"
    rf"|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES})(?:>|(?=<)|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")


def _hashed(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\n".join(parts), digest_size=8).digest(), "little", signed=True)


class Element:
    """An open block element: its tag, the one it stands in, and what holds for all its blocks: a hash of the tags down to it,
    the sections among them (see ``layout_of``), and whether a heading of the first rank is one of them."""

    __slots__ = ("parent", "path", "sections", "tag", "title")

    def __init__(self, tag: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        above = parent.sections if parent else ()
        ended = len(above) == 3 or (above and above[-1] in ("article", "main"))
        self.sections = above if ended or tag not in SECTIONS else (*above, tag)
        self.path = _hashed(tag.encode(), parent.path.to_bytes(8, "little", signed=True) if parent else b"")
        self.title = tag == "h1" or (parent is not None and parent.title)


class Block:
    """A block's text, whether it is linked, the innermost element it stands in (None outside of all), and whether it is
    inside an article or beside it."""

    __slots__ = ("_key", "beside", "element", "inside", "linked", "text")

    def __init__(self, text: str, linked: bool, element: Element | None, inside: bool, beside: bool):
        self.text, self.linked, self.element, self.inside, self.beside = text, linked, element, inside, beside
        self._key: int | None = None

    @property
    def path(self) -> int:
        return self.element.path if self.element else 0

    def key(self) -> int:
        if self._key is None:
            self._key = _hashed(self.path.to_bytes(8, "little", signed=True), self.text.encode("utf-8", "replace"))
        return self._key

    def prose(self) -> int:
        return len(self.text) if len(self.text) >= PROSE and not self.linked and not self.beside else 0


def _is_beside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    names = [m[1].lower() for m in _NAMED.finditer(attributes)]
    words = [w for name in names for token in name.split() for w in (*_WORD.findall(token), "".join(_WORD.findall(token)))]
    return not BESIDE.isdisjoint(words)


class _Open(NamedTuple):
    """An open tag: whether it or one around it is beside an article, or an article; the innermost block element, and where
    the tag of that stands among the open ones (-1: there is none)."""

    tag: str
    beside: bool
    article: bool
    element: Element | None
    block: int


_NOTHING = _Open("", False, False, None, -1)


def blocks(page: str) -> Iterator[Block]:
    """The text blocks of a page, in order."""
    stack: list[_Open] = []
    opened: collections.Counter[str] = collections.Counter()  # open tags by name
    text: list[str] = []
    links, linked = 0, 0

    def close(n: int) -> None:
        nonlocal links
        while len(stack) > n:
            tag = stack.pop().tag
            opened[tag] -= 1
            links -= tag == "a"

    def flush() -> Iterator[Block]:
        nonlocal linked
        if text:
            raw = "".join(text)
            joined = " ".join(entities.unescape(raw).split())
            if joined:
                top = stack[-1] if stack else _NOTHING
                yield Block(joined, linked * 100 >= len(raw.strip()) * LINKED, top.element, top.article, top.beside)
            text.clear()
            linked = 0

    def said(part: str) -> None:
        nonlocal linked
        text.append(part)
        linked += len(part) if links else 0

    def end(tag: str) -> None:
        if tag in BLOCKS:
            while opened[tag] and stack[-1].tag != tag:
                close(len(stack) - 1)
            if opened[tag]:
                close(len(stack) - 1)
            return
        # an inline end tag closes no block: it is looked for down to the innermost one
        for i in range(len(stack) - 1, stack[-1].block if stack else -1, -1):
            if stack[i].tag == tag:
                close(i)
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            said(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag == "br":
            text.append(" ")
        if tag in BLOCKS:
            yield from flush()
        if m[2]:
            if opened[tag]:
                end(tag)
            continue
        if tag in BLOCKS and stack and stack[-1].block >= 0:
            near = stack[stack[-1].block].tag
            if near == "p" or (tag in ("li", "dt", "dd", "td", "th", "tr") and near == tag):
                close(stack[-1].block)
        if tag in VOID or m[4].endswith("/"):
            continue
        top = stack[-1] if stack else _NOTHING
        article = tag in ("article", "main")
        beside = _is_beside(tag, m[4], top.article)
        if article and not beside and not top.article:
            close(sum(1 for x in stack if x.tag in ("html", "body")))  # whatever was left open before it
            top = stack[-1] if stack else _NOTHING
        block = tag in BLOCKS
        stack.append(_Open(tag, beside or top.beside, article or top.article, Element(tag, top.element) if block else top.element, len(stack) if block else top.block))
        opened[tag] += 1
        links += tag == "a"
    if at < len(page):
        said(page[at:])
    yield from flush()


class Node:
    __slots__ = ("blocks", "children", "tag")

    def __init__(self, tag: str):
        self.tag, self.children, self.blocks = tag, [], []


def tree(found: list[Block]) -> Node:
    """The DOM of a page's blocks: inner nodes are elements, leaves are blocks in their order."""
    root = Node("")
    known: dict[int, Node] = {}
    for b in found:
        new, element = [], b.element
        while element is not None and id(element) not in known:
            new.append(element)
            element = element.parent
        node = known[id(element)] if element is not None else root
        for element in reversed(new):
            child = known[id(element)] = Node(element.tag)
            node.children.append(child)
            node = child
        node.blocks.append(b)
    return root


def summed(root: Node, of: Callable[[Block], int]) -> dict[int, int]:
    """For each node, by its id, the sum of ``of`` over its blocks and those of the nodes below it."""
    order, out = [root], {}
    for node in order:
        order += node.children
    for node in reversed(order):
        out[id(node)] = sum(map(of, node.blocks)) + sum(out[id(c)] for c in node.children)
    return out


def held(node: Node) -> list[Block]:
    """All blocks of a node and the nodes below it."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        out += n.blocks
        todo += n.children
    return out


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size of the largest ordered mapping of two trees with equal roots, and its nodes.

    Pairs of nodes are settled after those of their children, from a list of what is to do: trees may be of any depth.
    """
    size: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], list[tuple[Node, Node]]] = {}

    def own(x: Node, y: Node) -> int:
        return 1 + sum(p.text == q.text for p, q in zip(x.blocks, y.blocks, strict=False))

    def value(x: Node, y: Node) -> int:
        if x.tag != y.tag:
            return 0
        return size[id(x), id(y)] if x.children and y.children else own(x, y)

    todo = [(a, b, False)] if a.tag == b.tag and a.children and b.children else []
    while todo:
        x, y, ready = todo.pop()
        if not ready:
            todo.append((x, y, True))
            inner = [d for d in y.children if d.children]
            todo += ((c, d, False) for c in x.children if c.children for d in inner if c.tag == d.tag)
            continue
        n, m = len(x.children), len(y.children)
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(1, n + 1):
            row, above, left = best[i], best[i - 1], x.children[i - 1]
            for j in range(1, m + 1):
                row[j] = max(row[j - 1], above[j], above[j - 1] + value(left, y.children[j - 1]))
        i, j, mapped = n, m, []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                mapped.append((x.children[i], y.children[j]))
        size[id(x), id(y)] = own(x, y) + best[n][m]
        chosen[id(x), id(y)] = mapped
    pairs = [(a, b)] if a.tag == b.tag else []
    for x, y in pairs:  # grows while it is read
        pairs += chosen.get((id(x), id(y)), ())
    return value(a, b), pairs


def slots(pairs: list[tuple[Node, Node]]) -> Iterator[tuple[Block, Block]]:
    """The blocks in equal places of matched nodes."""
    return ((x, y) for a, b in pairs for x, y in zip(a.blocks, b.blocks, strict=False))


def layout_of(found: list[Block]) -> int:
    """A hash of the sections that a page's blocks stand in, to a depth of three, and not below an article."""
    seen = {"/".join(b.element.sections) if b.element else "" for b in found}
    return _hashed(*(x.encode() for x in sorted(seen)))


class Read:
    """A group's pages, read once: blocks, trees, and the mapped nodes of any two."""

    def __init__(self, pages: list[str]):
        self.blocks = [list(blocks(p)) for p in pages]
        self.trees = [tree(x) for x in self.blocks]
        self._mapped: dict[tuple[int, int], list[tuple[Node, Node]]] = {}

    def mapped(self, i: int, j: int) -> list[tuple[Node, Node]]:
        if i == j:
            order = [self.trees[i]]
            for node in order:
                order += node.children
            return [(x, x) for x in order]
        if i > j:
            return [(y, x) for x, y in self.mapped(j, i)]
        if (i, j) not in self._mapped:
            self._mapped[i, j] = match(self.trees[i], self.trees[j])[1]
        return self._mapped[i, j]


def proposed(pages: Read) -> list[int]:
    """Keys of the blocks that any two of the pages have in the same place with the same text."""
    found: set[int] = set()
    for i, j in itertools.combinations(range(len(pages.trees)), 2):
        found |= {a.key() for a, b in slots(pages.mapped(i, j)) if a.text == b.text and a.path == b.path}
    return sorted(found)


def wrapper_of(pages: Read) -> str | None:
    """The way to the content that the pages' aligned slots show, as JSON: for each level the siblings, each a tag and its
    constant texts, and which to enter; and the paths of linked slots. Null where there is no prose."""
    read, trees = pages.blocks, pages.trees
    k = max(range(len(read)), key=lambda i: sum(b.prose() for b in read[i]))
    same: collections.Counter[int] = collections.Counter()
    place: dict[int, list[Node]] = {}  # of each node of page k: it and its counterparts
    for i in range(len(trees)):
        pairs = pages.mapped(k, i)
        same.update(id(a) for a, b in slots(pairs) if a.text == b.text)
        for a, b in pairs:
            place.setdefault(id(a), []).append(b)
    constant = {id(b) for b in read[k] if same[id(b)] == len(read)}
    fixed = {(b.path, b.text) for b in read[k] if id(b) in constant}
    varies = lambda b: (b.path, b.text) not in fixed
    named = any(b.prose() and b.inside and varies(b) for b in read[k])
    counted = lambda b: b.prose() if (b.inside or not named) and varies(b) else 0
    sums = {key: n for t in trees for key, n in summed(t, counted).items()}
    prose = lambda node: sum(sums[id(n)] for n in place.get(id(node), ()))
    node, all_prose, levels, way = trees[k], prose(trees[k]), [], []
    while all_prose and node.tag not in ("article", "main"):
        inner = [c for c in node.children if c.tag in BOXES and (c.children or len(c.blocks) > 1) and prose(c) * 100 >= all_prose * HELD]
        if not inner:
            break
        # what is constant in the one to enter is never looked at: its siblings tell where it is
        siblings = [[c.tag, [] if c is inner[0] else sorted(b.key() for b in held(c) if id(b) in constant)] for c in node.children]
        levels.append([siblings, node.children.index(inner[0])])
        way.append(node)
        node = inner[0]
    if not levels:
        return None
    # widen: around the content, texts that vary and lead nowhere, and headings, are parts of it
    part = lambda b: len(b.text) if not b.linked and not b.beside and (varies(b) or (b.element and b.element.tag in HEADINGS)) else 0
    parts, all_text = summed(trees[k], part), summed(trees[k], lambda b: len(b.text))
    while len(levels) > 1 and way[-1].tag not in ("", "html", "body"):
        around = all_text[id(way[-1])] - all_text[id(node)]
        if around and (parts[id(way[-1])] - parts[id(node)]) * 100 < around * HELD:
            break
        node = way.pop()
        levels.pop()
    menus: dict[int, bool] = {}
    for b in (b for x in read for b in x):
        menus[b.path] = menus.get(b.path, True) and b.linked
    return json.dumps([levels, sorted(p for p, always in menus.items() if always)])


def content_of(found: list[Block], levels: list) -> Node | None:
    """The node of a page that the wrapper's way leads to; none if it can't be followed to the end."""
    node = tree(found)
    sums = summed(node, Block.prose)
    for siblings, entered in levels:
        known = [set(x[1]) for x in siblings]
        keys = [{b.key() for b in held(c)} if any(known) else set() for c in node.children]
        prose = [sums[id(c)] for c in node.children]
        all_prose = sum(prose) or 1

        def value(i: int, j: int) -> float:
            if siblings[i][0] != node.children[j].tag:  # noqa: B023
                return -1.0
            return 1 + (0.9 * prose[j] / all_prose if i == entered else len(known[i] & keys[j]))  # noqa: B023

        n, m = len(siblings), len(node.children)
        best = [[0.0] * (m + 1) for _ in range(n + 1)]
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                v = value(i - 1, j - 1)
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + v if v > 0 else 0)
        i, j, child = n, m, None
        while i and j and child is None:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                child = node.children[j] if i == entered else None
                if i < entered:
                    break
        if child is None:
            return None
        node = child
    return node


def main_text(page: str | None, known: dict[int, tuple[frozenset[int], list | None]] | None = None) -> str:
    """known: template keys and wrapper by layout; those of layout 0 are for layouts that are not in it."""
    found = list(blocks(page or ""))
    mine, wrapper = known.get(layout_of(found), known[0]) if known else (frozenset(), None)
    node = content_of(found, wrapper[0]) if wrapper else None
    content, menus = set(map(id, held(node))) if node else set(), set(wrapper[1]) if wrapper else set()
    inside = any(b.inside for b in found)
    if inside and not any(b.inside and not b.beside for b in found if id(b) in content):
        content = set()
    if content:
        inside = any(b.inside for b in found if id(b) in content)
        title = lambda b: b.element is not None and b.element.title and not b.linked and id(b) not in content
        kept = (b for b in found if title(b) or (id(b) in content and b.inside == inside and not (b.linked and b.path in menus)))
    else:
        kept = (b for b in found if b.inside == inside)
    return "\n\n".join(b.text for b in kept if not b.beside and (not mine or b.key() not in mine))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1))


_PAGE = T.StructType([
    T.StructField("layout", T.LongType()),
    T.StructField("n_blocks", T.IntegerType()),
    T.StructField("length", T.LongType()),
    T.StructField("held", T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("length", T.LongType())]))),
])


@arrow_udf(_PAGE)
def _read(pages: pa.Array) -> pa.Array:
    """Layout, number of blocks, length of their texts, and the distinct blocks of each page."""
    out = []
    for page in pages:
        found, held = list(blocks(page.as_py() or "")), collections.Counter()
        for b in found:
            held[b.key()] += len(b.text)
        entries = [{"key": k, "length": n} for k, n in held.items()]
        out.append({"layout": layout_of(found), "n_blocks": len(found), "length": sum(held.values()), "held": entries})
    entry = pa.struct([("key", pa.int64()), ("length", pa.int64())])
    return pa.array(out, pa.struct([("layout", pa.int64()), ("n_blocks", pa.int32()), ("length", pa.int64()), ("held", pa.list_(entry))]))


@arrow_udf(T.StringType())
def _extracted(pages: pa.Array, known: pa.Array) -> pa.Array:
    out, last, parts = [], None, None
    for page, k in zip(pages, known, strict=True):
        if last is None or not k.equals(last):
            last, parts = k, {x["layout"]: (frozenset(x["keys"]), json.loads(x["wrapper"]) if x["wrapper"] else None) for x in k.as_py() or ()}
            if parts:
                parts.setdefault(0, (frozenset(), None))
        out.append(main_text(page.as_py(), parts))
    return pa.array(out, pa.string())


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, known) for hosts with a wrapper or template; pages has host, page_key, html. known: an entry (layout, keys,
    wrapper) for each layout of LEAST pages or more, and one with layout 0 for the others."""
    read = pages.select("host", "page_key", _read("html").alias("r")).select("host", "page_key", "r.*").where("n_blocks > 0")
    read = scratch.keep(read.dropDuplicates(["host", "page_key"]), "read")
    sizes = read.groupBy("host", "layout").agg(F.count("*").alias("n"))
    several = sizes.groupBy("host").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).select("host")
    sizes = sizes.join(several, "host", "left_semi")
    dealt_to = F.when(F.col("n") >= LEAST, F.col("layout")).otherwise(F.lit(0).cast("long"))
    sizes = scratch.keep(sizes.select("host", "layout", dealt_to.alias("dealt")), "layouts")
    dealt = read.join(sent_if_small(sizes, LAYOUTS_SENT), ["host", "layout"])
    small = F.col("n_blocks") <= ALIGNED_BLOCKS
    group = dealt.groupBy("host", "dealt").agg(F.count("*").alias("pages"), F.sum("length").alias("all"), F.count_if(small).alias("small"))
    group = scratch.keep(group, "groups")

    counts = dealt.select("host", "dealt", F.explode("held").alias("b")).groupBy("host", "dealt", F.col("b.key").alias("key"))
    counts = counts.agg(F.count("*").alias("n"), F.sum("b.length").alias("length")).where("n > 1")
    counts = scratch.keep(counts.join(sent_if_small(group, LAYOUTS_SENT), ["host", "dealt"]).where("n * 2 >= pages"), "counts")
    judged = counts.groupBy("host", "key").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    judged = judged.where((F.col("n") >= LEAST) & (F.col("n") * 100 >= F.col("pages") * NEARLY)).select("host", "key")

    order = Window.partitionBy("host", "dealt").orderBy("page_key")
    chosen = dealt.where(small).select("host", "dealt", "page_key").withColumn("rank", F.row_number().over(order))
    chosen = scratch.keep(chosen.where(F.col("rank") <= SAMPLE).select("host", "dealt", "page_key"), "chosen")
    # of repeated pages one stands for all, so that a group is SAMPLE pages at most
    sample = pages.join(sent_if_small(chosen), ["host", "page_key"]).dropDuplicates(["host", "page_key"])

    def induce(layout: tuple, rows: pa.Table) -> pa.Table:
        pages = Read([x or "" for x in rows.sort_by("page_key").column("html").to_pylist()])
        keys, one = proposed(pages), len(set(map(layout_of, pages.blocks))) == 1
        wrapper = wrapper_of(pages) if len(pages.blocks) > 1 and one else None
        n = len(keys) + 1
        columns = {"host": pa.array([layout[0].as_py()] * n, pa.string()), "dealt": pa.array([layout[1].as_py()] * n, pa.int64())}
        return pa.table(columns | {"key": pa.array([*keys, None], pa.int64()), "wrapper": pa.array([*[None] * len(keys), wrapper], pa.string())})

    places = sample.select("host", "dealt", "page_key", "html").groupBy("host", "dealt").applyInArrow(induce, "host string, dealt long, key long, wrapper string")
    places = scratch.keep(places, "places")
    wrappers = places.where("wrapper is not null").drop("key")
    places = places.where("key is not null").select("host", "dealt", "key").unionByName(counts.where("small < 2").select("host", "dealt", "key"))
    fixed = counts.join(judged, ["host", "key"], "left_semi").join(places, ["host", "dealt", "key"], "left_semi")
    fixed = fixed.groupBy("host", "dealt").agg(F.sort_array(F.collect_list("key")).alias("keys"), F.sum("length").alias("same"))
    fixed = scratch.keep(fixed, "fixed")
    # every layout of its own is named, so that one without template is not taken for one of the others
    named = group.join(fixed.select("host").unionByName(wrappers.select("host")).distinct(), "host", "left_semi")
    named = named.join(fixed, ["host", "dealt"], "left").join(wrappers, ["host", "dealt"], "left")
    keys = F.when(F.col("same") * 2 <= F.col("all"), F.col("keys")).otherwise(F.array().cast("array<long>"))
    return named.groupBy("host").agg(F.collect_list(F.struct(F.col("dealt").alias("layout"), keys.alias("keys"), "wrapper")).alias("known"))


def extracted(spark: SparkSession, pages: DataFrame, url_col: str = "url", html_col: str = "html", into: str = "text") -> DataFrame:
    """pages with the main text as column ``into`` (in place of one of that name); other columns as they are."""
    prepare(spark)
    scratch = Scratch(spark, "html")
    host = host_of(F.col(url_col))
    keyed = pages.select(host.alias("host"), F.xxhash64(html_col).alias("page_key"), F.col(html_col).alias("html"))
    own, keys = free_name(pages, "_host"), free_name(pages, "_known")
    known = scratch.keep(templates(keyed, scratch), "templates").select(F.col("host").alias(own), F.col("known").alias(keys))
    weight = F.aggregate(keys, F.lit(0), lambda n, x: n + F.size(x["keys"]) * 8 + F.length(F.coalesce(x["wrapper"], F.lit(""))))
    bytes_ = known.agg(F.sum(weight.cast("long"))).first()[0] or 0
    known = sent_if_small(known, HOSTS_SENT) if bytes_ <= KNOWN_SENT else known
    found = pages.withColumn(own, host).join(known, own, "left")
    return found.withColumn(into, _extracted(html_col, keys)).select(*dict.fromkeys([*pages.columns, into]))


def op7(spark: SparkSession, pages: DataFrame) -> DataFrame:
    out = extracted(spark, pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
