"""Main text of web pages by composite text density.

A page becomes a tree of its block elements. Menus, headers, footers, sidebars, adverts, notices, forms,
comments of readers, scripts and styles are no part of the article and are cut first. Where only names
(class, id, role) or a form say so, or an attribute hides it, an element is spared that holds an article or main element or, on a
page without these, more than half of the text outside links. Each remaining
node has a density: characters per tag, adjusted by how much of its text lies in links. The density sum of a
node adds the densities of its children. The node with the largest sum holds the text's densest
surroundings; the smallest density on the path from it up to the body is the threshold. From the body
downwards, in every child whose density reaches the threshold, the subtree with the largest sum is marked,
and the child's own children are gone through alike. Marked subtrees are kept, those inside others once.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradepanel.llm.common import map_batches

# Fixed values of the HTML standard: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q ruby rb rt rp s samp small span strike "
    "strong sub sup time tt u var wbr del".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr li main menu nav ol p pre section summary table ul".split()
)
#: A start tag of the key ends an open element of the values, up to one of the barriers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
# Elements, and names in class, id or role, that mark what is not the article.
ASIDE = frozenset("nav footer aside form script style head template select button textarea title noscript iframe dialog menu svg canvas object audio video input".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs footer header masthead sidebar aside widget comment comments disqus replies notice cookie cookies consent gdpr popup "
    "modal overlay newsletter subscribe signup social share sharing related recommended toolbar pagination pager search login form "
    "complementary contentinfo alert".split()
)
#: Words that make a name tell of the layout, as in "with-sidebar".
LAYOUT_WORDS = frozenset("with without no not non has have is hide show".split())
#: How an element is cut: by its kind; by an attribute that hides it, unless it holds an article or main element; by its name, unless it holds the article.
CERTAIN, HIDDEN, NAMED = 3, 2, 1
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_HEADING = frozenset(f"h{i}" for i in range(1, 7))


class Node:
    __slots__ = ("name", "parent", "children", "aside", "chars", "link_chars", "tags", "link_tags", "density", "total", "linked", "inner")

    def __init__(self, name: str, parent: Node | None, aside: int):
        self.name, self.parent, self.aside = name, parent, aside
        self.linked = False  # whether it stands in a link
        self.inner = 0  # open inline elements of its own name in it
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def marks_aside(name: str) -> bool:
    """Whether a single class, id or role is a marker word, or a compound whose last word is one ("top-nav", "ad_1")."""
    words = [w.lower() for w in _WORDS.findall(name)]
    return bool(words) and words[-1] in ASIDE_WORDS and LAYOUT_WORDS.isdisjoint(words)


def is_aside(name: str, attributes: str, inside_article: bool) -> int:
    """0, ``NAMED``, ``HIDDEN`` or ``CERTAIN``."""
    if name in ASIDE and name != "form" or name == "header" and not inside_article:
        return CERTAIN
    found = 0
    if attributes and name not in ("html", "body", "article", "main"):
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" and value.lower() not in ("until-found", "false") or key == "aria-hidden" and value.lower() == "true":
                return HIDDEN
            if key == "style" and _NOT_SHOWN.search(value):
                return HIDDEN
            if key in ("class", "id", "role") and any(map(marks_aside, value.split())):
                found = NAMED
    if found:
        return found
    return NAMED if name == "form" else 0


def _tag_end(page: str, at: int) -> int:
    """Where the tag that starts at ``at`` ends; quoted attribute values may hold ``>``."""
    end = page.find(">", at)
    if end < 0:
        return -1
    quote = min((q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0), default=-1)
    while 0 <= quote < end:
        close = page.find(page[quote], quote + 1)
        if close < 0:
            return end
        if close > end:
            end = page.find(">", close)
            if end < 0:
                return -1
        nexts = [q for q in (page.find('"', close + 1, end), page.find("'", close + 1, end)) if q >= 0]
        quote = min(nexts, default=-1)
    return end


class Tree:
    """A tree under construction. For each name, the depths of its open elements are at hand, so no step walks up the tree."""

    def __init__(self):
        root = Node("html", None, 0)
        self.body = Node("body", root, 0)
        root.children.append(self.body)
        self.path, self.depths, self.linked = [self.body], {}, False

    def add(self, text: str) -> None:
        if text:
            now = self.path[-1]
            now.children.append(text)
            if self.linked and not text.isspace():
                now.link_chars += len(" ".join(text.split()))

    def open(self, node: Node) -> None:
        self.path[-1].children.append(node)
        node.linked = self.linked
        self.depths.setdefault(node.name, []).append(len(self.path))
        self.path.append(node)

    def close(self, depth: int) -> None:
        """End the element at this depth and all in it; links that began in it end with it."""
        self.linked = self.linked and self.path[depth].linked
        for node in self.path[depth:]:
            self.depths[node.name].pop()
        del self.path[depth:]

    def deepest(self, names: Iterable[str]) -> int:
        """Depth of the innermost open element of these names, or 0."""
        return max((d[-1] for x in names if (d := self.depths.get(x))), default=0)

    def end_those(self, names: Iterable[str], barrier: Iterable[str]) -> None:
        """End the outermost open element of these names that no open barrier holds apart from here."""
        above = self.deepest(barrier)
        first = [d[i] for x in names if (d := self.depths.get(x)) and (i := bisect_right(d, above)) < len(d)]
        if first:
            self.close(min(first))


def parse(page: str) -> Node:
    """Tree of block elements in time linear in the page; inline elements melt into the text of their block, which counts its links.

    Text counts as linked up to the end of its link, also in blocks inside the link.
    """
    tree, at, n = Tree(), 0, len(page)
    while at < n:
        left = page.find("<", at)
        if left < 0:
            tree.add(html.unescape(page[at:]))
            break
        if left > at:
            tree.add(html.unescape(page[at:left]))
        if page.startswith("<!--", left):
            end = page.find("-->", left + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), left):
            end = page.find(">", left)
            at = n if end < 0 else end + 1
            continue
        closing = page.startswith("</", left)
        m = _NAME.match(page, left + 1 + closing)
        if not m:
            if closing and (end := page.find(">", left)) >= 0:
                at = end + 1
            else:
                tree.add("<")
                at = left + 1
            continue
        end = _tag_end(page, m.end())
        if end < 0:
            break  # a tag that never ends
        name, attributes, at = m[0].lower(), page[m.end() : end], end + 1
        if closing:
            _end_tag(tree, name)
        elif name in VOID:
            tree.path[-1].children.append(" ")
        elif name not in ("html", "body"):
            at = _start_tag(tree, name, attributes, page, at)
    spare(tree.body)
    return tree.body


def _end_tag(tree: Tree, name: str) -> None:
    depth = tree.deepest((name,))
    if name in INLINE:
        if depth and tree.path[depth].inner:
            tree.path[depth].inner -= 1
        elif depth:
            tree.close(depth)
        if name == "a":
            tree.linked = False
    elif depth:
        tree.close(depth)


def _start_tag(tree: Tree, name: str, attributes: str, page: str, at: int) -> int:
    """Put an element into the tree; returns where the page goes on."""
    link = name == "a" and "href" in attributes.lower()
    if name == "a":
        tree.linked = False  # a link ends where the next one begins
    if name in INLINE:
        aside = is_aside(name, attributes, True)
        if not aside:
            if depth := tree.deepest((name,)):
                tree.path[depth].inner += 1
            if link:
                tree.linked = True
                tree.path[-1].link_tags += 1
            return at
    else:
        if name in CLOSES_P:
            tree.end_those(("p",), ("button", "table"))
        if name in ENDS:
            tree.end_those(*ENDS[name])
        if name in _HEADING and tree.path[-1].name in _HEADING:
            tree.close(len(tree.path) - 1)
        aside = is_aside(name, attributes, name == "header" and tree.deepest(("article",)) > 0)
    new = Node(name, tree.path[-1], aside)
    if name in RAW:
        tree.path[-1].children.append(new)
        close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
        return close.end() if close else len(page)
    tree.open(new)
    if name in ("svg", "path") and attributes.endswith("/"):
        tree.close(len(tree.path) - 1)
    tree.linked = tree.linked or link
    return at


def spare(body: Node) -> None:
    """Take back the cut of elements that only their names cut, if they hold the article."""
    seen, todo = [], [body]
    while todo:
        node = todo.pop()
        seen.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node) and c.aside != CERTAIN)
    words: dict[int, int] = {}  # characters outside links, of each node's subtree
    holds: dict[int, bool] = {}  # whether an article or main element is below
    for node in reversed(seen):
        inner = [c for c in node.children if isinstance(c, Node) and c.aside != CERTAIN]
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str)) - node.link_chars
        words[id(node)] = own + sum(words[id(c)] for c in inner)
        holds[id(node)] = any(c.name in ("article", "main") or holds[id(c)] for c in inner)
    for node in seen:
        if node.aside and (holds[id(node)] or node.aside == NAMED and not holds[id(body)] and words[id(node)] * 2 > words[id(body)]):
            node.aside = 0


def _below(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and not c.aside]


def _nodes(body: Node) -> list[Node]:
    """Nodes outside cut subtrees, parents before children."""
    out, todo = [], [body]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(_below(node)))
    return out


def measure(body: Node) -> list[Node]:
    nodes = _nodes(body)
    for node in reversed(nodes):
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(" ".join(c.split()))
            elif not c.aside:
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += 1 + c.tags
                node.link_tags += c.link_tags
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(nodes):
        c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags + node.link_tags), node.link_tags
        if c:
            base = math.log(c * lc / (c - lc + 1) + ratio * c + math.e)
            node.density = c / t * math.log(1 + c / (lc + 1) * t / (lt + 1)) / base
        below = [x.density for x in node.children if isinstance(x, Node) and not x.aside]
        node.total = sum(below) if below else node.density
    return nodes


def _largest(nodes: list[Node]) -> Node:
    """The largest density sum; of equal ones the outermost, first one."""
    return max(nodes, key=lambda x: x.total)


def content(body: Node) -> list[Node]:
    """Subtrees to keep, in page order."""
    nodes = measure(body)
    top = _largest(nodes)
    if top.total <= 0:
        return []
    path, threshold = top, top.density
    while path is not None and path.name != "html":
        threshold = min(threshold, path.density)
        path = path.parent
    if top is body:
        return [body]
    largest: dict[int, Node] = {}  # of each node's subtree
    for node in reversed(nodes):
        largest[id(node)] = _largest([node, *(largest[id(c)] for c in _below(node))])
    marked, todo = set(), [body]
    while todo:
        for child in _below(todo.pop()):
            if child.density >= threshold:
                best = largest[id(child)]
                marked.add(id(best))
                if best is not child:
                    todo.append(child)
    kept, todo = [], [body]
    while todo:
        node = todo.pop()
        if id(node) in marked:
            kept.append(node)
        else:
            todo.extend(reversed(_below(node)))
    return kept


def text_of(nodes: list[Node]) -> str:
    words: list[str] = []
    for start in nodes:
        todo: list[Node | str] = [start]
        run: list[str] = []  # text of one block up to the next block's edge
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                run.append(x)
            else:
                words.extend("".join(run).split())
                run = []
                if x.name != "#edge" and not x.aside:
                    todo.append(Node("#edge", None, False))
                    todo.extend(reversed(x.children))
        words.extend("".join(run).split())
    return " ".join(words)


def main_text(page: str) -> str:
    return text_of(content(parse(page)))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Main text of each page: ``page_id``, ``url``, ``text``, ``n_chars`` (code points), one row per row of ``pages``.

    A null or empty page, or one without article, has the empty text. Pages may be of any length and
    badly formed; work is linear in it. Repeated rows give repeated rows, an empty table an empty one;
    other columns are not read. No shuffle.
    """
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for start in range(0, len(batch), 256):
            rows = batch.slice(start, 256)
            texts = [main_text(x) if x else "" for x in rows["html"].to_pylist()]
            yield {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(x) for x in texts]}

    chosen = pages.select(pages[key].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[source].cast("string").alias("html"))
    return map_batches(chosen, run, schema)
