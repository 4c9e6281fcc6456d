"""Main text of web pages by composite text density.

A page is read into a tree of elements. For every element, the density is its
characters per tag, raised where few of the characters are link text and
lowered where many are, compared with the page as a whole. An element's density
sum is that of its children. The element with the greatest sum is the main
text, in an article too; headings, paragraphs and sections beside it belong to
it. The least density on its path from the body is the threshold: every other
block on the page that reaches it is kept too, unless a third of its characters
or more are link text. Text that lies loose between blocks counts as a block.
Parts that are never article text - scripts, styles, navigation, headers and
footers of the page, sidebars, forms, notices, adverts, reader comments - are
left out before the densities are computed, by element, role or whole class
name or id; a heading's id says nothing, as it is made from its words.
Containers whose name leaves no doubt (comments, adverts, cookie banners,
newsletters) go wherever they stand. Inside an article an element with another
such name is left out only if a third of its characters or more are link text
or, headings and paragraphs aside, if it is less than a third as dense as the
article. Reading takes time in proportion to the page, however deep it is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeload.llm.common import give_back, column, no_cycle_search

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp noembed noframes iframe".split())
_ESCAPABLE = frozenset("title textarea".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    " caption optgroup option".split()
)
_DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button input select textarea option datalist svg"
    " math canvas iframe object embed audio video map menu dialog xmp noembed noframes".split()
)
_CLOSES_P = _BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}
_P_LIMITS = frozenset("button td th table".split())
_ENDS_WITH = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_TEXT_PARTS = frozenset("h1 h2 h3 h4 h5 h6 p section blockquote pre ul ol dl figure table".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert toolbar".split())
_FURNITURE = (
    r"(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|notification"
    r"|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|footer|masthead|toolbar|comments?|commentlist|respond|replies|reply"
    r"|disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|widget|pagination|pager|skip|tags)"
)
# whole names, or such words with those that say where it stands and what holds it, as in site-nav or comment-list
_NAMES = re.compile(
    r"(?:(?:site|page|top|bottom|left|right|primary|secondary|global|header|mobile|sticky|wp|js)[_-])*"
    rf"{_FURNITURE}(?:[_-](?:{_FURNITURE}|area|bar|block|box|btn|buttons?|container|icons?|inner|list|links?|outer|panel|posts|slot|wrap|wrapper|\d+))*"
)
# names of what no article is made of: such containers go wherever they stand
_CERTAIN = re.compile(
    r"(?:(?:user|reader|article|post|page|entry|view|site|google|wp|js|top|bottom|side|inline)[_-])*"
    r"(?:ads?|adverts?|advertisement|advertising|sponsored|comments|comment[_-]?(?:list|section|area|thread)|disqus(?:[_-]thread)?|cookies?[_-](?:banner|notice|bar|consent)"
    r"|consent[_-]banner|gdpr|newsletter|popup|breadcrumbs?)(?:[_-](?:area|bar|block|box|container|form|inner|list|outer|panel|section|signup|slot|thread|unit|wrap|wrapper|\d+))*"
)
_CONTAINERS = frozenset("aside div dl iframe ins ol section table td ul".split())
_KEEP = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story)(?:$|[\s_-])")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TABLE_PARTS = frozenset("table tr tbody thead tfoot".split())
_CELLS = ("td", "th", "table")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class _Node:
    __slots__ = ("name", "children", "parent", "in_article", "in_p", "named", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best", "holds", "depth")

    def __init__(self, name: str, parent: _Node | None) -> None:
        self.name, self.parent, self.named = name, parent, False
        self.children: list[_Node | str] = []
        # what an element lies in is handed down, so that deep pages take no walk up for every element
        self.in_article = name in ("article", "main") or (parent is not None and parent.in_article)
        self.in_p = name == "p" or (parent is not None and parent.in_p and name not in _P_LIMITS)
        self.depth = parent.depth + 1 if parent is not None else 0


def _dropped(name: str, attributes: dict[str, str], within_article: bool) -> bool:
    if name in _DROPPED:
        return True
    if name == "header":
        return not within_article
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return name not in ("body", "html", "article", "main") and attributes.get("role", "").lower() in _ROLES


def _furniture(name: str, attributes: dict[str, str]) -> bool:
    """Whether the class names or the id are those of a page's furniture."""
    if name in ("body", "html", "article", "main"):
        return False
    kinds, own = (re.sub(r"(?<=[a-z])(?=[A-Z])", "-", attributes.get(k, "")).lower() for k in ("class", "id"))
    names = kinds.split() + ([] if name in _HEADINGS else own.split())
    return any(map(_NAMES.fullmatch, names)) and not _KEEP.search(f"{kinds} {own}")


def _certain(name: str, attributes: dict[str, str]) -> bool:
    """Whether a container's class names, or its id where no heading's words made it, leave no doubt that it is furniture."""
    if name not in _CONTAINERS:
        return False
    kinds, own = (re.sub(r"(?<=[a-z])(?=[A-Z])", "-", attributes.get(k, "")).lower() for k in ("class", "id"))
    return any(map(_CERTAIN.fullmatch, kinds.split() + (own.split() if name != "section" else [])))


def parse(page: str) -> _Node:
    """The page's tree without the parts that are never article text."""
    root = node = _Node("body", None)
    path, held = [root], defaultdict(list)  # open elements, in all and by name

    def leave(depth: int) -> _Node:
        """Close all open elements from a depth on; the innermost that stays open."""
        while len(path) > depth:
            held[path.pop().name].pop()
        return path[-1]

    def close(names: set[str], limits: set[str]) -> _Node:
        """Close the outermost open element of one of the names, if no limit is in between."""
        limit = max((held[n][-1].depth for n in limits if held[n]), default=0)
        depth = len(path)
        for n in names:
            for up in reversed(held[n]):
                if up.depth <= limit:
                    break
                depth = min(depth, up.depth)
        return leave(depth)

    at, size = 0, len(page)
    skipped: list[str] = []  # open elements below and with a dropped one
    closing: Counter[str] = Counter()  # of the same, by name
    while at < size:
        found = _TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at and not skipped:
            node.children.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        name = found[2]
        if not name:
            continue
        name = name.lower()
        attributes = found[3]
        if found[1]:
            if skipped:
                if closing[name]:
                    while True:
                        last = skipped.pop()
                        closing[last] -= 1
                        if last == name:
                            break
                continue
            if held.get(name):
                depth = held[name][-1].depth
                if name in _TABLE_PARTS or depth >= max((held[n][-1].depth for n in _CELLS if held[n]), default=0):
                    node = leave(depth)
            continue
        closed = attributes.endswith("/") and name not in _BLOCKS
        if name in _RAW or name in _ESCAPABLE:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if name in _RAW or name in _DROPPED or skipped:
                at = end.end() if end else size
            continue
        if skipped:
            if name not in _VOID and not closed:
                if name in _ENDS_WITH and len(skipped) > 1 and skipped[-1] in _ENDS_WITH[name][0]:
                    closing[skipped.pop()] -= 1
                skipped.append(name)
                closing[name] += 1
            continue
        if name in ("html", "body"):
            continue
        if name in _CLOSES_P and node.in_p:
            node = close({"p"}, _P_LIMITS)
        if name in _ENDS_WITH:
            node = close(*_ENDS_WITH[name])
        if name in _VOID:
            if name in ("br", "hr", "img"):
                node.children.append(_Node(name, node))
            continue
        given = {a.lower(): html.unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(attributes)} if attributes else {}
        furniture = _furniture(name, given)
        if _dropped(name, given, node.in_article) or furniture and not node.in_article or _certain(name, given):
            if not closed:
                skipped.append(name)
                closing[name] += 1
            continue
        below = _Node(name, node)
        below.named = furniture
        node.children.append(below)
        if not closed:
            node = below
            path.append(below)
            held[name].append(below)
    return root


def _postorder(root: _Node) -> Iterator[_Node]:
    stack: list[tuple[_Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            yield node
            continue
        stack.append((node, True))
        stack += [(c, False) for c in node.children if not isinstance(c, str)]


def _count(node: _Node) -> None:
    """Characters, tags and links of an element from those of its children."""
    node.chars = node.tags = node.link_chars = node.link_tags = 0
    node.holds = False  # whether there is a block in it
    for child in node.children:
        if isinstance(child, str):
            node.chars += len(re.sub(r"\s+", "", child))
        else:
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.chars if child.name == "a" else child.link_chars
            node.link_tags += child.link_tags + (child.name == "a")
            node.holds |= child.name in _BLOCKS or child.holds


def _density(node: _Node, share: float) -> float:
    c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    if not c:
        return 0.0
    base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
    inside = c / lc * t / lt
    # a logarithm to a base near one of a number below one would change sign: such elements are all links
    return c / t * max(math.log(inside), 0.0) / max(math.log(base), 1e-9) if base > 1 and inside > 1 else (c / t if not node.link_chars else 0.0)


def _measure(root: _Node) -> None:
    """Characters, tags, densities and density sums of all elements."""
    nodes = list(_postorder(root))
    for node in nodes:
        _count(node)
        if node.name == "a":
            node.link_chars = node.chars
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
        own = sum(child.density for child in node.children if not isinstance(child, str))
        node.sum = own or node.density
        node.best = node
        for child in node.children:
            if not isinstance(child, str) and child.best.sum > node.best.sum:
                node.best = child.best


def _without_furniture(root: _Node) -> bool:
    """Leave out the elements in articles that their names and their links or density speak against; whether there were any."""
    out: set[_Node] = set()
    stack = [(root, root)]
    while stack:
        node, article = stack.pop()
        if node.named:
            sparse = 3 * node.chars * max(article.tags, 1) < article.chars * max(node.tags, 1)
            if 3 * node.link_chars >= node.chars or sparse and node.name != "p" and node.name not in _HEADINGS:
                out.add(node)
                continue
        if node.name in ("article", "main"):
            article = node
        stack += [(c, article) for c in node.children if not isinstance(c, str)]
    for parent in {node.parent for node in out}:
        parent.children = [c for c in parent.children if c not in out]
    return bool(out)


def _main_parts(root: _Node) -> list[_Node]:
    """The elements that hold the main text, in page order."""
    best = root.best
    if not best.chars:
        return []
    path, up = [], best
    while up is not None:
        path.append(up)
        up = up.parent
    # a lone paragraph or inline element that wins stands for the element that holds it and its like
    while best.parent is not None and (best.name not in ("article", "main", "section", "div", "td", "body")):
        best = best.parent
    # headings, paragraphs and sections beside it belong to the same text
    while best.parent is not None and best.parent.parent is not None and any(_beside(c) for c in best.parent.children if c is not best):
        best = best.parent
    threshold, share = min(node.density for node in path), root.link_chars / root.chars
    above, up = set(), best.parent
    while up is not None:
        above.add(up)
        up = up.parent
    taken: list[_Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node is best or node not in above and node.chars and node.density >= threshold and node.link_chars * 3 < node.chars:
            taken.append(node)
        elif node.parent is best.parent and _beside(node):  # the body itself is not taken whole, as it holds the rest of the page
            taken.append(node)
        elif node.holds:
            stack += reversed(_blocks_in(node, share))
    return taken


def _beside(item: _Node | str) -> bool:
    """Whether an element beside the main part belongs to it."""
    return not isinstance(item, str) and item.name in _TEXT_PARTS and 2 * item.link_chars < item.chars


def _blocks_in(node: _Node, share: float) -> list[_Node]:
    """The blocks an element holds and, as elements of their own, what lies loose between them."""
    out: list[_Node] = []
    for loose, children in groupby(node.children, lambda c: isinstance(c, str) or c.name not in _BLOCKS and not c.holds):
        if not loose:
            out += children
            continue
        run = _Node("#text", node)
        run.children += children
        _count(run)
        run.density = _density(run, share)
        out.append(run)
    return out


def _blocks(node: _Node) -> list[str]:
    """Texts of the blocks below an element, white space joined, empty ones left out."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            held.append(item)
        elif item.name == "br":
            held.append(" ")
        else:
            block = item.name in _BLOCKS
            if block:
                end()
                stack.append(None)
            stack += reversed(item.children)
    end()
    return out


def extract(page: str | None) -> str:
    """The main text of a page: its blocks joined by an empty line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    if _without_furniture(root):
        _measure(root)
    return "\n\n".join(block for part in _main_parts(root) for block in _blocks(part))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars`` (code points). Null pages are empty; rows are independent."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_cycle_search():
                texts = [extract(p) for p in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])
        give_back()


    plain = pages.select(column(id_col).cast("long").alias("id"), column(url_col).cast("string").alias("url"), column(html_col).cast("string").alias("html"))
    return plain.mapInArrow(rows, "id long, url string, text string, n_chars long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
