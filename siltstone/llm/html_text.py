"""Main text of web pages by tree scoring.

The page is read into a tree. Every block of text passes points for its length and
its commas to its ancestors, less with each step up and less the more of it is link
text; the container with most points and those of its siblings that score well are
kept, without the parts that are never article text.
"""

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from siltstone.llm.common import map_rows, texts_of

#: Fixed sets of HTML element names.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template svg math".split())
DROPPED = frozenset(
    "head script style noscript template svg math nav header footer aside form menu"
    " button select textarea option iframe object canvas dialog audio video".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label"
    " mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("article main section div body td html blockquote".split())
#: Elements that an opening tag of the same group closes when it is left open.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav"
    " ol p pre section table ul li dd dt tr td th tbody thead".split()
)
SAME_CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table article section div main body html td th".split())
#: Words of class, id or role that mark what is not the article.
_UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner\w*|promo\w*|sponsor\w*|comment\w*"
    r"|disqus|repl(?:y|ies)|respond|sidebar\w*|side|widget\w*|related|recommend\w*"
    r"|share|sharing|social|newsletter|subscribe|subscription|signup|login|cookie\w*"
    r"|consent|notice\w*|notification\w*|alert|popup|modal|overlay|nav\w*|menu\w*"
    r"|breadcrumb\w*|pagination|pager|footer\w*|foot|header|masthead|toolbar|search"
    r"|tags|meta|byline|copyright|legal|disclaimer|complementary|contentinfo|form)"
    r"(?=$|[\s_-])",
    re.I,
)
_WANTED = re.compile(r"article|content|entry|post|story|main|text|body", re.I)
#: A mark that is one of these words by itself outweighs the weak unwanted ones.
_ARTICLE = re.compile(r"(?:^|\s)(?:article|content|entry|post|story|main)(?=$|\s)", re.I)
_WEAK = re.compile(r"(?:^|[\s_-])(?:search|header|meta|tags|related|share|social)(?=$|[\s_-])", re.I)
#: One attribute: a value may hold quotes unless it begins with one, and a quote that
#: is never closed ends at white space or at the tag's end. No part is read twice.
_NAMED = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    rf"(?P<attrs>(?:[\s/]++|{_NAMED})*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+"""
)
_SPACE = re.compile(r"\s+")


class Node:
    """An element. ``block``, ``scope`` and ``container`` are the nearest such element
    among itself and its ancestors, so that deep pages need no long walks."""

    __slots__ = (
        "name", "marks", "hidden", "parent", "children", "score",
        "block", "scope", "container",
    )

    def __init__(self, name: str, parent: "Node | None", marks: str, hidden: bool):
        self.name, self.parent, self.marks, self.hidden = name, parent, marks, hidden
        self.children: list[Node | str] = []
        self.score = 0.0
        self.block = parent.block if parent and name in INLINE else self
        scoped = name in SCOPES or name in SAME_CLOSES
        self.scope = self if scoped or not parent else parent.scope
        contained = name not in CONTAINERS and parent
        self.container = parent.container if contained else self

    def dropped(self) -> bool:
        if self.name in DROPPED or self.hidden:
            return True
        if not self.marks or self.name in ("body", "html", "article", "main"):
            return False
        marks = _WEAK.sub(" ", self.marks) if _ARTICLE.search(self.marks) else self.marks
        return _UNWANTED.search(marks) is not None


def _attributes(text: str) -> tuple[str, bool]:
    """Class, id and role as one text; whether the element is hidden."""
    if "=" not in text and "hidden" not in text:
        return "", False
    found = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), next((v for v in values if v), ""))
    style = found.get("style", "").replace(" ", "").lower()
    hidden = (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )
    marks = " ".join(found[k] for k in ("class", "id", "role") if k in found)
    return marks, hidden


def parse(page: str) -> Node:
    """A tree of elements and texts; unclosed and stray tags do no harm."""
    root = node = Node("html", None, "", False)
    opened: Counter[str] = Counter()  # open elements by name
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            node.children.append(html.unescape(page[at:stop]))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if opened[name]:
                above = _ancestor(node, name)
                node = _left(node, above.parent, opened)
            continue
        if name == "html":
            continue
        node = _left(node, _opened(node, name), opened)
        marks, hidden = _attributes(found["attrs"] or "")
        child = Node(name, node, marks, hidden)
        node.children.append(child)
        ended = (found["attrs"] or "").endswith("/")
        if name in VOID or ended and (name not in RAW or name in ("svg", "math")):
            continue
        if name in RAW:
            # A page cut inside such an element has no text after it.
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        node = child
        opened[name] += 1
    return root


def _opened(node: Node, name: str) -> Node:
    """Where an opening tag attaches, after elements that it closes."""
    if name in CLOSES_P and node.block.name == "p" and node.block.parent:
        node = node.block.parent
    for other in SAME_CLOSES.get(name, ()):
        above = node.scope
        while above.parent and above.name not in SCOPES and above.name != other:
            above = above.parent.scope
        if above.name == other and above.parent:
            node = above.parent
    return node


def _ancestor(node: Node, name: str) -> Node:
    """The nearest open element of that name, which there is."""
    while node.name != name:
        node = node.parent
    return node


def _left(node: Node, outer: Node, opened: Counter) -> Node:
    """``outer``, once the elements inside it are counted as closed."""
    while node is not outer:
        opened[node.name] -= 1
        node = node.parent
    return outer


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks under a node, in page order."""
    blocks: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            blocks.append(text)
        parts.clear()

    todo: list = [node]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            parts.append(item)
        elif item is not node and item.dropped():
            continue
        elif item.name == "br":
            parts.append(" ")
        elif item.name in INLINE:
            todo.extend(reversed(item.children))
        else:
            end()
            todo.append(None)
            todo.extend(reversed(item.children))
    end()
    return blocks


def _measure(root: Node) -> list[Node]:
    """Give points to the ancestors of each text; return the scored containers."""
    scored: dict[int, Node] = {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, linked = todo.pop()
        linked = linked or node.name == "a"
        own = "".join(c for c in node.children if isinstance(c, str)).strip()
        if own:
            points = 1 + own.count(",") + min(len(own) / 100, 30.0)
            points *= -0.5 if linked else 1.0
            above, share = node.container, 1.0
            while share > 0.05:
                above.score += points * share
                scored[id(above)] = above
                share /= 2
                if above.parent is None:
                    break
                above = above.parent.container
        for child in node.children:
            if isinstance(child, Node) and not child.dropped():
                todo.append((child, linked))
    for node in scored.values():
        if node.name in ("article", "main"):
            node.score *= 1.5
        elif node.marks and _WANTED.search(node.marks):
            node.score *= 1.25
    return list(scored.values())


def main_text(page: str) -> str:
    """The article's blocks, one a line; empty if the page has no text."""
    root = parse(page)
    containers = _measure(root)
    if not containers:
        return "\n".join(_blocks(root)) if not root.dropped() else ""
    best = max(containers, key=lambda n: n.score)
    parent = best.parent
    if parent is None or best.name in ("body", "html"):
        return "\n".join(_blocks(best))
    least = max(3.0, 0.2 * best.score)
    blocks: list[str] = []
    for sibling in parent.children:
        if sibling is best:
            blocks += _blocks(best)
        elif isinstance(sibling, Node) and not sibling.dropped():
            heading = sibling.name in ("h1", "h2")
            alike = bool(best.marks) and (sibling.name, sibling.marks) == (best.name, best.marks)
            if heading or alike or sibling.score >= least or _is_prose(sibling):
                blocks += _blocks(sibling)
    return "\n".join(blocks)


def _is_prose(node: Node) -> bool:
    """A paragraph beside the article: long and not made of links."""
    if node.name not in ("p", "pre", "blockquote", "ul", "ol", "table", "figure"):
        return False
    text = " ".join(_blocks(node))
    return len(text) >= 80 and text.count(",") + text.count(".") > 0


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html.

    Null html counts as empty and gives empty text; repeated rows are read each.
    """

    def rows(batch):
        found = [main_text(t.decode("utf-8", "replace")) for t in texts_of(batch["html"])]
        made = {"page_id": batch["page_id"], "url": batch["url"], "text": found}
        return made | {"n_chars": [len(t) for t in found]}

    schema = "page_id long, url string, text string, n_chars long"
    return map_rows(pages.select("page_id", "url", "html"), rows, schema)
