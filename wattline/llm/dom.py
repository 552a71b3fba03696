"""A small tree of an HTML page, and simple tree matching of two such trees."""

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that begins closes an open one of these, up to the elements in the second set.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements below this depth begin a block where they stand, and what they hold belongs to the one above.
DEEPEST = 200
_P_SCOPE = {"td", "th", "table", "button", "caption", "object"}


@dataclass
class Node:
    tag: str
    marks: str = ""  # class, id and role, lower case
    hidden: bool = False
    children: list = field(default_factory=list)  # Nodes and texts


def parse(page: str) -> Node:
    """The tree of a page; character references are decoded, raw elements have no children.

    Missing end tags are implied, stray ones ignored; a tag that the page's end cuts off is no text.
    """
    root = Node("html")
    stack = [root]

    def close(tags: set[str], scope: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                del stack[depth:]
                return
            if stack[depth].tag in scope:
                return

    at, raw = 0, None
    for token in _TOKEN.finditer(page):
        if token.start() < at:
            continue
        if token.start() > at:
            stack[-1].children.append(html.unescape(page[at : token.start()]))
        at = token.end()
        ending, name = token.group(1), token.group(2)
        if name is None:
            continue
        name = name.lower()
        if ending:
            if name == "br":
                stack[-1].children.append(Node("br"))
            else:
                close({name}, {"td", "th", "table"} if name in ("p", "li") else set())
            continue
        if name in ("html", "body", "head"):
            continue
        if name in BLOCK:
            close({"p"}, _P_SCOPE)
        if name in _CLOSES:
            close(*_CLOSES[name])
        found = {}
        for key, *values in _ATTRIBUTE.findall(token.group(3)):
            found.setdefault(key.lower(), "".join(values))
        marks = " ".join(html.unescape(found[k]).lower() for k in ("class", "id", "role") if k in found)
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        node = Node(name, marks, hidden)
        stack[-1].children.append(node)
        if name in RAW:
            raw = re.compile(rf"</{re.escape(name)}[^>]*(?:>|\Z)", re.I).search(page, at)
            at = raw.end() if raw else len(page)
        elif name not in VOID and len(stack) < DEEPEST:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def joined(node: Node) -> str:
    """All text below a node, with single spaces."""
    parts: list[str] = []

    def walk(x: Node) -> None:
        for child in x.children:
            if isinstance(child, str):
                parts.append(child)
            else:
                walk(child)

    walk(node)
    return " ".join(" ".join(parts).split())


@dataclass
class Shape:
    """What alignment sees of a tree: neighbours with equal tag and marks are one repeated shape."""

    key: tuple[str, str]
    nodes: list[Node]
    children: list["Shape"]
    number: int = -1


def shape(nodes: list[Node]) -> Shape:
    groups: list[list[Node]] = []
    for child in (c for n in nodes for c in n.children if not isinstance(c, str)):
        if child.tag in VOID or child.tag in RAW:
            continue
        if groups and (groups[-1][0].tag, groups[-1][0].marks) == (child.tag, child.marks):
            groups[-1].append(child)
        else:
            groups.append([child])
    return Shape((nodes[0].tag, nodes[0].marks), nodes, [shape(g) for g in groups])


def numbered(root: Shape) -> list[Shape]:
    """All shapes in page order; each gets its place as number."""
    out: list[Shape] = []

    def walk(x: Shape) -> None:
        x.number = len(out)
        out.append(x)
        for child in x.children:
            walk(child)

    walk(root)
    return out


def match(left: Shape, right: Shape) -> list[tuple[Shape, Shape]]:
    """Simple tree matching: the pairs of a largest order-keeping mapping of equal keys, roots first."""
    if left.key != right.key:
        return []
    rows, columns = len(left.children), len(right.children)
    inner: dict[tuple[int, int], list[tuple[Shape, Shape]]] = {}
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i, a in enumerate(left.children):
        for j, b in enumerate(right.children):
            inner[i, j] = match(a, b)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + len(inner[i, j]))
    out, i, j = [], rows, columns
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append(inner[i, j])
    return [(left, right), *(pair for pairs in reversed(out) for pair in pairs)]
