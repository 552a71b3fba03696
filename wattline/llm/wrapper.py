"""Main text of pages by wrappers induced per host from aligned trees."""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import slices, stored
from wattline.llm.dom import BLOCK, RAW, Node, Shape, joined, match, numbered, parse, shape

#: A node is template if it counts at least so often among its host's other pages and agrees in so large a
#: share of that.
LEAST_PAGES, CONSTANT = 3, 0.9
#: Pages up to this many bytes come first as a host's reference page.
REFERENCE_BYTES = 16 << 10

# Elements that are never article text, and words of class, id or role that say so.
_BESIDE = frozenset("nav footer aside form button select input menu dialog search fieldset".split())
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|footer|sidebar|aside|cookies?|consent|gdpr|notice|"
    r"alert|popup|modal|newsletter|subscribe|shar(?:e|ing)|social|related|recommend\w*|comments?|commentlist|disqus|repl(?:y|ies)|"
    r"respond|login|search|toolbar|widget|masthead|topbar|contentinfo|complementary|navigation|site-header|page-header)(?:$|[\s_-])"
)
_ARTICLE = frozenset(("article", "main"))


def host_of(url: str | Column = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _aside(node: Node) -> bool:
    return node.tag in _BESIDE or node.tag in RAW or node.hidden or bool(node.marks and _MARKS.search(node.marks))


def _articles(root: Node) -> list[Node]:
    """Outermost article elements outside of what stands beside an article; else main elements."""
    for wanted in ({"article"}, {"main"}):
        found: list[Node] = []

        def walk(x: Node, found: list[Node] = found, wanted: set[str] = wanted) -> None:
            for child in x.children:
                if isinstance(child, str) or _aside(child):
                    continue
                if child.tag in wanted or child.marks in wanted:
                    found.append(child)
                else:
                    walk(child)

        walk(root)
        if found:
            return found
    return []


def blocks(roots: list[Node], template: set[int], whole: bool, articles: list[Node] = ()) -> list[str]:
    """Texts of the blocks below ``roots`` in page order. ``template`` has ids of nodes to leave out;
    ``whole`` if the roots are whole pages, then page headers outside of ``articles`` go as well."""
    out: list[list[str]] = [[]]
    inner = {id(x) for x in articles}

    def walk(x: Node, whole: bool) -> None:
        whole = whole and id(x) not in inner
        for child in x.children:
            if isinstance(child, str):
                out[-1].append(child)
            elif child.tag == "br":
                out[-1].append("\n")
            elif _aside(child) or id(child) in template or whole and child.tag == "header":
                if child.tag in BLOCK:
                    out.append([])
            elif child.tag in BLOCK:
                out.append([])
                walk(child, whole)
                out.append([])
            else:
                walk(child, whole)

    for root in roots:
        out.append([])
        walk(root, whole)
    return [x for x in (" ".join("".join(parts).split()) for parts in out) if x]


def _spare(root: Node, articles: list[Node], template: set[int]) -> None:
    """Takes out of ``template`` what holds an article, and all of an article that is constant as a whole."""
    inner = {id(x) for x in articles}

    def spare(x: Node) -> None:
        template.discard(id(x))
        for child in x.children:
            if not isinstance(child, str):
                spare(child)

    def walk(x: Node, gone: bool) -> bool:
        gone = gone or id(x) in template
        if id(x) in inner:
            if gone:
                spare(x)
            return True
        held = [walk(child, gone) for child in x.children if not isinstance(child, str)]
        if any(held):
            template.discard(id(x))
        return any(held)

    walk(root, False)


def _text(x: Shape, texts: dict[int, str]) -> str:
    """The texts of a shape's nodes, kept in ``texts`` by the shape's id."""
    if id(x) not in texts:
        texts[id(x)] = "\n".join(joined(n) for n in x.nodes)
    return texts[id(x)]


def _same(pair: tuple[Shape, Shape]) -> bool:
    return [joined(n) for n in pair[0].nodes] == [joined(n) for n in pair[1].nodes]


def _beside(root: Shape, texts: dict[int, str]) -> dict[int, str]:
    """By the id of each shape: the longest text of a shape neither above nor below it, markup's asides left out."""
    out: dict[int, str] = {id(root): ""}

    def walk(x: Shape) -> None:
        own = [("" if _aside(c.nodes[0]) else _text(c, texts)) for c in x.children]
        first, second = (sorted(range(len(own)), key=lambda i: -len(own[i])) + [-1, -1])[:2]
        for i, child in enumerate(x.children):
            other = second if i == first else first
            out[id(child)] = max(out[id(x)], own[other] if other >= 0 else "", key=len)
            walk(child)

    walk(root)
    return out


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def induce(pages: DataFrame) -> DataFrame:
    """(host, reference, template) of each host: its reference page, and the numbers of that tree's nodes
    that are constant among the host's pages; null where too few pages tell.

    Takes (host, html). The reference is the page with the least hash among the shorter ones, a minimum
    that is combined before the shuffle. Every page is aligned with its host's reference by simple tree
    matching. A node that differs counts once per text; one that agrees counts once per longest text beside
    it, and once for all texts shorter than its own. So copies and near copies of a story count once in
    whatever task they fall, as long as no text beside it that varies is longer than the story; only such keys
    are shuffled.
    """
    order = F.struct(F.octet_length("html") > REFERENCE_BYTES, F.xxhash64("html"), "html")
    references = pages.groupBy("host").agg(F.min(order).alias("least"))
    references = stored(references.select(F.col("host").alias("_host"), F.col("least.html").alias("reference")), "wrapper-references")
    both = pages.join(references, F.col("host") == F.col("_host")).filter("html != reference")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, tuple[Shape, dict[int, str]]] = {}
        for batch in slices(batches):
            found: set[tuple[str, int, bool, int]] = set()
            for host, page, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference")), strict=True):
                if host not in trees:
                    if len(trees) > 64:
                        trees.clear()
                    trees[host] = shape([parse(reference)]), {}
                    numbered(trees[host][0])
                tree, known = trees[host]
                texts: dict[int, str] = {}
                other = shape([parse(page)])
                beside = _beside(other, texts)
                for left, right in match(tree, other):
                    text, context = _text(right, texts), beside[id(right)]
                    same = text == _text(left, known)
                    found.add((host, left.number, same, (_key(context) if len(context) >= len(text) else 0) if same else _key(text)))
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = (pa.string(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "node", "same", "key"])

    agreed = both.select("host", "html", "reference").mapInArrow(align, "host string, node int, same boolean, key bigint").distinct()
    agreed = agreed.groupBy("host", "node").agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("same"))
    constant = (F.col("same") >= CONSTANT * F.col("n")) & (F.col("node") > 0)
    template = agreed.filter(F.col("n") >= LEAST_PAGES).groupBy("host").agg(F.array_sort(F.collect_list(F.when(constant, F.col("node")))).alias("template"))
    return references.join(template, F.col("_host") == F.col("host"), "left").select("_host", "reference", "template")


def text_of(page: str | None, reference: Shape | None, template: set[int]) -> str:
    """The main text: all that is not template, or what markup says where there is nothing to align with."""
    root = parse(page or "")
    articles = _articles(root)
    pairs = match(reference, shape([root])) if reference is not None else []
    if len(pairs) < 2:
        return "\n\n".join(blocks(articles or [root], set(), not articles))
    out = {id(n) for pair in pairs if pair[0].number in template and _same(pair) for n in pair[1].nodes}
    _spare(root, articles, out)
    return "\n\n".join(blocks([root], out, True, articles))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page.

    Takes (page_id, url, html, ...). Pages of a host are aligned with its reference page; nodes constant
    over the host are template and varying ones content, inside article elements and outside. Markup corrects
    that: an article that is constant as a whole is content, menus, footers, sidebars, adverts, notices, forms
    and comments are none although they vary. Only where a host has too few pages to tell, or a page has
    nothing to align, article elements decide. Null html gives empty text, a url without host is of host
    "", repeated rows are each returned, other columns ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", "url", F.col("html"), host_of().alias("host"))
    wrappers = stored(induce(rows.filter("html IS NOT NULL").select("host", "html")), "wrappers")
    with_wrapper = rows.join(wrappers, F.col("host") == F.col("_host"), "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Shape] = {}
        for batch in slices(batches):
            texts = []
            for host, page, reference, template in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference", "template")), strict=True):
                if template is not None and host not in trees:
                    if len(trees) > 64:
                        trees.clear()
                    trees[host] = shape([parse(reference)])
                    numbered(trees[host])
                texts.append(text_of(page, trees.get(host) if template is not None else None, set(template or ())))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    chosen = with_wrapper.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", "host", "reference", "template")
    return chosen.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
