"""Main text of web pages by tree scoring.

A page becomes a small element tree. Paragraphs give points for length and commas to their
ancestors, the nearer the more; an element's points shrink with the share of its text in links.
The element with most points and siblings that look like it are the article.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[/a-zA-Z](?:[^<>"']|"[^"<>]*"|'[^'<>]*')*>|<[/a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\s(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Never article text.
DROPPED = frozenset("head script style noscript iframe template title textarea nav footer aside form button select option svg canvas object dialog menu noframes xmp".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES_SAME = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Words in a class, id or role that mark what is not the article, and what may be.
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar comment comments commentlist disqus reply replies respond footer header masthead nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager search hidden skip tags".split()
)
#: Names that begin with these tell what else is on the page.
STATES = frozenset("has with without no".split())
LIKELY = frozenset("article body content entry main page post story text blog".split())
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


#: An ancestor gets a paragraph's points divided by this, by its distance; all further ones by the last.
SHARES = (1, 2, 6, 9, 12)


class Node:
    __slots__ = ("tag", "parent", "children", "unlikely", "likely", "points", "n_text", "n_link", "below")

    def __init__(self, tag: str, parent: Node | None, source: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.unlikely = self.likely = False
        self.points, self.n_text, self.n_link = 0.0, 0, 0
        self.below = [0.0] * len(SHARES)  # points of paragraphs one, two, ... levels down, the last of all further ones
        for key, value in _MARKS.findall(source):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "style":
                self.unlikely |= "display:none" in value.replace(" ", "")
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                self.unlikely = True
            else:
                names = [[w for w in SPLIT.split(name) if w] for name in value.split()]
                names = [set(words) for words in names if words and words[0] not in STATES]
                unlikely = [words for words in names if words & UNLIKELY]
                # "post-comments" is no post; "post category-search" is one, "post comments" isn't.
                likely = any(words & LIKELY and not words & UNLIKELY for words in names)
                self.unlikely |= bool(unlikely) and not (likely and all(words - UNLIKELY for words in unlikely))
                self.likely |= likely


def parse(page: str) -> Node:
    """The element tree; unclosed and stray tags are repaired, an unended tag at the end is dropped."""
    at, size, root = 0, len(page), Node("#root", None)
    node, opened = root, Counter()

    def leave(to: Node) -> None:
        nonlocal node
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at, source = m.end(), m.group(0)
        name = _NAME.match(source)
        if name is None or not source.endswith(">"):
            continue
        tag = name.group(1).lower()
        if source[1] == "/":
            if opened[tag]:  # else a stray one
                up = node
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            continue
        if tag in CLOSES_P and opened["p"]:
            leave(_close(node, ("p",), ("td", "th", "table", "button"), opened))
        if tag in CLOSES_SAME:
            closes, within = CLOSES_SAME[tag]
            if any(opened[t] for t in closes.split()):
                leave(_close(node, tuple(closes.split()), within, opened))
        child = Node(tag, node, source)
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not source.endswith("/>"):
            node = child
            opened[tag] += 1
    return root


def _close(node: Node, tags: tuple[str, ...], within: tuple[str, ...], opened: Counter) -> Node:
    """Leave the outermost open element of ``tags`` that isn't beyond one of ``within``."""
    up, found, left = node, None, sum(opened[t] for t in tags)
    while left and up.tag not in within:
        if up.tag in tags:
            found, left = up, left - 1
        up = up.parent
    return found.parent if found is not None else node


def _dropped(node: Node, in_article: bool) -> bool:
    if node.tag in DROPPED or (node.tag == "header" and not in_article):
        return True
    return node.unlikely and node.tag not in ("html", "body", "article", "main", "h1", "#root")


def _blocks(node: Node) -> list[str]:
    """Text of each block under a node, in page order, white space collapsed."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join(references.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [(node, False)]
    while stack:
        item, leaving = stack.pop()
        if isinstance(item, str):
            run.append(item)
        elif leaving:
            end()
        elif not (item is not node and _dropped(item, True)):
            if item.tag in BLOCKS:
                end()
                stack.append((item, True))
            stack += [(c, False) for c in reversed(item.children)]
    end()
    return out


PARAGRAPHS = frozenset("p pre td blockquote h1 h2 h3 li dd".split())


def _score(root: Node) -> list[Node]:
    """Gives points; returns the elements that have some, in page order."""
    order, stack = [], [(root, False, False)]
    while stack:
        node, link, in_article = stack.pop()
        order.append(node)
        link = link or node.tag == "a"
        in_article = in_article or node.tag in ("article", "main")
        for c in reversed(node.children):
            if isinstance(c, str):
                n = len(c.strip())
                node.n_text += n
                node.n_link += n * link
            elif not _dropped(c, in_article):
                stack.append((c, link, in_article))
    commas = {}
    for node in reversed(order):  # children come after their parents
        commas[id(node)] = commas.get(id(node), 0) + sum(c.count(",") for c in node.children if isinstance(c, str))
        if node.tag in PARAGRAPHS and node.n_text >= 25:
            given = 1 + commas[id(node)] + min(node.n_text / 100, 3)
        else:
            given = 0.0
        node.points += sum(x / share for x, share in zip(node.below, SHARES, strict=True))
        if node.parent is not None:
            for k, x in enumerate([given, *node.below]):
                node.parent.below[min(k, len(SHARES) - 1)] += x
            node.parent.n_text += node.n_text
            node.parent.n_link += node.n_link
            commas[id(node.parent)] = commas.get(id(node.parent), 0) + commas[id(node)]
    scored = []
    for node in order:
        node.points += 5 * node.likely + {"article": 25, "main": 15}.get(node.tag, 0) * bool(node.n_text)
        node.points *= 1 - node.n_link / max(1, node.n_text)
        if node.points > 0:
            scored.append(node)
    return scored


def main_text(page: str | None) -> str:
    """The article's text, blocks joined by one space; empty for null, empty and textless pages."""
    if not page:
        return ""
    root = parse(page)
    scored = [n for n in _score(root) if n.tag not in PARAGRAPHS and n.tag not in ("html", "#root")]
    if not scored:
        return " ".join(_blocks(root))
    best = max(scored, key=lambda n: n.points)
    chosen = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        near = set(map(id, scored))
        chosen = []
        for c in best.parent.children:
            if c is best:
                chosen.append(c)
            elif isinstance(c, Node) and not _dropped(c, True):
                density = c.n_link / max(1, c.n_text)
                alike = id(c) in near and c.points >= max(5, 0.2 * best.points)
                if alike or (c.tag in PARAGRAPHS and c.n_text and density < 0.25) or c.tag in ("h1", "h2"):
                    chosen.append(c)
    elif best.tag == "article" and best.parent is not None:
        chosen = [c for c in best.parent.children if isinstance(c, Node) and (c is best or (c.tag == "article" and c.points >= 0.2 * best.points))]
    return " ".join(b for c in chosen for b in _blocks(c))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page row, from its whole html.

    Null and empty html give an empty text. Repeated rows, null ids and null urls are kept as they
    are. Other columns are not read. An empty table gives no rows. No row needs another, so nothing is shuffled.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
