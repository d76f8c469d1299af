"""Main text of HTML pages by tag-path ratios.

A page is read as a row of text nodes, each with the path of tags that leads to it. Text length
and punctuation are summed per path over the page; their ratios to the number of nodes, multiplied, are the path's score, and
smoothed along the page the node's. Paths beyond the spread of the nodes' scores hold content. The article or main
element with most of that content is the article; where there is none, every part of the innermost element around
all content that holds some, gaps between them included.

Names (menus, forms, adverts, comments) leave parts out, but a name gives way where it would take the article: to a part
with half of the page's content or more that holds its main heading, main element or only article, or outside of which is next to nothing.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from perigee.llm.code import ship_code

_OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
TOKEN = re.compile(_OTHER + r"|</?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(>?)", re.DOTALL)
# For the rest of a page in which a quoted value does not end.
PLAIN_TOKEN = re.compile(_OTHER + r"|</?([a-zA-Z][^\s/>]*)([^>]*+)(>?)", re.DOTALL)
# Elements deeper than this count as the one around them, as in browsers.
DEEPEST = 512
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
PUNCTUATION = re.compile("[.,;:!?…。，、；：！？¿¡]")

# Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "noframes", "xmp", "iframe", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    *("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i"),
    *("ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike"),
    *("strong", "sub", "sup", "time", "tt", "u", "var"),
}
# Elements that end at the next one of the same kind, or of the others named.
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
# Elements inside which the ones above are kept apart from those outside.
SCOPES = {"ul", "ol", "dl", "table", "select", "menu"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements whose content is not text of the page.
NOT_TEXT = {
    *("script", "style", "noscript", "template", "button", "select", "iframe", "object", "svg", "canvas", "head"),
    *("textarea", "datalist"),
}
# Elements that are not part of an article, unless they hold it.
PARTS = {"nav", "footer", "aside", "menu", "dialog"}
# Elements that usually are not, and may be wrapped around a page.
WRAPPERS = {"header", "form", "fieldset"}
# Words in a class, id or role that mark such parts.
MARKS = {
    *("ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted"),
    *("banner", "comment", "comments", "disqus", "respond", "replies", "reply", "cookie", "cookies", "consent", "gdpr"),
    *("notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login"),
    *("nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc"),
    *("sidebar", "widget", "widgets", "footer", "foot", "header", "masthead", "topbar", "toolbar", "skip"),
    *("related", "recommended", "recommendations", "share", "sharing", "social", "tags", "search", "complementary"),
    *("contentinfo", "outbrain", "taboola", "paywall", "copyright", "disclaimer", "teaser"),
}
# Those that also mark a paragraph of an article, as a paragraph to be noticed.
STYLES = {"notice", "alert", "banner", "teaser", "header", "disclaimer", "overlay", "skip", "foot"}
# Words before a mark that turn it into a statement about the page: no-sidebar, has-menu.
ABOUT = {"no", "not", "non", "without", "with", "has", "hide"}
LEAVES = {"p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6"}
SMOOTHING = np.array([0.06, 0.24, 0.4, 0.24, 0.06])
#: Share of the content that a part must hold for its name to give way, and that must be left outside for the name to stand.
MOST, REST = 0.5, 0.1


@dataclass
class Node:
    """A block of text: its path, the elements open around it, those of them that names leave out."""

    path: tuple[str, ...]
    open: tuple[int, ...]
    named: tuple[int, ...]
    inline_out: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class Page:
    """Text nodes in order, and the elements that names leave out: by number the tag, and what they hold."""

    nodes: list[Node] = field(default_factory=list)
    named: dict[int, str] = field(default_factory=dict)
    holds: dict[int, Counter] = field(default_factory=lambda: defaultdict(Counter))


def _named(tag: str, attributes: str, inside: tuple[str, ...]) -> bool:
    """Whether names leave out an element with these attributes, open inside the tags of `inside`."""
    if tag in PARTS or tag in WRAPPERS:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    marks = MARKS
    if tag in LEAVES and ("article" in inside or "main" in inside):
        marks = MARKS - STYLES
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.lower() != "until-found":
            return True
        if name == "style" and NOT_SHOWN.search(value):
            return True
        if name in ("class", "id", "role"):
            for one in value.split():
                words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", one).lower())
                if any(w in marks and (not i or words[i - 1] not in ABOUT) for i, w in enumerate(words)):
                    return True
    return False


def read_page(source: str) -> Page:
    """Blocks of text of a page, in order, white space folded and character references decoded."""
    # Each open block element: tag, its number, whether it is text.
    stack: list[tuple[str, int, bool]] = []
    inline: list[tuple[str, bool]] = []
    page = Page()
    nodes = page.nodes
    current: Node | None = None
    counter, at, size = 0, 0, len(source)
    search = TOKEN.search

    def put(text: str) -> None:
        nonlocal current
        if stack and not stack[-1][2]:
            return
        out = any(out for _, out in inline)
        if current is not None and current.inline_out != out:
            current = None
        if current is None:
            if not text.strip():
                return
            open_now = tuple(s[1] for s in stack)
            named = tuple(n for n in open_now if n in page.named)
            current = Node(tuple(s[0] for s in stack), open_now, named, out)
            nodes.append(current)
        current.parts.append(text)
        if any(tag == "a" for tag, _ in inline):
            current.linked += len(text)

    def close(depth: int) -> None:
        nonlocal current
        del stack[depth:]
        inline.clear()
        current = None

    while at < size:
        found = search(source, at)
        if found is not None and found.group(1) is not None and not found.group(3) and search == TOKEN.search:
            search = PLAIN_TOKEN.search
            found = search(source, found.start())
        if found is None or found.group(1) is not None and not found.group(3):
            put(source[at:])
            break
        if found.start() > at:
            put(source[at : found.start()])
        at, token = found.end(), found.group()
        if found.group(1) is None:
            if token.startswith("<![CDATA["):
                put(html.escape(token[9:].removesuffix("]]>")))
            continue
        tag, attributes = found.group(1).lower(), found.group(2)
        if token[1] == "/":
            if tag in INLINE:
                for i in range(len(inline) - 1, -1, -1):
                    if inline[i][0] == tag:
                        del inline[i]
                        break
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if stack[i][0] in ("article", "main", "body") and tag in ("p", "li", "td", "tr"):
                        break  # a stray end tag ends no element outside
                else:
                    current = None
            continue
        if tag in VOID:
            if tag == "br":
                put(" ")
            elif tag == "hr":
                current = None
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else size
            continue
        if tag in INLINE:
            if not attributes.endswith("/"):
                code = any(s[0] == "pre" for s in stack) or any(t == "code" for t, _ in inline)
                inline.append((tag, not code and _named(tag, attributes, ())))
            continue
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == "p" or tag in CLOSED_BY.get(stack[i][0], ()):
                close(i)
                break
            if stack[i][0] in HEADINGS and tag in HEADINGS:
                close(i)
                break
            if stack[i][0] in SCOPES or stack[i][0] not in ("b", "i"):
                break
        current = None
        inline.clear()
        if len(stack) >= DEEPEST:
            continue
        counter += 1
        inside = tuple(s[0] for s in stack) if tag in LEAVES else ()
        stack.append((tag, counter, (not stack or stack[-1][2]) and tag not in NOT_TEXT))
        if tag in ("article", "main", "h1"):
            for _, number, _ in stack[:-1]:
                if number in page.named:
                    page.holds[number][tag] += 1
        if _named(tag, attributes, inside):
            page.named[counter] = tag
            page.holds[counter][tag] += tag in ("article", "main")
        if attributes.endswith("/"):
            stack.pop()
    for node in nodes:
        node.text = " ".join(html.unescape("".join(node.parts)).split())
    page.nodes = [node for node in nodes if node.text]
    return page


def path_scores(nodes: list[Node]) -> np.ndarray:
    """The score of each node's path: its mean length, times one more than its mean number of punctuation marks."""
    length: dict[tuple[str, ...], int] = defaultdict(int)
    marks: dict[tuple[str, ...], int] = defaultdict(int)
    count: dict[tuple[str, ...], int] = defaultdict(int)
    for node in nodes:
        length[node.path] += len(node.text) - min(node.linked, len(node.text))
        marks[node.path] += len(PUNCTUATION.findall(node.text))
        count[node.path] += 1
    score = {path: length[path] / n * (1 + marks[path] / n) for path, n in count.items()}
    return np.array([score[node.path] for node in nodes], dtype=float)


def content(nodes: list[Node]) -> np.ndarray:
    """For each node whether its path holds content: the path's score reaches the spread of the nodes' smoothed scores."""
    scores = path_scores(nodes)
    side = len(SMOOTHING) // 2
    smooth = np.convolve(np.pad(scores, side, mode="edge"), SMOOTHING, mode="valid")
    return (scores > 0) & (scores >= smooth.std())


def _weights(nodes: list[Node]) -> np.ndarray:
    return np.where(content(nodes), [len(n.text) for n in nodes], 0)


def _left_out(page: Page) -> set[int]:
    """Numbers of the elements whose names stand."""
    seen = [node for node in page.nodes if not node.inline_out]
    if not page.named or not seen:
        return set(page.named)
    weights = _weights(seen)
    total, inside, blocks = weights.sum(), Counter(), Counter()
    chars, linked = Counter(), Counter()
    for node, weight in zip(seen, weights.tolist(), strict=True):
        for number in node.named:
            inside[number] += weight
            blocks[number] += weight > 0
            chars[number] += len(node.text)
            linked[number] += node.linked
    rest = sum(w for node, w in zip(seen, weights.tolist(), strict=True) if not node.named)
    stand = set()
    for number, tag in page.named.items():
        held = page.holds[number]
        whole = held["main"] or held["h1"] or held["article"] == 1
        alone = tag not in PARTS and blocks[number] > 1 and rest < REST * total
        most = inside[number] and inside[number] >= MOST * total and 2 * linked[number] < chars[number]
        if not (most and (whole or alone)):
            stand.add(number)
    return stand


def main_text(source: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; empty if there is none."""
    page = read_page(source or "")
    out = _left_out(page)
    nodes = [node for node in page.nodes if not node.inline_out and out.isdisjoint(node.named)]
    if not nodes:
        return ""
    weights = _weights(nodes)
    total = weights.sum()
    held: dict[int, int] = defaultdict(int)
    elements: dict[int, tuple[int, str]] = {}
    for node, weight in zip(nodes, weights.tolist(), strict=True):
        for level, (number, tag) in enumerate(zip(node.open, node.path, strict=True)):
            held[number] += weight
            elements[number] = level, tag
    articles = [n for n, (_, tag) in elements.items() if tag in ("article", "main") and held[n] and held[n] >= MOST * total]
    if articles:
        # Articles first, and of those inside one another the outer, whose parts the inner ones are.
        holder = min(articles, key=lambda n: (elements[n][1] != "article", elements[n][0]))
        return "\n\n".join(node.text for node in nodes if holder in node.open)
    if not total:
        return "\n\n".join(node.text for node in nodes)
    # The innermost element around all content, and the parts of it that hold some; what lies between them belongs to it.
    around = max((n for n in held if held[n] == total), key=lambda n: elements[n][0], default=None)
    below = 0 if around is None else elements[around][0] + 1
    part = [node.open[below] if len(node.open) > below else None for node in nodes]
    wanted = [i for i, weight in enumerate(weights) if weight]
    first, last = wanted[0], wanted[-1]
    while first and part[first] is not None and part[first - 1] == part[first]:
        first -= 1
    # Headings right before belong to it.
    while first and nodes[first - 1].path and nodes[first - 1].path[-1] in HEADINGS:
        first -= 1
    while last + 1 < len(nodes) and part[last] is not None and part[last + 1] == part[last]:
        last += 1
    return "\n\n".join(node.text for node in nodes[first : last + 1])


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns of `pages` with text and n_chars, the article of the whole page and its code points.

    A null or empty page, and one whose text all lies in parts that names leave out, gives an empty text. Elements deeper than
    DEEPEST count as the one around them; pages of any length are read whole, each in one task. Each page is judged by
    itself, so repeated rows and null ids give what their html gives; other columns are left out.
    """
    ship_code(pages.sparkSession)
    schema = pages.select(*keep).schema.add("text", "string", False).add("n_chars", "long", False)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source) for source in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            names = [*batch.schema.names[:-1], "text", "n_chars"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), sizes], names=names)

    return pages.select(*keep, html_column).mapInArrow(read, schema)


def op7_pages(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
