"""Layout-aware text of web pages.

A page's tags build a tree the way browsers do in the common cases: missing
end tags are implied (paragraphs before blocks, list items, table parts,
options), void elements have no content, script and style hold raw text, and
stray end tags are dropped. Elements that no one sees are left out: scripts,
styles, the head, templates, ``hidden``, ``aria-hidden="true"``, inputs of
type hidden, and inline styles with ``display:none`` or
``visibility:hidden``; further what browsers do not show of objects, media,
frames, lists of suggestions, definitions in drawings and notes of formulas.
Texts of drawings and formulas, options (the label, if they have one) and text
areas, and the values of input fields (labels of buttons, what is typed or
hinted) are shown. The rest is rendered as it lies on the page: blocks on
lines of their own, paragraphs and headings with a blank line between, list
items with marks or numbers (``start``, ``value``) and indents, tables with
aligned columns on the grid that column and row spans make, preformatted text
as written.

Cases: null html gives null, empty html the empty text. Unclosed comments,
tags and raw elements end with the page; a quote opens a value only after "=". Repeated rows are rendered alike;
null ids are kept. The depth of the tree is bounded by MAX_DEPTH: deeper
elements count as children of the element at that depth, so no text is lost.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import read_table

MAX_DEPTH = 256
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe object embed audio video canvas datalist "
                   "noembed noframes meta link base param source track area".split())
#: Drawings and formulas: what they hold unseen, what HTML they may hold, and the tags that end them.
FOREIGN = {"svg": frozenset("defs desc metadata symbol clippath mask pattern marker".split()),
           "math": frozenset("annotation annotation-xml".split())}
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                       "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure ul ol dl table fieldset hr".split())
BLOCK = SPACED | frozenset("html body address article aside dd details dialog div dt figcaption footer form header hgroup "
                           "legend li main nav section summary caption tr thead tbody tfoot td th center".split())
#: An opening tag closes the nearest of these, unless one of the limits is nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
P_LIMITS = {"td", "th", "caption", "button", "object", "li", "div", "article", "section", "body", "table"}
# a quote opens a value only after "="; elsewhere it is part of a name
_VALUE = r"(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s\"'>][^\s>]*+))"
_NAMED = rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+{_VALUE}?+)?+"
_ANY = re.sub(r"(?<!\\)\((?!\?)", "(?:", _NAMED)
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|{_ANY})*+)(?:>|\Z)", re.S)
CDATA = re.compile(r"<!\[CDATA\[(.*?)(?:\]\]>|\Z)", re.S)
ATTRIBUTE = re.compile(_NAMED)
INVISIBLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children", "foreign")

    def __init__(self, tag: str, attributes: dict, foreign: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.foreign = foreign  # svg or math: the drawing or formula that its children belong to


def build(source: str) -> Node:
    root = Node("#root", {})
    stack, at = [root], 0
    while at < len(source):
        found = TOKEN.search(source, at)
        if not found:
            break
        if found.start() > at:
            stack[-1].children.append(entities.unescape(source[at:found.start()]))
        at = found.end()
        if found[2] is None:
            if stack[-1].foreign and (raw := CDATA.match(source, found.start())):
                stack[-1].children.append(raw[1])
                at = raw.end()
            continue
        tag = found[2].lower()
        if found[1]:
            _end(stack, tag)
            continue
        if stack[-1].foreign and tag in BREAKS_OUT:
            while stack[-1].foreign:
                stack.pop()
        foreign = tag if tag in FOREIGN else stack[-1].foreign
        if tag in CLOSES:
            _close(stack, *CLOSES[tag])
        if tag in ENDS_P:
            _close(stack, {"p"}, P_LIMITS)
        node = Node(tag, {m[1].lower(): entities.unescape(next((x for x in m.groups()[1:] if x is not None), ""))
                          for m in ATTRIBUTE.finditer(found[3])} if found[3].strip(" /\n\t\r") else {},
                    "" if tag in HOLDS_HTML else foreign)
        if tag in FOREIGN.get(stack[-1].foreign, ()):
            node.attributes["hidden"] = ""
        stack[-1].children.append(node)
        if foreign and found[3].endswith("/"):
            continue
        if tag in RAW and not (foreign and tag != "script" and tag != "style"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            raw = source[at:end.start() if end else len(source)]
            node.children.append(entities.unescape(raw) if tag == "textarea" else raw)
            at = end.end() if end else len(source)
        elif tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)
    if at < len(source):
        stack[-1].children.append(entities.unescape(source[at:]))
    return root


def _close(stack: list[Node], tags: set, limits: set) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in limits:
            return


def _end(stack: list[Node], tag: str) -> None:
    limits = set() if tag in ("table", "body", "html") else {"table", "td", "th"} - {tag}
    if tag in ("tr", "thead", "tbody", "tfoot"):
        limits = {"table"}
    _close(stack, {tag}, limits)


def seen(node: Node) -> bool:
    a = node.attributes
    return not (node.tag in UNSEEN or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
                or (node.tag == "input" and a.get("type", "").lower() == "hidden") or INVISIBLE.search(a.get("style", "")))


class Layout:
    """Lines of a box; inline text flows into the last one."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False  # a blank line is due before the next line

    def text(self, text: str) -> None:
        self.inline.append(re.sub(r"[ \t\n\r\f]+", " ", text))

    def flush(self) -> None:
        line = re.sub(r" +", " ", "".join(self.inline)).strip(" ")
        self.inline = []
        if line:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines += lines

    def space(self) -> None:
        self.flush()
        self.gap = True


def flow(node: Node, box: Layout) -> None:
    for child in node.children:
        if isinstance(child, str):
            box.text(child)
        elif seen(child):
            _element(child, box)


def _inner(node: Node) -> list[str]:
    box = Layout()
    flow(node, box)
    box.flush()
    return box.lines


def _element(node: Node, box: Layout) -> None:
    tag = node.tag
    if tag == "br":
        line = "".join(box.inline).strip()
        if line:
            box.flush()
        return
    if tag == "img":
        if node.attributes.get("alt"):
            box.text(" " + node.attributes["alt"] + " ")
        return
    if tag == "input":
        box.text(f" {_shown(node.attributes)} ")
        return
    if tag in ("option", "optgroup", "select", "svg") or (tag == "text" and node.foreign):  # each label apart
        label = node.attributes.get("label", "") if tag in ("option", "optgroup") else ""
        box.text(f" {label} ")
        if tag != "option" or not label:
            flow(node, box)
        box.text(" ")
        return
    if tag == "textarea":
        box.flush()
        text = _plain(node).removeprefix("\n").rstrip("\n")
        box.put(text.split("\n") if text.strip() else [])
        return
    if tag not in BLOCK:
        flow(node, box)
        return
    box.flush()
    if tag in SPACED:
        box.space()
    if tag == "hr":
        pass
    elif tag == "pre":
        box.put(_plain(node).strip("\n").split("\n") if _plain(node).strip() else [])
    elif tag in ("ul", "ol", "menu"):
        box.put(_list(node, tag == "ol"))
    elif tag == "table":
        box.put(_table(node))
    elif tag in ("blockquote", "dd"):
        box.put(["    " + x if x else x for x in _inner(node)])
    elif tag == "li":
        box.put(_item(_inner(node), "- "))
    else:
        flow(node, box)
        box.flush()
    if tag in SPACED:
        box.space()


def _shown(attributes: dict) -> str:
    """What an input field shows: a button's label, or what is typed, or would be."""
    kind = attributes.get("type", "text").lower()
    if kind == "image":
        return attributes.get("alt", "")
    if kind in ("checkbox", "radio", "password", "file", "range", "color", "hidden"):
        return attributes.get("placeholder", "") if kind == "password" and not attributes.get("value") else ""
    if kind in ("submit", "button", "reset"):
        return attributes.get("value", "")
    return attributes.get("value") or attributes.get("placeholder", "")


def _plain(node: Node) -> str:
    return "".join(c if isinstance(c, str) else "\n" if c.tag == "br" else _plain(c) if seen(c) else "" for c in node.children)


def _item(lines: list[str], mark: str) -> list[str]:
    return [(mark if i == 0 else " " * len(mark)) + x if x else x for i, x in enumerate(lines)]


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if re.fullmatch(r"\s*[-+]?\d{1,9}\s*", text or "") else otherwise


def _list(node: Node, numbered: bool) -> list[str]:
    number = _number(node.attributes.get("start"), 1) if numbered else 1
    out: list[str] = []
    loose = Layout()
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            loose.flush()
            out += loose.lines
            loose = Layout()
            if seen(child):
                number = _number(child.attributes.get("value"), number)
                out += _item(_inner(child), f"{number}. " if numbered else "- ")
                number += 1
        elif isinstance(child, str):
            loose.text(child)
        elif seen(child):
            _element(child, loose)
    loose.flush()
    return out + loose.lines


def _rows(node: Node, out: list, rest: Layout) -> None:
    """The rows of a table with the group (thead, tbody, ...) that each is in."""
    for child in node.children:
        if isinstance(child, str):
            rest.text(child)
        elif not seen(child):
            continue
        elif child.tag in ("thead", "tbody", "tfoot"):
            _rows(child, out, rest)
        elif child.tag == "tr":
            out.append((child, node))
        elif child.tag in ("td", "th"):
            row = Node("tr", {})
            row.children.append(child)
            out.append((row, node))
        else:
            _element(child, rest)


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _span(cell: Node, name: str, most: int) -> int:
    """A cell's colspan or rowspan, up to what browsers take; 1 where it is none."""
    text = cell.attributes.get(name, "1").strip()
    return min(int(text), most) if re.fullmatch(r"\d{1,9}", text) else 1


def _table(node: Node) -> list[str]:
    rows: list[tuple[Node, Node]] = []
    rest = Layout()  # captions and text that stands outside of cells
    _rows(node, rows, rest)
    rest.flush()
    grid, stray = [], []
    held: dict[int, int] = {}  # column: rows that a cell above still covers
    for at, (row, group) in enumerate(rows):
        if at and group is not rows[at - 1][1]:
            held = {}  # cells end with their group
        cells: dict[int, list[str]] = {}
        column, started = 0, {}
        for c in row.children:
            if isinstance(c, Node) and c.tag in ("td", "th") and seen(c):
                while column in held:
                    column += 1
                cells[column] = [x for x in _inner(c) if x]
                wide, high = max(1, _span(c, "colspan", 1000)), _span(c, "rowspan", 65534)
                for k in range(column, column + wide):
                    if high != 1:  # 0: down to the end of the group
                        started[k] = high - 1 if high else len(rows)
                column += wide
            elif isinstance(c, str):
                if c.strip():
                    stray.append(c.strip())
            elif seen(c):
                stray += _inner(c)
        held = {k: n - 1 for k, n in held.items() if n > 1} | started
        if any(cells.values()):
            grid.append(cells)
    # a column in which no cell begins takes no room
    columns = sorted({k for r in grid for k in r})
    widths = {k: max(_width(x) for r in grid for x in r.get(k) or [""]) for k in columns}
    out = list(rest.lines) + stray
    for r in grid:
        for level in range(max(map(len, r.values()))):
            parts = [(r.get(k) or [])[level:level + 1] for k in columns]
            out.append("  ".join(x + " " * (widths[k] - _width(x)) for k, p in zip(columns, parts, strict=True)
                                 for x in [p[0] if p else ""]).rstrip())
    return out


def render(source: str) -> str:
    lines = _inner(build(source))
    return "\n".join(lines).replace(" ", " ")


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text) per row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if h is None else render(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return pages.select(F.col(key).cast("long").alias("key"), html).mapInArrow(run, "key long, text string").withColumnRenamed("key", key)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages").select("page_id", "html"))
