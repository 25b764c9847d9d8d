"""Layout-aware HTML extraction: a tree builder with implied tags, visibility rules, and a
text rendering that keeps block spacing, lists and aligned table cells."""

from __future__ import annotations

import bisect
import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard that decide about layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe noembed noframes object audio video canvas svg math datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu".split())
BLOCK = SPACED | frozenset("html body div article section nav aside header footer main address form li dt dd tr td th thead tbody tfoot caption details summary figcaption legend option optgroup select center".split())
CLOSES_P = SPACED | frozenset("div article section nav aside header footer main address form li dt dd details summary figcaption center".split())
#: Start tag: the open elements that it ends, and the elements at which the search for them stops.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr", "caption"), ("table",)), "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption"), ("table",)), "tfoot": (("tbody", "thead", "tfoot", "caption"), ("table",)), "body": (("head",), ()),
}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\x20\x09-\x0D/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\x20\x09-\x0D/>]*+)([^>]*+)>""", re.S)
REMARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?", re.S)
ATTR = re.compile(r"""([^\x20\x09-\x0D"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\x20\x09-\x0D>]++)))?""")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
MAX_TABLES = 16  # tables nested deeper are laid out as blocks


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def parse(source: str) -> Node:
    """The tree of a page. Missing end tags are implied, end tags without a start are ignored."""
    root = Node("#root", {})
    stack, names, at, end, last = [root], Counter(), 0, len(source), source.rfind(">")

    def close(tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        if not any(names[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                names.subtract(n.tag for n in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    while at < end:
        m = (TOKEN if at <= last else REMARK).search(source, at)  # after the last > there are no tags
        if (stop := m.start() if m else end) > at:
            stack[-1].children.append(html.unescape(source[at:stop]))
        if not m:
            break
        at, tag = m.end(), (m[2] or m[5] or "").lower()  # a tag with an unclosed quote ends at the next >
        if not tag:
            continue
        if m[1] or m[4]:
            close((tag,), ("table",) if tag not in ("table", "body", "html") else ())
            continue
        if tag in CLOSES_P:
            close(("p",), ("table", "td", "th", "caption", "button", "object"))
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag == "tr":
            close(("td", "th"), ("table",))
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTR.findall(m[3] or m[6])} if m[3] or m[6] else {}
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in RAW:
            close_at = re.compile(rf"</{tag}(?=[\x20\x09-\x0D/>])[^>]*>?", re.I).search(source, at)
            text = source[at : close_at.start() if close_at else end]
            node.children.append(html.unescape(text) if tag in ("textarea", "title") else text)
            at = close_at.end() if close_at else end
        elif tag not in VOID:
            stack.append(node)
            names[tag] += 1
    return root


def _visible(node: Node, shown: bool) -> bool | None:
    """None: nothing below is shown. False: what is below is shown only where it says so itself."""
    if node.tag in UNSEEN or "hidden" in node.attrs or node.tag == "input":
        return None
    style = SPACE.sub("", node.attrs.get("style", "")).lower()
    if "display:none" in style:
        return None
    m = re.search(r"visibility:(\w+)", style)
    return m[1] == "visible" if m and m[1] in ("visible", "hidden", "collapse") else shown


class _Lines:
    """Text put together line by line."""

    def __init__(self):
        self.lines, self.line, self.gap, self.indent, self.mark, self.space = [], [], 0, 0, "", False

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *more = s.split("\n")
            self.put(first)
            for x in more:
                self.end(force=True)
                self.put(x)
            return
        words = SPACE.sub(" ", s)
        if words.startswith(" ") and self.line:
            self.space = True
        if core := words.strip(" "):
            self.put((" " if self.space and self.line else "") + core)
            self.space = words.endswith(" ")

    def put(self, s: str) -> None:
        if s:
            self.line.append(s)

    def end(self, gap: int = 0, force: bool = False) -> None:
        """Ends the line; gap: empty lines at least before the next text."""
        if self.line or force:
            self.lines += [""] * (self.gap if self.lines else 0)
            mark = self.mark if self.line else ""
            self.lines.append((" " * (self.indent - len(mark)) + mark + "".join(self.line)) if self.line else "")
            self.line, self.gap = [], 0
            self.mark = "" if mark else self.mark
        self.space, self.gap = False, max(self.gap, gap)


def _spans(node: Node, name: str, most: int) -> int:
    """colspan or rowspan, within the limits that the HTML standard sets."""
    text = node.attrs.get(name, "1").strip()
    if not (text.isascii() and text.isdigit()):
        return 1
    return max(1, most if len(text.lstrip("0")) > 5 else min(most, int(text)))


def _holds_pre(node: Node) -> bool:
    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, Node):
            if n.tag in ("pre", "textarea"):
                return True
            todo += n.children
    return False


def _taken(held: list[tuple[int, int, int]], new: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Intervals of columns in their order after new ones took their place; neighbours that end with one row are one."""
    parts, k = [], 0
    for first, end, row in held:
        while k < len(new) and new[k][1] <= first:
            k += 1
        for cut, after, _ in itertools.takewhile(lambda x: x[0] < end, new[k:]):
            if first < cut:
                parts.append((first, cut, row))
            first = max(first, after)
        if first < end:
            parts.append((first, end, row))
    out = []
    for x in sorted(parts + new):
        if out and out[-1][1] == x[0] and out[-1][2] == x[2]:
            out[-1] = (out[-1][0], *x[1:])
        else:
            out.append(x)
    return out


def _table(node: Node, depth: int, shown: bool) -> list[str]:
    """Rows of cells, each column as wide as its widest cell of one column. Cells of several rows
    stand in the first and leave their columns empty in the others; preformatted cells keep their lines."""
    rows, todo, captions = [], [(node, shown)], []
    while todo:
        n, shown = todo.pop()
        if isinstance(n, str):
            captions += [SPACE.sub(" ", n).strip()] if shown else []
        elif n is node or n.tag in ("thead", "tbody", "tfoot", "form"):  # a form here is only a mark: rows go on in it
            parts, implied = [], None
            for c in n.children:
                if isinstance(c, Node) and c.tag in ("td", "th"):
                    if implied is None:
                        parts.append(implied := Node("tr", {}))
                    implied.children.append(c)
                elif isinstance(c, Node) or c.strip():
                    parts.append(c)
                    implied = None
            for c in reversed(parts):
                see = shown if isinstance(c, str) or c.tag == "form" else _visible(c, shown)
                if see is not None:
                    todo.append((c, see))
        elif n.tag == "tr":
            cells = []
            for c in n.children:
                if isinstance(c, Node) and (see := _visible(c, shown)) is not None:
                    text = render(c, depth + 1, see)
                    lines = [x.rstrip() for x in text.strip("\n").split("\n")] if "\n" in text and _holds_pre(c) else [SPACE.sub(" ", text).strip()]
                    cells.append((lines, _spans(c, "colspan", 1000), _spans(c, "rowspan", 65534)))
                elif isinstance(c, str) and c.strip() and shown:
                    captions.append(SPACE.sub(" ", c).strip())
            rows.append(cells)
        else:  # stands in front of the table
            captions.append(" ".join(render(n, depth + 1, shown).split("\n")))
    widths, placed, held = {}, [], []  # held: columns (first, end, row) that a cell of several rows takes up to a row
    for r, cells in enumerate(rows):
        held = [x for x in held if x[2] > r] if any(x[2] <= r for x in held) else held
        at, row, taken, k = 0, [], [], 0
        for lines, span, down in cells:
            while k < len(held) and held[k][0] <= at:
                at, k = max(at, held[k][1]), k + 1
            row.append((at, span, lines))
            if span == 1:
                widths[at] = max(widths.get(at, 0), max(map(len, lines)))
            if down > 1 and r + 1 < len(rows):
                taken.append((at, at + span, min(r + down, len(rows))))
            at += span
        placed.append(row)
        held = _taken(held, taken) if taken else held
    order = sorted(widths)
    begin = dict(zip(order, itertools.accumulate([widths[x] + 3 for x in order], initial=0), strict=False))
    out = [c for c in captions if c]
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line, first = "", True
            for at, _, lines in row:
                place = bisect.bisect_left(order, at)
                start = begin[order[place]] if place < len(order) else len(line)
                text = lines[k] if k < len(lines) else ""
                line = (line.ljust(max(0, start - 3)) + ("" if first and not start else " | ") if start or not first else "") + text
                first = False
            if line.replace("|", "").strip():
                out.append(line.rstrip())
    return out


def render(root: Node, depth: int = 0, shown: bool = True) -> str:
    """The visible text below root. The walk keeps its own stack, so deep pages are safe."""
    out, todo = _Lines(), [(root, shown, False, None, True)]
    while todo:
        node, see, pre, counter, enter = todo.pop()
        if isinstance(node, str):
            if see:
                out.text(node, pre)
            continue
        tag = node.tag
        if not enter:  # leaving a block
            out.end(gap=int(tag in SPACED and not (tag in ("ul", "ol", "menu") and counter == "nested")))
            if tag in ("ul", "ol", "menu", "blockquote", "dd"):
                out.indent -= 2
            if tag == "li":
                out.mark = ""
            continue
        if node is not root:
            see = _visible(node, see)
            if see is None:
                continue
        if tag == "br":
            out.end(force=True)
            continue
        if tag == "hr":
            out.end(gap=1)
            continue
        if tag == "img" and node.attrs.get("alt") and see:
            out.text(node.attrs["alt"], False)
        if tag == "table" and node is not root and depth < MAX_TABLES:
            out.end(gap=1)
            for line in _table(node, depth, see):
                out.put(line)
                out.end()
            out.end(gap=1)
            continue
        lists = None
        if tag in BLOCK:
            nested = tag in ("ul", "ol", "menu") and out.indent > 0
            out.end(gap=int(tag in SPACED and not nested))
            todo.append((node, see, pre, "nested" if nested else None, False))
        if tag in ("ul", "ol", "menu", "blockquote", "dd"):
            out.indent += 2
            start = node.attrs.get("start", "1")
            lists = [int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1] if tag == "ol" else None
        if tag == "li":
            out.mark = "- "
            if counter is not None:
                out.mark = f"{counter[0]}. "
                counter[0] += 1
        todo += [(c, see, pre or tag in ("pre", "textarea"), lists if isinstance(c, Node) and c.tag == "li" else None, True) for c in reversed(node.children)]
    out.end()
    return "\n".join(out.lines)


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """pages with the visible text of html_col in column `into` (an existing one is replaced).

    Null gives null, an empty page "". Every page is rendered whole; rows are independent,
    so nothing is shuffled and a lost task is simply run again.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if x is None else render(parse(x)) for x in batch], dtype=object)

    return pages.withColumn(into, text(html_col))
