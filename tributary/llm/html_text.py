"""Visible text of HTML pages: a tree builder with implied tags, visibility rules, and a layout that keeps
block spacing, lists and the columns of tables.

The tree follows the usual rules in short: void elements have no content, some elements hold raw text, a
start tag may end the paragraph, item, cell or row before it, an end tag closes what was left open inside,
and an end tag without a start is dropped (`</p>` and `</br>` aside, which make an empty element).
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.common import over_rows

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes plaintext".split())
RCDATA = frozenset("title textarea".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes select datalist audio video canvas".split())
#: What svg and math hold besides and do not show.
FOREIGN_HIDDEN = {"svg": frozenset("defs desc metadata symbol".split()), "math": frozenset("annotation annotation-xml".split())}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p pre section summary table caption"
    " tbody thead tfoot tr td th ul optgroup option".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu dir table figure hr fieldset listing".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - frozenset("body html tr td th tbody thead tfoot caption option optgroup".split())
#: For a start tag: the open elements it ends, and those it does not look beyond.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
#: An end tag does not close elements outside these.
WALLS = frozenset("table td th caption template object".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?|[\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse)\b", re.IGNORECASE)
#: Kinds of input that show their value.
_SHOWS_VALUE = frozenset(["", "text", "search", "email", "url", "tel", "number", "date", "submit", "button", "reset"])
#: A slash that ends a value without quotes, not the tag.
_SLASH_IN_VALUE = re.compile(r"=\s*[^\s\"'=]+/\Z")
#: A wider cell does not widen its column.
WIDEST = 60


@dataclass
class Node:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)
    #: svg or math, if it stands in one.
    foreign: str = ""

    def attribute(self, name: str) -> str | None:
        """The first attribute of this name, entities resolved; empty if it has no value."""
        for m in _ATTRIBUTE.finditer(self.attributes) if self.attributes else ():
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None


def parse(page: str) -> Node:
    """The tree of a page. Every text gives a tree; what is not markup is text."""
    root = Node("#root")
    open_: list[Node] = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)  # where in open_ the elements of a tag stand

    def text(data: str) -> None:
        if data:
            open_[-1].children.append(html.unescape(data) if "&" in data else data)

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def close_until(tags, walls) -> bool:
        """Close the nearest of these elements and all inside it, unless a wall stands between."""
        at = nearest(tags)
        if not at or nearest(walls) > at:
            return False
        for node in open_[at:]:
            places[node.tag].pop()
        del open_[at:]
        return True

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:  # comment, doctype or the like
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                open_[-1].children.append(Node("br"))
            elif tag == "p" and not places["p"]:
                open_[-1].children.append(Node("p"))
            elif tag not in VOID:
                walls = frozenset() if tag in WALLS or tag in ("html", "body", "tr", "tbody", "thead", "tfoot") else WALLS
                close_until({tag}, walls)
            continue
        if tag in ENDS_P:
            close_until({"p"}, WALLS | {"button"})
        if tag in IMPLIED:
            ends, walls = IMPLIED[tag]
            while close_until(ends, walls):
                pass
        node = Node(tag, m[3] or "")
        svg, formula = nearest(["svg"]), nearest(["math"])
        if max(svg, formula) > nearest(["foreignobject", "annotation-xml"]):
            node.foreign = "svg" if svg > formula else "math"
        open_[-1].children.append(node)
        if tag in VOID:
            continue
        if (node.foreign or tag in FOREIGN_HIDDEN) and node.attributes.endswith("/") and not _SLASH_IN_VALUE.search(node.attributes):
            continue
        if tag in RAW or tag in RCDATA:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            stop = end.start() if end else size
            content = page[at:stop]
            if content:
                node.children.append(html.unescape(content) if tag in RCDATA else content)
            at = end.end() if end else size
        else:
            places[tag].append(len(open_))
            open_.append(node)
    text(page[at:])
    return root


def visible(node: Node) -> bool:
    """Whether an element is displayed at all; what is not takes its whole content along."""
    if node.tag in HIDDEN or node.foreign and node.tag in FOREIGN_HIDDEN[node.foreign]:
        return False
    if not node.attributes:
        return True
    if node.attribute("hidden") is not None or (node.attribute("aria-hidden") or "").strip().lower() == "true":
        return False
    if node.tag == "input" and (node.attribute("type") or "").strip().lower() == "hidden":
        return False
    if node.tag == "dialog" and node.attribute("open") is None:
        return False
    style = node.attribute("style")
    return not (style and _NOT_DISPLAYED.search(style))


def settle(root: Node) -> Node:
    """The tree without what is not displayed, and without what `visibility` hides.

    Visibility is handed down, and an element inside a hidden one may turn it on again. Hidden elements keep
    their place, as cells do, but lose their own text, marks and rules.
    """
    todo = [(root, True)]
    while todo:
        node, shown = todo.pop()
        kept = []
        for child in node.children:
            if isinstance(child, str):
                if shown:
                    kept.append(child)
            elif visible(child):
                asked = _VISIBILITY.findall(child.attribute("style") or "") if child.attributes else []
                seen = asked[-1].lower() in ("visible", "initial") if asked else shown
                if not seen and child.tag in ("img", "hr", "input"):
                    continue
                if not seen and child.tag == "li":
                    child.tag = "div"
                kept.append(child)
                todo.append((child, seen))
        node.children = kept
    return root


class Layout:
    """Lines under way. White space collapses across inline elements; blocks begin on lines of their own."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self._line: list[str] = []
        self._space = False
        self._blank = False
        self._mark = ""
        self.indent = ""
        #: In elements that keep white space.
        self.keeps = False

    def write(self, data: str) -> None:
        if self.keeps:
            self.keep(data)
            return
        words = _SPACE.sub(" ", data)
        if words.startswith(" "):
            self._space = True
            words = words[1:]
        if not words:
            return
        ends = words.endswith(" ")
        if not self._line:
            self._open()
        elif self._space:
            self._line.append(" ")
        self._line.append(words[:-1] if ends else words)
        self._space = ends

    def keep(self, data: str) -> None:
        """Text whose white space counts."""
        for i, line in enumerate(data.split("\n")):
            if i:
                self.newline(True)
            if line:
                if not self._line:
                    self._open()
                self._line.append(line)
        self._space = False

    def _open(self) -> None:
        if self._blank and self.lines:
            self.lines.append("")
        self._blank = False
        mark = self._mark
        self._line.append(self.indent[: len(self.indent) - len(mark)] + mark if mark else self.indent)
        self._mark = ""

    def newline(self, even_if_empty: bool = False) -> None:
        if self._line:
            self.lines.append("".join(self._line).rstrip())
        elif even_if_empty:
            self._open()
            self.lines.append("".join(self._line).rstrip())
        self._line, self._space = [], False

    def block(self, spaced: bool) -> None:
        self.newline()
        self._blank = self._blank or spaced

    def mark(self, mark: str) -> None:
        """Stands before the next line, inside its indent."""
        self._mark = mark

    def drop_mark(self) -> None:
        if self._mark:
            self.newline(True)

    def text(self) -> str:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _finish(steps: Iterator) -> None:
    """Run steps that yield the steps to run before they go on; elements may lie in one another at any depth."""
    under_way = [steps]
    while under_way:
        inner = next(under_way[-1], None)
        if inner is None:
            under_way.pop()
        else:
            under_way.append(inner)


def _render(node: Node, out: Layout) -> Iterator:
    item, step = 0, 1
    if node.tag == "ol":
        if node.attribute("reversed") is not None:
            step = -1
            item = 1 + sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
        start = (node.attribute("start") or "").strip()
        if start.lstrip("-").isdigit() and start.isascii():
            item = int(start) - step
    for child in node.children:
        if isinstance(child, str):
            out.write(child)
            continue
        tag = child.tag
        if tag == "br":
            out.newline(True)
        elif tag == "img":
            out.write(child.attribute("alt") or "")
        elif tag == "hr":
            out.block(True)
            out.write("---")
            out.block(True)
        elif tag == "input":
            if (child.attribute("type") or "").strip().lower() in _SHOWS_VALUE:
                out.write(child.attribute("value") or "")
        elif tag in ("pre", "listing", "textarea"):
            out.block(True)
            if _holds_blocks(child):
                before, out.keeps = out.keeps, True
                yield _render(child, out)
                out.keeps = before
            else:
                out.keep(_plain(child).removeprefix("\n").rstrip("\n"))
            out.block(True)
        elif tag == "table":
            yield _table(child, out)
        elif tag == "li":
            out.block(False)
            item += step
            if node.tag == "ol":
                value = child.attribute("value") or ""
                if value.strip().lstrip("-").isdigit() and value.isascii():
                    item = int(value)
                mark = f"{item}. "
            else:
                mark = "* "
            out.indent += " " * len(mark)
            out.mark(mark)
            yield _render(child, out)
            out.newline()
            out.drop_mark()
            out.indent = out.indent[: -len(mark)]
        elif tag in BLOCKS or (tag == "text" and child.foreign == "svg"):
            # A list within a list adds no empty lines.
            spaced = tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and node.tag == "li")
            out.block(spaced)
            inner = "  " if tag in ("dd", "blockquote") else ""
            out.indent += inner
            yield _render(child, out)
            out.block(spaced)
            out.indent = out.indent[: len(out.indent) - len(inner)]
        else:
            yield _render(child, out)


def _holds_blocks(node: Node) -> bool:
    """Whether lists, tables or other blocks lie in an element that keeps white space."""
    todo = [node]
    while todo:
        inner = [c for c in todo.pop().children if isinstance(c, Node)]
        if any(c.tag in BLOCKS or c.tag in ("table", "li") for c in inner):
            return True
        todo += inner
    return False


def _plain(node: Node) -> str:
    """Text as it is, white space included."""
    parts = []
    todo = [node]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            parts.append(at)
        elif at.tag == "br":
            parts.append("\n")
        else:
            todo.extend(reversed(at.children))
    return "".join(parts)


def _table(table: Node, out: Layout) -> Iterator:
    """Rows as lines, cells side by side in aligned columns. A cell of several lines spans as many lines.

    A cell that spans columns or rows is written in the first of them; below it, later rows leave its columns
    empty. Text outside cells comes before the table.
    """
    rows: list[list[tuple[int, list[str]]]] = []
    loose = Node("div")
    # Cells of earlier rows by column: the rows they still span, and their columns. The next free column.
    above: dict[int, tuple[float, int]] = {}
    below: dict[int, tuple[float, int]] = {}
    free = 0

    def next_row() -> list:
        nonlocal above, free
        above = {at: (n - 1, span) for at, (n, span) in (above | below).items() if n > 1}
        below.clear()
        free = 0
        rows.append([])
        return rows[-1]

    def number(cell: Node, name: str, least: int, most: int) -> int:
        given = (cell.attribute(name) or "1").strip()
        return min(int(given), most) if given.isascii() and given.isdigit() and int(given) >= least else 1

    def walk(node: Node, row: list | None) -> Iterator:
        nonlocal free
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    loose.children.append(child)
            elif child.tag == "tr":
                yield walk(child, next_row())
            elif child.tag in ("td", "th"):
                if row is None:
                    row = next_row()
                cell = Layout()
                cell.keeps = out.keeps
                yield _render(child, cell)
                while free in above:
                    row.append((above[free][1], [""]))
                    free += above[free][1]
                span, down = number(child, "colspan", 1, 1000), number(child, "rowspan", 0, 65534)
                row.append((span, cell.text().split("\n")))
                if down != 1:
                    below[free] = (down or math.inf, span)
                free += span
            elif child.tag in ("tbody", "thead", "tfoot"):
                above.clear()
                below.clear()
                yield walk(child, None)
                above.clear()
                below.clear()
            else:
                loose.children.append(child)

    yield walk(table, None)
    out.block(True)
    if loose.children:
        yield _render(loose, out)
        out.block(False)
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for span, lines in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(max(map(_width, lines)), WIDEST))
            at += span
    for row in rows:
        for i in range(max((len(lines) for _, lines in row), default=0)):
            line, at = "", 0
            for n, (span, lines) in enumerate(row):
                part = lines[i] if i < len(lines) else ""
                line += part
                if n < len(row) - 1:
                    room = sum(widths.get(c, 0) for c in range(at, at + span)) + 3 * (min(span, 1 + len(widths)) - 1)
                    line += " " * max(room - _width(part), 0) + " | "
                at += span
            out.keep(line)
            out.newline(True)
    out.block(True)


def render(page: str) -> str:
    """The visible text of a page. An empty page, or one without visible text, gives the empty text."""
    out = Layout()
    _finish(_render(settle(parse(page)), out))
    return out.text()


def title(page_tree: Node) -> str | None:
    """Text of the first title element, white space collapsed."""
    todo = [page_tree]
    while todo:
        node = todo.pop()
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return None


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page id, title, text, n_lines of every whole page.

    Formulas, the text of svg, the values of buttons and text fields, and what stands in for an object are text. Two kinds
    of text that browsers can show are left out on purpose: options of select lists, of which most are folded away, and
    what pages mark as `aria-hidden`, which is decoration. Pages of any length and depth are rendered whole.
    A null or empty page has a null title, the empty text and 0 lines. Rows that repeat are returned as
    often; a null id stays null. Other columns of the table are not read.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for page in batch.column(1).to_pylist():
                tree = parse(page or "")
                name = title(tree)
                out = Layout()
                _finish(_render(settle(tree), out))
                text = out.text()
                rows.append((name, text, text.count("\n") + 1 if text else 0))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64())))],
                names=[id_col, "title", "text", "n_lines"],
            )

    return over_rows(pages, [id_col, html_col], run, f"`{id_col}` long, title string, text string, n_lines long")
