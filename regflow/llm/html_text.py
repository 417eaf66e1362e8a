"""Layout-aware text of HTML pages.

A tokenizer feeds a tree builder that supplies what markup leaves out: end tags of paragraphs,
list items, table parts and options, rows and table bodies around loose cells, and a place
before the table for text that stands between its cells. A renderer then walks the tree the
way a page is laid out: hidden parts are left out, blocks start on new lines with blank lines
where margins would be, list items get bullets or numbers and indentation, preformatted text
keeps its blanks, and table cells are aligned in columns. Of drawings (svg) the text elements
are shown, of formulas (math) all but annotations.

Elements nested deeper than `DEPTH` lose their layout, such as a list item's bullet or a table's columns, but not
their text; what is hidden or drawn there is treated as elsewhere.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from regflow.llm.common import ids_and_texts, pieces
from regflow.session import ship_by_value

ship_by_value(__name__)

#: Elements nested deeper than this join their ancestor at this depth; their text is kept. Those
#: that decide whether text is shown stay what they are.
DEPTH = 200
#: Table columns are padded up to this width; longer cells run on, so a page's text stays of
#: the order of its markup.
WIDTH = 80

# Element kinds of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp iframe noembed noframes".split())
_TEXT_ONLY = frozenset("title textarea".split())
_NOT_SHOWN = frozenset(
    "head title script style template noscript noembed noframes iframe object audio video canvas "
    "datalist param source track meta link base col colgroup area annotation annotation-xml".split()
)
_MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl figure hr fieldset table ul ol menu xmp".split())
_BLOCK = _MARGIN | frozenset(
    "address article aside body center dd details dialog dir div dt fieldset figcaption footer "
    "form header hgroup html legend li main nav optgroup option search section summary caption "
    "thead tbody tfoot tr td th mtr".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
    "summary table ul dd dt xmp".split()
)
_SCOPE = frozenset("html table td th caption button object template".split())
_CELLS = frozenset(("td", "th"))
_SECTIONS = frozenset("thead tbody tfoot".split())
_TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
#: Parts of a drawing that are not drawn where they stand.
_NOT_DRAWN = frozenset("defs symbol clippath mask pattern marker lineargradient radialgradient filter metadata desc".split())
#: What a head and a column group hold; anything else ends them.
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
_IN_COLUMNS = frozenset(("col", "template"))

_NAME = re.compile(r"[A-Za-z][^\s/>\x00]*")
_ATTRIBUTE = re.compile(
    r"""[\s/]*(?:([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)""", re.ASCII
)
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDES = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "shown_as")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.shown_as = ""


def _attributes(html: str, at: int) -> tuple[dict[str, str], int, bool]:
    """The attributes from `at` on, the place after the tag, and whether the tag ends."""
    found: dict[str, str] = {}
    while True:
        match = _ATTRIBUTE.match(html, at)
        if not match:
            break
        at = match.end()
        value = match[2] or match[3] or match[4] or ""
        found.setdefault(match[1].lower(), unescape(value) if "&" in value else value)
    while at < len(html) and html[at] != ">":
        at += 1
    return found, at + 1, at < len(html)


class TreeBuilder:
    """Builds the tree of one page. `stack` holds the open elements."""

    def __init__(self):
        self.root = Node("html", {}, None)
        self.stack = [self.root]
        self.open: dict[str, int] = {"html": 1}
        #: Open elements below `DEPTH` that are none in the tree, those in the innermost element there, and those
        #: outside of it.
        self.flat: dict[str, int] = {}
        self.outer: list[dict[str, int]] = []
        #: Place of the element below `DEPTH` that conceals what is in it, and most open elements.
        self.concealed, self.deepest = 0, 1

    def build(self, html: str) -> Node:
        at, size = 0, len(html)
        while at < size:
            mark = html.find("<", at)
            if mark < 0:
                self.text(html[at:])
                break
            if mark > at:
                self.text(html[at:mark])
            at = self._markup(html, mark)
        return self.root

    def _markup(self, html: str, mark: int) -> int:
        size = len(html)
        if html.startswith("<!--", mark):
            for empty in ("<!-->", "<!--->"):
                if html.startswith(empty, mark):
                    return mark + len(empty)
            end = html.find("-->", mark + 4)
            return size if end < 0 else end + 3
        ending = html.startswith("</", mark)
        name = _NAME.match(html, mark + 1 + ending)
        if not name:
            if html[mark + 1 : mark + 2] in ("!", "?", "/") and mark + 2 < size:
                end = html.find(">", mark)
                return size if end < 0 else end + 1
            self.text("<")
            return mark + 1
        tag = name[0].lower()
        attributes, after, whole = _attributes(html, name.end())
        if not whole:
            return size
        if ending:
            self.end(tag)
            return after
        self.start(tag, attributes)
        if html[after - 2] == "/" and (self.open.get("svg") or self.open.get("math")):
            # Drawings and formulas have elements that end where they start.
            if tag not in _VOID:
                self.end(tag)
            return after
        if tag in _RAW or tag in _TEXT_ONLY:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, after)
            content = html[after : close.start() if close else size]
            if tag in _TEXT_ONLY:
                self.text(content)
            elif tag == "xmp":
                self.stack[-1].children.append(content)
            self.end(tag)
            if not close:
                return size
            end = html.find(">", close.end())
            return size if end < 0 else end + 1
        return after

    def text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        if self.stack[-1].tag in ("head", "colgroup") and text.strip():
            self._pop()
        top = self.stack[-1]
        if top.tag in _TABLE_PARTS and text.strip() and not self._in_unseen_cell():
            self._before_table(text)
        else:
            top.children.append(text)

    def _in_unseen_cell(self) -> bool:
        """Whether the cell that text belongs to is one below `DEPTH`, in a table that is not shown."""
        if not any(self.flat.get(t) for t in ("td", "th", "caption")):
            return False
        table = next(node for node in reversed(self.stack) if node.tag == "table")
        seen = _VISIBILITY.findall(table.attributes.get("style", ""))
        return _gone(table) or bool(seen and seen[-1].lower() != "visible")

    def _before_table(self, child: Node | str) -> None:
        place = next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i].tag == "table")
        holder, table = self.stack[place].parent, self.stack[place]
        at = len(holder.children) - 1
        while holder.children[at] is not table:
            at -= 1
        holder.children.insert(at, child)

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        top = self.stack[-1]
        node = Node(tag, attributes, top)
        outside = top.tag in _TABLE_PARTS and tag not in _NOT_SHOWN | _TABLE_PARTS | _CELLS | {"caption"}
        if outside and not self._in_unseen_cell():
            place = next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i].tag == "table")
            node.parent = self.stack[place].parent
            self._before_table(node)
        else:
            top.children.append(node)
        if tag in _VOID:
            return
        if len(self.stack) >= DEPTH:
            if not self._decides(node):
                self.flat[tag] = self.flat.get(tag, 0) + 1
                return
            if _conceals(node):
                self.concealed = len(self.stack)
            self.outer.append(self.flat)
            self.flat = {}
        self.stack.append(node)
        self.deepest = max(self.deepest, len(self.stack))
        self.open[tag] = self.open.get(tag, 0) + 1

    def _decides(self, node: Node) -> bool:
        """Whether text in an element is shown or not because of it. Below `DEPTH` only these
        stay elements, without a layout of their own, and none inside one that conceals all it holds."""
        if self.concealed:
            return False
        if _conceals(node) or node.tag == "svg":
            return True
        if self.open.get("svg") and node.tag in _NOT_DRAWN | {"text", "foreignobject"}:
            return True
        if _VISIBILITY.search(node.attributes.get("style", "")):
            node.shown_as = "span"
            return True
        return False

    def _pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1
        if len(self.stack) >= DEPTH:
            self.flat = self.outer.pop()
        if len(self.stack) <= self.concealed:
            self.concealed = 0

    def _close(self, tags, stops) -> bool:
        """Close the innermost open element of `tags` and all inside it, if it comes before
        any of `stops`."""
        if not any(self.open.get(t) for t in tags):
            return False
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[place].tag
            if tag in tags:
                while len(self.stack) > place:
                    self._pop()
                return True
            if tag in stops:
                return False
        return False

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body", "head"):
            if tag == "head" and len(self.stack) == 1:
                self._push(tag, attributes)
            elif tag == "body":
                self._close(("head",), ())
                self.root.attributes |= attributes
            return
        top = self.stack[-1].tag
        if (top == "head" and tag not in _IN_HEAD) or (top == "colgroup" and tag not in _IN_COLUMNS):
            self._pop()
        if tag in _ENDS_P:
            self._close(("p",), _SCOPE)
        if tag == "table" and self.stack[-1].tag in _TABLE_PARTS:
            self._close(("table",), _CELLS)
        if tag == "li":
            self._close(("li",), _SCOPE | {"ul", "ol", "menu", "dir"})
        elif tag in ("dt", "dd"):
            self._close(("dt", "dd"), _SCOPE | {"dl"})
        elif tag in ("option", "optgroup"):
            self._close(("option",), _SCOPE | {"select"})
            if tag == "optgroup":
                self._close(("optgroup",), _SCOPE | {"select"})
        elif tag == "a":
            self._close(("a",), _SCOPE)
        elif tag in _CELLS or tag == "tr" or tag in _SECTIONS or tag in ("caption", "colgroup"):
            if not self.open.get("table"):
                return
            self._close(("td", "th", "caption"), ("table",))
            if tag not in _CELLS:
                self._close(("tr",), ("table",))
                if tag != "tr":
                    self._close(_SECTIONS, ("table",))
            if (tag == "tr" or tag in _CELLS) and self.stack[-1].tag not in _SECTIONS | {"tr"}:
                self._push("tbody", {})
            if tag in _CELLS and self.stack[-1].tag != "tr":
                self._push("tr", {})
        self._push(tag, attributes)

    def end(self, tag: str) -> None:
        if self.flat.get(tag):
            self.flat[tag] -= 1
        elif tag in ("html", "body", "head"):
            if tag == "head":
                self._close(("head",), ())
        elif tag == "br":
            self.start("br", {})
        elif tag == "p" and not self._close(("p",), _SCOPE):
            self._push("p", {})
            self._pop() if self.stack[-1].tag == "p" else None
        elif tag in _TABLE_PARTS or tag in _CELLS or tag == "caption":
            self._close((tag,), ("table",) if tag != "table" else ())
        elif tag == "p":
            return
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._close(("h1", "h2", "h3", "h4", "h5", "h6"), _SCOPE)
        else:
            self._close((tag,), _SCOPE)


def _conceals(node: Node) -> bool:
    """Whether nothing in an element is shown, whatever it is."""
    closed = node.tag == "dialog" and "open" not in node.attributes
    return closed or node.tag in _NOT_SHOWN or _gone(node)


def _number(text: str | None, default: int, most: int = 1000) -> int:
    match = re.match(r"\s*(-?\d{1,9})", text or "", re.ASCII)
    return min(int(match[1]), most) if match else default


class Renderer:
    """Writes lines. `margin` is the number of blank lines due before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.margin = 0
        self.indent: list[str] = []
        self.marker = ""
        self.pre = 0

    def done(self) -> list[str]:
        self.close()
        return self.lines

    def close(self) -> None:
        line = self.line if self.pre else self.line.rstrip(" ")
        if line:
            self._put(line)
        self.line = ""

    def _put(self, line: str) -> None:
        if self.lines and self.margin:
            self.lines.extend([""] * self.margin)
        self.margin = 0
        prefix = "".join(self.indent)
        if self.marker:
            prefix = prefix[: len(prefix) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append(prefix + line)

    def block(self, margin: int) -> None:
        self.close()
        if self.lines:
            self.margin = max(self.margin, margin)

    def text(self, text: str) -> None:
        if self.pre:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.line += first
            for line in rest:
                self._put(self.line)
                self.line = line
            return
        text = _BLANKS.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.removeprefix(" ")
        self.line += text

    def children(self, node: Node, hidden: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                if not hidden:
                    self.text(child)
            else:
                self.element(child, hidden)

    def element(self, node: Node, hidden: bool) -> None:
        tag, attributes = node.shown_as or node.tag, node.attributes
        if tag in _NOT_SHOWN or "hidden" in attributes:
            return
        if tag == "dialog" and "open" not in attributes:
            return
        style = attributes.get("style")
        if style:
            if _HIDES.search(style):
                return
            seen = _VISIBILITY.findall(style)
            if seen:
                hidden = seen[-1].lower() != "visible"
        if tag == "br":
            if self.line or self.pre:
                self._put(self.line if self.pre else self.line.rstrip(" "))
                self.line = ""
            elif self.lines:
                self.margin = max(self.margin, 1)
            return
        if tag == "svg":
            self._drawing(node, hidden)
            return
        if tag == "mtd":
            self.text(" ")
        if tag not in _BLOCK:
            self.children(node, hidden)
            return
        nested = tag in ("ul", "ol", "menu") and bool(self.indent)
        margin = 1 if tag in _MARGIN and not nested else 0
        if self.marker and not self.line:
            margin = 0
        self.block(margin)
        if tag == "table":
            for line in table_lines(node, hidden, self):
                if line.strip():
                    self._put(line)
        elif tag in ("ul", "ol", "menu"):
            self._list(node, hidden)
        elif tag == "li":
            self._item(node, hidden, "- ")
        elif tag in ("blockquote", "dd"):
            self.indent.append("  ")
            self.children(node, hidden)
            self.close()
            self.indent.pop()
        elif tag in ("pre", "xmp"):
            self.pre += 1
            first = node.children[0] if node.children else None
            if tag == "pre" and isinstance(first, str) and first[:1] == "\n":
                node.children[0] = first[1:]
            self.children(node, hidden)
            self.close()
            self.pre -= 1
        else:
            self.children(node, hidden)
        self.block(margin)

    def _drawing(self, node: Node, hidden: bool) -> None:
        """The texts of a drawing and the pages in it, each on lines of its own."""
        for child in node.children:
            if isinstance(child, str) or child.tag in _NOT_SHOWN | _NOT_DRAWN or _gone(child):
                continue
            given = child.attributes
            if given.get("display") == "none":
                continue
            seen = _VISIBILITY.findall(given.get("style", "")) or [given.get("visibility", "")]
            veiled = seen[-1].lower() != "visible" if seen[-1] else hidden
            if child.tag in ("text", "foreignobject"):
                self.block(0)
                self.children(child, veiled)
                self.block(0)
            else:
                self._drawing(child, veiled)

    def _list(self, node: Node, hidden: bool) -> None:
        number = _number(node.attributes.get("start"), 1, 10**9)
        for child in node.children:
            if isinstance(child, str):
                if not hidden:
                    self.text(child)
            elif child.tag == "li" and "hidden" not in child.attributes and not _HIDES.search(child.attributes.get("style", "")):
                self.close()
                bullet = "- "
                if node.tag == "ol":
                    number = _number(child.attributes.get("value"), number, 10**9)
                    bullet = f"{number}. "
                    number += 1
                seen = _VISIBILITY.findall(child.attributes.get("style", ""))
                self._item(child, seen[-1].lower() != "visible" if seen else hidden, bullet)
            else:
                self.element(child, hidden)

    def _item(self, node: Node, hidden: bool, bullet: str) -> None:
        self.indent.append(" " * len(bullet))
        self.marker = bullet
        self.children(node, hidden)
        self.close()
        self.marker = ""
        self.indent.pop()


def _rows(table: Node) -> tuple[list[Node], list[Node]]:
    """The captions and the rows of a table: head, bodies, foot."""
    captions, rows = [], {"thead": [], "tbody": [], "tfoot": []}
    for part in table.children:
        if isinstance(part, str):
            continue
        if part.tag == "caption":
            captions.append(part)
        elif part.tag in rows and not _gone(part):
            rows[part.tag] += [r for r in part.children if isinstance(r, Node) and r.tag == "tr"]
    return captions, [r for part in rows.values() for r in part if not _gone(r)]


def _gone(node: Node) -> bool:
    return "hidden" in node.attributes or bool(_HIDES.search(node.attributes.get("style", "")))


def _hidden(node: Node, hidden: bool) -> bool:
    for holder in (node.parent, node):
        seen = _VISIBILITY.findall(holder.attributes.get("style", "")) if holder else []
        hidden = seen[-1].lower() != "visible" if seen else hidden
    return hidden


def table_lines(table: Node, hidden: bool, outer: Renderer) -> Iterator[str]:
    """A table's lines: captions, then rows with cells aligned. A cell over several columns
    takes their joint width; a cell over several rows keeps its columns free below."""
    captions, rows = _rows(table)
    for caption in captions:
        inner = Renderer()
        inner.element(caption, hidden)
        yield from inner.done()
    grid: list[list[tuple[int, int, list[str]]]] = []
    below: dict[int, int] = {}
    for row in rows:
        cells, column = [], 0
        still = {c: n - 1 for c, n in below.items() if n > 1}
        row_hidden = _hidden(row, hidden)
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in _CELLS or _gone(cell):
                continue
            while below.get(column):
                column += 1
            inner = Renderer()
            inner.children(cell, _hidden(cell, row_hidden))
            span = max(1, _number(cell.attributes.get("colspan"), 1))
            down = max(1, _number(cell.attributes.get("rowspan"), 1, 65_534))
            cells.append((column, span, inner.done()))
            if down > 1:
                still |= {c: down - 1 for c in range(column, column + span)}
            column += span
        grid.append(cells)
        below = still
    widths: dict[int, int] = {}
    for cells in grid:
        for column, span, lines in cells:
            if span == 1:
                fitting = max((len(x) for x in lines if len(x) <= WIDTH), default=0)
                widths[column] = max(widths.get(column, 0), fitting)
    used = sorted(c for c, w in widths.items() if w)
    starts, at = {}, 0
    for column in used:
        starts[column] = at
        at += widths[column] + 2
    for cells in grid:
        for k in range(max((len(lines) for *_, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if k < len(lines) and lines[k]:
                    if line:
                        line += "  "
                    place = starts.get(column)
                    if place is None:
                        place = next((starts[c] for c in used if c >= column), 0)
                    line = line.ljust(place) + lines[k]
            if line:
                yield line


def text_of(html: str | None) -> str:
    """The visible text of one page; empty for null."""
    if not html:
        return ""
    builder = TreeBuilder()
    root = builder.build(html.replace("\r\n", "\n").replace("\x00", ""))
    renderer = Renderer()
    limit = sys.getrecursionlimit()
    # Elements below `DEPTH` take two calls each, which need no more of the machine's stack.
    sys.setrecursionlimit(max(limit, 2000 + 3 * builder.deepest))
    try:
        renderer.element(root, False)
    finally:
        sys.setrecursionlimit(limit)
    return "\n".join(renderer.done())


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: id and visible text.

    A null or empty page has an empty text, a null id stays null, repeated rows each give a
    row, and columns other than the two are not read. Markup of any length and nesting is read
    whole: nesting beyond `DEPTH` is flattened without losing text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [text_of(html) for html in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"]
            )

    return ids_and_texts(pages, id_col, html_col).mapInArrow(run, "id long, text string")
