"""Visible text of HTML pages, laid out: a tree with implied tags, visibility rules, and a renderer.

The tree builder opens what HTML implies (table bodies, rows) and closes what it implies (a paragraph before
a block, an item before an item, a cell before a cell). An element is left out with all below it if it is
never shown (head, script, style, template, ...), has `hidden`, or is styled display:none; visibility:hidden
leaves text out until it is set visible again. The rest is rendered: blocks on lines of their own, blank
lines where browsers have margins, bullets and numbers, preformatted text as it is, tables as columns. Of
formulas all text is shown, of drawings that of their text elements. What has no text of its own on the
page, and so is not shown: media, form inputs, the inside of closed details and dialogs.

A null or empty page gives an empty text. Elements deeper than DEPTH are flattened, as browsers do at the
same depth; their text stays. A cell spans at most 1000 columns, as HTML has it. A cell wider than WIDEST
does not widen its column, so that a long cell costs its row alone: what follows it there stands two blanks
after it. Rows with a null or repeated page_id are pages of their own; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean

DEPTH, WIDEST = 512, 100
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template noscript meta link base datalist iframe noembed noframes object audio video canvas param source track area desc defs metadata".split())
#: Blocks with the blank lines around them; other blocks have none.
MARGINS = dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote figure table fieldset hr menu".split(), 1)
BLOCKS = frozenset(MARGINS) | frozenset("address article aside body center details dd dialog dir div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary caption tr tbody thead tfoot td th select".split())
#: What a start tag closes: the nearest of these, unless one of the fences lies before it.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "option": ("option", ("select", "datalist", "optgroup")),
    "optgroup": ("optgroup option", ("select",)),
    "tr": ("tr", ("table",)),
    "td": ("td th", ("table", "tr")),
    "th": ("td th", ("table", "tr")),
    "tbody": ("tbody thead tfoot caption colgroup", ("table",)),
    "thead": ("tbody thead tfoot caption colgroup", ("table",)),
    "tfoot": ("tbody thead tfoot caption colgroup", ("table",)),
    "caption": ("caption", ("table",)),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b) | {"html"}) for k, (a, b) in CLOSES.items()}
NO_PARAGRAPH = BLOCKS - frozenset("html body option optgroup select tr tbody thead tfoot td th caption li dt dd legend summary".split()) | {"li", "dt", "dd"}
SCOPES = frozenset("table td th caption button object template".split())
MARKUP = re.compile(r"<(?:!--(?:>|->|(?P<comment>.*?)(?:--!?>|\Z))|(?P<bogus>[!?][^>]*>?|/[^a-zA-Z][^>]*>?)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*))", re.S)
ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?)")
SPACES = re.compile(r"[ \t\n\r\f]+")
STYLED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes_at(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """The attributes from a place in a tag, the place after the tag, and whether the tag ends at all."""
    if page.startswith(">", at):
        return {}, at + 1, True
    found: dict[str, str] = {}
    while m := ATTRIBUTE.match(page, at):
        if m.end() == at:
            break
        at = m.end()
        if m[1]:
            return found, at, True
        value = next((v for v in m.group(3, 4, 5) if v is not None), "")
        found.setdefault(m[2].lower(), unescape(value) if "&" in value else value)
    end = page.find(">", at)
    return found, (len(page) if end < 0 else end + 1), end >= 0


class Tree:
    """Builds the tree of a page."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]

    def close(self, tags: frozenset[str], fences: frozenset[str]) -> bool:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                del self.open[k:]
                return True
            if tag in fences:
                return False
        return False

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < DEPTH:
            self.open.append(node)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body") and len(self.open) > 1 and any(n.tag == tag for n in self.open):
            return
        if tag == "body":
            self.close(frozenset(("head",)), frozenset())
        if tag in NO_PARAGRAPH:
            self.close(frozenset(("p",)), SCOPES)
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in ("tbody", "thead", "tfoot"):
            self.close(frozenset(("tr",)), frozenset(("table",)))
            self.close(*CLOSES[tag])
        if tag in ("tr", "td", "th"):
            if any(n.tag == "table" for n in self.open):
                top = self.open[-1].tag
                if tag == "tr" and top == "table" or tag != "tr" and top == "table":
                    self.push("tbody", {})
                if tag != "tr" and self.open[-1].tag in ("tbody", "thead", "tfoot"):
                    self.push("tr", {})
        if tag[0] == "h" and tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.open[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.open.pop()
        if self.open[-1].tag == "head" and tag not in UNSEEN:
            self.open.pop()
        self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.push("br", {})
        elif tag == "p" and not self.close(frozenset(("p",)), SCOPES):
            self.open[-1].children.append(Node("p", {}))
        elif tag not in ("p", "body", "html"):
            self.close(frozenset((tag,)), frozenset(("table",)) if tag in ("li", "dt", "dd", "div", "b", "i", "a", "span") else frozenset())

    def text(self, text: str) -> None:
        if text:
            if self.open[-1].tag == "head" and not text.isspace():
                self.open.pop()
            self.open[-1].children.append(unescape(text) if "&" in text else text)

    def build(self, page: str) -> Node:
        at, n = 0, len(page)
        while at < n:
            m = MARKUP.search(page, at)
            if not m:
                self.text(page[at:])
                break
            if m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            name = m["name"]
            if not name:
                continue
            attributes, at, whole = attributes_at(page, at)
            if not whole:
                break
            tag = name.lower()
            if m["end"]:
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                raw = page[at : close.start() if close else n]
                if self.open[-1].tag == tag:
                    if raw:
                        self.open[-1].children.append(unescape(raw) if tag in ("textarea", "title") else raw)
                    self.open.pop()
                at = close.end() if close else n
        return self.root


class Canvas:
    """Lines of text: words flow, margins collapse, marks of list items stand before their first line."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.some = False
        self.margin = 0
        self.indent, self.mark = "", ""

    def words(self, text: str) -> None:
        text = SPACES.sub(" ", text)
        if text == " " or not text:
            self.space = self.space or bool(text and self.parts)
            return
        if (self.space or text[0] == " ") and self.parts and not self.parts[-1].endswith("\n"):
            self.parts.append(" ")
        self.parts.append(text.strip(" "))
        self.space = text[-1] == " "

    def kept(self, text: str) -> None:
        for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.newline(True)
            if line:
                self.parts.append(line)
        self.space = False

    def newline(self, always: bool = False) -> None:
        """Ends the line that is begun; always: even an empty one."""
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.space = [], False
        if not line and not always:
            return
        if self.margin and self.some:
            self.lines += [""] * self.margin
        self.margin = 0
        if line or self.mark:
            line = self.indent[: len(self.indent) - len(self.mark)] + self.mark + line
            self.mark = ""
        self.lines.append(line.rstrip(" "))
        self.some = True

    def block(self, margin: int) -> None:
        self.newline()
        self.margin = max(self.margin, margin)

    def whole(self, lines: list[str]) -> None:
        """Lines that are laid out already."""
        self.newline()
        for line in lines:
            self.parts = [line]
            self.newline(True)

    def text(self) -> str:
        self.newline()
        return "\n".join(self.lines).strip("\n")


def hidden(node: Node, seen: bool | None) -> tuple[bool, bool | None]:
    """Whether a node is left out with all below it, and whether its own text is seen: None within a drawing, outside its text elements."""
    a = node.attributes
    if node.tag == "svg":
        seen = None if seen else seen
    elif seen is None and node.tag in ("text", "foreignobject"):
        seen = True
    if node.tag in UNSEEN or "hidden" in a or node.tag == "input" or node.tag == "dialog" and "open" not in a:
        return True, seen
    if "style" in a:
        for name, value in STYLED.findall(a["style"]):
            if name.lower() == "display" and value.lower() == "none":
                return True, seen
            if name.lower() == "visibility":
                seen = False if value.lower() in ("hidden", "collapse") else None if seen is None else True
    return False, seen


def number(text: str | None, otherwise: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,6})", text or "")
    return int(m[1]) if m else otherwise


def numeral(n: int, kind: str) -> str:
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(ord(kind) + k) + out
        return out
    if kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out += sign * (n // value)
            n %= value
        return out if kind == "i" else out.upper()
    return str(n)


def render(node: Node, out: Canvas, seen: bool, pre: bool, depth: int = 0) -> None:
    """Renders what is below a node."""
    tag, count, step, kind = node.tag, 0, 1, "1"
    if tag == "ol":
        kind, count = node.attributes.get("type", "1"), number(node.attributes.get("start"), 1)
        if "reversed" in node.attributes:
            step, count = -1, number(node.attributes.get("start"), sum(isinstance(c, Node) and c.tag == "li" for c in node.children))
    closed = tag == "details" and "open" not in node.attributes
    for child in node.children:
        if isinstance(child, str):
            if seen and not closed:
                out.kept(child) if pre else out.words(child)
            continue
        gone, visible = hidden(child, seen)
        if gone or closed and child.tag != "summary":
            continue
        name = child.tag
        if name == "br":
            out.newline(True)
        elif name == "table":
            out.block(1)
            out.whole(table(child, visible, depth))
            out.block(1)
        elif name in BLOCKS:
            margin = 0 if name in ("ul", "ol") and depth else MARGINS.get(name, 0)
            out.block(margin)
            indent, mark, deeper = out.indent, out.mark, depth
            if name == "li":
                sign = f"{numeral(number(child.attributes.get('value'), count), kind)}. " if tag == "ol" else "* "
                if tag == "ol":
                    count = number(child.attributes.get("value"), count) + step
                out.indent, out.mark, deeper = indent + " " * len(sign), sign, depth + 1
            elif name in ("dd", "blockquote"):
                out.indent = indent + "    "
            if name == "pre" and child.children and isinstance(child.children[0], str):
                child.children[0] = child.children[0].removeprefix("\n")
            render(child, out, visible, pre or name in ("pre", "textarea"), deeper)
            out.newline(False)
            out.block(margin)
            if name == "li" and out.mark and out.mark is not mark:
                out.newline(True)
            out.indent, out.mark = indent, "" if mark != out.mark else mark
        else:
            if name == "q" and visible:
                out.words('"')
                out.space = False
            drawn = name == "text" and visible and not seen
            out.space = out.space or drawn and bool(out.parts)
            render(child, out, visible, pre or name == "textarea", depth)
            out.space = out.space or drawn and bool(out.parts)
            if name == "q" and visible:
                out.parts.append('"')


def wide(text: str) -> int:
    """Columns that a text takes."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def table(node: Node, seen: bool, depth: int) -> list[str]:
    """The lines of a table: captions, then rows whose cells begin at the same column."""
    grid: list[dict[int, tuple[list[str], int]]] = []
    before, held, rows = [], {}, []

    def walk(parent: Node, visible: bool) -> None:
        for child in parent.children:
            if isinstance(child, str):
                if visible and not child.isspace() and parent.tag != "tr":
                    before.append(SPACES.sub(" ", child).strip())
                continue
            gone, shown = hidden(child, visible)
            if gone:
                continue
            if child.tag in ("thead", "tbody", "tfoot"):
                walk(child, shown)
            elif child.tag == "tr":
                rows.append((child, shown))
            elif child.tag not in ("col", "colgroup"):
                before.extend(canvas(child, shown, depth))

    walk(node, seen)
    for row, visible in rows:
        cells, at = {}, 0
        for child in row.children:
            if isinstance(child, str):
                if visible and not child.isspace():
                    before.append(SPACES.sub(" ", child).strip())
                continue
            gone, shown = hidden(child, visible)
            if gone:
                continue
            while held.get(at, 0) > 0:
                at += 1
            across = max(1, min(1000, number(child.attributes.get("colspan"), 1)))
            down = max(1, number(child.attributes.get("rowspan"), 1))
            cells[at] = canvas(child, shown, depth), across
            for c in range(at, at + across):
                held[c] = max(held.get(c, 0), down)
            at += across
        held = {c: n - 1 for c, n in held.items() if n > 1}
        grid.append(cells)
    sizes: dict[int, int] = {}
    for spanning in (False, True):
        for cells in grid:
            for at, (lines, across) in cells.items():
                need = max(map(wide, lines), default=0)
                if (across > 1) != spanning or need > WIDEST * across:
                    continue
                have = sum(sizes.get(c, 0) for c in range(at, at + across)) + 2 * (across - 1)
                sizes[at + across - 1] = sizes.get(at + across - 1, 0) + max(0, need - have)
    starts, x = {}, 0
    for c in range(max(sizes, default=-1) + 1):
        starts[c] = x
        x += sizes.get(c, 0) + (2 if sizes.get(c, 0) else 0)
    out = [line for line in before if line]
    for cells in grid:
        for k in range(max((len(lines) for lines, _ in cells.values()), default=0)):
            line, used = "", 0
            for at, (lines, _) in sorted(cells.items()):
                if k < len(lines) and lines[k]:
                    before_it = max(starts.get(at, x) - used, 2 if line else 0)
                    line += " " * before_it + lines[k]
                    used += before_it + wide(lines[k])
            out.append(line)
    return out


def canvas(node: Node, seen: bool, depth: int) -> list[str]:
    """The lines of a cell."""
    own = Canvas()
    render(node, own, seen, node.tag == "pre", 0)
    text = own.text()
    return text.split("\n") if text else []


def visible_text(page: str | None) -> str:
    """The visible text of a page."""
    out = Canvas()
    render(Tree().build((page or "").replace("\0", "�")), out, True, False)
    return out.text()


def extracted(pages: DataFrame) -> DataFrame:
    """page_id and the visible text of each page."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sys

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEPTH))
        for batch in batches:
            yield pa.record_batch([batch.column("page_id"), pa.array([visible_text(h) for h in batch.column("html").to_pylist()], pa.string())], names=["page_id", "text"])

    arrow_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(lean(each), "page_id bigint, text string")
