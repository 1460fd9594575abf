"""Visible text of web pages, laid out: a tree builder with implied tags, visibility rules, and a renderer.

The builder closes what markup leaves open (the head before the first element or text that cannot stand in
it, a paragraph before a block, a list item before the next, rows and cells of a table) and opens what it
leaves out (a row around a cell).  A table that starts among the rows of another ends that one; other
elements and text there are moved before the table, as browsers do.  Elements that a browser does not
show are left out.  Formulas show their text, drawings that of their text elements.  The renderer keeps line breaks and blank lines between blocks, marks and indents
list items, numbers ordered lists, keeps preformatted text and aligns the columns of tables.

Neither step recurses, so nesting may be as deep as a page is long.

Defined results
    null or empty html: the empty text, no blocks.  Text without any tag: the text, spaces collapsed.
    unfinished tags (also by a quoted value without its end), comments and raw elements run to the end of the page.
    repeated rows: each is rendered.  Empty table: no rows.
    a column whose name clashes with an added one is refused by ``ValueError``.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meanline.llm.text import pieces

_BLANK = " \t\n\r\f"
# Quotes open a value only right after the equals sign; elsewhere in a tag they are like letters.
_TAG_NAME, _NAME, _IS = rf"[a-zA-Z][^{_BLANK}/>]*+", rf"[^{_BLANK}/>][^{_BLANK}/>=]*+", rf"[{_BLANK}]*+=[{_BLANK}]*+"
_DOUBLE, _SINGLE, _BARE = r"[^\"]*+", r"[^']*+", rf"[^{_BLANK}\"'>][^{_BLANK}>]*+"
_INSIDE = rf"(?:[{_BLANK}/]++|{_NAME}(?:{_IS}(?:\"{_DOUBLE}(?:\"|\Z)|'{_SINGLE}(?:'|\Z)|{_BARE})?)?)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|</({_TAG_NAME}){_INSIDE}(?:>|\Z)|<({_TAG_NAME})({_INSIDE})(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_IS}(?:\"({_DOUBLE})(?:\"|\Z)|'({_SINGLE})(?:'|\Z)|({_BARE}))?)?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_HIDING_STYLE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Element names of HTML by what they do.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style xmp iframe noembed noframes noscript")
PLAIN = _names("title textarea")
HIDDEN = _names(
    "head script style template noscript title meta link base datalist iframe noembed noframes object audio video "
    "canvas map param source track col colgroup rp annotation annotation-xml"
)
#: Of a drawing only these elements show text, unless they stand in one of the others.
SVG_TEXT = _names("text foreignobject")
SVG_HIDDEN = _names("defs symbol clippath mask pattern marker metadata desc")
#: Blocks with a blank line around them, and without.
SPACED = _names("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table figure fieldset hr")
BLOCKS = SPACED | _names(
    "html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li "
    "main nav option optgroup search section summary caption thead tbody tfoot tr"
)
CLOSES_P = (BLOCKS - _names("html body option optgroup caption thead tbody tfoot tr legend")) | {"plaintext"}
#: What a start tag closes, and what keeps it from looking further out.
CLOSES = {
    "li": (_names("li"), _names("ul ol menu table td th")),
    "dd": (_names("dd dt"), _names("dl table td th")),
    "dt": (_names("dd dt"), _names("dl table td th")),
    "option": (_names("option"), _names("select datalist")),
    "optgroup": (_names("option optgroup"), _names("select")),
    "td": (_names("td th"), _names("table tr")),
    "th": (_names("td th"), _names("table tr")),
    "tr": (_names("tr td th caption colgroup"), _names("table thead tbody tfoot")),
    "thead": (_names("thead tbody tfoot tr td th caption colgroup"), _names("table")),
    "tbody": (_names("thead tbody tfoot tr td th caption colgroup"), _names("table")),
    "tfoot": (_names("thead tbody tfoot tr td th caption colgroup"), _names("table")),
    "body": (_names("head"), _names("body")),
}
#: What may stand in <head>; any other element, or text, ends it.
IN_HEAD = _names("head title meta link base basefont bgsound script style template noscript noframes")
#: What a table is made of; any other element, or text, that stands among it is shown before the table.
_PARTS = _names("caption colgroup col thead tbody tfoot tr td th")
_FRAME = _names("table colgroup thead tbody tfoot tr")
_P_SCOPE = _names("table td th caption button html object template")
_TABLE_WALLS = _names("td th caption table")


@dataclass
class Node:
    name: str
    attributes: dict[str, str]
    children: list = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), entities.unescape(double or single or bare))
    return found


def build(page: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root = Node("", {})
    stack = [root]
    opened: Counter[str] = Counter()  # open elements by name, so that looking for one that is not open costs nothing
    # for each open element the depth of the table that it stands in outside a cell; in a cell or caption minus its depth
    tables = [0]

    def add(child: Node | str) -> None:
        """Append to the open element; what cannot stand in a table goes before the table."""
        if tables[-1] > 0 and stack[-1].name in _FRAME and (
            child.strip(_BLANK) if isinstance(child, str) else child.name not in _PARTS
        ):
            around = stack[tables[-1] - 1].children  # the table is the last of them
            around.insert(len(around) - 1, child)
        else:
            stack[-1].children.append(child)

    def open_element(node: Node) -> None:
        add(node)
        within, depth = tables[-1], len(stack)
        if node.name == "table":
            within = depth
        elif node.name in _TABLE_WALLS:
            within = -depth if within > 0 else 0
        elif node.name == "template":
            within = 0
        stack.append(node)
        tables.append(within)
        opened[node.name] += 1

    def cut(depth: int) -> None:
        opened.subtract(node.name for node in stack[depth:])
        del stack[depth:], tables[depth:]

    def in_table(name: str) -> None:
        """Inside a table, end what the start of a part of it, or of another table, ends."""
        if name in _PARTS and tables[-1] < 0:
            cut(-tables[-1])
        table = tables[-1]
        if table > 0 and name == "table":
            cut(table)
        elif table > 0 and name in _PARTS:
            depth = table + 1
            if name not in ("caption", "colgroup"):
                while depth < len(stack) and stack[depth].name in _FRAME and (stack[depth].name != "colgroup" or name == "col"):
                    depth += 1
            cut(depth)

    def close(names: frozenset[str], walls: frozenset[str]) -> None:
        """End the outermost open element of ``names`` inside the nearest wall."""
        at = 0
        if not any(opened[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                at = depth
            elif stack[depth].name in walls:
                break
        if at:
            cut(at)

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else end]
        if text:
            text = entities.unescape(text)
            if stack[-1].name == "head" and text.strip(_BLANK):
                cut(len(stack) - 1)
            add(text)
        if token is None:
            break
        at = token.end()
        ended, started = token.group(1), token.group(2)
        if ended:
            name = ended.lower()
            if name == "br":
                if stack[-1].name == "head":
                    cut(len(stack) - 1)
                add(Node("br", {}))
                continue
            walls = frozenset() if name in ("table", "body", "html") else _TABLE_WALLS - {name}
            for depth in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[depth].name == name:
                    cut(depth)
                    break
                if stack[depth].name in walls and name not in ("tr", "thead", "tbody", "tfoot"):
                    break
        elif started:
            name = started.lower()
            if name == "head" and opened["head"]:
                continue
            if stack[-1].name == "head" and name not in IN_HEAD:
                cut(len(stack) - 1)
            if name == "colgroup" and not tables[-1]:
                continue
            in_table(name)
            if name in CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                    if stack[depth].name == "p":
                        cut(depth)
                        break
                    if stack[depth].name in _P_SCOPE:
                        break
            if name in CLOSES:
                close(*CLOSES[name])
            if name in ("td", "th") and stack[-1].name in ("table", "thead", "tbody", "tfoot"):
                open_element(Node("tr", {}))
            node = Node(name, _attributes(token.group(3)))
            if name in RAW or name in PLAIN:
                add(node)
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                inner = page[at : closing.start() if closing else end]
                node.children.append(entities.unescape(inner) if name in PLAIN else inner)
                at = closing.end() if closing else end
            elif name in VOID or (opened["svg"] or opened["math"] or name in ("svg", "math")) and token.group(3).endswith("/"):
                add(node)
            elif name == "form" and tables[-1] > 0:
                stack[-1].children.append(node)  # ended at once
            else:
                open_element(node)
    return root


def visible(node: Node) -> bool:
    """Whether a browser shows the element at all."""
    a = node.attributes
    return not (
        node.name in HIDDEN or "hidden" in a or _HIDING_STYLE.search(a.get("style", ""))
        or node.name == "dialog" and "open" not in a or node.name == "input" and a.get("type", "").lower() == "hidden"
    )


def _drawn(svg: Node) -> list:
    """The outermost elements of a drawing that show text, set apart by spaces."""
    found, pending = [], list(reversed(svg.children))
    while pending:
        node = pending.pop()
        if isinstance(node, str) or node.name in SVG_HIDDEN or not visible(node):
            continue
        if node.name in SVG_TEXT:
            found += [" ", node, " "]
        else:
            pending.extend(reversed(node.children))
    return found


class _Flow:
    """Lines of one column of text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self._line: list[str] = []
        self._space, self._gap = False, 0
        self.indents: list[str] = []
        self.marker = ""
        self.preformatted = 0

    def _open(self) -> None:
        if not self._line:
            if self._gap > 1 and self.lines:
                self.lines.append("")
            self._gap = 0
            before = "".join(self.indents)
            if self.marker:
                before = before[: len(before) - len(self.marker)] + self.marker
                self.marker = ""
            self._line.append(before)

    def text(self, text: str) -> None:
        if self.preformatted:
            for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
                if i:
                    self.end_line(True)
                if line:
                    self._open()
                    self._line.append(line)
            return
        words = _SPACES.sub(" ", text)
        if words[:1] == " ":
            self._space = True
            words = words[1:]
        trailing = words[-1:] == " "
        words = words[:-1] if trailing else words
        if words:
            if self._space and len(self._line) > 1:
                self._line.append(" ")
            self._open()
            self._line.append(words)
            self._space = trailing

    def end_line(self, keep_empty: bool = False) -> None:
        if self._line:
            self.lines.append("".join(self._line).rstrip(" "))
        elif keep_empty and self.lines and not self._gap:
            self.lines.append("")
        self._line, self._space = [], False

    def block(self, gap: int) -> None:
        self.end_line()
        self._gap = max(self._gap, gap)

    def add_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._open()
            self._line.append(line)
            self.end_line()


class _Table:
    """Rows of cells; a cell is its lines and the columns it spans."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []
        self.captions: list[str] = []

    def lines(self) -> list[str]:
        """Rows with aligned columns; a row is as high as its highest cell."""
        widths: dict[int, int] = {}
        for row in self.rows:
            column = 0
            for cell, span in row:
                if span == 1:
                    widths[column] = max(widths.get(column, 0), *map(len, cell), 0) if cell else widths.get(column, 0)
                column += span
        out = list(self.captions)
        for row in self.rows:
            for at in range(max((len(cell) for cell, _ in row), default=0)):
                parts, column = [], 0
                for cell, span in row:
                    width = sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
                    parts.append((cell[at] if at < len(cell) else "").ljust(width))
                    column += span
                out.append("  ".join(parts).rstrip(" "))
        return out


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"-?\d{1,9}", text.strip()) else otherwise


def render(root: Node) -> str:
    """The visible text of a tree."""
    flow, flows, tables = _Flow(), [], []
    counters: list[int | None] = []
    veiled = [False]  # for each entered element, whether its visibility hides its own text
    pending: list[tuple[str, object]] = [("enter", root)]
    while pending:
        step, node = pending.pop()
        if isinstance(node, str):
            if veiled[-1] or tables and flow is tables[-1][1]:
                continue  # hidden, or blank text between cells
            flow.text(node)
            continue
        name = node.name
        if step == "enter":
            if not visible(node):
                continue
            pending.append(("leave", node))
            stated = _VISIBILITY.findall(node.attributes.get("style", ""))
            veiled.append(stated[-1].lower() != "visible" if stated else veiled[-1])
            children = _drawn(node) if name == "svg" else node.children
            if name == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.name == "summary"][:1]
            if name == "br":
                flow.end_line(not veiled[-1])
            elif name == "table":
                flow.block(2)
                flows.append(flow)
                flow = _Flow()
                tables.append((_Table(), flow))
            elif name == "tr" and tables:
                tables[-1][0].rows.append([])
            elif name in ("td", "th", "caption") and tables:
                flows.append(flow)
                flow = _Flow()
            elif name in BLOCKS:
                flow.block(2 if name in SPACED and not (name in ("ul", "ol", "menu") and counters) else 1)
                if name in ("ul", "ol", "menu"):
                    counters.append(_number(node.attributes.get("start"), 1) if name == "ol" else None)
                elif name == "li":
                    mark = "- "
                    if counters and counters[-1] is not None:
                        number = _number(node.attributes.get("value"), counters[-1])
                        counters[-1] = number + 1
                        mark = f"{number}. "
                    flow.indents.append(" " * len(mark))
                    flow.marker = mark
                elif name in ("dd", "blockquote"):
                    flow.indents.append("  ")
                elif name == "pre":
                    flow.preformatted += 1
                    if children and isinstance(children[0], str) and children[0][:1] == "\n":
                        children = [children[0][1:], *children[1:]]
            pending.extend(("enter", c) for c in reversed(children))
            continue
        veiled.pop()
        if name == "table":
            table, _ = tables.pop()
            flow.end_line()
            lines = table.lines()
            flow = flows.pop()
            flow.add_lines(lines)
            flow.block(2)
        elif name in ("td", "th", "caption") and tables:
            flow.end_line()
            lines = flow.lines
            flow = flows.pop()
            if name == "caption":
                tables[-1][0].captions.extend(lines)
            else:
                if not tables[-1][0].rows:
                    tables[-1][0].rows.append([])
                span = max(1, min(1000, _number(node.attributes.get("colspan"), 1)))
                tables[-1][0].rows[-1].append((lines, span))
        elif name in BLOCKS and not (name == "tr" and tables):
            if name in ("ul", "ol", "menu"):
                counters.pop()
            elif name in ("li", "dd", "blockquote"):
                flow.end_line()
                flow.indents.pop()
                flow.marker = ""
            elif name == "pre":
                flow.preformatted -= 1
            flow.block(2 if name in SPACED and not (name in ("ul", "ol", "menu") and counters) else 1)
    flow.end_line()
    return "\n".join(flow.lines)


def title_of(root: Node) -> str | None:
    """The text of the first title element."""
    pending = [root]
    while pending:
        node = pending.pop()
        if node.name == "title":
            return _SPACES.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip(" ")
        pending.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return None


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``title``, the visible ``text`` and its number of blocks, ``n_blocks``, in place of ``html``."""
    kept = [f for f in pages.schema.fields if f.name != html]
    added = [T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType())]
    clash = {f.name for f in added} & {f.name for f in kept}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in pieces(batches, html):
            titles, texts = [], []
            for page in batch.column(html).to_pylist():
                root = build(page or "")
                titles.append(title_of(root))
                texts.append(render(root))
            blocks = [sum(1 for b in t.split("\n\n") if b.strip()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(titles, pa.string()), pa.array(texts, pa.string()),
                 pa.array(blocks, pa.int64())],
                names=[*(f.name for f in kept), "title", "text", "n_blocks"],
            )

    return pages.mapInArrow(run, T.StructType([*kept, *added]))
