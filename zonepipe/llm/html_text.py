"""Layout-aware HTML to text.

A tokenizer feeds a tree builder that supplies implied end tags (``p``, ``li``, ``td``
and their like) and ignores stray ones; visibility rules take out what a browser does not
show; a renderer walks the tree and keeps the layout that carries meaning: block spacing,
line breaks, preformatted text, nested lists with their markers, and tables whose cells
are aligned in columns, those that reach over several rows too.  Lists, quotes and tables
nested more than DEPTH deep show their text without markers, indents or columns.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Classes of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "script style template head title noscript iframe object embed canvas audio video datalist noembed noframes"
    " annotation annotation-xml mphantom rp".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table ul"
    " tr td th thead tbody tfoot caption option optgroup select".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset menu".split())
#: What an opening tag ends, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: Parts of a table, and what they may lie in: elements in between end, as in a browser.
WITHIN = {
    "td": {"tr", "thead", "tbody", "tfoot", "table"},
    "th": {"tr", "thead", "tbody", "tfoot", "table"},
    "tr": {"thead", "tbody", "tfoot", "table"},
    "thead": {"table"},
    "tbody": {"table"},
    "tfoot": {"table"},
}
#: Elements whose border an implied or stray end tag does not cross.
SCOPE = frozenset("table td th caption button object template html".split())

#: What an end tag crosses the borders of SCOPE for.
TABLE_PARTS = frozenset("table tr tbody thead tfoot".split())
#: Levels of lists, quotes and tables that keep their layout; each is a level of recursion.
DEPTH = 30

#: Parts of a drawing that are not shown where they stand.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker desc metadata".split())
#: Start tags that leave an open head open.
HEAD = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())

# Quotes count only as an attribute's value, which an unclosed one ends with the page.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible|initial)\b", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


def parse(page: str) -> Node:
    """The page's tree; text is kept as strings among the children."""
    root = Node("html", {})
    stack, at, end, styled = [root], 0, len(page), False
    # Where the open elements of a name lie on the stack, so that no tag needs a walk along it.
    held: defaultdict[str, list[int]] = defaultdict(list)

    def open_element(node: Node) -> None:
        stack[-1].children.append(node)
        held[node.name].append(len(stack))
        stack.append(node)

    def close_from(i: int) -> None:
        for node in stack[i:]:
            held[node.name].pop()
        del stack[i:]

    def pop_to(names: set[str] | frozenset[str], barrier) -> None:
        """End the outermost open element of ``names`` that no ``barrier`` hides."""
        if not any(map(held.get, names)):
            return
        border = innermost(b for b in barrier if b not in names)
        inside = [where[i] for n in names if (where := held[n]) and (i := bisect_right(where, border)) < len(where)]
        if inside:
            close_from(min(inside))

    def innermost(names: Iterable[str]) -> int:
        """Where the innermost open element of ``names`` lies; 0 if none is open."""
        return max((where[-1] for n in names if (where := held.get(n))), default=0)

    def back_to(names: set[str]) -> None:
        """End what lies inside the innermost open element of ``names``, unless it is hidden there."""
        i = innermost(names)
        if i > innermost(HIDDEN):
            close_from(i + 1)

    while at < end:
        stop, found = page.find("<", at), None
        while stop >= 0 and not (found := _TOKEN.match(page, stop)):
            stop = page.find("<", stop + 1)
        if stop < 0:
            stop = end
        if stop > at:
            text = html.unescape(page[at:stop])
            if stack[-1].name == "head" and text.strip(" \t\n\r\f"):
                close_from(len(stack) - 1)
            stack[-1].children.append(text)
        if not found:
            break
        at = max(found.end(), stop + 1)
        if not found["name"]:
            if page.startswith("<![CDATA[", stop):
                stack[-1].children.append(page[stop + 9 : at].removesuffix("]]>"))
            continue
        name = found["name"].lower()
        if found["end"]:
            if name == "br":
                stack[-1].children.append(Node("br", {}))
            elif name not in ("html", "body") and held.get(name):
                borders = () if name in TABLE_PARTS else (b for b in SCOPE if b != name)
                if held[name][-1] > innermost(borders):
                    close_from(held[name][-1])
            continue
        if name in ("html", "body"):
            if name == "body":
                pop_to({"head"}, ())
            continue
        rest = found["rest"]
        attributes = {}
        if rest and not rest.isspace():
            for a in _ATTRIBUTE.finditer(rest):
                attributes.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
            styled = styled or _visibility(attributes) is not None
        if stack[-1].name == "head" and name not in HEAD:
            close_from(len(stack) - 1)
        if name in CLOSES:
            closing, barrier = CLOSES[name]
            pop_to(closing, barrier)
        if name in BLOCK and name not in ("option", "optgroup"):
            pop_to({"head"}, ())
            pop_to({"p"}, SCOPE)
        if name in WITHIN and held["table"] and stack[-1].name not in WITHIN[name]:
            back_to(WITHIN[name])
        if name in ("td", "th") and stack[-1].name in ("table", "thead", "tbody", "tfoot"):
            open_element(Node("tr", {}))
        node = Node(name, attributes)
        # In drawings and formulas a slash ends an element, unless it belongs to an attribute's value.
        empty = rest.endswith("/") and (held["svg"] or held["math"] or name in ("svg", "math"))
        if name in VOID or (empty and "=" not in rest[max(map(rest.rfind, " \t\n\r\f\"'")) + 1 :]):
            stack[-1].children.append(node)
            continue
        if name in RAW_TEXT:
            stack[-1].children.append(node)
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            body = page[at : closing.start() if closing else end]
            if name in ("title", "textarea"):
                body = html.unescape(body)
            node.children.append(body)
            at = closing.end() if closing else end
            continue
        open_element(node)
    if styled:
        _drop_invisible(root)
    return root


def _visibility(attributes: dict[str, str]) -> str | None:
    """The element's own visibility, or None where it has its parent's."""
    said = _VISIBILITY.findall(attributes.get("style", ""))
    return said[-1].lower() if said else None


def _drop_invisible(root: Node) -> None:
    """Takes out what visibility hides; elements in it that are made visible again stay."""
    pending, order = [(root, False)], []
    while pending:
        node, hidden = pending.pop()
        own = _visibility(node.attributes)
        hidden = own in ("hidden", "collapse") if own else hidden
        order.append((node, hidden))
        pending.extend((c, hidden) for c in node.children if isinstance(c, Node))
    gone = set()
    for node, hidden in reversed(order):
        node.children = [c for c in node.children if (not hidden if isinstance(c, str) else id(c) not in gone)]
        if hidden and not node.children:
            gone.add(id(node))


def _drawn(node: Node) -> list[Node | str]:
    """The texts of a drawing, and the pages it embeds, each set off by blanks."""
    found, pending = [], [*reversed(node.children)]
    while pending:
        child = pending.pop()
        if isinstance(child, str) or child.name in UNDRAWN or not visible(child):
            continue
        if child.attributes.get("display", "").strip().lower() == "none":
            continue
        if child.name in ("text", "foreignobject"):
            shown = Node(child.name, {})
            shown.children = [c for c in child.children if isinstance(c, str) or c.name not in UNDRAWN]
            found += [" ", shown, " "]
        else:
            pending.extend(reversed(child.children))
    return found


def visible(node: Node) -> bool:
    if node.name in HIDDEN:
        return False
    a = node.attributes
    if not a:
        return True
    if "hidden" in a or (node.name == "input" and a.get("type", "").lower() == "hidden"):
        return False
    if node.name == "dialog" and "open" not in a:
        return False
    return not _HIDDEN_STYLE.search(a.get("style", ""))


def width(text: str) -> int:
    """Columns that a line of text takes: wide characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Rendered lines under construction."""

    def __init__(self):
        self.done: list[str] = []
        self.pieces: list[str] = []
        self.blank_wanted = False
        self.space = False
        self.preformatted = 0

    def text(self, text: str) -> None:
        if self.preformatted:
            first, *more = text.expandtabs(8).replace("\r\n", "\n").split("\n")
            self._add(first)
            for line in more:
                self._flush(keep_empty=True)
                self._add(line)
            return
        flat = _BLANKS.sub(" ", text)
        if flat == " ":
            self.space = True
            return
        if flat.startswith(" "):
            self.space = True
        body = flat.strip(" ")
        if body:
            self._add((" " if self.space and self.pieces else "") + body)
            self.space = flat.endswith(" ")

    def _add(self, text: str) -> None:
        if text:
            if self.blank_wanted and self.done and self.done[-1] and not self.pieces:
                self.done.append("")
            self.blank_wanted = False
            self.pieces.append(text)

    def _flush(self, keep_empty: bool = False) -> None:
        if self.pieces or (keep_empty and self.done):
            self.done.append("".join(self.pieces).rstrip(" "))
        self.pieces, self.space = [], False

    def line_break(self) -> None:
        self._flush(keep_empty=bool(self.pieces))

    def block(self, spaced: bool) -> None:
        self._flush()
        self.blank_wanted = self.blank_wanted or spaced

    def insert(self, lines: list[str], first: str = "", other: str = "") -> None:
        """Finished lines, the first and the others behind a prefix each."""
        self._flush()
        for i, line in enumerate(lines):
            if line or first:
                self._add(((first if i == 0 else other) + line).rstrip(" ") or " ")
                self._flush()
            elif self.done:
                self.done.append("")

    def finish(self) -> list[str]:
        self._flush()
        while self.done and not self.done[-1]:
            self.done.pop()
        return self.done


def _rendered(node: Node, depth: int) -> list[str]:
    lines = Lines()
    _children(node, lines, depth)
    return lines.finish()


def _children(node: Node, lines: Lines, depth: int) -> None:
    """Walks without recursion except into lists, quotes and tables, whose nesting is bounded below."""
    stack: list = [iter(node.children)]
    ends: list = [None]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            leaving = ends.pop()
            if leaving is not None:
                if leaving.name == "pre":
                    lines.preformatted -= 1
                if leaving.name in BLOCK:
                    lines.block(leaving.name in SPACED)
            continue
        if isinstance(child, str):
            lines.text(child)
            continue
        if not visible(child):
            continue
        name = child.name
        if name == "br":
            lines.line_break()
        elif name == "hr":
            lines.block(False)
            lines.insert(["---"])
        elif name == "img":
            if alt := child.attributes.get("alt", "").strip():
                lines.text(alt)
        elif name == "input":
            if child.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                lines.text(child.attributes.get("value", ""))
        elif name in ("ul", "ol", "menu") and depth < DEPTH:
            lines.block(depth == 0)
            _list(child, lines, depth + 1)
            lines.block(depth == 0)
        elif name == "blockquote" and depth < DEPTH:
            lines.block(True)
            lines.insert(_rendered(child, depth + 1), "  ", "  ")
            lines.block(True)
        elif name == "dd" and depth < DEPTH:
            lines.block(False)
            lines.insert(_rendered(child, depth + 1), "  ", "  ")
        elif name == "table" and depth < DEPTH:
            lines.block(True)
            _table(child, lines, depth + 1)
            lines.block(True)
        else:
            if name in BLOCK:
                lines.block(name in SPACED)
            if name == "pre":
                lines.preformatted += 1
            shown = child.children
            if name == "svg":
                shown = _drawn(child)
            elif name == "details" and "open" not in child.attributes:
                shown = [c for c in shown if isinstance(c, Node) and c.name == "summary"][:1]
            stack.append(iter(shown))
            ends.append(child)


def _number(node: Node, attribute: str, default: int) -> int:
    value = node.attributes.get(attribute, "").strip()
    return int(value) if re.fullmatch(r"-?\d{1,9}", value) else default


def _list(node: Node, lines: Lines, depth: int) -> None:
    number = _number(node, "start", 1)
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                lines.text(child)
            continue
        if not visible(child):
            continue
        if child.name == "li":
            number = _number(child, "value", number)
            mark = f"{number}. " if node.name == "ol" else "- "
            number += 1
            lines.insert(_rendered(child, depth) or [""], mark, " " * len(mark))
        else:
            holder = Node("div", {})
            holder.children = [child]
            lines.insert(_rendered(holder, depth), "  ", "  ")


def _row_groups(node: Node) -> Iterator[list[Node]]:
    """Rows of the table itself, nested tables left out; each of its sections is a group."""
    own: list[Node] = []
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.name in ("thead", "tbody", "tfoot"):
                yield own
                yield from _row_groups(child)
                own = []
            elif child.name == "tr":
                own.append(child)
    yield own


def _loose(node: Node) -> Iterator[Node | str]:
    """What lies in the table or its sections outside all rows; a browser shows it before the table."""
    for child in node.children:
        if isinstance(child, str) or child.name not in ("thead", "tbody", "tfoot", "colgroup", "tr", "col"):
            yield child
        elif child.name not in ("tr", "col") and visible(child):
            yield from _loose(child)


def _span(node: Node) -> int:
    value = node.attributes.get("colspan", "1").strip()
    return min(1000, max(1, int(value))) if re.fullmatch(r"\d{1,4}", value) else 1


def _row_span(node: Node, rows_left: int) -> int:
    """Rows that a cell reaches over, its own included; 0 is all the rows left of its group."""
    value = node.attributes.get("rowspan", "1").strip()
    return min(rows_left, int(value) or rows_left) if re.fullmatch(r"\d{1,5}", value) else 1


def _cells(rows: list[Node], depth: int) -> Iterator[list[tuple[int, int, list[str]]]]:
    """The cells of each row of a group: column, columns taken, and lines.

    A cell that reaches over several rows takes its columns in all of them.
    """
    held: list[tuple[int, int, int]] = []  # First column, the one after the last, rows still taken; in order.
    for i, row in enumerate(rows):
        cells, column, begun, next_held = [], 0, [], 0
        for cell in row.children:
            if isinstance(cell, str):
                if not cell.strip():
                    continue
                holder = Node("td", {})
                holder.children = [cell]
                cell = holder
            if not visible(cell):
                continue
            body = _rendered(cell, depth)
            # Only cells take a column when they are empty.
            if not body and cell.name not in ("td", "th"):
                continue
            while next_held < len(held) and held[next_held][0] <= column:
                column = max(column, held[next_held][1])
                next_held += 1
            span, down = _span(cell), _row_span(cell, len(rows) - i)
            cells.append((column, span, body))
            if down > 1:
                begun.append((column, column + span, down))
            column += span
        held = sorted((first, after, left - 1) for first, after, left in [*held, *begun] if left > 1)
        yield cells


def _table(node: Node, lines: Lines, depth: int) -> None:
    loose = Node("div", {})
    loose.children = list(_loose(node))
    before = _rendered(loose, depth)
    if before:
        lines.insert(before)
    grid = [
        cells for rows in _row_groups(node) for cells in _cells(rows, depth) if any(body for _, _, body in cells)
    ]
    widths: dict[int, int] = {}
    for cells in grid:
        # The last cell of a row and cells over several columns don't widen a column.
        for column, span, body in cells[:-1]:
            if span == 1:
                widths[column] = max([widths.get(column, 0), *map(width, body)])
    starts, at = {}, 0
    for column in range(max((c for cells in grid for c, _, _ in cells), default=-1) + 1):
        starts[column] = at
        at += widths.get(column, 0) + (2 if widths.get(column) else 0)
    for cells in grid:
        for i in range(max(len(body) for _, _, body in cells)):
            line = ""
            for column, _, body in cells:
                if i < len(body) and body[i]:
                    gap = starts[column] - width(line)
                    line += " " * (gap if gap > 0 else 2 if line else 0) + body[i]
            lines.insert([line])


def extract(page: str | None) -> str | None:
    """The page's visible text; null stays null, markup without text gives an empty text."""
    if page is None:
        return None
    return "\n".join(_rendered(parse(page), 0))


@F.pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    return pd.Series([extract(p if isinstance(p, str) else None) for p in pages], dtype=object)


def extract_text(df: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``df`` with the visible text of each page in ``into``.

    Whole pages are read.  Null pages give null, pages without visible text an empty text;
    a column of ``df`` named like ``into`` is replaced.
    """
    return df.withColumn(into, visible_text(F.col(html_col)))
