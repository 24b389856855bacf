"""HTML extraction (operator 7): layout-aware rendering of all visible text.

A tree builder makes elements of the markup, with the end tags that HTML lets authors leave out, the
row that a cell implies, and text misplaced in a table moved before it.  Visibility rules hide what a
browser does not show.  The rest is laid out as plain text: blocks on lines of their own, with an
empty line where browsers leave a margin; list items with their marker and indented below it; tables
with cells in aligned columns, spans included; preformatted text as it stands; other white space
collapsed.  Nothing is recursive, so nesting may be of any depth.

Hidden: the head, scripts, styles, templates and the like; elements with ``hidden``, ``display:
none`` or (unless a descendant says otherwise) ``visibility: hidden``; closed ``dialog`` and, but for
their summary, closed ``details``; fallback content of media.  Formatting elements that a block
interrupts are not opened anew, since that does not change the text.

Defined results: null and empty pages give an empty text; pages of any length are read whole;
markup that never ends is read as far as it goes, and a tag that no ``>`` outside quotes ends goes to its
first ``>``, as if nothing were quoted; equal pages give equal texts; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from unicodedata import combining, east_asian_width

import pandas as pd
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--(?:(?!-?>).*?--!?>|.*?>|.*)"
    r"|<[!?][^>]*>?"
    r"|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNQUOTED = re.compile(r"[^>\"']*+")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


def _set(text: str) -> frozenset[str]:
    return frozenset(text.split())


_VOID = _set("area base br col embed frame hr img input link meta param source track wbr")
_RAW = _set("script style xmp iframe noembed noframes noscript")
_TEXT_ONLY = _set("textarea title")
_HIDDEN = _set(
    "head title script style template noscript iframe noembed noframes object audio video canvas svg math "
    "datalist area map param rp"
)
_MARGIN = _set("p h1 h2 h3 h4 h5 h6 blockquote ul ol menu dir dl pre table figure fieldset hr listing xmp")
_BLOCK = _MARGIN | _set(
    "html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li "
    "main nav optgroup option search section summary caption textarea"
)
_CLOSES_P = (_BLOCK | _set("hr")) - _set("html body option optgroup caption textarea legend")
_LISTS = _set("ul ol menu dir")
_SECTIONS = _set("thead tbody tfoot")
_IN_TABLE = _SECTIONS | _set("table tr")
_TABLE_PARTS = _SECTIONS | _set("tr td th caption colgroup col")
_BARRIER = _set("table td th caption button object template html")
#: The open elements that a start tag closes, up to the elements at which the search ends.
_CLOSES = {
    "li": (_set("li"), _LISTS | _BARRIER),
    "dt": (_set("dt dd"), _set("dl") | _BARRIER),
    "dd": (_set("dt dd"), _set("dl") | _BARRIER),
    "option": (_set("option"), _set("select datalist") | _BARRIER),
    "optgroup": (_set("option optgroup"), _set("select") | _BARRIER),
    "rt": (_set("rt rp"), _set("ruby") | _BARRIER),
    "rp": (_set("rt rp"), _set("ruby") | _BARRIER),
    "td": (_set("td th caption"), _set("tr table")),
    "th": (_set("td th caption"), _set("tr table")),
    "tr": (_set("td th tr caption"), _set("table")),
    **dict.fromkeys(("thead", "tbody", "tfoot", "caption"), (_set("td th tr thead tbody tfoot caption"), _set("table"))),
}


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes = tag, attributes or {}
        self.children: list[Element | str] = []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text) if text.strip(" /") else ():
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class _Builder:
    def __init__(self):
        self.root = Element("html")
        self.open = [self.root]

    def close_to(self, place: int) -> None:
        del self.open[max(1, place) :]

    def find(self, tags: frozenset[str], barrier: frozenset[str]) -> int:
        """Place of the outermost open element of ``tags`` inside the barrier; 0 if there is none."""
        found = 0
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in tags:
                found = place
            elif tag in barrier:
                break
        return found

    def place(self, child: Element | str) -> None:
        """Into the current element, or before the table that cannot hold it."""
        parent = self.open[-1]
        if parent.tag in _IN_TABLE and (isinstance(child, str) or child.tag not in _TABLE_PARTS):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == "table":
                    siblings = self.open[at - 1].children
                    table = max(i for i, c in enumerate(siblings) if c is self.open[at])
                    siblings.insert(table, child)
                    return
        parent.children.append(child)

    def text(self, text: str) -> None:
        if self.open[-1].tag not in _IN_TABLE or not text.isspace():
            self.place(text)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "frameset"):
            if tag == "body":
                self.open[1:] = [e for e in self.open[1:] if e.tag != "head"]
            return
        if tag in _CLOSES_P and (place := self.find(_set_p, _BARRIER)):
            self.close_to(place)
        if tag in _CLOSES and (place := self.find(*_CLOSES[tag])):
            self.close_to(place)
        if tag in _TABLE_PARTS:
            if tag in ("td", "th") and self.open[-1].tag in _SECTIONS | {"table"}:
                self.start("tr", "")
            elif not any(e.tag == "table" for e in self.open):
                return  # a part without its table is no element
        if tag not in ("head", "title", "meta", "link", "style", "script", "base", "noscript", "template"):
            if self.open[-1].tag == "head":
                self.close_to(len(self.open) - 1)  # the head ends where content begins
        element = Element(tag, _attributes(attributes))
        self.place(element)
        if tag not in _VOID:
            self.open.append(element)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.start("br", "")
            return
        barrier = _set_table if tag in _TABLE_PARTS else frozenset() if tag == "table" else _BARRIER - {tag}
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag == tag:
                self.close_to(place)
                return
            if self.open[place].tag in barrier:
                break
        if tag == "p":  # an end without a start is an empty paragraph
            self.place(Element("p"))


_set_p, _set_table = _set("p"), _set("table")


class _TagEnds:
    """Finds the ``>`` that ends a tag: the first one outside quotes, however long the quoted parts are.

    Tags come in their order.  Walks that find none are kept as the places where their quotes open and
    close.  A walk that is outside quotes where a former one was goes on like it, so it ends there: together they read a page a few times.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {quote: page.rfind(quote) for quote in "\"'"}
        self.endless: list[tuple[list[int], int]] = []

    def find(self, start: int) -> int:
        """The place of the ``>``, or -1."""
        page, at, quotes = self.page, start, []
        while not any(at < end and bisect_right(own, at) % 2 == 0 for own, end in self.endless):
            at = _UNQUOTED.match(page, at).end()
            if at < len(page) and page[at] == ">":
                return at
            if at >= len(page) or self.last[page[at]] == at:  # a quote that nothing closes
                quotes += [at] * (at < len(page))
                at = len(page) + 1
                break
            close = page.index(page[at], at + 1)
            quotes += [at, close + 1]
            at = close + 1
        self.endless.append((quotes, at))
        return -1


def tree_of(page: str) -> Element:
    """The elements of a page below its root."""
    builder, at, size = _Builder(), 0, len(page)
    ends = _TagEnds(page)
    while at < size:
        begin = page.find("<", at)
        match = None
        while begin >= 0 and (match := _TOKEN.match(page, begin)) is None:
            begin = page.find("<", begin + 1)  # a sign that starts no markup is text
        if begin < 0:
            builder.text(html.unescape(page[at:]))
            break
        if begin > at:
            builder.text(html.unescape(page[at:begin]))
        at = match.end()
        if match[1]:
            builder.end(match[1].lower())
            continue
        tag = (match[2] or "").lower()
        if not tag:
            continue
        stop = ends.find(at)
        stop = page.find(">", at) if stop < 0 else stop
        builder.start(tag, page[at:] if stop < 0 else page[at:stop])
        at = size if stop < 0 else stop + 1
        if tag in _RAW or tag in _TEXT_ONLY:
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            content = page[at : stop.start() if stop else size]
            builder.text(html.unescape(content) if tag in _TEXT_ONLY else content)
            at = stop.start() if stop else size
    return builder.root


# -- layout ---------------------------------------------------------------------------------------------


def width_of(text: str) -> int:
    """Columns a text takes; wide signs take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Flow:
    """Lines of a page or of a cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False  # white space before the next word
        self.gap = 0
        self.indents: list[str] = []
        self.markers: list[str] = []

    def words(self, text: str) -> None:
        for i, piece in enumerate(_BLANKS.split(text)):
            self.blank |= i > 0
            if piece:
                self.put((" " if self.blank and self.parts else "") + piece)
                self.blank = False

    def put(self, text: str) -> None:
        if not self.parts:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = 0
            indent = "".join(self.indents)
            if self.markers:  # markers stand at the end of the indents they belong to
                marks = "".join(self.markers)
                indent = indent[: len(indent) - len(marks)] + marks
                self.markers = []
            self.parts.append(indent)
        self.parts.append(text)

    def line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
        self.blank = False

    def broken(self) -> None:
        """A line break in running text; an empty line if there is no text before it."""
        if not self.parts and self.lines and not self.gap:
            self.gap = 1
        self.line()

    def block(self, margin: bool) -> None:
        self.line()
        self.gap = max(self.gap, int(margin))

    def verbatim(self, text: str) -> None:
        for i, piece in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                if not self.parts:
                    self.put("")
                self.line()
            if piece:
                self.put(piece.expandtabs(8))

    def item(self, marker: str) -> None:
        self.line()
        self.indents.append(" " * len(marker))
        self.markers.append(marker)

    def item_end(self) -> None:
        self.line()
        if self.markers:
            self.markers.pop()
        self.indents.pop()

    def text(self) -> list[str]:
        self.line()
        return self.lines


def _roman(number: int) -> str:
    found = ""
    for value, sign in zip(
        (1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split()
    ):
        found += sign * (number // value)
        number %= value
    return found


def _letters(number: int) -> str:
    found = ""
    while number:
        number, rest = divmod(number - 1, 26)
        found = chr(97 + rest) + found
    return found


def _whole(text: str | None, otherwise: int) -> int:
    match = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(match[1]) if match else otherwise


class _List:
    def __init__(self, element: Element):
        own = element.attributes
        self.ordered, self.kind = element.tag == "ol", own.get("type", "1")
        self.step = -1 if "reversed" in own else 1
        items = sum(1 for c in element.children if isinstance(c, Element) and c.tag == "li") if "reversed" in own else 1
        self.next = _whole(own.get("start"), items)

    def marker(self, item: Element) -> str:
        if not self.ordered:
            return "- "
        number = _whole(item.attributes.get("value"), self.next)
        self.next = number + self.step
        shown = str(number)
        if number > 0 and self.kind in "aAiI":
            shown = (_roman if self.kind in "iI" and number < 4000 else _letters)(number)
            shown = shown.upper() if self.kind in "AI" else shown
        return f"{shown}. "


class _Table:
    def __init__(self):
        self.caption: list[str] = []
        self.parts: dict[str, list[list]] = {"thead": [], "tbody": [], "tfoot": []}

    def row(self, section: str) -> None:
        self.parts[section].append([])

    def cell(self, section: str, element: Element, lines: list[str]) -> None:
        if not self.parts[section]:
            self.row(section)
        own = element.attributes
        across = min(1000, max(1, _whole(own.get("colspan"), 1)))
        down = max(0, _whole(own.get("rowspan"), 1))
        right = own.get("align", "").lower() == "right" or re.search(r"text-align\s*:\s*right", own.get("style", ""), re.I)
        self.parts[section][-1].append((lines, across, down, bool(right)))

    def lines(self) -> list[str]:
        placed, widths, rows = [], {}, 0
        for section in self.parts.values():
            taken: dict[tuple[int, int], bool] = {}
            for number, cells in enumerate(section):
                column = 0
                for lines, across, down, right in cells:
                    while taken.get((number, column)):
                        column += 1
                    for i in range(number, min(len(section), number + (down or len(section)))):
                        for j in range(column, column + across):
                            taken[i, j] = True
                    placed.append((rows + number, column, across, lines, right))
                    column += across
            rows += len(section)
        # A column is as wide as its widest cell; one that spans several widens the last of them.
        for _, column, across, lines, _ in sorted(placed, key=lambda c: c[2]):
            need = max(map(width_of, lines), default=0)
            have = sum(widths.get(j, 0) for j in range(column, column + across)) + 2 * (across - 1)
            last = column + across - 1
            widths[last] = widths.get(last, 0) + max(0, need - have)
        used = [j for j in range(max(widths, default=-1) + 1)]
        starts, at = {}, 0
        for j in used:  # a column without any text takes no room
            starts[j] = at
            at += widths.get(j, 0) + 2 * (widths.get(j, 0) > 0)
        by_row: dict[int, list] = {}
        for row, column, across, lines, right in placed:
            by_row.setdefault(row, []).append((starts[column], column, across, lines, right))
        found = list(self.caption)
        for row in range(rows):
            cells = by_row.get(row, [])
            for i in range(max((len(c[3]) for c in cells), default=0)):
                line, used_width = "", 0
                for start, column, across, lines, right in sorted(cells, key=lambda c: c[1]):
                    piece = lines[i] if i < len(lines) else ""
                    if not piece:
                        continue
                    if right:
                        room = sum(widths.get(j, 0) for j in range(column, column + across)) + 2 * (across - 1)
                        start += max(0, room - width_of(piece))
                    line += " " * (start - used_width) + piece
                    used_width = max(start, used_width) + width_of(piece)
                found.append(line.rstrip())
        return found


_DISPLAY_NONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


def _gone(element: Element, parent: Element) -> bool:
    own = element.attributes
    if element.tag in _HIDDEN or "hidden" in own or "style" in own and _DISPLAY_NONE.search(own["style"]):
        return True
    if element.tag == "dialog" and "open" not in own:
        return True
    return parent.tag == "details" and "open" not in parent.attributes and element.tag != "summary"


class _Layout:
    def __init__(self):
        self.flows = [_Flow()]
        self.lists: list[_List] = []
        self.tables: list[tuple[_Table, list[str]]] = []  # and the open section of each
        self.verbatim = 0

    def enter(self, element: Element) -> None:
        tag, flow = element.tag, self.flows[-1]
        if tag == "br":
            flow.broken()
        elif tag == "table":
            flow.block(True)
            self.tables.append((_Table(), ["tbody"]))
        elif tag in _SECTIONS and self.tables:
            self.tables[-1][1].append(tag)
        elif tag == "tr" and self.tables:
            self.tables[-1][0].row(self.tables[-1][1][-1])
        elif tag in ("td", "th", "caption") and self.tables:
            self.flows.append(_Flow())
        elif tag == "li":
            flow.item(self.lists[-1].marker(element) if self.lists else "- ")
        elif tag in _BLOCK:
            flow.block(tag in _MARGIN and not (tag in _LISTS and self.lists))
            if tag in _LISTS:
                self.lists.append(_List(element))
            elif tag in ("blockquote", "dd"):
                flow.indents.append("  ")
            elif tag in ("pre", "listing", "textarea", "xmp"):
                self.verbatim += 1

    def leave(self, element: Element) -> None:
        tag, flow = element.tag, self.flows[-1]
        if tag == "table":
            table, _ = self.tables.pop()
            for line in table.lines():
                flow.put(line)
                flow.line()
            flow.block(True)
        elif tag in _SECTIONS and self.tables:
            self.tables[-1][1].pop()
        elif tag in ("td", "th", "caption") and self.tables:
            lines = self.flows.pop().text()
            table, section = self.tables[-1]
            if tag == "caption":
                table.caption += lines
            else:
                table.cell(section[-1], element, lines)
        elif tag == "li":
            flow.item_end()
        elif tag in _BLOCK:
            if tag in ("blockquote", "dd"):
                flow.line()
                flow.indents.pop()
            elif tag in ("pre", "listing", "textarea", "xmp"):
                self.verbatim -= 1
            elif tag in _LISTS:
                self.lists.pop()
            flow.block(tag in _MARGIN and not (tag in _LISTS and self.lists))

    def text(self, text: str, first: bool) -> None:
        if self.verbatim:
            self.flows[-1].verbatim(text[1:] if first and text.startswith("\n") else text)
        else:
            self.flows[-1].words(text)


def text_of(page: str | None) -> str:
    """All visible text of a page, laid out."""
    if not page:
        return ""
    root, layout = tree_of(page.replace("\x00", "")), _Layout()
    stack: list[tuple[Element, Iterator, bool]] = [(root, iter(root.children), True)]
    while stack:
        parent, children, seen = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            layout.leave(parent)
        elif isinstance(child, str):
            if seen and not (parent.tag == "details" and "open" not in parent.attributes):
                layout.text(child, child is parent.children[0])
        elif not _gone(child, parent):
            if "style" in child.attributes and (says := _VISIBILITY.search(child.attributes["style"])):
                seen = says[1].lower() == "visible"
            layout.enter(child)
            stack.append((child, iter(child.children), seen))
    return "\n".join(layout.flows[0].text()).replace("\xa0", " ")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, n_chars, text`` of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_of(p) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "n_chars": [len(t) for t in texts], "text": texts})

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(pages[id_col].alias("page_id"), pages[html_col].alias("html"))
    return rows.mapInPandas(run, f"page_id {kind}, n_chars long, text string")
