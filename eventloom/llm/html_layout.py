"""All visible text of an HTML page, laid out as the page shows it.

A tokeniser feeds a tree builder that keeps the stack of open elements, adds the tags a page may leave out and
closes what a new tag ends. A renderer follows the builder: blocks start lines, margins become one blank line,
list items get markers and indentation, table cells are aligned in columns, and preformatted text stays as it
is. What the page does not show (by element, attribute, inline style or a simple style sheet rule) gives no text.

Both work along the page without recursion, so nesting may be as deep as it likes.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from bisect import bisect_left
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import with_struct
from eventloom.llm.visibility import Styles

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # comment
    r"|<[!?][^>]*+>?|</[^a-zA-Z][^>]*+>?"  # doctype and what counts as a comment
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_BLANK = re.compile(r"[ \t\n\r\f]+")


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style xmp iframe noembed noframes noscript textarea title")
UNSEEN = _set("head script style template title noscript noembed noframes iframe object video audio canvas datalist svg math rp")
MARGIN = _set("p h1 h2 h3 h4 h5 h6 ul ol dl dir menu blockquote pre xmp listing plaintext table figure hr")
BLOCK = MARGIN | _set("html body div section article header footer nav main aside address li dt dd form fieldset legend details"
                      " summary figcaption center caption search hgroup dialog optgroup option select textarea")
LISTS = _set("ul ol dir menu")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
# Start tags that end an open paragraph.
ENDS_P = _set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header"
              " hgroup hr main menu nav ol p pre listing xmp plaintext search section summary table ul li dd dt") | HEADINGS
INLINE = _set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike"
              " strong sub sup time tt u var ruby rt rb")
SECTIONS = _set("thead tbody tfoot")
# End tags do not reach beyond these.
SCOPE = _set("html table td th caption template object")
INDENT = {"blockquote": "    ", "dd": "    "}


class _Flow:
    """Lines of running text."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the current line
        self.indents: list[str] = []
        self.marker: str | None = None
        self.gap = False
        self.pre = 0

    def text(self, text: str) -> None:
        if self.pre:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.parts.append(first)
            for part in rest:
                self.end_line()
                self.parts.append(part)
            return
        text = _BLANK.sub(" ", text)
        if text[:1] == " " and (not self.parts or self.parts[-1][-1:] == " "):
            text = text[1:]
        if text:
            self.parts.append(text)

    def end_line(self) -> None:
        """Ends the line, also an empty one."""
        line = "".join(self.parts)
        if not self.pre:
            line = line.rstrip(" ")
        self.parts = []
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        head = "".join(self.indents)
        if self.marker is not None:
            head, self.marker = "".join(self.indents[:-1]) + self.marker, None
        self.lines.append(head + line if line else head.rstrip(" "))

    def block(self, margin: bool = False) -> None:
        """A block starts or ends here."""
        if any(map(str.strip, self.parts)) or self.pre and any(self.parts):
            self.end_line()
        self.parts = []
        # A gap comes before an item's marker, not between the marker and its text.
        self.gap = self.gap or margin and bool(self.lines) and self.marker is None

    def add(self, lines: list[str]) -> None:
        self.block()
        pre, self.pre = self.pre, 1
        for line in lines:
            self.parts.append(line)
            self.end_line()
        self.pre = pre

    def close(self) -> list[str]:
        self.block()
        if self.marker is not None:
            self.end_line()
        return self.lines


class _Table:
    """Cells as lists of lines, by row; placed in columns when the table ends."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.captions: list[str] = []

    def lines(self) -> list[str]:
        taken: dict[int, int] = {}  # column: rows that a cell above still covers
        placed: list[list[tuple[int, int, list[str]]]] = []
        for row in self.rows:
            at, own, below = 0, [], {}
            for lines, columns, rows in row:
                while taken.get(at):
                    at += 1
                own.append((at, columns, lines))
                below.update(dict.fromkeys(range(at, at + columns), rows - 1))
                at += columns
            taken = {c: n - 1 for c, n in taken.items() if n > 1} | {c: n for c, n in below.items() if n}
            placed.append(own)
        widths: dict[int, int] = {}
        for own in placed:
            for at, spanned, lines in own:
                if spanned == 1:
                    widths[at] = max(widths.get(at, 0), *map(width, lines), 0)
        columns = sorted(widths)
        before = [0, *itertools.accumulate(widths[c] + 2 for c in columns)]
        out = list(self.captions)
        for own in placed:
            height = max((len(lines) for _, _, lines in own), default=0)
            offsets = [before[bisect_left(columns, at)] for at, _, _ in own]
            for k in range(height):
                line = ""
                for offset, (_, _, lines) in zip(offsets, own, strict=True):
                    if k < len(lines) and lines[k]:
                        # A wide spanning cell may have run past its place.
                        line += " " * max(offset - width(line), 2 if line else 0) + lines[k]
                out.append(line)
        return out


def width(text: str) -> int:
    """Columns on a terminal: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Element:
    """An open element: whether it is shown (and its text seen), the number of its last list item, whether
    it hides all but its summary, and whether it has indented the flow."""

    __slots__ = ("folded", "indented", "item", "marks", "name", "seen", "shown")

    def __init__(self, name: str, shown: bool, seen: bool, marks: frozenset[str] = frozenset()):
        self.name, self.shown, self.seen, self.marks = name, shown, seen, marks
        self.item, self.folded, self.indented = 0, False, False


class Page:
    """The builder and the renderer of one page."""

    def __init__(self):
        self.stack: list[_Element] = [_Element("html", True, True)]
        self.open: dict[str, int] = {"html": 1}
        self.flows: list[_Flow] = [_Flow()]
        self.tables: list[_Table] = []
        self.spans: list[tuple[int, int]] = []
        self.styles = Styles()

    # The builder.

    def feed(self, html: str) -> str:
        at = 0
        while found := _TOKEN.search(html, at):
            if found.start() > at:
                self.text(unescape(html[at:found.start()]))
            at, name = found.end(), found[2]
            if not name:
                continue
            name = name.lower()
            if found[1]:
                self.end(name)
                continue
            self.start(name, found[3])
            if name == "plaintext":
                self.text(html[at:])
                at = len(html)
            elif name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])|\Z", re.I).search(html, at)
                self.raw(name, html[at:close.start()])
                at = close.start()
        if at < len(html):
            self.text(unescape(html[at:]))
        while len(self.stack) > 1:
            self.pop()
        lines = self.flows[0].close()
        while lines and not lines[-1]:
            lines.pop()
        return "\n".join(lines)

    def raw(self, name: str, text: str) -> None:
        if name == "style":
            self.styles.add(text)
        elif self.stack[-1].shown:
            self.text(unescape(text) if name in ("textarea", "title") else text)

    def in_scope(self, names: frozenset[str] | tuple[str, ...], stops: frozenset[str] = SCOPE) -> bool:
        if not any(self.open.get(n) for n in names):
            return False
        for element in reversed(self.stack):
            if element.name in names:
                return True
            if element.name in stops:
                return False
        return False

    def pop_to(self, names: frozenset[str] | tuple[str, ...]) -> None:
        while len(self.stack) > 1 and self.pop() not in names:
            pass

    def clear_to(self, names: tuple[str, ...]) -> None:
        while self.stack[-1].name not in names and len(self.stack) > 1:
            self.pop()

    def start(self, name: str, attributes: str) -> None:
        if name == "image":
            name = "img"
        if name in ("html", "body", "frameset"):
            if self.in_scope(("head",)):
                self.pop_to(("head",))
            return
        if self.open.get("head") and name not in UNSEEN and name not in ("base", "link", "meta"):
            self.pop_to(("head",))
        if name in ENDS_P and self.in_scope(("p",)):
            self.pop_to(("p",))
        if name in HEADINGS and self.stack[-1].name in HEADINGS:
            self.pop()
        elif name == "li" and self.in_scope(("li",), SCOPE | LISTS):
            self.pop_to(("li",))
        elif name in ("dd", "dt") and self.in_scope(("dd", "dt"), SCOPE | {"dl"}):
            self.pop_to(("dd", "dt"))
        elif name == "option" and self.stack[-1].name == "option" or name == "optgroup" and self.stack[-1].name in ("option", "optgroup"):
            self.pop()
        elif name in ("a", "button") and self.in_scope((name,)):
            self.pop_to((name,))
        elif name in ("td", "th", "tr", "caption", "col", "colgroup") or name in SECTIONS:
            if not self.in_scope(("table",), frozenset(("html", "template", "object"))):
                return
            self.clear_to({"td": ("tr", *SECTIONS, "table"), "th": ("tr", *SECTIONS, "table"), "tr": (*SECTIONS, "table")}
                          .get(name, ("table",)))
            if name in ("td", "th", "tr") and self.stack[-1].name == "table":
                self.push("tbody", "")
            if name in ("td", "th") and self.stack[-1].name != "tr":
                self.push("tr", "")
        elif name == "table" and self.stack[-1].name in (*SECTIONS, "tr", "table"):
            self.pop_to(("table",))
        self.push(name, attributes)
        if name in VOID:
            self.pop()

    def end(self, name: str) -> None:
        if name in ("html", "body") or name in VOID and name != "br":
            return
        if name == "br":
            self.start("br", "")
        elif name == "p" and not self.in_scope(("p",)):
            self.start("p", "")
            self.pop()
        elif name in HEADINGS:
            if self.in_scope(HEADINGS):
                self.pop_to(HEADINGS)
        elif name in ("table", "tr", "td", "th", "caption") or name in SECTIONS:
            stops = {"html", "template", "object"} if name == "table" else {"html", "template", "object", "table"}
            if self.in_scope((name,), frozenset(stops)):
                self.pop_to((name,))
        elif self.in_scope((name,), SCOPE | BLOCK - {name} if name in INLINE else SCOPE - {name}):
            self.pop_to((name,))

    # The renderer.

    def push(self, name: str, attributes: str) -> None:
        above = self.stack[-1]
        given = {}
        if "=" in attributes or attributes.strip(" \t\n\r\f/"):
            for key, *values in _ATTRIBUTE.findall(attributes):
                given.setdefault(key.lower(), "".join(values))
        shown, seen = above.shown, above.seen
        marks = frozenset(("." + c for c in given.get("class", "").split()))
        if given.get("id"):
            marks |= {"#" + given["id"]}
        if shown:
            shown, seen = self.visible(name, given, above, marks)
        element = _Element(name, shown, seen, marks)
        self.stack.append(element)
        self.open[name] = self.open.get(name, 0) + 1
        if not shown:
            return
        flow = self.flows[-1]
        if name == "br":
            flow.end_line()
        elif name == "table":
            self.tables.append(_Table())  # what is between its parts still goes to the line before it
        elif name == "tr":
            self.tables[-1].rows.append([])
        elif name in ("td", "th", "caption"):
            self.flows.append(_Flow())
            self.spans.append((_number(given.get("colspan"), 1, 1000), _number(given.get("rowspan"), 1, 65534)))
        elif name in BLOCK:
            nested = name in LISTS and any(self.open.get(x) for x in LISTS - {name}) or name in LISTS and self.open[name] > 1
            flow.block(name in MARGIN and not nested)
            if name in ("pre", "xmp", "listing", "plaintext", "textarea"):
                flow.pre += 1
            elif name == "details":
                element.folded = "open" not in given
            elif name == "ol":
                element.item = _number(given.get("start"), 1, 1 << 31) - 1
            elif name == "li":
                self.item(flow, element, given)
            elif name in INDENT:
                flow.indents.append(INDENT[name])
                element.indented = True

    def item(self, flow: _Flow, element: _Element, given: dict[str, str]) -> None:
        owner = next((e for e in reversed(self.stack[:-1]) if e.name in LISTS), None)
        marker = "- "
        if owner is not None and owner.name == "ol":
            owner.item = _number(given.get("value"), owner.item + 1, 1 << 31)
            marker = f"{owner.item}. "
        if flow.marker is not None:  # an item that starts with a list
            flow.end_line()
        flow.marker = marker
        flow.indents.append(" " * len(marker))
        element.indented = True

    def visible(self, name: str, given: dict[str, str], above: _Element, marks: frozenset[str]) -> tuple[bool, bool]:
        """Whether an element of a shown one is shown, and whether its text is seen."""
        seen = above.seen
        if name in UNSEEN or name == "input" and given.get("type", "").lower() == "hidden":
            return False, seen
        if above.folded and name != "summary":
            return False, seen
        display, visibility = self.styles.of(name, marks, self.stack, given.get("style", ""))
        if display is None and ("hidden" in given and given["hidden"] != "until-found" or name == "dialog" and "open" not in given):
            display = "none"
        if visibility is not None:
            seen = visibility not in ("hidden", "collapse")
        return display != "none", seen

    def text(self, text: str) -> None:
        top = self.stack[-1]
        if top.name in ("html", "head") and not _BLANK.sub("", text):
            return
        if top.name == "head":
            self.pop()
            top = self.stack[-1]
        if not top.shown or not top.seen or top.folded:
            return
        # Text between the parts of a table comes before it; its white space is nothing.
        if top.name in ("table", "tr", "colgroup") or top.name in SECTIONS:
            if not (text := _BLANK.sub(" ", text).strip()):
                return
        self.flows[-1].text(text)

    def pop(self) -> str:
        element = self.stack.pop()
        name = element.name
        self.open[name] -= 1
        if not element.shown:
            return name
        flow = self.flows[-1]
        if name in ("td", "th", "caption"):
            lines = self.flows.pop().close()
            columns, rows = self.spans.pop()
            if name == "caption":
                self.tables[-1].captions += lines
            else:
                self.tables[-1].rows[-1].append((lines, columns, rows))
        elif name == "table":
            flow.block(True)
            flow.add(self.tables.pop().lines())
            flow.block(True)
        elif name in BLOCK:
            flow.block(False)
            if name == "li" and flow.marker is not None:
                flow.end_line()  # an empty item
            if element.indented:
                flow.indents.pop()
            if name in ("pre", "xmp", "listing", "plaintext", "textarea"):
                flow.pre -= 1
            if name in MARGIN and not (name in LISTS and any(self.open.get(x) for x in LISTS)):
                flow.block(True)
        return name


def _number(text: str | None, default: int, most: int) -> int:
    if text is None or not (m := re.match(r"\s*(-?\d{1,9})", text)):
        return default
    return min(max(int(m[1]), 1 if default == 1 and most <= 65534 else -most), most)


def render(html: str | None) -> str | None:
    return None if html is None else Page().feed(html)


def visible_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Adds the page's visible text, whole, as a column; one of the same name gives way.

    Lines end in a line feed; blocks that have margins are parted by one blank line; list items begin with
    ``- `` or their number; cells of a table row stand in columns, two spaces apart at least. A null page has
    a null text, an empty page and one that shows nothing an empty one. Broken markup is repaired as browsers
    do it, except that formatting is not carried on into the next block. Style sheets hide what they hide on a
    screen (see ``visibility``). Rows are read one by one, so ties and repeated rows change nothing; a page of any
    length is rendered whole, an empty table gives no rows.
    """

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([render(p) for p in pages], dtype=object)

    return with_struct(pages, F.struct(run(F.col(html)).alias(text)), [text])
