"""Layout-aware text of web pages.

A page is read tag by tag into a stack of open elements with the tags that HTML implies (a paragraph ends before a block, an
item before the next item, a cell before the next cell, a cell without row opens one). Whatever a browser shows is emitted:
blocks on lines of their own, blank lines around paragraphs, markers and indentation for lists, and table cells in aligned
columns. Closed dialogs, and closed details but for their summary, are not shown. The work per page is a loop over its tags, without
recursion; open elements are found by name, so it grows with the length of a page and not with its depth. A page is held by one
task, with its text, a few times over."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import prepare, with_results

# Names of elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
INVISIBLE = frozenset(
    "head script style title template noscript iframe noembed noframes datalist object audio video canvas".split())
# Elements inside svg and math: those never shown, those that hold HTML, and the HTML tags that end the drawing or formula.
UNDRAWN = frozenset(
    "title desc metadata defs symbol style script clippath mask pattern marker lineargradient radialgradient filter annotation"
    " annotation-xml".split())
HOLDS_HTML = frozenset("\0foreignobject \0desc \0title \0mi \0mo \0mn \0ms \0mtext \0annotation-xml".split(" "))
LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre"
    " ruby s small span strong strike sub sup table tt u ul var".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset listing".split())
LINES = frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend li"
    " main nav optgroup option search section summary".split())
BLOCKS = PARAGRAPHS | LINES
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
# An open element of the first set ends before a start tag; the search for it stops at one of the second set.
ENDS_BEFORE = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir table td th caption".split())),
    "dt": (frozenset(("dt", "dd")), frozenset("dl table td th caption".split())),
    "dd": (frozenset(("dt", "dd")), frozenset("dl table td th caption".split())),
    "option": (frozenset(("option",)), frozenset("select datalist table td th".split())),
    "optgroup": (frozenset(("option", "optgroup")), frozenset("select table td th".split())),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(("table", "template"))),
    "td": (frozenset("td th caption colgroup".split()), frozenset(("tr", "table", "template"))),
    "th": (frozenset("td th caption colgroup".split()), frozenset(("tr", "table", "template"))),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(("table", "template"))),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(("table", "template"))),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(("table", "template"))),
}
PARAGRAPH_SCOPE = frozenset("table td th caption button object template".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())

# The largest colspan and rowspan, and the largest number of a list item.
MOST_ACROSS, MOST_DOWN, LARGEST_NUMBER = 1000, 65534, (1 << 31) - 1
# Spaces that aligning one table may take, in characters: against pages that are made to fill a task's memory. Beyond it the
# widest columns are left as they are.
MOST_PADDING = 16 << 20

_TOKEN = re.compile(
    r"<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)", re.DOTALL)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_ATTRIBUTE = re.compile(r"[\s/]*+(=?[^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]*+)))?", re.DOTALL)
_MATTERS = re.compile(r"hidden|style|span|start|open|/\s*\Z", re.IGNORECASE)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_DECLARATION = re.compile(r"(?:[^;\"'(]|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|\([^)]*+(?:\)|\Z))++")
_NUMBER = re.compile(r"\s*+([+-]?)(\d+)")


def attributes_of(source: str) -> tuple[dict[str, str], bool]:
    """Values by lower-case name, of several with one name the first, and whether a `/` ends the tag. None are looked for in
    tags where no attribute matters."""
    if not source or not _MATTERS.search(source):
        return {}, False
    found, closed = {}, source.endswith("/")
    for match in _ATTRIBUTE.finditer(source):
        if match[1]:
            found.setdefault(match[1].lower(), html.unescape(match[2] or match[3] or match[4] or ""))
            if match[4] and match.end() == len(source):
                closed = False  # the slash belongs to the value
    return found, closed


def style_of(style: str) -> dict[str, str]:
    """The declarations of a style attribute that decide what is shown; the last counts, or the last that is important."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _DECLARATION.findall(_COMMENT.sub(" ", style)):
        name, _, value = declaration.partition(":")
        value, _, mark = value.lower().partition("!")
        name, value, mark = name.strip().lower(), value.strip(), mark.strip()
        if name in ("display", "visibility") and value and mark in ("", "important"):
            if bool(mark) >= found.get(name, (False, ""))[0]:
                found[name] = (bool(mark), value)
    return {name: value for name, (_, value) in found.items()}


def _number(attributes: dict[str, str], name: str, otherwise: int) -> int:
    found = _NUMBER.match(attributes.get(name, ""))
    return int(found[1] + (found[2].lstrip("0")[:19] or "0")) if found else otherwise


class Flow:
    """Lines of one block context: the page, or a table cell."""

    __slots__ = ("lines", "line", "gap", "space", "marker")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space, self.marker = 0, False, ""

    def text(self, text: str, indent: int) -> None:
        text = _SPACE.sub(" ", text)
        if text == " " or not text:
            self.space = self.space or text == " " and bool(self.line)
            return
        if not self.line:
            self._begin(indent)
            text = text.removeprefix(" ")
        elif self.space and text[0] != " ":
            self.line.append(" ")
        elif not self.space and text[0] == " ":
            self.line.append(" ")
            text = text[1:]
        elif self.space:
            self.line.append(" ")
            text = text[1:]
        self.space = text.endswith(" ")
        self.line.append(text.removesuffix(" "))

    def _begin(self, indent: int) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        if self.marker:
            self.line.append(" " * (indent - len(self.marker)) + self.marker)
            self.marker = ""
        elif indent:
            self.line.append(" " * indent)

    def part(self) -> None:
        """What follows stands apart on the same line."""
        self.space = self.space or bool(self.line)

    def raw(self, text: str, indent: int) -> None:
        """Text whose spaces and line breaks count."""
        for i, part in enumerate(re.split(r"\r\n?|\n", text)):
            if i:
                self.end_line(always=True)
            if part:
                if not self.line:
                    self._begin(indent)
                self.line.append(part)

    def end_line(self, always: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line))
        elif always and self.lines:
            self.lines.append("")
        self.line, self.space = [], False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def add_lines(self, lines: list[str], indent: int) -> None:
        self.block(2)
        for line in lines:
            self._begin(indent)
            self.line.append(line)
            self.end_line(always=True)
        self.block(2)

    def finished(self) -> list[str]:
        self.end_line()
        if self.marker:
            self._begin(len(self.marker))
            self.end_line()
        return [line.rstrip(" ") for line in self.lines]


class Table:
    __slots__ = ("rows", "busy", "row_open")

    def __init__(self):
        self.rows: list[dict[int, list[str]]] = []
        self.busy: dict[int, int] = {}  # column -> rows from here on that a cell above still covers
        self.row_open = False

    def new_row(self) -> None:
        self.busy = {column: left - 1 for column, left in self.busy.items() if left > 1}
        self.rows.append({})

    def add(self, lines: list[str], across: int, down: int) -> None:
        row, column = self.rows[-1], 0
        while column in row or column in self.busy:
            column += 1
        row[column] = lines
        for i in range(column, column + across):
            row.setdefault(i, [])
            if down > 1:
                self.busy[i] = down

    def rendered(self) -> list[str]:
        rows = [row for row in self.rows if any(row.values())]
        columns = sorted({c for row in rows for c, lines in row.items() if lines})
        width = {c: max((len(line) for row in rows for line in row.get(c, ())), default=0) for c in columns}
        many = sum(max(map(len, row.values()), default=0) for row in rows)
        for c in sorted(columns, key=lambda c: -width[c]):
            if many * sum(width.values()) <= MOST_PADDING:
                break
            width[c] = 0
        found = []
        for row in rows:
            for parts in zip_longest(*(row.get(c, []) for c in columns), fillvalue=""):
                last = max((i for i, part in enumerate(parts) if part), default=-1) + 1
                cells = [part.ljust(width[c]) for c, part in zip(columns, parts[:last])]
                found.append(" | ".join(cells).rstrip(" "))
        return found


class Page:
    """The stack of open elements and what they have emitted."""

    def __init__(self):
        self.open: list[str] = []
        self.places: dict[str, list[int]] = {}  # by name, where its open elements stand
        self.folded: list[bool] = []   # closed details: nothing but the summary is shown
        self.hidden: list[bool] = []   # without any box, with all that is inside
        self.unseen: list[bool] = []   # invisible, but elements inside can be visible again
        self.silent: list[bool] = []   # in a drawing, outside its texts
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.lists: list[list] = []  # [next number or None for bullets, marker width]
        self.spans: list[tuple[int, int]] = []
        self.indents = [0]
        self.preformatted = 0
        self.summaries: dict[int, bool] = {}  # places of open details that have their summary

    # -- start and end of elements

    def start(self, tag: str, source: str) -> bool:
        """Whether what follows is inside the element."""
        attributes, closed = attributes_of(source)
        if self._is_foreign():
            if tag not in LEAVES:
                self.push("\0" + tag, tag in UNDRAWN, attributes)
                if closed:
                    self.pop()
                return not closed
            self._leave_foreign()
        if self.open and self.open[-1] == "head" and tag not in HEAD and tag != "head":
            self.pop()
        if tag in ENDS_BEFORE:
            ended, stop = ENDS_BEFORE[tag]
            self._end_innermost(ended, stop)
        if tag in BLOCKS:
            self._end_innermost(("p",), PARAGRAPH_SCOPE)
        in_table = bool(self.tables)
        if tag in CELLS and in_table and not self.tables[-1].row_open:
            self.push("tr", False)
        if (tag in CELLS or tag == "tr" or tag in SECTIONS or tag == "caption") and not in_table:
            return True  # table parts outside tables are no elements
        if tag == "br":
            if not self._is_hidden():
                self.flows[-1].end_line(always=True)
        elif tag in VOID:
            if tag in BLOCKS and not self._is_hidden():
                self.flows[-1].block(2)
        else:
            self.push(tag, tag in INVISIBLE, attributes)
            if closed and tag in ("svg", "math"):
                self.pop()
        return True

    def push(self, tag: str, hidden: bool, attributes: dict[str, str] | None = None) -> None:
        attributes = attributes or {}
        style = style_of(attributes["style"]) if "style" in attributes else {}
        display = style.get("display", "revert")
        hidden = hidden or self._is_hidden() or display == "none" or (
            "hidden" in attributes and display in ("revert", "revert-layer"))
        unseen = bool(self.unseen) and self.unseen[-1]
        visibility = style.get("visibility", "hidden" if tag == "\0mphantom" else "inherit")
        if visibility in ("hidden", "collapse", "visible", "initial"):
            unseen = visibility in ("hidden", "collapse")
        parent = len(self.open) - 1
        if parent >= 0 and self.folded[parent] and (tag != "summary" or self.summaries.get(parent)):
            hidden = True
        if parent >= 0 and tag == "summary" and self.open[parent] == "details":
            self.summaries[parent] = True
        if tag == "dialog" and "open" not in attributes and display in ("revert", "revert-layer"):
            hidden = True
        silent = tag == "svg" or bool(self.silent) and self.silent[-1] and tag not in ("\0text", "\0foreignobject", "math")
        self.places.setdefault(tag, []).append(len(self.open))
        self.folded.append(tag == "details" and "open" not in attributes)
        self.open.append(tag)
        self.hidden.append(hidden)
        self.unseen.append(unseen)
        self.silent.append(silent)
        if tag == "\0text" and not hidden:
            self.flows[-1].part()
        if tag in BLOCKS and not hidden:
            nested = tag in ("ul", "ol", "menu") and bool(self.lists)
            self.flows[-1].block(2 if tag in PARAGRAPHS and not nested else 1)
        if tag == "table":
            self.tables.append(Table())
        elif tag == "tr":
            self.tables[-1].row_open = True
            if not hidden:
                self.tables[-1].new_row()
        elif tag in CELLS:
            across = min(max(_number(attributes, "colspan", 1), 1), MOST_ACROSS)
            down = min(max(_number(attributes, "rowspan", 1), 1), MOST_DOWN)
            self.spans.append((across, down))
            self.flows.append(Flow())
            self.indents.append(0)
        elif tag in ("ul", "menu", "dir", "ol"):
            begin = _number(attributes, "start", 1)
            self.lists.append([(begin if abs(begin) <= LARGEST_NUMBER else 1) if tag == "ol" else None])
        elif tag == "li":
            number = self.lists[-1][0] if self.lists else None
            marker = "- " if number is None else f"{number}. "
            if number is not None and not hidden:
                self.lists[-1][0] += 1
            self.indents.append(self.indents[-1] + len(marker))
            if not hidden:
                self.flows[-1].marker = "" if unseen else marker
        elif tag in ("dd", "blockquote"):
            self.indents.append(self.indents[-1] + 2)
        elif tag in ("pre", "listing", "textarea"):
            self.preformatted += 1

    def pop(self) -> None:
        tag, hidden, _, _, _ = self.open.pop(), self.hidden.pop(), self.unseen.pop(), self.silent.pop(), self.folded.pop()
        self.places[tag].pop()
        self.summaries.pop(len(self.open), None)
        if tag == "\0text" and not hidden:
            self.flows[-1].part()
        if tag in BLOCKS and not hidden:
            nested = tag in ("ul", "ol", "menu") and len(self.lists) > 1
            self.flows[-1].block(2 if tag in PARAGRAPHS and not nested else 1)
        if tag == "table":
            table = self.tables.pop()
            if not hidden:
                self.flows[-1].add_lines(table.rendered(), self.indents[-1])
        elif tag == "tr":
            self.tables[-1].row_open = False
        elif tag in CELLS:
            self.indents.pop()
            lines, (across, down) = self.flows.pop().finished(), self.spans.pop()
            if not hidden:
                self.tables[-1].add(lines, across, down)
        elif tag in ("ul", "menu", "dir", "ol"):
            self.lists.pop()
        elif tag == "li":
            self.indents.pop()
            self.flows[-1].marker = ""
        elif tag in ("dd", "blockquote"):
            self.indents.pop()
        elif tag in ("pre", "listing", "textarea"):
            self.preformatted -= 1

    def end(self, tag: str) -> None:
        if tag in ("br", "p") and self._is_foreign():
            self._leave_foreign()
        if tag == "br":
            self.start("br", "")
            return
        if tag == "p" and not self.places.get("p"):
            if not self._is_hidden():
                self.flows[-1].block(2)
            return
        # An end tag reaches out of a cell or table only if it ends a part of that table.
        barrier = self._innermost(("table",) if tag in TABLE_PARTS else ("table", *CELLS))
        place = self._innermost((tag, "\0" + tag))
        if place >= max(barrier, 0):
            self._pop_to(place)

    def _innermost(self, names) -> int:
        """Where the innermost open element of these names stands; -1 if none is open."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def _pop_to(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def _end_innermost(self, tags, stop) -> None:
        """End the outermost element of several tags, or the innermost of one, that is inside the innermost one of `stop`."""
        limit = self._innermost(stop)
        inside = [places[bisect_right(places, limit) if len(tags) > 1 else -1]
                  for places in (self.places.get(tag) for tag in tags) if places and places[-1] > limit]
        if inside:
            self._pop_to(min(inside))

    # -- drawings and formulas: elements within them have names that begin with a zero byte

    def _is_foreign(self) -> bool:
        return bool(self.open) and (self.open[-1] in ("svg", "math") or self.open[-1][0] == "\0" and self.open[-1] not in HOLDS_HTML)

    def _leave_foreign(self) -> None:
        while self._is_foreign():
            self.pop()

    # -- text

    def _is_hidden(self) -> bool:
        return bool(self.hidden) and self.hidden[-1]

    def text(self, text: str) -> None:
        if self.open and self.open[-1] == "head" and not _SPACE.fullmatch(text):
            self.pop()
        if self._is_hidden() or self.open and (self.unseen[-1] or self.silent[-1] or self.folded[-1]):
            return
        if "&" in text:
            text = html.unescape(text)
        if self.preformatted:
            self.flows[-1].raw(text, self.indents[-1])
        else:
            self.flows[-1].text(text, self.indents[-1])

    def finished(self) -> str:
        while self.open:
            self.pop()
        return "\n".join(self.flows[0].finished()).strip("\n")


def page_text(source: str | None) -> str:
    """The visible text of a page. Null and empty pages have none; a `<` that begins no tag is text."""
    if not source:
        return ""
    page, at, match = Page(), 0, _TOKEN.search
    while found := match(source, at):
        if found.start() > at:
            page.text(source[at:found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            page.end(tag)
            continue
        inside = page.start(tag, found[3] or found[6] or "")
        if tag in RAW and inside and (tag in INVISIBLE or page.open[-1:] == [tag]):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
            end = close.start() if close else len(source)
            if end > at and tag == "textarea":
                page.text(source[at:end])
            page.end(tag)
            rest = source.find(">", end) + 1
            at = rest if close and rest else len(source)
    if at < len(source):
        page.text(source[at:])
    return page.finished()


def extract(pages: DataFrame, source: str, name: str = "text") -> DataFrame:
    """The rows of `pages` with the visible text of column `source` as `name`; empty for a null."""
    prepare(pages.sparkSession)

    @F.arrow_udf("string")
    def visible(column: pa.Array) -> pa.Array:
        return pa.array([page_text(value) for value in column.to_pylist()], pa.string())

    return with_results(pages, **{name: visible(F.col(f"`{source}`"))})
