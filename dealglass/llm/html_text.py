"""Visible text of HTML pages, laid out as a reader sees it.

A small tree builder reads tags, closes what HTML lets authors leave open
(paragraphs, list items, table cells and rows, options) and tells what is
visible: no scripts, styles, head, templates, comments, hidden attributes or
``display: none``. When an element is closed, its text becomes lines in its
parent, so a page is rendered in one pass without recursion:

* blocks stand on lines of their own, paragraphs and the like between blank lines;
* list items begin with "- " or their number and indent what they hold;
* the cells of a table stand in columns of equal width, " | " between them;
* preformatted text keeps its spaces and line breaks, ``br`` breaks a line;
* each ``text`` of a drawing (svg) stands on a line, parts of a formula (math) are
  joined by the signs / ^ _ where they stand above or below each other.

Attributes are read by the states of HTML: a quote opens a value only right after
"=", any other is part of a name or value; a quoted value without an end takes the
rest of the page, as in a browser.

Cells that span columns or rows take their place in the grid of the table: what follows
them stands under its own column.

All visible text is kept: navigation and footers too, and text of pages cut off
in the middle. Elements nested deeper than ``MAX_DEPTH`` add their text, blocks on
lines of their own, but no other layout; they are opened and closed like others, so what is
hidden stays so. A null page
gives null, a page without visible text an empty text. Rows, repeated ones included, and
their other columns pass through unchanged; ``visible_text`` replaces a column of that name.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DEPTH = 256  # of layout
MAX_COLUMNS, MAX_ROWS = 1000, 65534  # that a cell spans, as in HTML
Cell = tuple[list[str], int, int]  # lines, columns, rows
# Fixed values of HTML: elements by how they are laid out or closed.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe object audio video canvas "
    "datalist noembed noframes".split())
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside nav header footer main address form details summary "
    "li dt dd figcaption center legend option optgroup search hgroup menu dir caption "
    "svg:text".split())
CLOSES_P = BLOCK - {"html", "body", "option", "optgroup", "caption", "legend", "svg:text"}
# Within svg and math: not drawn, drawn on lines of their own, and back to HTML.
UNDRAWN = frozenset(
    "defs symbol clippath mask marker pattern lineargradient radialgradient desc metadata "
    "annotation annotation-xml".split())
DRAWN_TEXT = "svg:text"
HTML_WITHIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
LEAVES_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img "
    "li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul "
    "var".split())
JOINS = {"mfrac": "/", "msup": "^", "msub": "_", "msubsup": "_^", "mover": "^", "munder": "_",
         "munderover": "_^", "mtr": " ", "mtable": ";"}  # between the first, second ... parts
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup".split())
# A start tag ends these open elements, looked for up to the given boundaries.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
SCOPES = frozenset("table td th caption button object template".split())  # p is closed within

ATTRIBUTE = re.compile(r"""
    ([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)
    (?:[ \t\n\r\f]*+=[ \t\n\r\f]*+
       (?:"([^"]*+)(?:"|\Z) | '([^']*+)(?:'|\Z) | ([^ \t\n\r\f"'>][^ \t\n\r\f>]*+) | (?=>) | \Z))?+
    """, re.X)
_PLAIN_ATTRIBUTE = re.sub(r"(?<!\\)\((?!\?)", "(?:", ATTRIBUTE.pattern)
TAG = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^ \t\n\r\f/>]*+)"
    rf"((?:[ \t\n\r\f/]++|{_PLAIN_ATTRIBUTE})*+)(>|\Z)", re.S | re.X)
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")


class Element:
    """An open element: text of the line being written, and finished lines."""

    __slots__ = ("tag", "run", "lines", "lead", "gap", "number", "rows", "seen", "pre", "foreign",
                 "parts", "span", "deep", "count")

    def __init__(self, tag: str, seen: bool, pre: bool, number: int | None = None,
                 foreign: bool = False):
        self.tag, self.seen, self.pre, self.number = tag, seen, pre, number
        self.foreign = foreign  # of svg or math
        self.parts = 0  # of a formula, closed so far
        self.run: list[str] = []  # inline text since the last line
        self.lines: list[str] = []
        self.lead = False  # a blank line is due before the first line
        self.gap = False  # and before the next line
        self.rows: list[list[Cell]] = []  # of a table
        self.span = (1, 1)  # columns and rows of a cell
        self.deep: list[str] = []  # elements open within this one beyond the depth of layout
        self.count: Counter[str] = Counter()  # of those, by tag

    def open_deep(self, tag: str) -> None:
        self.deep.append(tag)
        self.count[tag] += 1
        if tag in BLOCK or tag in TABLE_PARTS:
            self.end_line()

    def find_deep(self, tags, bounds) -> int | None:
        """Place of the nearest deep element of ``tags``; -1 if one of ``bounds`` is nearer."""
        if not any(self.count[t] for t in tags):
            return -1 if any(self.count[t] for t in bounds) else None
        for k in range(len(self.deep) - 1, -1, -1):
            if self.deep[k] in tags:
                return k
            if self.deep[k] in bounds:
                return -1
        return None

    def close_deep(self, place: int) -> None:
        closed = self.deep[place:]
        del self.deep[place:]
        self.count.subtract(closed)
        if not (BLOCK.isdisjoint(closed) and TABLE_PARTS.isdisjoint(closed)):
            self.end_line()

    def end_line(self, forced: bool = False) -> None:
        text = "".join(self.run)
        self.run.clear()
        if not self.pre:
            text = SPACES.sub(" ", text).strip(" ")
            if text or forced:
                self.put([text])
        elif text:
            self.put(text.split("\n"))

    def put(self, lines: list[str], before: bool = False, after: bool = False) -> None:
        """Adds lines, with blank lines around them; two of those make one."""
        if not lines:
            return
        if not self.lines:
            self.lead = before
        elif (self.gap or before) and self.lines[-1]:
            self.lines.append("")
        self.lines.extend(lines)
        self.gap = after


def _attributes(text: str) -> tuple[dict[str, str], bool]:
    """Attributes, the first of a name, and whether the tag ends with a slash."""
    found, end = {}, 0
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        end = m.end()
    return found, text.endswith("/") and end < len(text)


def _hidden(tag: str, attributes: dict[str, str], foreign: bool = False) -> bool:
    if foreign and (
            tag in UNDRAWN or attributes.get("display", "").strip() == "none"
            or attributes.get("visibility", "").strip() in ("hidden", "collapse")):
        return True
    return (
        tag in UNSEEN or "hidden" in attributes
        or (tag == "dialog" and "open" not in attributes)
        or bool(HIDING.search(attributes.get("style", ""))))


def _spans(attributes: dict[str, str]) -> tuple[int, int]:
    """Columns and rows of a cell, within the limits of HTML; 0 rows are all that follow."""
    def number(name: str, most: int) -> int:
        text = re.match(r"[ \t\n\r\f]*\+?(\d{1,9})", attributes.get(name, ""))
        return min(int(text[1]), most) if text else 1

    return max(number("colspan", MAX_COLUMNS), 1), number("rowspan", MAX_ROWS) or MAX_ROWS


def _grid(rows: list[list[Cell]]) -> list[list[tuple[int, int, list[str]]]]:
    """First and last column and lines of the cells, row by row.

    Columns are those at which a cell begins; others have no width of their own.
    """
    placed: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # columns that cells of earlier rows reach into, rows left
    for row in rows:
        at, line, more = 0, [], {}
        for lines, columns, down in row:
            while taken.get(at, 0) > 0:
                at += 1
            line.append((at, at + columns, lines))
            if down > 1:
                more.update(dict.fromkeys(range(at, at + columns), down))
            at += columns
        placed.append(line)
        taken = {c: n - 1 for c, n in {**taken, **more}.items() if n > 1}
    begins = sorted({begin for line in placed for begin, _, _ in line})
    return [[(bisect_left(begins, begin), bisect_left(begins, end) - 1, lines)
             for begin, end, lines in line] for line in placed]


def _table(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells as lines, columns as wide as their widest line."""
    grid = _grid(rows)
    widths = [0] * (1 + max((last for line in grid for _, last, _ in line), default=-1))
    for spread in (False, True):  # cells of one column first; a wider one widens its last
        for line in grid:
            for first, last, lines in line:
                if (last > first) == spread:
                    wanted = max(map(len, lines), default=0) - 3 * (last - first)
                    widths[last] += max(0, wanted - sum(widths[first:last + 1]))
    out = []
    for line in grid:
        for k in range(max((len(lines) for _, _, lines in line), default=0)):
            parts: list[str] = []
            column = 0
            for first, last, lines in line:
                parts += [" " * w for w in widths[column:first]]
                width = sum(widths[first:last + 1]) + 3 * (last - first)
                parts.append((lines[k] if k < len(lines) else "").ljust(width))
                column = last + 1
            out.append(" | ".join(parts).rstrip())
    return out


class Page:
    """Tree builder and renderer of one page."""

    def __init__(self):
        self.open = [Element("", True, False)]

    def text(self, text: str) -> None:
        top = self.open[-1]
        if top.seen and not (top.foreign and top.tag in JOINS and not text.strip()):
            top.run.append(text)

    def within_foreign(self) -> bool:
        """Whether a tag that comes now belongs to svg or math."""
        top = self.open[-1]
        return top.foreign and top.tag not in HTML_WITHIN

    def start(self, tag: str, rest: str) -> bool:
        """Opens an element; False if it was closed by its own tag."""
        if tag in LEAVES_FOREIGN:
            while self.within_foreign():
                self.close()
        foreign = tag in ("svg", "math") or self.within_foreign()
        if foreign:
            if tag == "text":
                tag = DRAWN_TEXT
            attributes, ended = _attributes(rest)
            deep = len(self.open) >= MAX_DEPTH and not _hidden(tag, attributes, True)
            if not ended and (not deep or tag in RAW):
                self.push(tag, attributes, True)
            elif not ended:
                self.open[-1].open_deep(tag)
            return not ended
        if tag in CLOSES_P:
            self.close_within({"p"}, SCOPES)
        if tag in ENDS:
            closed, bounds = ENDS[tag]
            while self.close_within(closed, bounds):
                pass
        top = self.open[-1]
        attributes = _attributes(rest)[0] if rest.strip("/ \t\r\n\f") else {}
        if tag in VOID:
            if not top.seen or _hidden(tag, attributes):
                return True
            if tag == "br":
                if top.pre:
                    top.run.append("\n")
                else:
                    top.end_line(forced=True)
            elif tag == "hr":
                top.end_line()
                top.gap = True
            elif tag == "img" and attributes.get("alt"):
                top.run.append(attributes["alt"])
            elif tag == "input" and attributes.get("type", "text").lower() in (
                    "submit", "button", "reset"):
                top.run.append(attributes.get("value", ""))
            return True
        if tag == "body" or tag == "html":
            if any(e.tag == tag for e in self.open):
                return True
        if len(self.open) >= MAX_DEPTH and tag not in RAW | UNSEEN and not _hidden(tag, attributes):
            self.open[-1].open_deep(tag)
            return True
        if tag in ("td", "th") and top.tag in ("table", "thead", "tbody", "tfoot"):
            self.push("tr", {})
        self.push(tag, attributes)
        return True

    def push(self, tag: str, attributes: dict[str, str], foreign: bool = False) -> None:
        top = self.open[-1]
        number = None
        if tag == "ol":
            first = attributes.get("start", "1")
            number = int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1
        elif tag == "li" and top.tag == "ol" and top.number is not None:
            number, top.number = top.number, top.number + 1
        seen = top.seen and not _hidden(tag, attributes, foreign)
        if seen and (tag in BLOCK or tag in TABLE_PARTS):
            top.end_line()
        pre = (top.pre or tag in ("pre", "textarea", "xmp")) and tag not in ("td", "th")
        self.open.append(Element(tag, seen, pre, number, foreign))
        if tag in ("td", "th"):
            self.open[-1].span = _spans(attributes)

    def close_within(self, tags: set[str], bounds) -> bool:
        """Closes the nearest open element of ``tags``, not looking beyond ``bounds``."""
        for i in range(len(self.open) - 1, -1, -1):
            place = self.open[i].find_deep(tags, bounds) if self.open[i].deep else None
            if place is not None and place >= 0:
                self.close_to(i + 1)
                self.open[i].close_deep(place)
                return True
            if place is not None or i == 0:
                return False
            if self.open[i].tag in tags:
                self.close_to(i)
                return True
            if self.open[i].tag in bounds:
                return False
        return False

    def end(self, tag: str) -> None:
        if tag == "text" and self.within_foreign():
            tag = DRAWN_TEXT
        if tag == "br":
            self.start("br", "")
        elif tag == "p" and not any(e.tag == "p" or e.count["p"] for e in self.open):
            self.open[-1].end_line()
        elif tag not in ("body", "html"):  # what follows them still belongs to the page
            bounds = () if tag in BLOCK or tag in TABLE_PARTS or tag == "table" else (
                "td", "th", "caption")
            self.close_within({tag}, bounds)

    def close_to(self, index: int) -> None:
        while len(self.open) > index:
            self.close()

    def close(self) -> None:
        done = self.open.pop()
        into = self.open[-1]
        if not done.seen:
            return
        tag = done.tag
        if into.foreign and into.tag in JOINS:
            signs = JOINS[into.tag]
            if into.parts:
                into.run.append(signs[min(into.parts, len(signs)) - 1])
            into.parts += 1
        if tag not in BLOCK and tag not in TABLE_PARTS:  # inline: joins the parent's line
            if done.lines:
                done.end_line()
                into.end_line()
                into.put(done.lines, done.lead, done.gap)
            else:
                into.run.extend(done.run)
            return
        done.end_line()
        lines = done.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            del lines[0]
        if tag in ("td", "th"):
            if into.tag == "tr":
                if not into.rows:
                    into.rows.append([])
                into.rows[0].append((lines, *done.span))
            else:
                into.put(lines)
        elif tag == "tr":
            cells = done.rows[0] if done.rows else []
            if lines:
                cells = [*cells, (lines, 1, 1)]
            if into.tag in ("table", "thead", "tbody", "tfoot"):
                into.rows.append(cells)
            else:
                into.put(_table([cells]))
        elif tag in ("thead", "tbody", "tfoot"):
            if into.tag == "table":
                into.rows.extend(done.rows)
            else:
                into.put(_table(done.rows))
            into.put(lines)
        elif tag == "table":
            into.put([*lines, *_table(done.rows)], True, True)
        elif tag == "li" and lines:
            mark = "- " if done.number is None else f"{done.number}. "
            pad = " " * len(mark)
            into.put([(mark if i == 0 else pad) + x if x else x for i, x in enumerate(lines)])
        elif tag in ("dd", "blockquote"):
            into.put([x and "  " + x for x in lines], tag in SPACED, tag in SPACED)
        else:
            spaced = tag in SPACED and not (tag in ("ul", "ol") and into.tag == "li")
            into.put(lines, spaced or done.lead, spaced or done.gap)


def render(page: str) -> str:
    """The visible text of a page."""
    out, at = Page(), 0
    while True:
        found = TAG.search(page, at)
        text = page[at:found.start()] if found else page[at:]
        if text:
            out.text(html.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        if page.startswith("<![CDATA[", found.start()) and out.within_foreign():
            close = page.find("]]>", found.start())
            at = close + 3 if close >= 0 else len(page)
            out.text(page[found.start() + 9:close if close >= 0 else at])
            continue
        if not found[2] or not found[4]:  # comment, declaration, or cut off within the tag
            continue
        tag = found[2].lower()
        if found[1]:
            out.end(tag)
            continue
        opened = out.start(tag, found[3])
        if tag in RAW and opened:  # nothing but its own end tag counts inside
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            text = page[at:close.start() if close else len(page)]
            if tag == "textarea":
                out.text(html.unescape(text))
            if not close:
                break
            at = close.start()
    out.close_to(1)
    root = out.open[0]
    root.end_line()
    return "\n".join(root.lines).strip("\n")


@F.pandas_udf(T.StringType())
def visible_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([None if page is None else render(page) for page in batch], dtype=object)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """All rows and columns, and a column ``visible_text``."""
    return pages.withColumn("visible_text", visible_text.asNondeterministic()(F.col(f"`{page}`")))
