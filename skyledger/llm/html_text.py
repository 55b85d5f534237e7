"""Layout-aware HTML rendering (operator 3).

A tree builder with implied tags (p, li, table parts and the like close and
open themselves) feeds a renderer that emits all visible text in order: blocks
are kept apart by line breaks or blank lines, list items get their marks and
indent, table cells are padded so that columns line up, `pre` keeps its spaces.
Hidden content (head, script, style, the hidden attribute, display:none and the
like) is left out.

Time and memory of a page grow with its length, whatever it holds: the tokenizer
reads no character twice from the same state, and a line is laid out once, behind
the prefix of the quotes and list items around it. Three rules keep the output in
proportion: a prefix grows up to PREFIX characters (deeper items and quotes add
nothing to it); in a table inside TABLE_DEPTH others, and in one whose padded cells
no longer fit into PADDING characters for each character of the page, each cell
stands on lines of its own; a column in which no cell stands alone takes no room.

Cases: a null or empty page renders as an empty text; unclosed, misnested and
stray tags are mended; a tag that never ends is text; null or repeated ids give one
row per input row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard, by role in rendering.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript noframes iframe object datalist svg math audio video canvas".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr".split())
BLOCK = PARAGRAPH | frozenset("address article aside body center details dialog dd div dt fieldset figcaption footer form header hgroup html legend li main menu nav optgroup option search section summary tr caption thead tbody tfoot td th".split())
# an opening tag closes an open element of these names ...
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th", "caption"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("caption", "tr", "td", "th", "tbody", "tfoot", "thead"), "tbody": ("caption", "tr", "td", "th", "tbody", "tfoot", "thead"),
    "tfoot": ("caption", "tr", "td", "th", "tbody", "tfoot", "thead"), "body": ("head",),
}
# ... unless one of these lies between
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "optgroup": ("select",)}
TABLE_SCOPE = ("table",)
CLOSE_P = PARAGRAPH | frozenset("address article aside center details dialog dir div dl fieldset figcaption footer form header hgroup main menu nav search section summary li dt dd".split())

PREFIX = 400          # characters of quote signs, list marks and indentation before a line
TABLE_DEPTH = 12      # tables around a table whose cells are still aligned
PADDING = 64          # characters of aligned tables for each character of the page
FREE_PADDING = 1 << 18  # and for any page

NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile("[>\"']")
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
SPACES = re.compile(r"[ \t\n\r\f]+")
START = re.compile("-?[0-9]{1,9}")
LISTS = ("ul", "ol", "menu")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def get(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTR.finditer(self.attrs)}


class Tokens:
    """Tags of a page by one pass. Whether a tag ends is known from the quotes its
    attributes go through: those of tags that never end are remembered, so that no
    later tag follows them again."""

    def __init__(self, page: str):
        self.page = page
        self.dead: set[int] = set()      # quotes outside a value from where no tag ends
        self.special = (0, -1)           # no quote or ">" stands from the first place to before the second

    def _special(self, at: int) -> int:
        """Place of the first quote or ">" from `at` on, or the page's length."""
        lo, hi = self.special
        if not lo <= at <= hi:
            m = SPECIAL.search(self.page, at)
            self.special = lo, hi = at, m.start() if m else len(self.page)
        return hi

    def tag_end(self, at: int) -> int:
        """Place of the ">" that ends a tag whose attributes start at `at`, or -1."""
        page, seen = self.page, []
        while True:
            q = self._special(at)
            if q < len(page) and page[q] == ">":
                return q
            if q == len(page) or q in self.dead:
                break
            seen.append(q)
            at = page.find(page[q], q + 1) + 1
            if not at:
                break
        self.dead.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """(start, end, name or "" for a comment, attributes, closing) of the first token from `at` on."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            sign = page[at + 1:at + 2]
            if sign == "!" or sign == "?":
                end = page.find("-->", at + 4) + 3 if page.startswith("<!--", at) else page.find(">", at) + 1
                return at, end if end > at else len(page), "", "", False
            m = NAME.match(page, at)
            if m:
                end = self.tag_end(m.end())
                if end >= 0:
                    return at, end + 1, m[1].lower(), page[m.end():end], sign == "/"
            at += 1
        return None


def parse(page: str) -> Node:
    """Tree of a page, as deep as its elements are nested. The places of the open
    elements of each tag are kept, so that no tag has to search the open ones."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = {}

    def deepest(tags):
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def pop():
        places[stack.pop().tag].pop()

    def close(names, scope):
        at = deepest(names)
        if not at or at < deepest(scope):
            return False
        while len(stack) > at:
            pop()
        return True

    def open_(tag, attrs=""):
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)

    at, n, tokens = 0, len(page), Tokens(page)
    while at < n:
        m = tokens.next(at)
        if m is None:
            stack[-1].kids.append(html.unescape(page[at:]))
            break
        start, end, tag, attrs, closing = m
        if start > at:
            stack[-1].kids.append(html.unescape(page[at:start]))
        at = end
        if not tag:
            continue
        if closing:
            if tag == "p" and not places.get("p"):
                open_("p")  # a stray </p> is an empty paragraph
                pop()
            elif tag == "br":
                stack[-1].kids.append(Node("br"))
            elif tag not in VOID:
                close((tag,), ("table", "td", "th") if tag not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html") else
                      (TABLE_SCOPE if tag not in ("table", "body", "html") else ()))
            continue
        if tag in CLOSE_P:
            close(("p",), ("table", "td", "th", "button", "caption"))
        if tag[0] == "h" and len(tag) == 2 and tag[1] in "123456" and stack[-1].tag[0] == "h" and stack[-1].tag[1:] in ("1", "2", "3", "4", "5", "6"):
            pop()
        if tag in CLOSES:
            while close(CLOSES[tag], SCOPE.get(tag, TABLE_SCOPE)) and tag in ("tr", "thead", "tbody", "tfoot", "dt", "dd", "optgroup"):
                pass
        if tag in ("td", "th") and stack[-1].tag != "tr" and places.get("table"):
            open_("tr")  # implied row
        open_(tag, attrs)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            stop = end.start() if end else n
            if tag in ("textarea", "title", "xmp"):
                stack[-1].kids.append(html.unescape(page[at:stop]) if tag != "xmp" else page[at:stop])
            at = end.end() if end else n
            if stack[-1].tag == tag:
                pop()
    return root


class Lines:
    """Text being laid out; pending breaks collapse to the widest asked for. The text
    of a list item or a quote has Lines of its own that write to the lines of the
    whole: `mark` stands before its first line, `rest` before the others."""

    __slots__ = ("out", "outer", "mark", "lead", "item", "begun", "any", "blanks", "open", "line", "space", "gap")

    def __init__(self, outer: Lines | None = None, mark: str = "", rest: str = ""):
        self.out: list[str] = outer.out if outer else []
        self.outer, self.mark, self.item = outer, mark, mark != rest
        self.lead = _longer(outer.lead, rest) if outer else ""   # before all lines but the first
        self.begun = self.any = False    # a line is out; there is a line, maybe a blank one that waits
        self.blanks = 0                  # blank lines that wait for text behind them
        self.open = False                # the last line out may go on
        self.line: list[str] = []
        self.space = False
        self.gap = 0

    def text(self, s: str, keep: bool) -> None:
        if keep:
            for i, part in enumerate(s.replace("\r\n", "\n").split("\n")):
                if i:
                    self.newline()
                if part:
                    self._put(part)
            return
        words = SPACES.split(s)
        for i, w in enumerate(words):
            if i:
                self.space = True
            if w:
                self._put(w)

    def row(self, s: str) -> None:
        """A line of its own."""
        self.block(1)
        s = s.rstrip(" ")
        if s:
            self._put(s)

    def _put(self, w: str) -> None:
        started = self.open or self.line
        if not started:
            self._settle()
        if self.space and started:
            self.line.append(" ")
        self.space = False
        self.line.append(w)

    def _settle(self) -> None:
        """The gap asked for becomes blank lines, as text comes behind it."""
        if self.any and self.gap:
            self.blanks += self.gap - 1
        self.gap = 0

    def _emit(self, s: str) -> None:
        """A line of text. Those around that have no line yet start with it."""
        chain = [self]
        while chain[-1].outer and not chain[-1].begun:
            chain.append(chain[-1].outer)
        chain.reverse()
        lead = chain[0].lead
        for i, x in enumerate(chain):
            if not x.begun:
                lead = _longer(lead, x.mark)
            if x is not self:
                x._settle()
            for _ in range(x.blanks):
                if x.item and x.begun:
                    break  # no blank lines inside an item
                self.out.append(lead.rstrip(" "))
                for y in chain[:i + 1]:
                    y.begun = True
                chain, lead, i = chain[i:], x.lead, 0
            x.blanks = 0
            x.any = True
        self.out.append((lead + s).rstrip(" "))
        for x in chain:
            x.begun = True

    def newline(self) -> None:
        """A forced line break."""
        s = "".join(self.line)
        if self.open:
            if s:
                self.out[-1] = (self.out[-1] + s).rstrip(" ")
        elif s.rstrip(" "):
            self._emit(s)
        else:
            self.blanks += 1
            self.any = True
        self.line, self.space, self.open = [], False, False

    def block(self, gap: int) -> None:
        if self.line or self.open:
            self.newline()
        self.gap = max(self.gap, gap)
        self.space = False

    def done(self) -> list[str]:
        """The end of the text; blank lines at the end go. An item without text is its mark."""
        if self.line or self.open:
            self.newline()
        self.blanks = 0
        if self.outer:
            if self.item and not self.begun:
                self._emit("")
                self.outer.space = True
            self.outer.open = self.begun
        return self.out


def _longer(lead: str, more: str) -> str:
    return lead + more if len(lead) + len(more) <= PREFIX else lead


def hidden(node: Node) -> bool:
    if node.tag in HIDDEN:
        return True
    if not node.attrs or not node.attrs.strip():
        return False
    a = node.get()
    return ("hidden" in a or a.get("aria-hidden") == "true" or (node.tag == "input" and a.get("type", "").lower() == "hidden")
            or (node.tag == "dialog" and "open" not in a) or bool(INVISIBLE.search(a.get("style", ""))))


class Room:
    """Characters that aligned tables of a page may still take, and the tables around."""

    def __init__(self, page: str):
        self.left = PADDING * len(page) + FREE_PADDING
        self.tables = 0


def _inner(node: Node, keep: bool, room: Room) -> list[str]:
    sub = Lines()
    _lay_out(node, sub, keep, room)
    return sub.done()


def _table(node: Node, lines: Lines, keep: bool, room: Room) -> None:
    """Cells of a column padded to one width; a cell of several lines spans as many."""
    rows, captions = [], []
    waiting = [iter(node.kids)]
    while waiting:
        k = next(waiting[-1], None)
        if k is None:
            waiting.pop()
        elif isinstance(k, str):
            if k.strip():
                captions.append([k.strip()])
        elif hidden(k):
            continue
        elif k.tag == "tr":
            cells = []
            for c in k.kids:
                if isinstance(c, str):
                    if c.strip():
                        cells.append(([SPACES.sub(" ", c.strip())], 1))
                elif not hidden(c):
                    span = c.get().get("colspan", "1") if c.attrs else "1"
                    cells.append((_inner(c, keep, room), min(int(span), 1000) if len(span) < 9 and span.isdecimal() and int(span) else 1))
            rows.append(cells)
        elif k.tag in ("thead", "tbody", "tfoot", "colgroup"):
            waiting.append(iter(k.kids))
        else:
            captions.append(_inner(k, keep, room))
    width: dict[int, int] = {}
    for cells in rows:
        col = 0
        for text, span in cells:
            if span == 1:
                width[col] = max([width.get(col, 0), *map(len, text)])
            col += span
    for text in captions:
        for t in text:
            lines.block(1)
            lines.text(t, True)
    columns = sorted(width)
    before = [0, *accumulate(width[c] + 2 for c in columns)]  # room of the columns before each, with what parts them
    placed, area = [], 0
    for cells in rows:
        if not any(t for text, _ in cells for t in text):
            continue
        col, row, full = 0, [], 0
        for text, span in cells:
            w = max(before[bisect_left(columns, col + span)] - before[bisect_left(columns, col)] - 2, 0)
            row.append((text, w))
            full += max(w, *map(len, text), 0) + 2 if text else w + 2
            col += span
        placed.append(row)
        area += full * max(len(text) for text, _ in cells)
    aligned = area <= room.left
    if aligned:
        room.left -= area
    for row in placed:
        if aligned:
            for i in range(max(len(text) for text, _ in row)):
                lines.row("  ".join([(text[i] if i < len(text) else "").ljust(w) for text, w in row]))
        else:
            for text, _ in row:
                for t in text:
                    lines.row(t)


class Open:
    """An element whose contents are being laid out."""

    __slots__ = ("kids", "node", "lines", "keep", "number", "gap", "after")

    def __init__(self, node: Node, kids: list, lines: Lines, keep: bool, gap: int = 0, after: Lines | None = None):
        self.kids, self.node, self.lines, self.keep, self.gap = iter(kids), node, lines, keep, gap
        self.after = after    # the lines around, if the element has lines of its own
        self.number = 1


def _lay_out(node: Node, lines: Lines, keep: bool, room: Room) -> None:
    """Contents of an element. Open elements wait on a list instead of the call stack."""
    stack = [Open(node, node.kids, lines, keep)]
    while stack:
        top = stack[-1]
        for k in top.kids:
            if isinstance(k, str):
                top.lines.text(k, top.keep)
            elif not hidden(k):
                inside = _item(k, top) if k.tag == "li" and top.node.tag in LISTS else _enter(k, top, room)
                if inside:
                    stack.append(inside)
                    break
        else:
            stack.pop()
            if stack:
                _leave(top)


def _item(node: Node, top: Open) -> Open:
    mark = f"{top.number}. " if top.node.tag == "ol" else "- "
    top.number += 1
    top.lines.block(1)
    return Open(node, node.kids, Lines(top.lines, mark, " " * len(mark)), top.keep, after=top.lines)


def _enter(node: Node, top: Open, room: Room) -> Open | None:
    tag, lines = node.tag, top.lines
    if tag == "br":
        lines.newline()
        return None
    if tag == "img":
        alt = node.get().get("alt", "")
        if alt.strip():
            lines.text(alt, False)
        return None
    if tag == "input":
        a = node.get()
        if a.get("type", "").lower() in ("submit", "button", "reset") and a.get("value", "").strip():
            lines.text(a["value"], False)
        return None
    if tag == "wbr":
        return None
    gap = 2 if tag in PARAGRAPH else 1 if tag in BLOCK else 0
    if tag in ("ul", "ol") and top.node.tag == "li":
        gap = 1
    if gap:
        lines.block(gap)
    if tag == "table" and room.tables < TABLE_DEPTH:
        room.tables += 1
        _table(node, lines, top.keep, room)
        room.tables -= 1
        lines.block(gap)
        return None
    if tag == "blockquote":
        return Open(node, node.kids, Lines(lines, "> ", "> "), top.keep, gap, lines)
    kids = node.kids
    if tag == "pre" and kids and isinstance(kids[0], str) and kids[0].startswith("\n"):
        kids = [kids[0][1:], *kids[1:]]
    inside = Open(node, kids, lines, top.keep or tag in ("pre", "textarea", "xmp"), gap)
    start = node.get().get("start", "1") if tag == "ol" and node.attrs else "1"
    if START.fullmatch(start):
        inside.number = int(start)
    return inside


def _leave(top: Open) -> None:
    lines = top.lines
    if top.after:
        lines.done()
        lines = top.after
    if top.node.tag in ("td", "th", "option", "button"):
        lines.space = True
    if top.gap:
        lines.block(top.gap)


def render(page: str | None) -> str:
    """All visible text of a page, laid out in lines."""
    if not page:
        return ""
    lines = Lines()
    _lay_out(parse(page), lines, False, Room(page))
    return "\n".join(lines.done())


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars) of every page."""
    def go(batches):
        for b in batches:
            start, text, size = 0, [], 0
            for i in range(b.num_rows):
                text.append(render(b.column(1)[i].as_py()))
                size += len(text[-1])
                if len(text) == 512 or size > 1 << 22 or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(text)), pa.array(text, pa.string()),
                                                      pa.array([len(t) for t in text], pa.int64())], ["page_id", "text", "n_chars"])
                    start, text, size = i + 1, [], 0

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("_html"))
    return rows.mapInArrow(go, "page_id long, text string, n_chars long")
