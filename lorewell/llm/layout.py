"""Layout-aware text of HTML pages.

A tree builder reads markup once, from left to right: it closes elements whose
end tags may be left out, keeps table, list and cell scopes apart, and reports
open and close events of the resulting tree. A renderer turns the events into
all visible text: blocks are set apart by their margins, list items carry
indented markers, cells of a table are aligned in columns (a table that holds
another one is laid out as blocks), `pre` keeps its blanks. Not visible are
head matter, scripts, styles, templates, hidden attributes and inline styles
that hide, closed details but their summary, and comments. Unclosed comments,
tags and raw-text elements run to the end of the page, as in browsers.

Work is linear in the page: no text is scanned twice from different openers, and
scopes keep counts of open names, so stray end tags cost nothing. A null page
gives null, an empty or blank one the empty string.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from .scratch import column, free_name

# Element names by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset(
    "head script style title template iframe noembed noframes noscript object video audio canvas svg math "
    "datalist dialog rp link meta base param source track area".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("table td th caption template button object html marquee applet".split())
# Margins in lines around blocks; blocks not named here have none.
MARGINS = dict.fromkeys(
    "p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre listing xmp figure table fieldset hr".split(), 1
)
BLOCKS = CLOSES_P | frozenset(
    "body html table caption tr td th thead tbody tfoot option optgroup legend".split()
)
LISTS = frozenset("ul ol menu dir".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript noframes".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
REST_OF_TAG = re.compile(r"""[^>"']*""")
BLANKS = re.compile(r"[ \t\n\f\r]+")
HIDING_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
MAX_COLSPAN = 1000
# Cells are padded up to this width; longer ones push the next column aside.
ALIGN = 40


def _tag_end(page: str, at: int) -> int:
    """Position behind the tag's `>`, or -1 if the page ends inside the tag."""
    while True:
        at = REST_OF_TAG.match(page, at).end()
        if at >= len(page):
            return -1
        if page[at] == ">":
            return at + 1
        # A quote opens a value only behind an equals sign.
        if page[max(0, at - 64) : at].rstrip().endswith("="):
            at = page.find(page[at], at + 1)
            if at < 0:
                return -1
        at += 1


def _attributes(markup: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(markup):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


class Builder:
    """Open elements of the tree. Events: [name, attributes], text, or [name] at the end."""

    def __init__(self):
        self.open: list[tuple[str, list]] = []
        self.scopes: list[Counter] = [Counter()]
        self.owners: list[str] = [""]  # the element each scope belongs to
        self.events: list = []
        self.tables: list[list] = []

    def start(self, name: str, attributes: dict[str, str]) -> None:
        self._imply_end(name)
        if name in ("td", "th") and "tr" not in self.scopes[-1] and self.open and self._inner() in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        self._push(name, attributes)
        if name in VOID:
            self._pop()

    def _inner(self) -> str:
        return self.open[-1][0] if self.open else ""

    def _push(self, name: str, attributes: dict[str, str]) -> None:
        event = [name, attributes, False]
        self.events.append(event)
        if name == "table":
            for outer in self.tables[-1:]:
                outer[2] = True  # it holds a table: laid out as blocks
            self.tables.append(event)
        self.scopes[-1][name] += 1
        self.open.append((name, event))
        if name in SCOPES:
            self.scopes.append(Counter())
            self.owners.append(name)

    def _pop(self) -> None:
        name, event = self.open.pop()
        if name in SCOPES:
            self.scopes.pop()
            self.owners.pop()
        scope = self.scopes[-1]
        scope[name] -= 1
        if not scope[name]:
            del scope[name]
        if name == "table":
            self.tables.pop()
        self.events.append((name,))

    def _close_to(self, name: str) -> None:
        while self._inner() != name:
            self._pop()
        self._pop()

    def _close_here(self, name: str) -> None:
        """Close `name` if it is open in the innermost scope."""
        if name in self.scopes[-1]:
            self._close_to(name)

    def _close_first(self, names: tuple[str, ...], stop: frozenset[str]) -> None:
        """Close the nearest of `names` unless an element of `stop` is nearer."""
        if not any(n in self.scopes[-1] for n in names):
            return
        for name, _ in reversed(self.open):
            if name in names:
                self._close_to(name)
                return
            if name in stop or name in SCOPES:
                return

    def _imply_end(self, name: str) -> None:
        if name not in HEAD_ONLY and name not in ("html", "head"):
            self._close_here("head")
        if name in CLOSES_P:
            self._close_here("p")
        if name == "li":
            self._close_first(("li",), LISTS)
        elif name in ("dd", "dt"):
            self._close_first(("dd", "dt"), frozenset(("dl",)))
        elif name in HEADINGS and self._inner() in HEADINGS:
            self._pop()
        elif name == "option":
            self._close_here("option")
        elif name == "optgroup":
            self._close_here("option")
            self._close_here("optgroup")
        elif name == "a":
            self._close_here("a")
        elif name in ("td", "th"):
            self._leave_cell()
        elif name == "tr":
            self._leave_cell()
            self._close_first(("tr",), frozenset(("table",)))
        elif name in ("thead", "tbody", "tfoot", "caption", "colgroup"):
            self._leave_cell()
            self._close_first(("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",)))

    def _leave_cell(self) -> None:
        """End the cell or caption that is open in the innermost table."""
        if self.owners[-1] in ("td", "th", "caption"):
            self._close_to(self.owners[-1])

    def end(self, name: str) -> None:
        if name == "p" and "p" not in self.scopes[-1]:
            self._push("p", {})
        if name == "br":
            self.start("br", {})
            return
        if name in self.scopes[-1]:
            self._close_to(name)
        elif len(self.scopes) > 1:
            scope_name = self.owners[-1]
            table_part = name in ("table", "tr", "thead", "tbody", "tfoot")
            if scope_name == name:
                self._close_to(name)
            elif table_part and scope_name in ("td", "th", "caption") and name in self.scopes[-2]:
                self._close_to(scope_name)
                self._close_to(name)
            elif name == "table" and scope_name in ("td", "th", "caption") and len(self.scopes) > 2:
                self._close_to(scope_name)
                self._close_to("table")

    def text(self, value: str) -> None:
        if value:
            if "head" in self.scopes[-1] and not value.isspace():
                self._close_here("head")
            self.events.append(value)

    def finish(self) -> list:
        while self.open:
            self._pop()
        return self.events


def parse(page: str) -> list:
    """Events of the page's tree."""
    builder, at, n = Builder(), 0, len(page)
    while at < n:
        spot = page.find("<", at)
        if spot < 0:
            spot = n
        if spot > at:
            builder.text(html.unescape(page[at:spot]))
        if spot == n:
            break
        at = spot
        if page.startswith("<!--", at):
            if page.startswith((">", "->"), at + 4):
                at = page.find(">", at) + 1
                continue
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        tag = TAG.match(page, at)
        if not tag:
            if page.startswith(("<!", "<?", "</"), at):
                end = page.find(">", at)
                at = n if end < 0 else end + 1
            else:
                builder.text("<")
                at += 1
            continue
        end = _tag_end(page, tag.end())
        if end < 0:
            break
        name = tag[2].lower()
        if tag[1]:
            builder.end(name)
        else:
            builder.start(name, _attributes(page[tag.end() : end - 1]))
        at = end
        if not tag[1] and name in RAW:
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            stop = close.start() if close else n
            inner = page[at:stop]
            if name not in HIDDEN:
                builder.text(html.unescape(inner) if name == "textarea" else inner)
            at = stop
            if not close:
                break
    return builder.finish()


class Writer:
    """Lines of text with pending margins, indents and markers."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.margin = 0
        self.indents: list[str] = []
        self.marker: str | None = None
        self.pre = 0

    def text(self, value: str) -> None:
        if self.pre:
            first, *more = value.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            for line in more:
                self.line(keep=True)
                self.parts.append(line)
        else:
            self.parts.append(BLANKS.sub(" ", value))

    def line(self, keep: bool = False) -> None:
        """End the current line; an empty one counts only if `keep`."""
        joined = "".join(self.parts)
        value = joined.rstrip() if self.pre else BLANKS.sub(" ", joined).strip(" ")
        self.parts = []
        if not value and self.marker is None and not keep:
            return
        if not value and not keep:
            return
        self.put(value)

    def put(self, value: str) -> None:
        if self.margin and self.lines:
            self.lines.extend([""] * self.margin)
        self.margin = 0
        indent = "".join(self.indents)
        if self.marker is not None:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = None
        self.lines.append((indent + value).rstrip())

    def block(self, margin: int) -> None:
        self.line()
        self.margin = max(self.margin, margin)

    def result(self) -> str:
        self.line()
        return "\n".join(self.lines).strip("\n")


class Table:
    """Rows of captured cells, placed in a grid by their spans."""

    def __init__(self):
        self.rows: list[dict[int, list[str]]] = []
        self.held: dict[int, int] = {}
        self.columns: list[int] = []

    def row(self) -> None:
        self.rows.append({})
        self.held = {c: n - 1 for c, n in self.held.items() if n > 1}
        self.at = 0

    def cell(self, lines: list[str], colspan: int, rowspan: int) -> None:
        if not self.rows:
            self.row()
        while self.held.get(self.at):
            self.at += 1
        self.rows[-1][self.at] = lines
        if rowspan > 1:
            for c in range(self.at, self.at + colspan):
                self.held[c] = rowspan
        self.at += colspan

    def lines(self) -> list[str]:
        used = sorted({c for row in self.rows for c, lines in row.items() if lines})
        order = {c: i for i, c in enumerate(used)}
        width = [0] * len(used)
        for row in self.rows:
            for c, lines in row.items():
                if lines:
                    width[order[c]] = max(width[order[c]], min(ALIGN, max(map(len, lines))))
        out = []
        for row in self.rows:
            filled = {order[c]: lines for c, lines in row.items() if lines}
            for i in range(max(map(len, filled.values()), default=0)):
                cells = [filled[c][i] if i < len(filled.get(c, ())) else "" for c in range(max(filled) + 1)]
                out.append(" | ".join(v.ljust(width[c]) for c, v in enumerate(cells)).rstrip())
        return out


def _number(value: str | None, default: int, most: int) -> int:
    digits = re.match(r"\s*(-?\d{1,9})", value or "")
    return max(1, min(most, int(digits[1]))) if digits else default


def _is_hidden(name: str, attributes: dict[str, str]) -> bool:
    if name in HIDDEN and not (name == "dialog" and "open" in attributes):
        return True
    if "hidden" in attributes or (name == "input" and attributes.get("type", "").lower() == "hidden"):
        return True
    return bool(attributes.get("style")) and bool(HIDING_STYLE.search(attributes["style"]))


def render(events: list) -> str:
    """Visible text of a tree given as events."""
    writers, tables, lists = [Writer()], [], []
    hidden, spans, depth = 0, [], 0
    # Open details: whether they are closed and whether their summary is open;
    # `folded` counts those whose content is not shown now.
    details, folded = [], 0
    for event in events:
        out = writers[-1]
        if isinstance(event, str):
            if not hidden and not folded:
                out.text(event)
            continue
        name = event[0]
        if isinstance(event, tuple):
            depth -= 1
            if hidden:
                hidden -= 1
                continue
            if name in ("td", "th", "caption") and spans and spans[-1][2] == depth:
                colspan, rowspan, _ = spans.pop()
                captured = writers.pop()
                captured.line()
                lines = [line for line in captured.lines if line]
                if name == "caption":
                    for line in lines:
                        writers[-1].put(line)
                else:
                    tables[-1].cell(lines, colspan, rowspan)
            elif name == "table" and tables and tables[-1] is not None:
                for line in tables.pop().lines():
                    out.put(line)
                out.block(1)
            elif name == "table":
                tables and tables.pop()
                out.block(1)
            elif name == "details":
                folded -= details.pop()[0]
                out.block(0)
            elif name == "summary":
                out.block(0)
                if details and details[-1][1]:
                    details[-1][1] = False
                    folded += 1
            elif name in LISTS:
                lists.pop()
                out.block(0 if lists else 1)
            elif name == "li" or name == "blockquote" or name == "dd":
                out.line()
                out.marker = None
                out.indents.pop()
                out.block(MARGINS.get(name, 0))
            elif name in ("pre", "listing", "xmp"):
                out.block(1)
                out.pre -= 1
            elif name in BLOCKS:
                out.block(MARGINS.get(name, 0))
            continue
        attributes = event[1]
        depth += 1
        if hidden or _is_hidden(name, attributes):
            hidden += 1
            continue
        if name == "summary":
            out.block(0)
            if details and details[-1][0] and not details[-1][1]:
                details[-1][1] = True
                folded -= 1
        elif name == "br":
            out.line(keep=True)
        elif name == "wbr":
            pass
        elif name == "details":
            out.block(0)
            details.append(["open" not in attributes, False])
            folded += details[-1][0]
        elif name == "table":
            out.block(1)
            tables.append(None if event[2] else Table())
        elif name == "tr":
            if tables and tables[-1] is not None:
                tables[-1].row()
            else:
                out.block(0)
        elif name in ("td", "th", "caption"):
            if tables and tables[-1] is not None:
                spans.append((
                    _number(attributes.get("colspan"), 1, MAX_COLSPAN), _number(attributes.get("rowspan"), 1, 65534), depth - 1
                ))
                writers.append(Writer())
            else:
                out.block(0)
        elif name in LISTS:
            out.block(0 if lists else 1)
            start = re.match(r"\s*(-?\d{1,9})", attributes.get("start", ""))
            lists.append([name == "ol", int(start[1]) if start else 1])
        elif name == "li":
            out.block(0)
            marker = "- "
            if lists and lists[-1][0]:
                value = re.match(r"\s*(-?\d{1,9})", attributes.get("value", ""))
                lists[-1][1] = int(value[1]) if value else lists[-1][1]
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            out.indents.append(" " * len(marker))
            out.marker = marker
        elif name == "blockquote" or name == "dd":
            out.block(MARGINS.get(name, 0))
            out.indents.append("  ")
        elif name in ("pre", "listing", "xmp"):
            out.block(1)
            out.pre += 1
        elif name in BLOCKS:
            out.block(MARGINS.get(name, 0))
        elif name in ("option", "button", "select"):
            out.text(" ")
    return writers[0].result()


def page_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def visible_text(page: Column | str) -> Column:
    """The visible text of a column of HTML pages."""

    @F.arrow_udf(StringType())
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([page_text(p) for p in pages.to_pylist()], pa.string())

    return of(page)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with a column `text`."""
    return pages.withColumn(free_name("text", pages.columns), visible_text(column(html_col)))
