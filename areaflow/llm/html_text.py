"""Visible text of HTML pages, laid out: a small tree builder with implied tags, visibility, and a block renderer.

The builder closes elements whose end tags may be left out and ignores end tags without a start. Rendering drops what
a browser does not show (heads, scripts, hidden elements), separates blocks by line breaks (paragraphs and headings
by blank lines), indents lists with their marks, keeps preformatted text, and aligns table cells in columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of HTML: elements without content, elements never shown, blocks, blocks set off by blank lines, and
#: for each element the open elements that its start tag closes and those behind which they are out of reach.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object audio video canvas svg math datalist select textarea".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "body": ({"head"}, set()),
}
SCOPES = frozenset("table td th caption button object template html".split())
#: Elements whose start tags leave an open head open.
IN_HEAD = frozenset("head title meta link style script base noscript template".split())
#: Elements that are nested deeper are flattened into the deepest one.
DEEPEST = 200
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.IGNORECASE)
BLANK = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("tag", "attributes", "parts")

    def __init__(self, tag: str, attributes: dict[str, str | None]) -> None:
        self.tag, self.attributes, self.parts = tag, attributes, []

    def hidden(self) -> bool:
        a = self.attributes
        return self.tag in UNSEEN or "hidden" in a or (self.tag == "dialog" and "open" not in a) or bool(HIDDEN_STYLE.search(a.get("style") or ""))


class Builder(HTMLParser):
    """Tree of a page; `root` holds what was outside of any element, too."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]

    def close(self) -> None:
        super().close()
        self.open = [self.root]

    def leave(self, tags: set[str], behind: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of these tags within the nearest of those that it cannot be behind."""
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in behind:
                break
            if self.open[k].tag in tags:
                found = k
        if found is not None:
            del self.open[found:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P:
            self.leave({"p"}, SCOPES)
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.open.pop()
        if tag in CLOSES:
            self.leave(*CLOSES[tag])
        new = Element(tag, dict(attrs))
        self.open[-1].parts.append(new)
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(new)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash at the end means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        limit = frozenset() if tag in SCOPES or tag in ("tr", "tbody", "body") else SCOPES
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in limit:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self.open.pop()
        self.open[-1].parts.append(data)


def width(text: str) -> int:
    """Columns that a text takes: wide characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines of a block: runs of inline text, broken by blocks inside."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []

    def flush(self) -> None:
        text = "".join(self.run)
        self.run.clear()
        for line in text.split("\v"):  # a forced break
            line = BLANK.sub(" ", line).strip(" ")
            if line or "\v" in text:
                self.lines.append(line)

    def gap(self) -> None:
        if self.lines and self.lines[-1]:
            self.lines.append("")

    def add(self, lines: list[str], spaced: bool) -> None:
        if lines:
            if spaced:
                self.gap()
            self.lines += lines
            if spaced:
                self.lines.append("")

    def block(self, e: Element) -> list[str]:
        """The lines of an element that is a block of its own."""
        if e.tag == "hr":
            return ["---"]
        if e.tag == "pre":
            text = "".join(texts(e)).removeprefix("\n").rstrip("\n")
            return [line.rstrip() for line in text.split("\n")] if text.strip() else []
        if e.tag == "table":
            return table_lines(e)
        if e.tag in ("ul", "ol", "menu", "dir"):
            return list_lines(e)
        inner = Layout()
        inner.fill(e)
        lines = inner.done()
        if e.tag == "blockquote":
            return ["> " + x if x else ">" for x in lines]
        return ["    " + x if x else x for x in lines] if e.tag == "dd" else lines

    def fill(self, e: Element) -> None:
        for part in e.parts:
            if isinstance(part, str):
                self.run.append(part.replace("\v", " "))
            elif part.tag == "br":
                self.run.append("\v")
            elif part.tag == "img":
                self.run.append(part.attributes.get("alt") or "")
            elif part.hidden():
                continue
            elif part.tag in BLOCKS:
                self.flush()
                self.add(self.block(part), part.tag in SPACED)
            else:
                self.fill(part)

    def done(self) -> list[str]:
        self.flush()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def texts(e: Element) -> Iterator[str]:
    for part in e.parts:
        if isinstance(part, str):
            yield part
        elif part.tag == "br":
            yield "\n"
        elif not part.hidden():
            yield from texts(part)


def list_lines(e: Element) -> list[str]:
    """Items with their marks; what an item holds is indented below it."""
    start = e.attributes.get("start") or "1"
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    lines: list[str] = []
    for part in e.parts:
        if isinstance(part, str) or part.hidden():
            if isinstance(part, str) and part.strip():
                lines.append(BLANK.sub(" ", part).strip())
            continue
        inner = Layout()
        if part.tag == "li":
            inner.fill(part)
            mark = f"{number}. " if e.tag == "ol" else "- "
            number += 1
        else:
            holder = Element("div", {})
            holder.parts.append(part)
            inner.fill(holder)
            mark = "  "
        own = [x for x in inner.done() if x]
        lines += [(mark if not k else " " * len(mark)) + x for k, x in enumerate(own)]
    return lines


def rows_of(e: Element) -> Iterator[Element]:
    for part in e.parts:
        if isinstance(part, Element) and not part.hidden():
            if part.tag == "tr":
                yield part
            elif part.tag in ("tbody", "thead", "tfoot"):
                yield from rows_of(part)


def table_lines(e: Element) -> list[str]:
    """Caption, and rows with cells in aligned columns; a cell over several columns takes their place."""
    lines: list[str] = []
    known = {id(r) for r in rows_of(e)}
    for part in e.parts:  # whatever is no row stays visible, before the table
        if isinstance(part, str):
            if part.strip():
                lines.append(BLANK.sub(" ", part).strip())
        elif not part.hidden() and id(part) not in known and part.tag not in ("tbody", "thead", "tfoot", "colgroup", "col"):
            holder = Layout()
            outer = Element("div", {})
            outer.parts.append(part)
            holder.fill(outer)
            lines += holder.done()
    grid: list[list[tuple[list[str], int]]] = []
    for row in rows_of(e):
        cells = []
        for part in row.parts:
            if isinstance(part, str):
                if part.strip():
                    cells.append(([BLANK.sub(" ", part).strip()], 1))
                continue
            if part.hidden():
                continue
            inner = Layout()
            inner.fill(part)
            span = part.attributes.get("colspan") or "1"
            cells.append(([x for x in inner.done() if x], min(50, max(1, int(span))) if re.fullmatch(r"\d{1,4}", span) else 1))
        if any(x for x, _ in cells):
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        at = 0
        for content, span in cells:
            if span == 1:
                widths[at] = max([widths.get(at, 0), *map(width, content)])
            at += span
    for cells in grid:
        for k in range(max(len(content) for content, _ in cells)):
            at, out = 0, []
            for content, span in cells:
                text = content[k] if k < len(content) else ""
                room = sum(widths.get(c, 0) for c in range(at, at + span)) + 3 * (span - 1)
                out.append(text + " " * max(0, room - width(text)))
                at += span
            lines.append(" | ".join(out).rstrip())
    return lines


def visible_text(html: str | None) -> str | None:
    """The text of a page as laid out; null for null, empty where nothing is visible."""
    if html is None:
        return None
    builder = Builder()
    builder.feed(html)
    builder.close()
    page = Layout()
    page.fill(builder.root)
    out: list[str] = []
    for line in page.done():
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out)


def extracted(html: Column) -> Column:
    """Visible text of a column of pages."""

    @F.arrow_udf(T.StringType())
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([visible_text(p.as_py()) for p in pages], type=pa.string())

    return run.asNondeterministic()(html)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add visible_text to pages. Broken markup is read as far as it goes; repeated rows and null keys are pages of
    their own. An empty table gives no rows."""
    return pages.withColumn("visible_text", extracted(F.col(html)))
