"""HTML pages as blocks in reading order, by one pass of a tag automaton.

``page_blocks`` gives a row for each heading, paragraph, list item, table row and
preformatted text, with its nesting and the region of the page it stands in.
Where the regular expressions of ``parse_pages`` see a flat text, the automaton
keeps a stack of open elements: lists in lists and tables in cells keep their
depth, elements left open are closed by what follows them, and a page cut off in
a tag, a comment or a script ends there.

The automaton reads a page from left to right once.  Each element on the stack
carries the state of all those below it, and open elements are counted by name, so no
tag looks through the stack except to take off what it closes: the time is linear in the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

from quarry.session import importable

BLOCKS = "block int, kind string, depth int, region string, text string, cells array<string>"
ROWS = 4096  # blocks sent back at a time

NAME = re.compile(r"</?([A-Za-z][^ \t\r\n\f/>]*)")
ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
BLANKS = re.compile(r"[ \t\r\n\f]+")

# fixed values: element names of HTML by what they mean for the layout
HEADINGS = {f"h{i}": i for i in range(1, 7)}
LISTS = {"ul", "ol", "menu", "dl"}
ITEMS = {"li", "dt", "dd"}
CELLS = {"td", "th"}
REGIONS = {"nav", "header", "footer", "aside"}
UNSEEN = {"script", "style", "noscript", "template", "textarea", "iframe"}
PLAIN = {"p", "div", "article", "section", "main", "body", "head", "html", "form", "fieldset", "blockquote", "address", "figure", "figcaption", "details", "summary", "caption", "thead", "tbody", "tfoot"}
ENDS = {name: re.compile(rf"</{name}(?=[ \t\r\n\f/>]|$)", re.I | re.A) for name in UNSEEN}


@dataclass
class Table:
    """An open table: its depth and the cells of its open row, each a list of texts."""

    depth: int
    cells: list[list[str]] | None = None
    in_cell: bool = False


class Open(NamedTuple):
    """An open element with the state that text in it has."""

    names: Counter  # open elements since the innermost cell
    name: str = ""
    kind: str = "paragraph"
    depth: int = 0  # of a heading: its level; of an item: open lists
    lists: int = 0
    item: bool = False  # an item is open in the innermost list
    region: str = "body"
    table: Table | None = None


class Layout:
    def __init__(self):
        self.stack = [Open(Counter())]
        self.lines: list[list[str]] = [[]]
        self.found: list[tuple] = []
        self.tables = 0

    # -------------------------------------------------------------------- text

    def text(self, piece: str) -> None:
        self.lines[-1].append(entities.unescape(piece))

    def flush(self) -> None:
        """Text since the last boundary becomes a block, or part of the open cell."""
        if self.lines == [[]]:
            return
        top = self.stack[-1]
        if top.kind == "pre":
            t = "\n".join("".join(x) for x in self.lines).strip("\r\n")
            t = t if t.strip() else ""
        else:
            t = "\n".join(filter(None, (BLANKS.sub(" ", "".join(x)).strip(" ") for x in self.lines)))
        self.lines = [[]]
        if not t:
            return
        if top.table is not None and top.table.in_cell:
            top.table.cells[-1].append(t)
        else:
            self.found.append((top.kind, top.depth, top.region, t, None))

    # ------------------------------------------------------------------- stack

    def push(self, name: str, **state) -> None:
        top = self.stack[-1]._replace(name=name, **state)
        top.names[name] += 1
        self.stack.append(top)

    def pop(self) -> str:
        self.flush()
        gone = self.stack.pop()
        gone.names[gone.name] -= 1
        if gone.name in CELLS:
            gone.table.in_cell = False
        elif gone.name == "tr":
            cells = [" ".join(c) for c in gone.table.cells]
            gone.table.cells = None
            if any(cells):
                self.found.append(("row", gone.table.depth, gone.region, " | ".join(cells), cells))
        elif gone.name == "table":
            self.tables -= 1
        return gone.name

    def close(self, *names: str) -> None:
        """Take off elements up to the first of these; one of them must be open."""
        while self.pop() not in names:
            pass

    # -------------------------------------------------------------------- tags

    def start(self, name: str) -> None:
        if name == "br":
            self.lines.append([])
            return
        if name == "hr":
            self.flush()
            return
        known = name in HEADINGS or name in LISTS or name in ITEMS or name in CELLS or name in REGIONS or name in PLAIN
        if not known and name not in ("tr", "table", "pre", "title"):
            return  # an inline element: its text goes on
        self.flush()
        if self.stack[-1].name in ("p", "title") or name in HEADINGS and self.stack[-1].name in HEADINGS:
            self.pop()
        top = self.stack[-1]
        if name in HEADINGS:
            self.push(name, kind="heading", depth=HEADINGS[name])
        elif name in LISTS:
            self.push(name, kind="paragraph", depth=0, lists=top.lists + 1, item=False)
        elif name in ITEMS:
            if top.item:
                self.close(*ITEMS)
            self.push(name, kind="item", depth=self.stack[-1].lists, item=True)
        elif name == "table":
            self.tables += 1
            self.push(name, kind="paragraph", depth=0, table=Table(self.tables))
        elif name == "tr" or name in CELLS:
            if top.table is None:
                return  # outside of a table it only parts texts
            self.row(name)
        elif name in ("pre", "title"):
            self.push(name, kind=name, depth=0)
        elif name in REGIONS:
            self.push(name, region=name)
        else:
            self.push(name)

    def row(self, name: str) -> None:
        table = self.stack[-1].table
        if name == "tr" and table.cells is not None:
            self.close("tr")
        elif table.in_cell:
            self.close(*CELLS)
        if table.cells is None:
            table.cells = []
            self.push("tr")
        if name in CELLS:
            table.cells.append([])
            table.in_cell = True
            self.push(name, kind="paragraph", depth=0, lists=0, item=False, names=Counter())

    def end(self, name: str) -> None:
        table = self.stack[-1].table
        if name == "table":
            if table is not None:
                self.close("table")
        elif name == "tr" and table is not None:
            if table.cells is not None:
                self.close("tr")
        elif name in CELLS and table is not None:
            if table.in_cell:
                self.close(*CELLS)
        elif name in ("p", "br"):
            self.flush()
            if self.stack[-1].name == "p":
                self.pop()
        elif self.stack[-1].names[name]:
            self.close(name)
        elif name in PLAIN or name in REGIONS or name in LISTS or name in ITEMS or name in HEADINGS:
            self.flush()  # closes nothing, but parts texts

    def read(self, page: str) -> list[tuple]:
        """``(kind, depth, region, text, cells)`` of a page's blocks."""
        at, quotes = 0, True
        while (lt := page.find("<", at)) >= 0:
            if lt > at:
                self.text(page[at:lt])
            tag = NAME.match(page, lt)
            if tag:
                after = ATTRIBUTES.match(page, tag.end()) if quotes else None
                # a quote left open: from here on the next > ends a tag, so that no tag reads the rest again
                quotes = after is not None
                at = after.end() if after else page.find(">", tag.end()) + 1
                name = tag.group(1).lower()
                if not at:
                    break  # cut off in a tag
                if page[lt + 1] == "/":
                    self.end(name)
                elif name in UNSEEN:
                    over = ENDS[name].search(page, at)
                    if not over:
                        break
                    at = over.start()
                else:
                    self.start(name)
            elif page.startswith("<!--", lt):
                at = page.find("-->", lt + 4) + 3
                if at < 3:
                    break
            elif page[lt + 1 : lt + 2] in ("!", "?", "/"):
                at = page.find(">", lt) + 1
                if not at:
                    break
            elif lt + 1 == len(page):
                break
            else:
                self.text("<")
                at = lt + 1
        else:
            self.text(page[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()
        return self.found


def page_blocks(df: DataFrame, id_col: str, html: str = "html") -> DataFrame:
    """``(id, block, kind, depth, region, text, cells)``, one row for each block of a page, ``block`` from 0.

    ``kind``: title, heading (``depth`` is its level), item (open lists), row of a table
    (open tables; ``cells`` holds its texts, ``text`` them parted by " | "), pre, or
    paragraph for any other text (depth 0).  ``region``: nav, header, footer or aside,
    the innermost open, or body.  Entities are decoded, blanks collapse, <br> is a line break.
    Scripts, styles, comments and the like are left out.  A block within a cell is part of
    it; rows of a table within a cell come before the row of the cell.
    Elements left open end where HTML ends them or with the page; a page cut off in
    a tag, comment or script ends before it.  After a quote that is never closed, a tag ends
    at the next ">".  A null or empty page has no blocks; rows of one id are pages of their own.
    """
    importable(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [id_col, *[c.split(" ")[0] for c in BLOCKS.split(", ")]]
        rows: list[tuple] = []
        for b in batches:
            for key, page in zip(b["id"], b["html"]):
                for i, found in enumerate(Layout().read(page or "")):
                    rows.append((key, i, *found))
                    if len(rows) == ROWS:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)
                rows = []

    pages = df.select(df[id_col].alias("id"), df[html].alias("html")).filter("html IS NOT NULL")
    return pages.mapInPandas(parse, f"`{id_col}` {id_type}, {BLOCKS}")
