"""All visible text of a page, laid out in blocks, lists and aligned tables."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tiermill.llm.common import short_batches

# Fixed values of HTML: which tags hold no content, raw text or nothing visible, and which make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript iframe object svg annotation annotation-xml canvas audio video datalist select"
    " noembed noframes title map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup"
    " option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 ol ul menu pre table hr".split())
PARAGRAPH_ENDS = BLOCKS - frozenset(
    "body html li dt dd td th tr tbody thead tfoot caption option optgroup legend summary".split()
)
# A start tag ends open elements on the left, up to the nearest of those on the right.
IMPLIED_ENDS = {
    "li": ("li", "ol ul menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th caption", "table"),
    "td": ("td th caption", "tr table"),
    "th": ("td th caption", "tr table"),
    "tbody": ("tbody thead tfoot tr td th caption", "table"),
    "thead": ("tbody thead tfoot tr td th caption", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption", "table"),
    "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"),
}
IMPLIED_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED_ENDS.items()}
# What may stand in a head; any other start tag or text ends it.
HEAD = frozenset(
    "head title meta link base basefont bgsound script style noscript template noframes".split()
)
SCOPES = frozenset("html table td th caption object template button".split())

# A quote opens a string only at the start of a value; elsewhere it is a letter like others.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+"
    r"(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s>\"'][^\s>]*+)?)?+)*+)>?",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
# Lists and tables within each other that are indented and aligned.
NESTED = 60
# What browsers take for larger spans.
SPANS = {"colspan": 1000, "rowspan": 65534}
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Open:
    """The open elements from the root down, and the depths at which each tag is open: so the nearest of
    some tags is found without a walk, however many elements a broken page leaves open."""

    def __init__(self, root: Node):
        self.nodes, self.depths = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.depths[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """End all elements from ``depth`` on."""
        while len(self.nodes) > depth:
            self.depths[self.nodes.pop().tag].pop()

    def nearest(self, tags) -> int:
        """The depth of the innermost open element of ``tags``; 0 if there is none."""
        return max([held[-1] for tag in tags if (held := self.depths.get(tag))], default=0)

    def close(self, tags: frozenset, until: frozenset) -> None:
        """End the open elements ``tags`` within the nearest of ``until``, and all within them."""
        border = self.nearest(until)
        while (depth := self.nearest(tags)) > border:
            self.cut(depth)


def parse(page: str) -> Node:
    """The tree of a page. End tags that may be left out are implied; an end tag without a start, and
    what looks like a tag but is none, are dropped or kept as text, as browsers do."""
    root = Node("html", {})
    stack, at = Open(root), 0

    def text(part: str) -> None:
        if stack.nodes[-1].tag == "head" and part.strip(" \t\n\r\f"):
            stack.cut(len(stack.nodes) - 1)
        if part:
            stack.nodes[-1].children.append(html.unescape(part))

    while (found := TOKEN.search(page, at)) is not None:
        text(page[at : found.start()])
        at = found.end()
        end, tag, rest = found.groups()
        if end:
            end = end.lower()
            if end == "p" and not stack.depths["p"]:
                stack.nodes[-1].children.append(Node("p", {}))
            if end == "br":
                stack.nodes[-1].children.append(Node("br", {}))
                continue
            limit = SCOPES - {end} if end not in ("table", "body", "html") else frozenset()
            if (depth := stack.nearest((end,))) > stack.nearest(limit):
                stack.cut(depth)
        elif tag:
            tag = tag.lower()
            attributes = {}
            for name, value in ATTRIBUTE.findall(rest):
                value = value[1:].rstrip(value[0]) if value[:1] in "\"'" and value else value
                attributes.setdefault(name.lower(), html.unescape(value))
            if tag == "html":
                root.attributes.update(attributes)
                continue
            if tag in PARAGRAPH_ENDS:
                stack.close(frozenset({"p"}), SCOPES)
            if tag in IMPLIED_ENDS:
                stack.close(*IMPLIED_ENDS[tag])
            if tag == "body" or (tag not in HEAD and stack.nodes[-1].tag == "head"):
                stack.close(frozenset({"head"}), frozenset())
            if tag in ("td", "th") and stack.nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr", {})
                stack.nodes[-1].children.append(row)
                stack.push(row)
            node = Node(tag, attributes)
            stack.nodes[-1].children.append(node)
            if tag in RAW:
                last = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                inside = page[at : last.start() if last else len(page)]
                at = last.end() if last else len(page)
                if tag == "textarea":
                    node.children.append(html.unescape(inside))
            elif tag not in VOID:
                stack.push(node)
    text(page[at:])
    return root


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attributes:
        return False
    if node.tag == "input" and node.attributes.get("type", "").lower() == "hidden":
        return False
    return not UNSEEN.search(node.attributes.get("style", ""))


class Layout:
    """Lines of text with the blank lines that blocks ask for."""

    def __init__(self):
        self.lines: list[str] = []
        # The parts of the line that is being filled.
        self.current: list[str] = []
        self.blank, self.space = False, False

    def words(self, text: str) -> None:
        for i, part in enumerate(SPACE.split(text)):
            self.space = self.space or i > 0
            if part:
                if self.space and self.current:
                    self.current.append(" ")
                self.current.append(part)
                self.space = False

    def add(self, text: str) -> None:
        """Text as it is, with its blanks."""
        if text:
            self.current.append(text)

    def end_line(self) -> None:
        if self.current:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append("".join(self.current))
            self.blank = False
        self.current, self.space = [], False

    def put(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Whole lines, the first and the others with something before them."""
        self.end_line()
        for i, line in enumerate(lines):
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(((first if i == 0 else rest) + line).rstrip())


def lines_of(node: Node, depth: int = 0) -> list[str]:
    """The lines of what is in a node. Lists and tables nested deeper than NESTED are laid out as plain
    blocks."""
    layout = Layout()
    _inside(node, layout, depth)
    layout.end_line()
    return layout.lines


def _inside(node: Node, layout: Layout, depth: int) -> None:
    # A work list in place of recursion: trees of broken pages are deeper than Python's stack.
    work: list = [("in", c, node, node.tag == "pre") for c in reversed(node.children)]
    numbers: dict[int, int] = {}
    while work:
        what, item, parent, pre = work.pop()
        if what == "out":
            layout.end_line()
            layout.blank = layout.blank or item in SPACED
        elif isinstance(item, str):
            if pre:
                first, *others = item.split("\n")
                layout.add(first)
                for line in others:
                    layout.end_line() if layout.current else layout.put([""])
                    layout.add(line)
            else:
                layout.words(item)
        elif not visible(item):
            continue
        elif item.tag == "br":
            layout.end_line() if layout.current else layout.put([""])
        elif item.tag == "img":
            layout.words(item.attributes.get("alt", ""))
        elif item.tag == "table" and depth < NESTED:
            layout.end_line()
            layout.blank = True
            layout.put(_table(item, depth + 1))
            layout.blank = True
        elif item.tag == "li" and depth < NESTED:
            mark = "- "
            if parent.tag == "ol":
                count = numbers.setdefault(id(parent), 1)
                mark, numbers[id(parent)] = f"{count}. ", count + 1
            layout.put(lines_of(item, depth + 1), mark, " " * len(mark))
        else:
            block = item.tag in BLOCKS
            if block:
                layout.end_line()
                layout.blank = layout.blank or item.tag in SPACED
                work.append(("out", item.tag, None, pre))
            if item.tag == "ol":
                start = item.attributes.get("start", "").strip()
                numbers[id(item)] = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
            inner = pre or item.tag == "pre"
            work.extend(("in", c, item, inner) for c in reversed(item.children))


def _parts(table: Node) -> tuple[list[tuple[Node, Node]], list]:
    """The rows and captions of a table with the row group they are in, and what stands in it outside
    of cells."""
    rows, loose, work = [], [], [(c, table) for c in reversed(table.children)]
    while work:
        item, group = work.pop()
        if isinstance(item, str):
            loose += [item] if item.strip() else []
        elif item.tag in ("tbody", "thead", "tfoot"):
            work.extend([(c, item) for c in reversed(item.children)] if visible(item) else ())
        elif item.tag in ("tr", "caption"):
            if visible(item):
                rows.append((item, group))
                if item.tag == "tr":
                    loose += [c for c in item.children if not _is_cell(c) and str(c).strip()]
        elif item.tag not in ("colgroup", "col"):
            loose.append(item)
    return rows, loose


def _is_cell(item: Node | str) -> bool:
    return isinstance(item, Node) and item.tag in ("td", "th")


def _span(cell: Node, name: str) -> int | None:
    """The columns or rows of a cell; none for those up to the end of the row group."""
    span = cell.attributes.get(name, "").strip()
    if not re.fullmatch("[0-9]+", span):
        return 1
    span = min(int(span.lstrip("0")[:9] or 0), SPANS[name])
    return span or (1 if name == "colspan" else None)


def _table(table: Node, depth: int) -> list[str]:
    """Rows with cells that start in the same column; cells of several lines stay beside each other.
    What stands outside of cells comes before the table."""
    rows, loose = _parts(table)
    before = Node("div", {})
    before.children = loose
    out, grid = lines_of(before, depth), []
    # Columns with a cell of a row above, and for how many rows more.
    last, held = None, {}
    for row, group in rows:
        if row.tag == "caption":
            out += lines_of(row, depth)
            continue
        if group is not last:
            last, held = group, {}
        cells, below = [], {c: n and n - 1 for c, n in held.items() if n != 1}
        for cell in filter(_is_cell, row.children):
            if visible(cell):
                while len(cells) in held:
                    cells.append([""])
                columns, span = _span(cell, "colspan"), _span(cell, "rowspan")
                if span != 1:
                    places = range(len(cells), len(cells) + columns)
                    below.update(dict.fromkeys(places, span and span - 1))
                cells.append(lines_of(cell, depth) or [""])
                cells += [[""]] * (columns - 1)
        held = below
        if any(cells):
            grid.append(cells)
    columns = max(map(len, grid), default=0)
    widths = [
        max((len(line) for cells in grid if i < len(cells) for line in cells[i]), default=0)
        for i in range(columns)
    ]
    for cells in grid:
        for n in range(max(map(len, cells), default=0)):
            line = "  ".join(
                (c[n] if n < len(c) else "").ljust(w) for c, w in zip(cells, widths)
            ).rstrip()
            if line or n:
                out.append(line)
    return out


def render(page: str | None) -> str:
    """The text of a page as a browser shows it, lines separated by line feeds."""
    lines = lines_of(parse(page or ""))
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return "\n".join(lines).replace("\xa0", " ")


def visible_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row of ``pages``: all visible text of ``html``.

    Blocks start new lines and paragraphs, headings, lists and tables have a blank line around them;
    list items have a dash or number and their lines are indented; the cells of a table column start
    at the same place. Scripts, styles, the head, and what ``hidden`` or a style hides are left out.
    Null and empty pages, and pages without visible text, give an empty text. Repeated rows and null
    ids are rendered like others; other columns are ignored; an empty table gives an empty result.
    """
    short_batches(pages.sparkSession, 64)

    def rendered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["text"] = [render(page) for page in frame.pop("html")]
            yield frame

    rows = pages.selectExpr("cast(page_id AS string) AS page_id", "url", "html")
    shown = rows.mapInPandas(rendered, "page_id string, url string, text string")
    return shown.select(shown["page_id"].cast(pages.schema["page_id"].dataType), "url", "text")
