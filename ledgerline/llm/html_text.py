"""HTML extraction by layout: a tree with implied tags, visibility, rendering.

``parse`` builds the element tree as browsers do: void elements have no content,
an end tag closes what is open inside it, start tags imply the end of what cannot
hold them (a block ends an open paragraph, an item the item before it, a cell the
cell before it); parts of a table open the rows they need and close what is in
between, other content of a table that is not in a cell goes before the table,
a form tag between cells counts for nothing; ``svg`` and ``math`` may close
themselves and end at the first ordinary HTML tag.  Comments, declarations and tags
that never end reach to the end of the page.  ``visible_text`` lays the tree out,
without recursion:

* hidden are scripts, styles, templates, the head and other content that no
  browser shows, elements with ``hidden`` or ``aria-hidden="true"`` or an inline
  style ``display:none``, closed ``details`` but for their summary, closed dialogs,
  text of drawings outside their ``text`` elements, and text under
  ``visibility:hidden`` or ``collapse`` unless a descendant turns visible again; of a
  drop-down list the chosen option is shown, of a list box all; of inputs the
  labels of buttons;
* a block starts a new line; paragraphs, headings, lists and tables stand
  apart by a blank line; ``br`` breaks the line; other white space collapses
  to one space, but ``pre`` and ``textarea`` keep theirs;
* items get ``- `` or their number, indented by depth of the list;
* table cells are padded to their column's width and joined by `` | ``, rows of the
  head first and of the foot last; a cell of several columns is as wide as these
  together, one of several rows leaves its place blank in the rows below; a
  nested table is laid out inside its cell on one line, however deep it is.

Null and empty pages give the empty text.  A page's tree and lines are held in
memory while it is rendered, one page at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names as HTML groups them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("""script style template head title noscript noframes noembed iframe object audio video canvas datalist
    annotation annotation-xml""".split())
BLOCK = frozenset("""html body address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table
    caption textarea ul""".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table pre blockquote figure hr".split())
ENDS_P = BLOCK - frozenset("html body li dd dt caption legend summary option optgroup textarea figcaption".split())
LISTS = frozenset("ul ol menu dir".split())
VERBATIM = frozenset("pre textarea".split())
SECTIONS = frozenset("tbody thead tfoot".split())
TABLE_PARTS = SECTIONS | frozenset("caption colgroup col tr td th".split())
OUTSIDE_CELLS = SECTIONS | frozenset("table tr colgroup".split())       # only parts of the table go here
# start tag: the open elements that it ends, and those it doesn't look beyond
IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
SCOPES = frozenset("table td th caption html foreignobject".split())     # an end tag doesn't reach through these
FOREIGN = ("svg", "math")
# in these, content of svg and math is ordinary HTML again
BACK_TO_HTML = ("foreignobject", "desc", "mi", "mo", "mn", "ms", "mtext")
ENDS_FOREIGN = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu
    meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
DRAWN_TEXT = ("text", "foreignobject")
BUTTONS = ("submit", "button", "reset")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDES = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBLE = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


class _Builder(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.at: defaultdict[str, list[int]] = defaultdict(list)      # tag -> its places among the open elements

    # ------------------------------------------------------------ what never ends reaches to the end of the page
    def parse_comment(self, i: int, report: bool = True) -> int:
        m = re.compile(r"--!?>|(?<=<!--)-?>").search(self.rawdata, i + 4)
        return m.end() if m else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        return self._past(i + 2)

    def parse_pi(self, i: int) -> int:
        return self._past(i + 2)

    def _past(self, i: int) -> int:
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        end = super().parse_starttag(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_endtag(self, i: int) -> int:
        end = super().parse_endtag(i)
        return end if end >= 0 else len(self.rawdata)

    # ------------------------------------------------------------ the open elements
    def _top(self, tag: str) -> int:
        """The place of the innermost open element of a tag, 0 without one."""
        return self.at[tag][-1] if self.at[tag] else 0

    def _end_to(self, tags: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` within the limits."""
        floor = max((self._top(t) for t in limits), default=0)
        found = [self.at[t][n] for t in tags if (n := bisect_right(self.at[t], floor)) < len(self.at[t])]
        if found:
            self._close(min(found))

    def _close(self, at: int) -> None:
        for n in self.open[at:]:
            self.at[n.tag].pop()
        del self.open[at:]

    def _push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.open))
        self.open.append(node)

    def _add(self, child: Node | str) -> None:
        """Into the open element; before the table, if that takes no such content."""
        text = isinstance(child, str)
        if self.open[-1].tag in OUTSIDE_CELLS and (child.strip() if text else child.tag not in TABLE_PARTS | {"script", "style", "template"}):
            self.open[self._top("table") - 1].children.insert(-1, child)     # an open table is its parent's last child
        else:
            self.open[-1].children.append(child)

    def _foreign(self) -> int:
        """The place of the ``svg`` or ``math`` element whose content this is, or 0."""
        inner = max(self._top(t) for t in FOREIGN)
        return inner if inner > max(self._top(t) for t in BACK_TO_HTML) else 0

    # ------------------------------------------------------------ tags and text
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]], closed: bool = False) -> None:
        node = Node(tag, dict(reversed(attrs)))               # the first of repeated attributes counts
        if self._foreign() and tag in ENDS_FOREIGN:
            while at := self._foreign():
                self._close(at)
        if self._foreign():
            self._add(node)
            if not closed:
                self._push(node)
            return
        if tag in TABLE_PARTS:
            self._table_part(node)
            return
        if self.open[-1].tag in OUTSIDE_CELLS and tag == "form":
            return
        if self.open[-1].tag in OUTSIDE_CELLS and tag == "table":
            self._close(self._top("table"))
        if tag in ENDS_P:
            self._end_to({"p"}, SCOPES | LISTS)
        if tag in IMPLIED:
            self._end_to(*IMPLIED[tag])
        elif self.open[-1].tag == "head" and tag not in UNSEEN and tag not in VOID:
            self._close(len(self.open) - 1)                   # content ends the head
        self._add(node)
        if tag == "input" and (node.attrs.get("type") or "").lower() in BUTTONS and node.attrs.get("value"):
            node.children.append(node.attrs["value"])
        if tag not in VOID and not (closed and tag in FOREIGN):
            self._push(node)

    def _table_part(self, node: Node) -> None:
        """A cell, row, group or caption: close what is open up to where it belongs."""
        table = self._top("table")
        if not table:
            return                                            # outside of tables these tags count for nothing
        group = max([t for s in SECTIONS if (t := self._top(s)) > table], default=table)
        parent = table
        if node.tag in ("td", "th"):
            parent = self._top("tr") if self._top("tr") > table else group
        elif node.tag == "tr":
            parent = group
        elif node.tag == "col" and self._top("colgroup") > table:
            parent = self._top("colgroup")
        self._close(parent + 1)
        if node.tag in ("td", "th") and self.open[-1].tag != "tr":
            row = Node("tr")
            self.open[-1].children.append(row)
            self._push(row)
        self.open[-1].children.append(node)
        if node.tag != "col":
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs, closed=True)         # the slash counts for foreign elements only

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
            return
        found = self._top(tag)
        if tag in TABLE_PARTS:
            reaches = found > self._top("table")
        else:
            reaches = tag in ("table", "body", "html") or found >= max(self._top(t) for t in SCOPES)
        if found and reaches:
            self._close(found)

    def handle_data(self, data: str) -> None:
        if self.cdata_elem in ("textarea", "title"):
            data = unescape(data)
        if self._top("svg") and not any(self._top(t) > self._top("svg") for t in DRAWN_TEXT):
            return
        self._add(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.rawdata = html
    builder.goahead(1)
    if builder.cdata_elem == "textarea":                      # one that never ends
        builder.handle_data(builder.rawdata)
    return builder.root


class _Page:
    """Lines under construction; ``gap`` is set when a blank line is due."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        self.space = False
        self.prefix = ""

    def text(self, s: str, verbatim: bool) -> None:
        if verbatim:
            first, *rest = s.split("\n")
            self._put(first)
            for part in rest:
                self.end_line(keep=True)
                self._put(part)
            return
        words = _SPACE.split(s)
        self.space = self.space or (words[0] == "" and len(words) > 1)
        for i, w in enumerate(words):
            if w:
                self._put((" " if (self.space or i) and self.line else "") + w)
                self.space = False
        self.space = bool(words[-1] == "" and len(words) > 1) or self.space

    def _put(self, s: str) -> None:
        if s:
            self.line.append(s)

    def end_line(self, keep: bool = False) -> None:
        s = "".join(self.line)
        if s.strip() or keep:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append((self.prefix + s).rstrip())
            self.prefix = " " * len(self.prefix)
        self.line, self.space = [], False

    def done(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """Whether the element is laid out, and whether its text is visible."""
    style = node.attrs.get("style") or ""
    if (node.tag in UNSEEN or "hidden" in node.attrs or (node.attrs.get("aria-hidden") or "").lower() == "true" or _HIDES.search(style)
            or (node.tag == "dialog" and "open" not in node.attrs)):
        return False, False
    for m in _VISIBLE.finditer(style):
        visible = m[1].lower() == "visible"
    return True, visible


def _number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?[0-9]{1,6}", value.strip()) else default


def _content(node: Node) -> list[Node | str]:
    """The children that are laid out: of closed details the summary, of a
    drop-down list the chosen option."""
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag != "select":
        return node.children
    options, stack = [], list(reversed(node.children))
    while stack:
        n = stack.pop()
        if isinstance(n, Node) and _shown(n, True)[0]:
            if n.tag == "option":
                options.append(n)
            else:
                stack.extend(reversed(n.children))
    for o in options:
        if o.attrs.get("label"):
            o.children = [o.attrs["label"]]
    if "multiple" in node.attrs or _number(node.attrs.get("size"), 1) > 1:
        return options
    chosen = [o for o in options if "selected" in o.attrs][-1:] or [o for o in options if "disabled" not in o.attrs][:1]
    return chosen[0].children if chosen else []


States = dict[Node, bool]          # laid-out elements -> whether their text is visible
Laid = dict[Node, list[str]]       # tables -> their lines


def _states(root: Node) -> tuple[States, list[Node]]:
    """The laid-out elements, and the tables among them, outer ones first."""
    states: States = {}
    tables = []
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, visible = stack.pop()
        out, visible = _shown(node, visible)
        if not out:
            continue
        states[node] = visible
        if node.tag == "table":
            tables.append(node)
        node.children = _content(node)
        stack.extend((c, visible) for c in reversed(node.children) if isinstance(c, Node))
    return states, tables


def _flow(children: list[Node | str], visible: bool, states: States, laid: Laid) -> str:
    """The text of some content, from an explicit stack of steps."""
    page = _Page()
    verbatim, lists, counts = 0, 0, []
    steps: list[tuple[bool, Node | str, bool]] = [(True, c, visible) for c in reversed(children)]
    while steps:
        opens, node, seen = steps.pop()
        if isinstance(node, str):
            if seen:
                page.text(node, verbatim > 0)
            continue
        if not opens:
            verbatim -= node.tag in VERBATIM
            if node.tag in LISTS:
                lists -= 1
                counts.pop()
            if node.tag in BLOCK:
                page.end_line()
                page.gap = page.gap or (node.tag in APART and not (lists and node.tag in LISTS))
                if node.tag == "li":
                    page.prefix = ""
            continue
        if node not in states:
            continue
        if node.tag == "br":
            page.end_line(keep=bool(page.line))
            continue
        if node.tag in BLOCK:
            page.end_line()
            page.gap = page.gap or (node.tag in APART and not (lists and node.tag in LISTS))
        if node.tag in LISTS:
            lists += 1
            counts.append(_number(node.attrs.get("start"), 1) if node.tag == "ol" else None)
        if node.tag == "li":
            indent = "  " * max(0, lists - 1)
            mark = "- "
            if counts and counts[-1] is not None:
                counts[-1] = _number(node.attrs.get("value"), counts[-1])
                mark = f"{counts[-1]}. "
                counts[-1] += 1
            page.prefix = indent + mark
        if node.tag == "table":
            for line in laid[node]:
                page.line = [line]
                page.end_line()
            page.gap = True
            continue
        verbatim += node.tag in VERBATIM
        steps.append((False, node, states[node]))
        steps.extend((True, c, states[node]) for c in reversed(node.children))
    return page.done()


def _rows(table: Node, states: States) -> list[tuple[Node, int]]:
    """The laid-out rows, head first and foot last, each with the rows that follow in its group."""
    parts: dict[str, list[list[Node]]] = {"thead": [], "tbody": [], "tfoot": []}
    loose: list[Node] = []
    for c in table.children:
        if isinstance(c, Node) and c in states and c.tag == "tr":
            if not loose:
                parts["tbody"].append(loose)
            loose.append(c)
        elif isinstance(c, Node) and c in states and c.tag in SECTIONS:
            loose = []
            parts[c.tag].append([r for r in c.children if isinstance(r, Node) and r.tag == "tr" and r in states])
    groups = [g for name in ("thead", "tbody", "tfoot") for g in parts[name]]
    return [(r, len(g) - i - 1) for g in groups for i, r in enumerate(g)]


def _table_lines(table: Node, states: States, laid: Laid) -> list[str]:
    """A table's captions and aligned rows; the tables in its cells are laid out already."""
    lines: list[str] = []
    for c in table.children:
        if isinstance(c, Node) and c.tag == "caption" and c in states:
            lines += [line for line in _flow(c.children, states[c], states, laid).split("\n") if line]
    grid: list[list[tuple[int, int, str]]] = []              # per row (column, columns, text)
    held: list[tuple[int, int, int]] = []                    # from rows above: (column, end, rows left)
    for row, below in _rows(table, states):
        at, cells = 0, [(a, b - a, "") for a, b, _ in held]
        new = []
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in ("td", "th") or cell not in states:
                continue
            span = max(1, min(1000, _number(cell.attrs.get("colspan"), 1)))
            down = _number(cell.attrs.get("rowspan"), 1)
            down = below if down == 0 else max(0, min(down - 1, below))
            for a, b, _ in held:                             # sorted: skip the places taken from above
                if a <= at < b:
                    at = b
            cells.append((at, span, _SPACE.sub(" ", _flow(cell.children, states[cell], states, laid)).strip()))
            if down:
                new.append((at, at + span, down))
            at += span
        held = sorted([(a, b, n - 1) for a, b, n in held if n > 1] + new)
        if any(text for _, _, text in cells):
            grid.append(sorted(cells))
    used = sorted({at for cells in grid for at, _, _ in cells})
    widths = [0] * len(used)
    for at, span, text in sorted((c for cells in grid for c in cells), key=lambda c: c[1]):
        first, end = bisect_left(used, at), bisect_left(used, at + span)
        widths[end - 1] += max(0, len(text) - sum(widths[first:end]) - 3 * (end - first - 1))
    for cells in grid:
        parts = []
        for at, span, text in cells:
            first, end = bisect_left(used, at), bisect_left(used, at + span)
            parts.append(text.ljust(sum(widths[first:end]) + 3 * (end - first - 1)))
        lines.append(" | ".join(parts).rstrip())
    return lines


def visible_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    states, tables = _states(root)
    laid: Laid = {}
    for table in reversed(tables):
        laid[table] = _table_lines(table, states, laid)
    return _flow(root.children, True, states, laid)


def text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([visible_text(p) for p in pages], dtype="object")
    return extract(html)


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(id_col, text, n_lines)`` for every row of ``pages``; ids may be null
    or repeated, other columns are not read."""
    rows = pages.select(F.col(id_col).alias("id"), text_column(F.col(html_col)).alias("text"))
    return rows.select(F.col("id").alias(id_col), "text",
                       F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"))
