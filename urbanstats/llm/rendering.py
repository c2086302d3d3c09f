"""HTML extraction: a tree with implied tags, rendered as text the way a page is laid out."""

import re
import textwrap
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import functions as F

# Fixed values, from the HTML standard: elements without content,
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements whose content is text up to their end tag,
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
# elements that are never shown,
UNSEEN = frozenset(
    "head script style title template noscript noembed noframes iframe object audio video datalist".split()
)
# elements that start a line of their own, and those of them with a blank line around.
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav
    ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp""".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul xmp".split())
# Elements that end an open paragraph.
_END_P = BLOCKS - frozenset("body dd dt html legend optgroup option tbody td tfoot th thead tr".split())
# A start tag ends the open elements in the first set, up to one in the second.
_LISTS = frozenset("ol ul menu dir".split())
_ROWS = frozenset("tbody thead tfoot".split())
IMPLIED_END = {
    "li": (frozenset(["li"]), _LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["table"])),
    "th": (frozenset(["td", "th"]), frozenset(["table"])),
    "tr": (frozenset(["td", "th", "tr", "caption", "colgroup"]), frozenset(["table"])),
    **{
        tag: (frozenset(["td", "th", "tr", "caption", "colgroup"]) | _ROWS, frozenset(["table"]))
        for tag in ("tbody", "thead", "tfoot")
    },
}
# Start tags that bring a missing parent with them: the parent, and what counts as one.
IMPLIED_START = {
    "td": ("tr", frozenset(["tr"])),
    "th": ("tr", frozenset(["tr"])),
    "tr": ("tbody", _ROWS),
}
MOST_COLUMNS, MOST_ROWS = 1000, 65534
# Cells longer than this are wrapped where others follow in their row.
WIDEST_COLUMN = 80
# Deeper elements join their ancestor at this depth; none of their text is lost.
DEEPEST = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|"
    r"""<([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element; children are elements and texts."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag, attributes):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(text):
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def build_tree(html):
    """The tree of a page, from a root without a name; any text gives one."""
    root = Node("", {})
    stack, count = [root], Counter()

    def open_(tag, attributes):
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if len(stack) < DEEPEST:
            stack.append(node)
            count[tag] += 1

    def cut(i):
        """Close the elements from this depth on."""
        count.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(tags, until):
        """Close the innermost of ``tags`` and what it is directly in of these."""
        if not any(count[t] > 0 for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in until:
                break
            if stack[i].tag in tags:
                lowest = i
                while lowest - 1 > 0 and stack[lowest - 1].tag in tags:
                    lowest -= 1
                cut(lowest)
                return

    at = 0
    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            fence = frozenset() if tag in ("table", "body", "html") else frozenset(["table"])
            for i in range(len(stack) - 1, 0, -1) if count[tag] > 0 else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in fence:
                    break
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
        elif m[2]:
            tag = m[2].lower()
            if tag == "body" and count["body"] > 0:
                continue
            if tag in BLOCKS and stack[-1].tag == "head" and tag != "html":
                cut(len(stack) - 1)
            if tag in _END_P:
                close(frozenset(["p"]), frozenset(["table", "td", "th", "caption", "button", "object"]))
            if tag in IMPLIED_END:
                close(*IMPLIED_END[tag])
            if tag in IMPLIED_START:
                parent, like = IMPLIED_START[tag]
                if parent == "tr" and stack[-1].tag == "table":
                    open_("tbody", {})
                if stack[-1].tag not in like and count["table"] > 0:
                    open_(parent, {})
            attributes = _attributes(m[3]) if m[3].strip("/ \t\n\r\f") else {}
            if tag in VOID:
                stack[-1].children.append(Node(tag, attributes))
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(html, at)
                stop = end.start() if end else len(html)
                node = Node(tag, attributes)
                text = html[at:stop]
                node.children.append(unescape(text) if tag in ("textarea", "title") else text)
                stack[-1].children.append(node)
                closing = html.find(">", stop)
                at = len(html) if end is None or closing < 0 else closing + 1
            else:
                open_(tag, attributes)
    if at < len(html):
        stack[-1].children.append(unescape(html[at:]))
    return root


_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.IGNORECASE)


def _shown(node, parent):
    """Whether an element or a text takes part in the layout at all."""
    if parent.tag == "details" and "open" not in parent.attributes:
        return not isinstance(node, str) and node.tag == "summary"
    if isinstance(node, str):
        return True
    a = node.attributes
    if node.tag in UNSEEN or ("hidden" in a and a["hidden"].lower() != "until-found"):
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and _NOT_SHOWN.search(a["style"]))


class Flow:
    """Lines of text that blocks, indents and list marks are written to."""

    def __init__(self):
        self.lines, self.line, self.open = [], [], False
        self.gap, self.space, self.indents, self.marks = 0, False, [], []

    def write(self, text):
        """Text of a line, with its space collapsed across elements."""
        words = _SPACE.sub(" ", text)
        if words[:1] == " ":
            self.space = True
            words = words[1:]
        trailing = words[-1:] == " "
        words = words[:-1] if trailing else words
        if words:
            self._start()
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(words)
            self.space = False
        self.space |= trailing

    def write_as_is(self, text):
        """Preformatted text: line ends and spaces stay."""
        for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.end_line(forced=True)
            if part:
                self._start()
                self.line.append(part)

    def write_line(self, text):
        self.end_line()
        self._start()
        self.line.append(text)
        self.end_line()

    def _start(self):
        if not self.open:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap, self.open, self.space = 0, True, False
            indent = "".join(self.indents)
            if self.marks:
                mark = "".join(self.marks)
                indent = indent[: max(0, len(indent) - len(mark))] + mark
                self.marks = []
            self.indent = indent

    def end_line(self, forced=False):
        """End the line; ``forced`` leaves an empty one where there is none."""
        if self.open:
            self.lines.append((self.indent + "".join(self.line)).rstrip())
        elif forced and self.lines and not self.gap:
            self.lines.append("")
        self.line, self.open, self.space = [], False, False

    def block(self, spaced):
        self.end_line()
        self.gap = max(self.gap, int(spaced))

    def text(self):
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _number(text, default, least, most):
    digits = re.match(r"\s*(-?\d{1,9})", text or "")
    return min(most, max(least, int(digits[1]))) if digits else default


class Table:
    """Cells of a table by row and column; spans take their places."""

    def __init__(self):
        self.rows, self.taken = [], {}

    def row(self):
        self.rows.append([])
        self.column = 0

    def cell(self, text, attributes):
        if not self.rows:
            self.row()
        r = len(self.rows) - 1
        wide = _number(attributes.get("colspan"), 1, 1, MOST_COLUMNS)
        high = _number(attributes.get("rowspan"), 1, 1, MOST_ROWS)
        while self.taken.get(self.column, 0) > r:
            self.column += 1
        self.rows[-1].append((self.column, wide, text.split("\n") if text else [""]))
        if high > 1:
            for c in range(self.column, self.column + wide):
                self.taken[c] = r + high
        self.column += wide

    def render(self):
        """Lines in which each cell starts at its column's place, two spaces after the one before.

        A column is as wide as its widest line of at most ``WIDEST_COLUMN``; columns that a
        spanning cell covers share what it lacks. Only cells that others follow are wrapped
        and make spanned columns wider. Where a line cannot be wrapped and is too wide, the
        cells after it stand on the next line, still at their places.
        """
        columns = sorted({c for row in self.rows for c, _, _ in row})
        index = {c: i for i, c in enumerate(columns)}
        widths, spans = [0] * len(columns), []
        rows = [[[index[c], lines] for c, _, lines in row] for row in self.rows]
        for row, cells in zip(self.rows, rows):
            for k, (column, wide, _) in enumerate(row):
                cell, followed = cells[k], k + 1 < len(row)
                end = bisect_left(columns, column + wide)
                if end - cell[0] > 1:
                    if followed:
                        spans.append((end, cell))
                    continue
                if followed:
                    cell[1] = _wrapped(cell[1], WIDEST_COLUMN)
                widths[cell[0]] = max(widths[cell[0]], _widest(cell[1], WIDEST_COLUMN))
        for end, cell in sorted(spans, key=lambda s: (s[0] - s[1][0], s[0])):
            start, n = cell[0], end - cell[0]
            room = sum(widths[start:end]) + 2 * (n - 1)
            most = max(WIDEST_COLUMN, room)
            cell[1] = _wrapped(cell[1], most)
            lack = max(0, _widest(cell[1], most) - room)
            for i in range(n if lack else 0):
                widths[start + i] += lack * (i + 1) // n - lack * i // n
        place = [0, *accumulate(w + 2 for w in widths)]
        out = []
        for cells in rows:
            for k in range(max((len(lines) for _, lines in cells), default=0)):
                line = ""
                for column, lines in cells:
                    if k < len(lines) and lines[k]:
                        if line and len(line) + 2 > place[column]:
                            out.append(line.rstrip())
                            line = ""
                        line = line.ljust(place[column]) + lines[k]
                out.append(line.rstrip())
        return [line for line in out if line]


def _widest(lines, most):
    return max((len(line) for line in lines if len(line) <= most), default=0)


def _wrapped(lines, width):
    """Lines cut at spaces to ``width``. Words stay whole, and so do lines with runs of
    space within them, as those are aligned already."""
    out = []
    for line in lines:
        text = line.strip(" ")
        if len(line) <= width or "  " in text:
            out.append(line)
            continue
        indent = line[: min(len(line) - len(line.lstrip(" ")), width // 2)]
        out += textwrap.wrap(
            text,
            width,
            initial_indent=indent,
            subsequent_indent=indent,
            expand_tabs=False,
            replace_whitespace=False,
            break_long_words=False,
            break_on_hyphens=False,
        )
    return out


def render(root):
    """The visible text of a tree, laid out in lines."""
    flows, tables, lists = [Flow()], [], []
    # Entries: an element to enter or to leave, its parent, visible, preformatted.
    todo = [(False, root, root, True, False)]
    while todo:
        leaving, node, parent, visible, as_is = todo.pop()
        flow = flows[-1]
        if leaving:
            _leave(node, flows, tables, lists)
            continue
        if not _shown(node, parent):
            continue
        if isinstance(node, str):
            if visible:
                flow.write_as_is(node) if as_is else flow.write(node)
            continue
        tag = node.tag
        style = _VISIBILITY.search(node.attributes.get("style", ""))
        visible = style[1].lower() == "visible" if style else visible
        as_is = as_is or tag in ("pre", "textarea", "xmp")
        if tag == "br":
            flow.end_line(forced=True)
            continue
        if tag == "input":
            if visible and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                flow.write(node.attributes.get("value", ""))
            continue
        _enter(node, visible, flows, tables, lists)
        todo.append((True, node, parent, visible, as_is))
        children = node.children
        if tag in ("pre", "textarea") and children and isinstance(children[0], str):
            # The standard drops a line end right after the start tag.
            children = [re.sub(r"\A\r?\n", "", children[0]), *children[1:]]
        todo.extend((False, child, node, visible, as_is) for child in reversed(children))
    return flows[0].text()


def _enter(node, visible, flows, tables, lists):
    tag, flow = node.tag, flows[-1]
    if tag == "table":
        flow.block(True)
        tables.append(Table())
    elif tag == "tr" and tables:
        tables[-1].row()
    elif tag in ("td", "th", "caption") and tables:
        flows.append(Flow())
    elif tag in BLOCKS:
        flow.block(tag in SPACED and not (tag in _LISTS and lists))
    if tag in _LISTS:
        start = _number(node.attributes.get("start"), 1, -(10**9), 10**9)
        lists.append([tag == "ol", start])
    elif tag == "li":
        numbered, n = lists[-1] if lists else (False, 0)
        if lists:
            lists[-1][1] = n = _number(node.attributes.get("value"), n, -(10**9), 10**9)
            lists[-1][1] += 1
        mark = f"{n}. " if numbered else "- "
        flow.indents.append(" " * len(mark))
        if visible:
            flow.marks.append(mark)
    elif tag in ("dd", "blockquote"):
        flow.indents.append("  ")


def _leave(node, flows, tables, lists):
    tag, flow = node.tag, flows[-1]
    if tag in ("li", "dd", "blockquote"):
        flow.end_line()
        flow.indents.pop()
        if tag == "li":
            flow.marks = []
    if tag in _LISTS:
        lists.pop()
    if tag == "table":
        for line in tables.pop().render():
            flow.write_line(line)
        flow.block(True)
    elif tag in ("td", "th", "caption") and tables:
        text = flows.pop().text()
        if tag == "caption":
            for line in text.split("\n"):
                if line:
                    flows[-1].write_line(line)
        else:
            tables[-1].cell(text, node.attributes)
    elif tag in BLOCKS:
        flow.block(tag in SPACED and not (tag in _LISTS and lists))


def visible_text(html):
    """All text of a page that is shown, laid out in lines."""
    return render(build_tree(html)) if html else ""


def extract_text(pages, html_column="html", id_column="page_id"):
    """One row per row of ``pages``: its id, and ``text``, what a reader of the page sees.

    Missing and implied tags are put in place, unclosed and misnested ones closed. Blocks
    stand on lines of their own, paragraphs, headings, lists and tables between blank
    lines. Items carry ``-`` or their number and are indented by depth; the cells of a
    table start at their column's place in every row; cells over 80 characters are wrapped
    where others follow them.
    Space collapses but in preformatted text. Left out is what is not shown: head,
    scripts, styles, templates, comments, and elements that ``hidden``, ``display:none``,
    ``visibility:hidden``, a closed ``details`` or ``dialog`` hide.

    A NULL or empty page gives an empty text. NULL and repeated ids give a row each; other
    columns are ignored. A page of any length is rendered whole. An empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield rows.map(visible_text)

    html = F.coalesce(F.col(f"`{html_column}`"), F.lit(""))
    return pages.select(F.col(f"`{id_column}`"), text(html).alias("text"))
