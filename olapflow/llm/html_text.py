"""HTML to text by layout: a tree with implied tags, visibility rules, and a renderer.

Markup is cut into tags and text by one pattern. The tree builder closes elements whose
end tags HTML lets authors leave out, ignores end tags that match nothing, and drops what
browsers do not show. SVG and MathML elements are told from those of HTML by a prefix of
their tags, and opened and closed by the rules of foreign content. The renderer walks the tree without recursion and keeps the layout:
blocks on lines of their own, blank lines where blocks have margins, list markers with
indentation, preformatted text as it is, and table cells padded to columns.
"""

from __future__ import annotations

import bisect
import html
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements that are not shown at all.
UNSEEN = frozenset(
    "head title script style template noscript noembed noframes iframe object audio video canvas datalist meta link "
    "base map colgroup col rp".split()
) | {
    *(f"svg {tag}" for tag in (
        "defs title desc metadata script style symbol clippath mask marker pattern lineargradient radialgradient filter".split()
    )), "math mphantom",
}
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul caption xmp listing plaintext".split()
)
#: Blocks with a margin: a blank line parts them from their neighbours.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote figure pre table hr fieldset xmp listing".split())
#: HTML tags that end foreign content.
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Foreign elements on lines of their own, those with parts to keep apart, and those that show one child.
_OWN_LINE = frozenset({"svg text", "svg foreignobject"})
_APART = frozenset({"math mfrac", "math mtable", "math mtr", "math mlabeledtr"})
_ONE_CHILD = frozenset({"svg switch", "math semantics", "math maction"})
_CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption option optgroup legend".split())
#: Foreign elements in which markup is HTML again, and which end the search for open elements.
_HTML_INSIDE = frozenset({"svg foreignobject", "svg desc", "svg title"})
_TOKENS = frozenset({"math mi", "math mo", "math mn", "math ms", "math mtext"})
_POINTS = _HTML_INSIDE | _TOKENS | {"math annotation-xml"}
#: Opening the first closes an open element of the second, looked for up to the third.
_CELL, _TABLE = frozenset({"td", "th"}), frozenset({"table", "html"}) | _POINTS
_P_SCOPE = frozenset("table td th button caption object html".split()) | _POINTS
_IMPLIED = {
    "li": ({"li"}, frozenset("ul ol menu dir html".split())),
    "dt": ({"dt", "dd"}, frozenset({"dl", "html"})),
    "dd": ({"dt", "dd"}, frozenset({"dl", "html"})),
    "td": (_CELL, frozenset({"tr", "table", "html"})),
    "th": (_CELL, frozenset({"tr", "table", "html"})),
    "tr": ({"tr"}, _TABLE),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "option": ({"option"}, frozenset({"select", "datalist", "html"})),
    "optgroup": ({"option", "optgroup"}, frozenset({"select", "html"})),
    "rt": ({"rt", "rp"}, frozenset({"ruby", "html"})),
    "rp": ({"rt", "rp"}, frozenset({"ruby", "html"})),
    "body": ({"head"}, frozenset({"html"})),
}
_IMPLIED = {tag: (closed, stop | _POINTS) for tag, (closed, stop) in _IMPLIED.items()}
_HEAD = frozenset("head title base link meta style script template noscript html".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?/](?![A-Za-z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:[\"'][^>]*+)?)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
#: A slash at the end of an unquoted value belongs to the value.
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'][^\s]*\Z")
#: References to numbers with more digits than any character has, and with leading zeros.
_LONG_NUMBER, _ZEROS = re.compile(r"&#0*[1-9][0-9]{7,};?"), re.compile(r"&#0{7,}(?=[0-9])")
#: Columns of indentation at most; columns that the cells above leave empty in a row, and
#: columns or times the mean width of its cells that a table column is padded to at most.
#: So the text of a page stays within a constant factor of the page.
MOST_INDENT, MOST_GAP, MOST_PADDING, MEAN_PADDING = 80, 160, 80, 4
_GAP = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "shown", "words")

    def __init__(self, tag: str, attributes: dict[str, str], shown: bool):
        self.tag, self.attributes, self.children, self.shown = tag, attributes, [], shown
        self.words = True  # whether text right inside is shown


def _unescape(text: str) -> str:
    """Character references resolved; numbers beyond all characters become U+FFFD."""
    if "&#" in text:
        text = _ZEROS.sub("&#0", _LONG_NUMBER.sub("\ufffd", text))
    return html.unescape(text)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), _unescape(double or single or bare))
    return found


def _is_shown(tag: str, attributes: dict[str, str]) -> bool:
    if tag in UNSEEN or "hidden" in attributes or (tag == "input" and attributes.get("type", "").lower() == "hidden"):
        return False
    if tag.startswith("svg ") and (
        attributes.get("display", "").strip() == "none" or attributes.get("visibility", "").strip() in ("hidden", "collapse")
    ):
        return False
    style = re.sub(r"\s", "", attributes.get("style", "")).lower()
    return not ("display:none" in style or "visibility:hidden" in style or "visibility:collapse" in style)


def parse(source: str) -> Node:
    """Tree of a page. The root is ``html``; its head, if any, is a child that is not shown."""
    root = Node("html", {}, True)
    stack = [root]
    opened: dict[str, list[int]] = {}  # where in the stack the open elements of each tag are
    plain = [0]  # where those of HTML are
    at, size = 0, len(source)

    def push(node: Node) -> None:
        opened.setdefault(node.tag, []).append(len(stack))
        if " " not in node.tag:
            plain.append(len(stack))
        stack.append(node)

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop().tag
            opened[tag].pop()
            if " " not in tag:
                plain.pop()

    def innermost(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def close(tags, stop) -> None:
        depth = innermost(tags)
        if depth and depth >= innermost(stop):
            pop_to(depth)

    def add(text: str) -> None:
        top = stack[-1]
        if top.words and (text.strip() or not top.tag.startswith("math ") or top.tag in _TOKENS):
            top.children.append(text)

    def is_foreign(tag: str) -> bool:
        """Whether a start tag is one of the foreign content that is open."""
        top = stack[-1]
        if " " not in top.tag or top.tag in _HTML_INSIDE:
            return False
        if top.tag in _TOKENS:
            return tag in ("mglyph", "malignmark")
        if top.tag == "math annotation-xml":
            encoding = top.attributes.get("encoding", "").lower()
            return tag != "svg" and encoding not in ("text/html", "application/xhtml+xml")
        return True

    def break_out() -> None:
        while " " in stack[-1].tag and stack[-1].tag not in _HTML_INSIDE and stack[-1].tag not in _TOKENS:
            pop_to(len(stack) - 1)

    while at < size:
        m = _MARKUP.search(source, at)
        text = source[at : m.start() if m else size]
        if text:
            if stack[-1].tag == "head" and text.strip():
                pop_to(len(stack) - 1)  # text ends the head
            add(_unescape(text) if "&" in text else text)
        if not m:
            break
        at, tag = m.end(), (m.group(2) or "").lower()
        if not tag:
            if " " in stack[-1].tag and source.startswith("<![CDATA[", m.start()):
                end = source.find("]]>", m.start() + 9)
                add(source[m.start() + 9 : end if end >= 0 else size])
                at = end + 3 if end >= 0 else size
            continue
        if m.group(1):
            if " " in stack[-1].tag:
                if tag in ("p", "br"):
                    break_out()
                depth = innermost((f"svg {tag}", f"math {tag}"))
                if depth > plain[-1]:
                    pop_to(depth)
                    continue
            if tag == "p" and not opened.get("p"):
                stack[-1].children.append(Node("p", {}, True))  # a stray end tag makes an empty paragraph
            elif tag == "br":
                stack[-1].children.append(Node("br", {}, True))
            elif tag not in ("html", "body"):
                limit = _POINTS if tag == "table" else _TABLE if tag in BLOCK else _TABLE | _CELL
                close(_HEADINGS if tag in _HEADINGS else {tag}, limit - {tag})
            continue
        attributes = _attributes(m.group(3)) if m.group(3) else {}
        foreign = is_foreign(tag)
        if foreign and (tag in _BREAKOUT or (tag == "font" and attributes.keys() & {"color", "face", "size"})):
            break_out()
            foreign = False
        if foreign or tag in ("svg", "math"):
            if stack[-1].tag == "head":
                pop_to(len(stack) - 1)
            name = f"{stack[-1].tag.split(' ')[0] if foreign else tag} {tag}"
            node = Node(name, attributes, _is_shown(name, attributes))
            if name.startswith("svg "):  # of its text, a drawing shows what is inside of text elements
                inside = stack[-1].words and stack[-1].tag.startswith("svg ") and stack[-1].tag not in _HTML_INSIDE
                node.words = name in ("svg text", "svg foreignobject") or (inside and tag != "svg")
            stack[-1].children.append(node)
            slash = m.group(3).endswith("/") and not _UNQUOTED_END.search(_QUOTED.sub('""', m.group(3)))
            if not slash:
                push(node)
            continue
        if tag == "html" or (tag == "body" and opened.get("body")):
            continue
        if stack[-1].tag == "head" and tag not in _HEAD:
            pop_to(len(stack) - 1)
        if tag in _CLOSES_P:
            close({"p"}, _P_SCOPE)
        if tag in _IMPLIED:
            close(*_IMPLIED[tag])
        node = Node(tag, attributes, _is_shown(tag, attributes))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            content = source[at : end.start() if end else size]
            if content:
                node.children.append(_unescape(content) if tag in ("textarea", "title") else content)
            at = end.end() if end else size
        elif tag not in VOID:
            push(node)
    return root


class _Lines:
    """Text in progress: finished lines, the open line, and what must come before more text."""

    def __init__(self):
        self.lines: list[str] = []
        self.open: list[str] = []
        self.blank = self.space = False
        self.indent, self.marker = "", ""

    def add(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.lines.append(self._line())
                self.open = []
                self._put(line)
            return
        words = _GAP.split(text)
        if len(words) == 1:
            self._word(words[0])
            return
        for i, word in enumerate(words):
            if i:
                self.space = True
            self._word(word)

    def _word(self, word: str) -> None:
        if word:
            if self.space and self.open:
                word = " " + word
            self.space = False
            self._put(word)

    def _put(self, text: str) -> None:
        if not text and not self.open:
            return
        if not self.open:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.open.append(self.indent + self.marker)
            if self.marker:
                self.marker = " " * len(self.marker)
                self.indent, self.marker = (self.indent + self.marker)[:MOST_INDENT], ""
        self.open.append(text)

    def _line(self) -> str:
        return "".join(self.open).rstrip(" ")

    def end_line(self, force: bool = False) -> None:
        if self.open:
            self.lines.append(self._line())
            self.open = []
        elif force and self.lines:
            self.lines.append("")
        self.space = False

    def end_block(self, spaced: bool) -> None:
        self.end_line()
        self.blank |= spaced and bool(self.lines)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _width(text: str) -> int:
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _span(node: Node, name: str, least: int, most: int) -> int:
    """A span as HTML reads it: its leading digits, at most ``most``; 1 without any."""
    digits = re.match(r"[ \t\n\r\f]*\+?0*([0-9]*)", node.attributes.get(name, "1"))
    given = digits.group(0).strip(" \t\n\r\f+")
    if not given:
        return 1
    value = int(digits.group(1)[:6] or 0)
    return max(min(value, most), least) if value or not least else 1


def _rows(table: Node) -> Iterator[tuple[int, list[Node]]]:
    """Rows of a table, in order, each with the number of its group; those of nested tables
    are left out, and stray content is a row."""
    stray: list = []
    groups = itertools.count(1)
    work = [(0, child) for child in reversed(table.children)]
    for_stray = 0
    while work:
        group, node = work.pop()
        if isinstance(node, Node) and (not node.shown or node.tag == "caption"):
            continue
        if isinstance(node, Node) and node.tag in ("tbody", "thead", "tfoot"):
            group = next(groups)
            work.extend((group, child) for child in reversed(node.children))
        elif isinstance(node, Node) and node.tag == "tr":
            if stray:
                yield for_stray, [_cell(stray)]
                stray = []
            cells, loose = [], []
            for child in node.children:
                if isinstance(child, Node) and child.tag in _CELL:
                    if loose:
                        cells.append(_cell(loose))
                        loose = []
                    if child.shown:
                        cells.append(child)
                elif isinstance(child, Node) or child.strip():
                    loose.append(child)
            yield group, cells + ([_cell(loose)] if loose else [])
        elif isinstance(node, Node) or node.strip():
            stray.append(node)
            for_stray = group
    if stray:
        yield for_stray, [_cell(stray)]


def _cell(children: list) -> Node:
    node = Node("td", {}, True)
    node.children = children
    return node


def _placed(rows: list[tuple[int, list[tuple[Node, str]]]]) -> list[list[tuple[int, int, str]]]:
    """Per row its cells as (column, columns it spans, text). Cells that reach down from
    above keep their columns, within their group of rows. Columns in which no cell begins
    take no room and are left out of the count."""
    placed: list[list[tuple[int, int, str]]] = []
    above: list[tuple[int, int, int]] = []  # (first column, end, last row), by column
    current = None
    for number, (group, row) in enumerate(rows):
        if group != current:
            above, current = [], group
        if above and min(a[2] for a in above) < number:
            above = [a for a in above if a[2] >= number]
        at, near, here, reach = 0, 0, [], []
        for node, text in row:
            while near < len(above) and above[near][0] <= at:
                at = max(at, above[near][1])
                near += 1
            wide, high = _span(node, "colspan", 1, 1_000), _span(node, "rowspan", 0, 65_534)
            here.append((at, wide, text))
            if high != 1:
                last = min(number + high, len(rows)) - 1 if high else len(rows) - 1
                if reach and reach[-1][1] == at and reach[-1][2] == last:
                    reach[-1] = (reach[-1][0], at + wide, last)
                else:
                    reach.append((at, at + wide, last))
            at += wide
        if reach:
            merged: list[tuple[int, int, int]] = []
            for a in sorted(above + reach):
                if merged and merged[-1][1] == a[0] and merged[-1][2] == a[2]:
                    merged[-1] = (merged[-1][0], a[1], a[2])
                else:
                    merged.append(a)
            above = merged
        placed.append(here)
    starts = sorted({at for row in placed for at, _, _ in row})
    index = {at: i for i, at in enumerate(starts)}
    return [[(index[at], bisect.bisect_left(starts, at + wide) - index[at], text) for at, wide, text in row] for row in placed]


def _grid(rows: list[tuple[int, list[tuple[Node, str]]]]) -> list[str]:
    """Lines of a table whose cells are padded to the widths of their columns. A column is
    padded to ``MOST_PADDING`` columns or ``MEAN_PADDING`` times its mean width at most;
    wider cells push on what follows them in their line."""
    placed = _placed(rows)
    columns = 1 + max((at for row in placed for at, _, _ in row), default=0)
    widths, sums, counts = [0] * columns, [0] * columns, [0] * columns
    measured = [[[_width(line) for line in text.split("\n")] for _, _, text in row] for row in placed]
    for row, sizes in zip(placed, measured, strict=True):
        for (column, wide, _), size in zip(row, sizes, strict=True):
            if wide == 1:
                widths[column] = max(widths[column], *size)
                sums[column] += sum(size)
                counts[column] += len(size)
    limit = [max(MOST_PADDING, MEAN_PADDING * s // max(n, 1)) for s, n in zip(sums, counts, strict=True)]
    widths = [min(w, most) for w, most in zip(widths, limit, strict=True)]
    edges = [0, *itertools.accumulate(w + 2 for w in widths)]
    for row, sizes in zip(placed, measured, strict=True):  # a cell over several columns widens the last of them
        for (column, wide, _), size in zip(row, sizes, strict=True):
            if wide > 1:
                last = column + wide - 1
                short = min(max(size), MOST_PADDING) - (edges[column + wide] - edges[column] - 2)
                if short > 0 and widths[last] < limit[last]:
                    widths[last] = min(widths[last] + short, limit[last])
    edges = [0, *itertools.accumulate(w + 2 for w in widths)]
    out = []
    for row, sizes in zip(placed, measured, strict=True):
        if not any(text for _, _, text in row):
            continue
        cells = [text.split("\n") for _, _, text in row]
        open_ = list(range(len(cells)))  # cells that still have lines
        for k in range(max(map(len, cells))):
            open_ = [i for i in open_ if k < len(cells[i])]
            line, upto = [], 0
            for i in open_:
                first, wide, _ = row[i]
                line.append(" " * min(edges[first] - upto, MOST_GAP))
                piece = cells[i][k]
                room = edges[first + wide] - edges[first]
                pad = max(room - 2 - sizes[i][k], 0) + 2 if i != open_[-1] else 0
                line.append(piece + " " * min(pad, max(MOST_GAP, limit[first])))
                upto = edges[first + wide]
            out.append("".join(line).rstrip(" "))
    return out


def _foreign_children(node: Node) -> list:
    """What a foreign element shows of its children."""
    if node.tag in _ONE_CHILD:
        able = (
            c for c in node.children
            if isinstance(c, Node) and not c.attributes.keys() & {"requiredextensions", "systemlanguage"}
        )
        return [*itertools.islice(able, 1)]
    if node.tag in _TOKENS and len(node.children) == 1 and isinstance(node.children[0], str):
        return [node.children[0].strip(" \t\n\r\f")]
    if node.tag in _APART:
        return [x for child in node.children for x in (" ", child)][1:]
    return node.children


def render(root: Node) -> str:
    """Visible text of a tree. The walk uses a stack of its own, so depth is no limit."""
    top = _Lines()
    # each step: (what, node, lines, preformatted)
    work: list[tuple] = [("open", root, top, False)]
    while work:
        what, node, out, pre = work.pop()
        if what == "text":
            out.add(node.replace("\xa0", " "), pre)
        elif what == "close":
            node, indent = node
            out.end_block(node.tag in SPACED)
            out.indent, out.marker = indent, ""
        elif what == "table":
            node, rows = node
            lines = _grid([(group, [(cell, part.text()) for cell, part in row]) for group, row in rows])
            if lines:
                out.end_block(True)
                for line in lines:
                    out._put(line)
                    out.end_line(force=True)
                out.end_block(True)
        elif not node.shown:
            continue
        elif node.tag == "br":
            out.end_line(force=True)
        elif node.tag == "hr":
            out.end_block(True)
        elif node.tag == "table":
            rows, inner = [], []
            for group, row in _rows(node):
                parts = [(cell, _Lines()) for cell in row]
                rows.append((group, parts))
                inner += [("inside", cell, part, False) for cell, part in parts]
            captions = [c for c in node.children if isinstance(c, Node) and c.tag == "caption"]
            work.append(("table", (node, rows), out, pre))
            work += reversed(inner)
            work += [("open", c, out, pre) for c in reversed(captions)]
        else:
            if what == "open" and (
                node.tag in BLOCK or node.tag in _OWN_LINE
                or (node.tag == "math math" and node.attributes.get("display", "").lower() == "block")
            ):
                out.end_block(node.tag in SPACED)
                work.append(("close", (node, out.indent), out, pre))
            if node.tag in ("ul", "ol", "menu", "dir"):
                number = int(node.attributes["start"]) if re.fullmatch(r"-?\d{1,9}", node.attributes.get("start", "")) else 1
                for child in node.children:
                    if isinstance(child, Node) and child.tag == "li" and child.shown:
                        child.attributes["\0marker"] = f"{number}. " if node.tag == "ol" else "- "
                        number += 1
            elif node.tag == "li":
                out.marker = node.attributes.get("\0marker", "- ")
            elif node.tag in ("dd", "blockquote"):
                out.indent = (out.indent + "    ")[:MOST_INDENT]
            if node.tag == "textarea" or node.tag in ("pre", "xmp", "listing", "plaintext"):
                pre = True
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\r").removeprefix("\n")
            children = node.children
            if " " in node.tag:
                children = _foreign_children(node)
                if node.tag == "svg tspan" and node.attributes.keys() & {"x", "y", "dy"}:
                    out.space = True  # placed apart
            for child in reversed(children):
                work.append(("text", child, out, pre) if isinstance(child, str) else ("open", child, out, pre))
    return top.text()


def html_text(source: str | None) -> str:
    """All visible text of a page; empty for a null or empty page."""
    return render(parse(source)) if source else ""


def extract(pages: DataFrame, column: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``column`` as ``name``.

    A null or empty page gives an empty text, broken markup the text a browser would show.
    Repeated rows give equal texts, an empty table an empty result. An input column named
    ``name`` is replaced; others pass as they are. Pages are read whole, in time that grows
    with their length; nesting of any depth is walked without recursion. Indentation and
    the padding of tables have limits (see ``MOST_INDENT``), so that a text is never more
    than a constant times as long as its page; the words all stay.
    """

    @F.arrow_udf("string")
    def visible(sources: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in sources:
            yield pa.array([html_text(s) for s in batch.to_pylist()], pa.string())

    return pages.withColumn(name, visible(F.col(column).cast("string")))
