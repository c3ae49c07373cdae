"""Layout-aware HTML extraction.

A tokenizer and a tree builder that supplies implied tags make a tree of each
page; the renderer walks it and emits all visible text: blocks on lines of
their own, paragraphs and headings apart, list items with markers and
indentation, table cells in aligned columns, preformatted text as it is. Both
work with explicit stacks, so deep nesting is no problem, in time linear in the
page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = " \t\n\r\f"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Where the content of a raw element stops.
CLOSE = {t: re.compile(f"</{t}", re.I | re.A) for t in RAW}
#: Never shown, with all they hold.
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes canvas audio video datalist".split())
FOREIGN = frozenset({"svg", "math"})
#: Never shown inside svg and math.
FOREIGN_HIDDEN = frozenset("annotation annotation-xml desc defs metadata".split())
#: Children that stand apart without white space in the page.
APART = frozenset("mfrac mtable mtr mlabeledtr".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp figure dl ul ol table".split())
BLOCK = PARAGRAPH | frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup hr html "
    "legend li main menu nav option optgroup search section summary tr tbody thead tfoot".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul li dd dt xmp".split())
ROWS = frozenset("tbody thead tfoot".split())
#: start tag: (open elements it ends, elements the search stops at)
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir", "table", "td", "th"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "td", "th"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "td", "th"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"optgroup", "option"}), frozenset({"select", "datalist"})),
    "rt": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
    "rp": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    **{t: (ROWS | {"caption", "colgroup", "tr"}, frozenset({"table"})) for t in (*ROWS, "caption", "colgroup")},
}
SCOPE = frozenset({"table", "td", "th", "caption", "html"})
#: Columns wider than this are not padded, so no table grows with rows times its longest cell.
WIDEST = 60


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attr(self, name: str) -> str | None:
        for m in ATTRIBUTE.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


def build(html: str) -> Node:
    """The tree of a page, with implied ends, rows and table sections; misplaced table text stands before the table."""
    root = Node("html")
    stack, count = [root], {"html": 1}

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        count[node.tag] = count.get(node.tag, 0) + 1

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            count[node.tag] -= 1
        del stack[i:]

    def end(tags: frozenset, stop: frozenset) -> None:
        """Close the outermost open element of ``tags`` inside the nearest of ``stop``."""
        if not any(count.get(t) for t in tags):
            return
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in stop:
                break
            if stack[i].tag in tags:
                found = i
        if found:
            pop_to(found)

    def text(s: str) -> None:
        if not s:
            return
        top = stack[-1].tag
        if (top == "table" or top in ROWS or top == "tr") and s.strip(SPACE):
            i = max(i for i, n in enumerate(stack) if n.tag == "table")
            stack[i - 1].children.insert(len(stack[i - 1].children) - 1, s)
        else:
            stack[-1].children.append(s)

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            break
        if m.start() > at:
            text(unescape(html[at:m.start()]))
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif count.get(tag) and tag not in ("html", "body"):
                stop = frozenset() if tag in ("table", "html") else frozenset({"table"}) if tag in SCOPE or tag in ROWS or tag == "tr" else SCOPE
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        pop_to(i)
                        break
                    if stack[i].tag in stop or tag not in BLOCK and tag not in SCOPE and stack[i].tag in BLOCK:
                        break
            continue
        if tag in ("html", "body") and (tag == "html" or count.get("body")):
            continue
        if tag == "body" or tag in CLOSES_P and count.get("head"):
            end(frozenset({"head"}), frozenset())
        if tag in CLOSES_P and count.get("p"):
            end(frozenset({"p"}), SCOPE)
        if tag in ENDS:
            end(*ENDS[tag])
            top = stack[-1].tag
            if tag == "tr" and top == "table":
                push(Node("tbody"))
            elif tag in ("td", "th") and (top == "table" or top in ROWS):
                if top == "table":
                    push(Node("tbody"))
                push(Node("tr"))
        node = Node(tag, m[3])
        if tag in VOID or m[3].endswith("/") and (count.get("svg") or count.get("math") or tag in FOREIGN):
            stack[-1].children.append(node)
        elif tag in RAW:
            # in the page itself: lower-casing can change its length
            close = CLOSE[tag].search(html, at)
            stop = close.start() if close else n
            if tag == "textarea":
                node.children.append(unescape(html[at:stop]))
            elif tag == "xmp":
                node.children.append(html[at:stop])
            stack[-1].children.append(node)
            at = (html.find(">", stop) + 1 or n) if close else n
        else:
            push(node)
    if at < n:
        text(unescape(html[at:]))
    return root


class Flow:
    """Lines of output: pending newlines and spaces are written before the next text only."""

    def __init__(self):
        self.out, self.newlines, self.space, self.indent, self.marker = [], 0, False, "", ""

    def gap(self, lines: int) -> None:
        self.newlines, self.space = max(self.newlines, lines), False

    def write(self, s: str) -> None:
        if not self.out:
            s = self.indent + self.marker + s
        elif self.newlines:
            self.out.append("\n" * self.newlines)
            s = self.indent + self.marker + s
        elif self.space:
            self.out.append(" ")
        if self.marker:
            self.indent, self.marker = self.indent + " " * len(self.marker), ""
        self.newlines, self.space = 0, False
        self.out.append(s)

    def words(self, s: str) -> None:
        flat = " ".join([w for w in re.split(r"[ \t\n\r\f]+", s) if w]) if "\t" in s or "\n" in s or "  " in s or "\r" in s or "\f" in s else s.strip(" ")
        if not flat:
            self.space = self.space or bool(s)
            return
        if s[0] in SPACE:
            self.space = True
        self.write(flat)
        self.space = s[-1] in SPACE

    def lines(self, s: str) -> None:
        for i, line in enumerate(s.split("\n")):
            if i:
                self.newlines += 1
            if line:
                self.write(line.rstrip("\r"))

    def text(self) -> str:
        return "".join(self.out)


class Table:
    """Cells of the table being rendered, and the places that rowspans hold."""

    def __init__(self):
        self.rows, self.held = [], {}

    def row(self) -> None:
        self.held = {c: n - 1 for c, n in self.held.items() if n > 1}
        self.rows.append([])

    def cell(self, text: str, colspan: int, rowspan: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        at = row[-1][0] + row[-1][2] if row else 0
        while at in self.held:
            at += 1
        row.append((at, " ".join(text.split()), colspan))
        if rowspan > 1:
            self.held.update({c: rowspan for c in range(at, at + colspan)})

    def render(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for at, text, span in row:
                if span == 1 and text:
                    width[at] = max(width.get(at, 0), min(len(text), WIDEST))
        starts, x = {}, 0
        for c in sorted(width):
            starts[c] = x
            x += width[c] + 2
        lines = []
        for row in self.rows:
            line = ""
            for at, text, _ in row:
                if text:
                    line = line.ljust(starts.get(at, 0)) if not line else line.ljust(max(starts.get(at, 0) - 2, 0)) + "  "
                    line += text
            if line.strip():
                lines.append(line)
        return lines


def _number(value: str | None, most: int) -> int:
    return min(max(int(value), 1), most) if value and value.strip().isdecimal() and len(value.strip()) < 9 else 1


def visible(node: Node) -> bool:
    """Not of a hidden kind, and neither hidden, display: none nor visibility: hidden of its own."""
    if node.tag in HIDDEN:
        return False
    if not node.attrs or "hidden" not in (a := node.attrs.lower()) and "none" not in a:
        return True
    if node.attr("hidden") is not None:
        return False
    style = re.sub(r"\s", "", (node.attr("style") or "").lower())
    return not re.search(r"(?:^|;)(?:display:none|visibility:(?:hidden|collapse))", style)


def render(root: Node) -> str:
    """The visible text of a tree."""
    flows, tables, lists = [Flow()], [], []
    pre = foreign = 0
    work: list = [root]
    while work:
        item = work.pop()
        flow = flows[-1]
        if isinstance(item, str):
            flow.lines(item) if pre else flow.words(item)
            continue
        if isinstance(item, Node):
            tag = item.tag
            if not visible(item) or foreign and tag in FOREIGN_HIDDEN:
                continue
            if tag == "br":
                flow.newlines, flow.space = flow.newlines + 1, False
                continue
            if tag == "img":
                continue
            if tag == "table":
                flow.gap(2 if len(flows) == 1 else 1)
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("td", "th") and tables:
                flows.append(Flow())
                lists.append(None)
            elif tag in BLOCK:
                flow.gap(2 if tag in PARAGRAPH and not (tag in ("ul", "ol", "dl") and lists and lists[-1]) else 1)
                if tag in ("ul", "ol", "menu", "dir"):
                    start = item.attr("start") if tag == "ol" and item.attrs else None
                    lists.append([tag, int(start) if start and re.fullmatch(r"-?\d{1,8}", start) else 1, flow.indent])
                elif tag == "li":
                    own = lists[-1] if lists and lists[-1] else ["ul", 1, flow.indent]
                    work.append(("indent", flow.indent))
                    flow.indent = own[2]
                    flow.marker = f"{own[1]}. " if own[0] == "ol" else "- "
                    own[1] += 1
                elif tag == "dd":
                    work.append(("indent", flow.indent))
                    flow.indent += "  "
            elif foreign and tag == "text":
                flow.gap(1)
            pre += tag in ("pre", "textarea", "xmp")
            foreign += tag in FOREIGN
            work.append(("end", item))
            work.extend(x for c in reversed(item.children) for x in ((c, " ") if foreign and tag in APART else (c,)))
            continue
        kind, value = item
        if kind == "indent":
            flow.indent, flow.marker = value, ""
            continue
        tag = value.tag
        pre -= tag in ("pre", "textarea", "xmp")
        foreign -= tag in FOREIGN
        if foreign and tag == "text":
            flow.gap(1)
        if tag in ("td", "th") and tables:
            done = flows.pop()
            lists.pop()
            tables[-1].cell(done.text(), _number(value.attr("colspan"), 1000) if value.attrs else 1, _number(value.attr("rowspan"), 65534) if value.attrs else 1)
        elif tag == "table":
            flow.gap(1)
            for line in tables.pop().render():
                flow.write(line)
                flow.gap(1)
            flow.gap(2 if len(flows) == 1 else 1)
        elif tag in BLOCK and tag != "tr":
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            flow.gap(2 if tag in PARAGRAPH and not (tag in ("ul", "ol", "dl") and lists and lists[-1]) else 1)
    return flows[0].text()


def html_to_text(html: str) -> str:
    return render(build(html))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text): the visible text of every row of ``pages``.

    A null page gives a null text; an empty one, or one without visible text,
    an empty text. Broken markup never fails: unknown tags are inline, open
    elements end with the page. Repeated rows give equal rows, other columns
    are not read, an empty table gives an empty one.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [None if h is None else html_to_text(h) for h in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["id", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(work, "id long, text string").withColumnRenamed("id", id_col)
