"""Layout-aware HTML rendering to plain text.

A tokenizer reads tags, comments and text; the tree builder opens and closes
elements with HTML's implied-tag rules (a block start closes an open
paragraph, list items, table rows and cells, definitions and options close
their siblings, stray end tags are ignored, void elements never nest).  The
renderer walks the tree once and emits all visible text:

* hidden: head, script, style, template, ... , ``hidden`` attributes, inline
  ``display:none`` and ``visibility:hidden`` (visible again inside where a
  descendant says so), closed ``details`` apart from their summary;
* formulas (math) and the text of drawings (svg) run inline, without their
  titles, descriptions, definitions and annotations; a select shows its chosen
  option, else its first, and as a list (``multiple``, ``size``) all of them;
* white space collapses, except in pre and textarea;
* blocks start on their own line, paragraphs and headings with a blank line;
* list items carry bullets or numbers and are indented by depth;
* table cells are padded to their column's width (beyond ``MAX_PAD`` a column
  is not padded further), rows are lines; cells span columns and rows as
  ``colspan`` and ``rowspan`` say; a nested table is rendered inside its cell.

Pages are independent, so this is one narrow ``mapInArrow``.  Null html is
null text; empty or text-free html is an empty text.  Elements may
nest to any depth; only tables inside table cells recurse, up to MAX_TABLES deep
(beyond, their text is emitted as plain blocks).
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INVISIBLE = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video canvas".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure fieldset hr".split())
BLOCK = PARAGRAPH | frozenset("address article aside body caption center dd details dialog dir div dt figcaption footer form "
                              "header hgroup html legend li main menu nav option optgroup search section summary tbody td "
                              "tfoot th thead tr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split())
# start tag -> (open elements it closes, elements that stop the search)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
# never drawn inside svg and math; start tags that end these; their elements in which HTML goes on
FOREIGN = frozenset("svg math".split())
UNDRAWN = frozenset("title desc defs metadata symbol clippath mask marker pattern annotation annotation-xml".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
                     "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
INTEGRATION = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
SCOPE = frozenset("html table td th caption object template button".split())

TOKEN = re.compile(r"<(?:!--(?:>|->|(?:.*?)(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                   r"|([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z))", re.S)
ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MAX_TABLES = 20
MAX_PAD = 200   # padding of a column; longer cells are written whole and simply reach further
SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag, attrs=None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def parse_attrs(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in ATTR.finditer(text):
        value = m.group(2) if m.group(2) is not None else m.group(3) if m.group(3) is not None else m.group(4) or ""
        out.setdefault(m.group(1).lower(), entities.unescape(value) if "&" in value else value)
    return out


def build_tree(source: str) -> Node:
    """Element tree; kids are nodes or strings (character references resolved)."""
    root = Node("#root")
    stack = [root]
    count: Counter = Counter()     # open elements by tag: nothing is searched for that is not open
    pos, end = 0, len(source)

    def text(chunk):
        if chunk:
            stack[-1].kids.append(entities.unescape(chunk) if "&" in chunk else chunk)

    def pop_to(index):
        for n in stack[index:]:
            count[n.tag] -= 1
        del stack[index:]

    while pos < end:
        lt = source.find("<", pos)
        if lt < 0:
            text(source[pos:])
            break
        m = TOKEN.match(source, lt)
        if not m:   # a lone "<" is text
            text(source[pos:lt + 1])
            pos = lt + 1
            continue
        text(source[pos:lt])
        pos = m.end()
        closing, opening = m.group(1), m.group(2)
        if closing:
            tag = closing.lower()
            if tag == "br":
                stack[-1].kids.append(Node("br"))
                continue
            for i in range(len(stack) - 1, 0, -1) if count[tag] else ():
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE and tag not in ("html", "body", "table", "tr", "tbody", "thead", "tfoot"):
                    break
            continue
        if not opening:
            continue
        tag = opening.lower()
        foreign = count["svg"] or count["math"]
        if foreign and tag in BREAKOUT:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in INTEGRATION:
                    break
                if stack[i].tag in FOREIGN:
                    pop_to(i)
                    foreign = count["svg"] or count["math"]
                    break
        if tag in CLOSES_P and count["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in IMPLIED:
            closes, stops = IMPLIED[tag]
            hit = None
            for i in range(len(stack) - 1, 0, -1) if any(count[t] for t in closes) else ():
                if stack[i].tag in closes:
                    hit = i
                elif stack[i].tag in stops:
                    break
            if hit is not None:
                pop_to(hit)
        raw_attrs = m.group(3) or ""
        node = Node(tag, parse_attrs(raw_attrs))
        if foreign and tag in UNDRAWN:
            node.attrs["hidden"] = ""
        stack[-1].kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, pos)
            body = source[pos:close.start() if close else end]
            if tag in ("textarea", "title") and "&" in body:
                body = entities.unescape(body)
            node.kids.append(body)
            pos = close.end() if close else end
            continue
        if not (raw_attrs.rstrip().endswith("/") and (foreign or tag in FOREIGN)):
            stack.append(node)
            count[tag] += 1
    return root


def visibility(node: Node, inherited: bool) -> tuple[bool, bool]:
    """(rendered at all, its own text is visible)."""
    if node.tag in INVISIBLE:
        return False, False
    a = node.attrs
    if not a:
        return True, inherited
    if "hidden" in a and a["hidden"].lower() != "until-found":
        return False, False
    style = a.get("style")
    if style:
        s = SPACES.sub("", style.lower())
        if "display:none" in s or "content-visibility:hidden" in s:
            return False, False
        if "visibility:hidden" in s or "visibility:collapse" in s:
            return True, False
        if "visibility:visible" in s:
            return True, True
    return True, inherited


class Lines:
    """Collects text with pending line breaks and collapsed white space."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0
        self.space = False
        self.fresh = True      # nothing on the current line yet
        self.prefix = ""

    def _open(self):
        if self.breaks and self.out:
            self.out.append("\n" * self.breaks)
            self.fresh = True
        self.breaks = 0
        if self.fresh:
            self.out.append(self.prefix)
            if self.prefix:
                self.prefix = " " * len(self.prefix)
            self.fresh = False
            self.space = False

    def block(self, n: int):
        self.breaks = max(self.breaks, n)
        self.space = False

    def line_break(self):
        if not self.out:
            return
        self.breaks += 1
        self.space = False

    def text(self, s: str):
        words = s.split()
        if not words:
            self.space = self.space or bool(s)
            return
        lead = s[0].isspace()
        self._open_space(lead)
        self.out.append(" ".join(words))
        self.space = s[-1].isspace()

    def _open_space(self, lead):
        pending = (self.space or lead) and not self.breaks and not self.fresh
        self._open()
        if pending:
            self.out.append(" ")

    def literal(self, s: str):
        for k, line in enumerate(s.split("\n")):
            if k:
                self.breaks += 1
                if not line:
                    continue
            if line:
                self._open()
                self.out.append(line)

    def result(self) -> str:
        return "".join(self.out).strip("\n")


def _span(cell, name: str, most: int) -> int:
    value = cell.attrs.get(name, "").strip() if isinstance(cell, Node) and cell.tag in ("td", "th") else ""
    return min(int(value), most) if value.isascii() and value.isdigit() and len(value) < 10 else 1


def _place(rows) -> list[list[tuple[int, int]]]:
    """(first column, end column) of every cell, after the cells beside it and those that reach down from above."""
    busy: dict[int, int] = {}       # column -> first row below the cell that reaches down there
    out = []
    for r, cells in enumerate(rows):
        at, places = 0, []
        for cell, _ in cells:
            while busy.get(at, 0) > r:
                at += 1
            wide, high = max(_span(cell, "colspan", 1000), 1), _span(cell, "rowspan", 65534) or len(rows)
            if high > 1:
                for k in range(at, at + wide):
                    busy[k] = r + high
            places.append((at, at + wide))
            at += wide
        out.append(places)
    return out


def _render_table(table: Node, shown: bool, depth: int) -> list[str]:
    captions, rows = _ordered_rows(table, shown)
    lines = []
    for c, v in captions:
        lines += _render(c, v, depth).split("\n")
    places = _place(rows)
    # only columns in which a cell begins are drawn
    column = {c: k for k, c in enumerate(sorted({a for p in places for a, _ in p}))}
    starts = list(column)
    grid = []
    for cells, p in zip(rows, places):
        drawn = [_render(c, v, depth).split("\n") if isinstance(c, Node) else [" ".join(c.split())] for c, v in cells]
        if any(x != [""] for x in drawn):
            grid.append([(column[a], bisect_left(starts, z), cell) for (a, z), cell in zip(p, drawn)])
    widths = [0] * len(starts)
    for spanning in (False, True):
        for r in grid:
            for a, z, cell in r:
                if (z - a > 1) == spanning:
                    widths[z - 1] = max(widths[z - 1], max(map(len, cell)) - sum(min(w, MAX_PAD) + 2 for w in widths[a:z - 1]))
    ends = [0]
    for w in widths:
        ends.append(ends[-1] + min(w, MAX_PAD) + 2)
    for r in grid:
        for h in range(max(len(cell) for _, _, cell in r)):
            line, at = [], 0        # at: where the next cell would begin if none were missing
            for a, z, cell in r:
                line.append(" " * (ends[a] - at) + (cell[h] if h < len(cell) else "").ljust(ends[z] - ends[a] - 2) + "  ")
                at = ends[z]
            lines.append("".join(line).rstrip())
    return lines


def _options(select: Node) -> tuple[list[Node], bool]:
    """(options that a select shows, whether it is a list)."""
    found, stack = [], list(reversed(select.kids))
    while stack:
        n = stack.pop()
        if isinstance(n, Node) and visibility(n, True)[0]:
            if n.tag == "option":
                found.append(n)
            else:
                stack.extend(reversed(n.kids))
    size = select.attrs.get("size", "").strip()
    if "multiple" in select.attrs or (size.isascii() and size.isdigit() and int(size[:9]) > 1):
        return found, True
    chosen = [n for n in found if "selected" in n.attrs][-1:] or [n for n in found if "disabled" not in n.attrs][:1]
    return chosen, False


def _ordered_rows(table: Node, shown: bool):
    captions, rows = [], []

    def visit(node, vis):
        stray: list = []

        def flush():
            if stray:
                rows.append(list(stray))
                stray.clear()
        for kid in node.kids:
            if isinstance(kid, str):
                if kid.strip():
                    stray.append((kid, vis))
                continue
            drawn, v = visibility(kid, vis)
            if not drawn:
                continue
            if kid.tag == "caption":
                captions.append((kid, v))
            elif kid.tag in ("thead", "tbody", "tfoot") and node is table:
                flush()
                visit(kid, v)
            elif kid.tag == "tr":
                flush()
                rows.append([(c, visibility(c, v)[1]) if isinstance(c, Node) else (c, v) for c in kid.kids
                             if (visibility(c, v)[0] if isinstance(c, Node) else c.strip())])
            else:
                stray.append((kid, v))
        flush()
    visit(table, shown)
    return captions, rows


def _render(top: Node, shown: bool = True, depth: int = 0) -> str:
    """Visible text below ``top``; ``depth`` counts the tables around it."""
    out = Lines()
    # entries: (node or string or closing action, visible, in pre, list state)
    stack: list = [(k, shown, top.tag in ("pre", "textarea"), ()) for k in reversed(top.kids)]
    while stack:
        item, vis, pre, lists = stack.pop()
        if callable(item):
            item()
            continue
        if isinstance(item, str):
            if vis:
                out.literal(item) if pre else out.text(item)
            continue
        drawn, v = visibility(item, vis)
        if not drawn:
            continue
        tag = item.tag
        if tag == "br":
            out.line_break()
            continue
        if tag == "table" and depth < MAX_TABLES:
            lines = _render_table(item, v, depth + 1)
            out.block(2)
            for line in lines:
                if line:
                    out._open()
                    out.out.append(line)
                out.breaks = max(out.breaks, 0) + 1
            out.block(2)
            continue
        if tag == "select":
            options, listed = _options(item)
            if not listed:      # inline, apart from its neighbours
                out.text(" ")
                stack.append((" ", True, False, lists))
                stack.extend((k, v, False, lists) for n in options for k in reversed(n.kids))
            else:
                stack.extend((n, v, False, lists) for n in reversed(options))
            continue
        if tag in ("text", "mtext"):    # labels of a drawing or formula stand apart
            out.text(" ")
            stack.append((" ", True, False, lists))
        gap = 2 if tag in PARAGRAPH else 1 if tag in BLOCK else 0
        if tag in ("ul", "ol", "menu", "dir"):
            if lists:
                gap = 1
            start = item.attrs.get("start", "")
            number = int(start) - 1 if start.lstrip("-").isdigit() and len(start) < 10 else 0
            lists = lists + ([tag == "ol", number],)
        if gap:
            out.block(gap)
        if tag == "li":
            state = lists[-1] if lists else [False, 0]
            value = item.attrs.get("value", "")
            state[1] = int(value) if value.lstrip("-").isdigit() and len(value) < 10 else state[1] + 1
            mark = f"{state[1]}. " if state[0] else "- "
            before = out.prefix
            out.prefix = "  " * max(len(lists) - 1, 0) + mark
            out.fresh = True if out.breaks or not out.out else out.fresh

            def after(old=before):
                out.block(1)
                out.prefix = old
            stack.append((after, vis, pre, lists))
        elif tag == "blockquote" or tag == "dd":
            before = out.prefix
            out.prefix = before.replace("- ", "  ") + "  "

            def after(old=before, g=gap):
                out.block(g)
                out.prefix = old
            stack.append((after, vis, pre, lists))
        elif gap:
            stack.append((lambda g=gap: out.block(g), vis, pre, lists))
        kids = item.kids
        if tag == "details" and "open" not in item.attrs:
            kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
        stay = pre or tag in ("pre", "textarea", "listing", "plaintext")
        if stay and not pre and kids and isinstance(kids[0], str) and kids[0].startswith("\n"):
            kids = [kids[0][1:], *kids[1:]]
        stack.extend((k, v, stay, lists) for k in reversed(kids))
    return out.result()


def render(source: str) -> str:
    """Visible text of an HTML page."""
    return _render(build_tree(source))


def extract_text(pages: DataFrame, html: str = "html", columns=("page_id",)) -> DataFrame:
    """``columns`` of pages with ``text`` (null for null html) and its length in characters."""
    src = pages.select(*columns, F.col(html).cast("string").alias("_html"))
    kept = [f for f in src.schema.fields if f.name != "_html"]
    schema = T.StructType(kept + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for rb in batches:
            texts = [None if h is None else render(h) for h in rb.column("_html").to_pylist()]
            cols = [rb.column(f.name).cast(arrow.field(f.name).type) for f in kept]
            cols += [pa.array(texts, arrow.field("text").type), pa.array([None if t is None else len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
    return src.mapInArrow(run, schema)
