"""Layout-aware HTML rendering to plain text.

A page is cut into tags and text, built into a tree with implied end tags
(paragraphs, list items, table rows and cells, options), and rendered: all
visible text in order, blocks on lines of their own, a blank line around
paragraphs, headings, lists and tables, list items with their marker and
indented by depth, table cells padded to aligned columns, preformatted text as
it is.

Not visible: head, scripts, styles, templates and other elements without
rendered text, comments, elements with ``display:none``, ``hidden`` or closed
dialogs unless a style displays them, the text of a closed ``details`` but its
summary, and text whose visibility is hidden (inherited, so a visible child
shows).  Styles are an element's own and the tag, class and id rules of style
elements, by importance, specificity and order; other selectors are ignored.
Rules under ``@media`` (or in a style element with ``media``) count if they fit a screen
of ``SCREEN`` pixels, a mouse, and no preferences; those under ``@supports`` and
``@layer`` count unless the condition is negated, other at-rules do not.

Cases: null or empty html renders to an empty text; broken markup is repaired
(unclosed elements end with their parent, stray end tags are ignored, an
unfinished tag is text); elements may be nested to any depth (lines are
indented by ``MAX_INDENT`` at most); long pages take linear time, and a table's
padding is bounded by its text; repeated rows render alike; an empty table gives an empty result; result
columns get underscores in front where their names are taken.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas svg math datalist title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table ul optgroup option".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table pre blockquote figure fieldset hr".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li option optgroup legend".split()) | frozenset(["li", "dd", "dt"])
#: An opening tag ends open elements of these kinds, up to the boundary.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
}
#: Bounds of the layout, not of the text: how far lines are indented, and up to
#: which width and number of lines cells are set side by side.
MAX_INDENT, MAX_CELL, MAX_CELL_LINES = 80, 60, 20

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
SPECIAL = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
IGNORED = re.compile(r"""(?s)/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|<!--|-->""")
SELECTOR = re.compile(r"[.#]?[\w-]+")
SCREEN = {"width": 1280.0, "height": 800.0}
FEATURES = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "enabled", "update": "fast",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference", "forced-colors": "none",
}
LENGTH = re.compile(r"([\d.]+)(px|r?em|)")
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw.strip(" /\t\n\r\f"):
        for name, double, single, bare in ATTRIBUTE.findall(raw):
            out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


class TagEnds:
    """Where the tags of a page end: at the first ``>`` outside quotes.  Each
    quote is followed up once, so a page of broken tags takes linear time."""

    def __init__(self, page: str):
        self.page = page
        self.next = -1  # the first special character at or after the last place asked for
        self.known: dict[int, int] = {}  # opening quote -> the end of its tag, -1 without

    def after(self, at: int) -> int:
        if self.next < at:
            m = SPECIAL.search(self.page, at)
            self.next = m.start() if m else len(self.page)
        place, path = self.next, []
        while True:
            if place >= len(self.page):
                end = -1
                break
            if self.page[place] == ">":
                end = place
                break
            if place in self.known:
                end = self.known[place]
                break
            path.append(place)
            closing = self.page.find(self.page[place], place + 1)
            if closing < 0:
                end = -1
                break
            m = SPECIAL.search(self.page, closing + 1)
            place = m.start() if m else len(self.page)
        for quote in path:
            self.known[quote] = end
        return end


def build(page: str) -> tuple[Node, str, int]:
    """The page's tree, the text of its style elements, and the tree's depth."""
    root = Node("#root", {})
    stack, styles, at, depth = [root], [], 0, 1
    ends, said = TagEnds(page), []
    opened: Counter = Counter()

    def put(node: Node | None = None) -> None:
        if said:
            stack[-1].children.append(html.unescape("".join(said)))
            said.clear()
        if node is not None:
            stack[-1].children.append(node)

    def close(kinds, bounds) -> None:
        if not any(opened[k] for k in kinds):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in bounds:
                break
            if stack[i].tag in kinds:
                put()
                opened.subtract(n.tag for n in stack[i:])
                del stack[i:]
                break

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            lt = len(page)
        if lt > at:
            said.append(page[at:lt])
            at = lt
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
            continue
        m = NAME.match(page, at)
        gt = ends.after(m.end()) if m else -1
        if gt < 0:
            said.append("<")
            at += 1
            continue
        raw, at = page[m.end() : gt], gt + 1
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                put(Node("br", {}))
            elif opened[tag]:
                bounds = ("table",) if tag not in ("table", "html", "body") and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot") else ()
                close((tag,), () if tag == "table" else bounds)
            continue
        if tag in CLOSES_P:
            close(("p",), ("button", "td", "th", "caption", "table", "li", "div", "section", "article"))
        if tag in IMPLIED:
            kinds, bounds = IMPLIED[tag]
            before = -1
            while before != len(stack):  # a cell, then its row, then its section
                before = len(stack)
                close(kinds, bounds)
        node = Node(tag, attributes(raw))
        put(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            stop = len(page) if end is None else end.start()
            if tag == "style" and fits(node.attrs.get("media", "")):
                styles.append(page[at:stop])
            node.children.append(html.unescape(page[at:stop]) if tag in ("textarea", "title") else page[at:stop])
            gt = page.find(">", stop)
            at = len(page) if end is None or gt < 0 else gt + 1
        elif tag not in VOID:
            stack.append(node)
            opened[tag] += 1
            depth = max(depth, len(stack))
    put()
    return root, "\n".join(styles), depth


def pixels(value: str) -> float | None:
    m = LENGTH.fullmatch(value)
    try:
        return float(m[1]) * (16 if m[2].endswith("em") else 1) if m else None
    except ValueError:
        return None


def feature(text: str) -> bool | None:
    """Whether the screen has a media feature; None for an unknown one."""
    name, colon, value = (x.strip() for x in text.partition(":"))
    if colon:
        bound, _, side = name.rpartition("-")
        if bound in ("min", "max") and side in SCREEN:
            size = pixels(value)
            return None if size is None else SCREEN[side] >= size if bound == "min" else SCREEN[side] <= size
        return SCREEN[name] == pixels(value) if name in SCREEN else FEATURES[name] == value if name in FEATURES else None
    if name in SCREEN or name in FEATURES:
        return FEATURES.get(name, "") not in ("none", "no-preference")
    parts = [x.strip() for x in re.split(r"([<>]=?|=)", text)]
    if len(parts) not in (3, 5) or not any(x in SCREEN for x in parts):
        return None
    sizes = [SCREEN.get(x, pixels(x)) for x in parts[::2]]
    if None in sizes:
        return None
    compare = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}
    return all(compare[sign](x, y) for x, sign, y in zip(sizes, parts[1::2], sizes[1:]))


def fits(media: str) -> bool:
    """Whether one of a list of media queries fits the screen."""

    def one(query: str) -> bool:
        m = re.fullmatch(r"(not\b|only\b)?\s*([a-z-]+)?\s*(?:(?:\band\b)?\s*(\(.*))?", query, re.DOTALL)
        if not m:
            return False
        kind, ok = m[2] or "all", True
        if m[3]:
            terms = re.split(r"\s*\b(and|or)\b\s*", m[3])
            known = []
            for term in terms[::2]:
                t = re.fullmatch(r"(not\s*)?\(([^()]*)\)\s*", term)
                has = feature(t[2]) if t else None
                if has is None:
                    return False
                known.append(has != bool(t[1]))
            ok = any(known) if "or" in terms[1::2] else all(known)
        return (kind in ("all", "screen") and ok) != (m[1] == "not")

    return not media.strip() or any(one(q.strip()) for q in media.lower().split(","))


def declared(text: str) -> tuple[str, bool, bool | None] | None:
    """(property, important, shown) of a declaration of display or visibility;
    shown is None where the element's parent or kind decides."""
    name, colon, value = text.partition(":")
    name, words = name.strip().lower(), value.lower().replace("!", " !").split()
    if not colon or name not in ("display", "visibility"):
        return None
    important = "!important" in words or words[-2:] == ["!", "important"]
    value = words[0] if words else ""
    if name == "display":
        return name, important, None if value in ("revert", "revert-layer") else value != "none"
    shown = {"hidden": False, "collapse": False, "visible": True, "initial": True, "inherit": None, "unset": None, "revert": None, "revert-layer": None}
    return (name, important, shown[value]) if value in shown else None


class Styles:
    """What the rules of a page's style elements say of display and
    visibility: selector -> property -> (important, order, shown)."""

    def __init__(self, styles: str):
        self.rules: dict[str, dict[str, tuple[bool, int, bool | None]]] = {}
        text = IGNORED.sub(" ", styles)
        # open blocks: whether they count, and whose declarations they hold
        blocks: list[tuple[bool, list[str] | None]] = [(True, None)]
        at = 0
        for m in re.finditer(r"[{};]|\Z", text):
            chunk, at = text[at : m.start()].strip(), m.end()
            counts, owners = blocks[-1]
            if m[0] != "{":
                if counts and owners and (found := declared(chunk)):
                    self.add(owners, *found, m.start())
                if m[0] == "}" and len(blocks) > 1:
                    blocks.pop()
            elif chunk.startswith("@"):
                name, condition = re.fullmatch(r"(?s)@([\w-]*)(.*)", chunk).groups()
                condition = condition.strip().lower()
                name = name.lower()
                counts &= fits(condition) if name == "media" else name in ("supports", "layer") and not condition.startswith("not")
                blocks.append((counts, owners))
            elif owners is None:
                blocks.append((counts, [x.strip().lower() for x in chunk.split(",") if SELECTOR.fullmatch(x.strip())]))
            else:
                blocks.append((False, owners))  # nested rules have other selectors

    def add(self, owners: list[str], name: str, important: bool, shown: bool | None, order: int) -> None:
        for selector in owners:
            held = self.rules.setdefault(selector, {})
            held[name] = max(held.get(name, (False, -1, None)), (important, order, shown), key=lambda x: x[:2])

    def state(self, node: Node, visible: bool) -> bool | None:
        """Whether the node's own text is visible, given its parent's; None if
        nothing of the node is displayed."""
        a = node.attrs
        if node.tag in UNSEEN:
            return None
        best: dict[str, tuple] = {}
        if self.rules:
            own = [(1, node.tag), *((2, f".{c.lower()}") for c in a.get("class", "").split()), (3, f"#{a.get('id', '').lower()}")]
            for rank, selector in own:
                for name, (important, order, shown) in self.rules.get(selector, {}).items():
                    best[name] = max(best.get(name, (False, 0, 0, None)), (important, rank, order, shown), key=lambda x: x[:3])
        if a.get("style"):
            for i, part in enumerate(IGNORED.sub(" ", a["style"]).split(";")):
                if found := declared(part):
                    name, important, shown = found
                    best[name] = max(best.get(name, (False, 0, 0, None)), (important, 4, i, shown), key=lambda x: x[:3])
        displayed = best["display"][3] if "display" in best else None
        if displayed is None:
            displayed = not ("hidden" in a or (node.tag == "dialog" and "open" not in a))
        if not displayed:
            return None
        own_visible = best["visibility"][3] if "visibility" in best else None
        return visible if own_visible is None else own_visible


class Page:
    """Lines under construction.  ``gap``: line breaks owed before the next
    text (2 makes a blank line)."""

    def __init__(self, styles: Styles, visible: bool = True):
        self.styles = styles
        self.visible = visible
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0
        self.indent = ""
        self.marker = ""
        self.space = False

    def end_line(self, gap: int = 1) -> None:
        if self.line.strip():
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False
        self.gap = max(self.gap, gap)

    def start(self) -> None:
        if not self.line:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.line = self.indent[: len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent
            self.marker, self.gap, self.space = "", 0, False

    def text(self, raw: str, pre: bool) -> None:
        if not self.visible:
            return
        if pre:
            for i, part in enumerate(raw.split("\n")):
                if i:
                    if not self.line:
                        self.start()
                    self.lines.append(self.line.rstrip())
                    self.line = ""
                if part:
                    self.start()
                    self.line += part
            return
        words = SPACE.sub(" ", raw)
        if words == " " or not words:
            self.space |= bool(words) and bool(self.line)
            return
        lead = words[0] == " "
        fresh = not self.line
        self.start()
        if not fresh and (lead or self.space):
            self.line += " "
        self.line += words.strip(" ")
        self.space = words[-1] == " "

    def render(self, node: Node, pre: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                self.text(child, pre)
                continue
            tag, outer = child.tag, self.visible
            visible = self.styles.state(child, outer)
            if visible is None:
                continue
            self.visible = visible
            if tag == "br":
                if not visible:
                    self.visible = outer
                    continue
                self.start()
                self.lines.append(self.line.rstrip())
                self.line, self.space = "", False
            elif tag == "table":
                self.end_line(2)
                for line in table_lines(child, self.styles, visible):
                    self.lines_of(line)
                self.end_line(2)
            elif tag in ("ul", "ol", "menu"):
                self.items(child, pre)
            elif tag in BLOCK:
                gap = 2 if tag in SPACED else 1
                self.end_line(gap)
                held = self.indent
                if tag in ("dd", "blockquote") and len(self.indent) < MAX_INDENT:
                    self.indent += "  "
                if tag == "details" and "open" not in child.attrs:
                    child.children = [c for c in child.children if isinstance(c, Node) and c.tag == "summary"]
                self.render(child, pre or tag == "pre")
                self.end_line(gap)
                self.indent = held
            else:
                self.render(child, pre)
            self.visible = outer

    def lines_of(self, line: str) -> None:
        if line.strip():
            self.start()
            self.line += line
        self.end_line(1)

    def items(self, node: Node, pre: bool) -> None:
        nested = self.indent != ""
        self.end_line(1 if nested else 2)
        held, number = self.indent, 1
        if node.tag == "ol" and re.fullmatch(r"\d{1,9}", node.attrs.get("start", "")):
            number = int(node.attrs["start"])
        for child in node.children:
            if isinstance(child, str):
                self.text(child, pre)
                continue
            if child.tag != "li":
                holder = Node("#part", {})
                holder.children = [child]
                self.render(holder, pre)
                continue
            outer, visible = self.visible, self.styles.state(child, self.visible)
            if visible is None:
                continue
            self.end_line(1)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            deeper = held + " " * len(mark) if len(held) < MAX_INDENT else held
            self.indent, self.marker, self.visible = deeper, mark if visible else "", visible
            self.render(child, pre)
            self.end_line(1)
            self.indent, self.marker, self.visible = held, "", outer
        self.end_line(1 if nested else 2)

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def lines_under(node: Node, styles: Styles, visible: bool = True) -> list[str]:
    page = Page(styles, visible)
    page.render(node, node.tag == "pre")
    lines = page.result()
    while lines and not lines[0].strip():
        lines.pop(0)
    while lines and not lines[-1].strip():
        lines.pop()
    return lines


def _span(cell: Node, name: str) -> int:
    """Columns or rows that a cell takes; a rowspan of 0 goes on to the end."""
    raw = cell.attrs.get(name, "")
    n = int(raw) if re.fullmatch(r"\d{1,4}", raw) else 1
    return min(1000, n) if n else 1000 if name == "rowspan" else 1


def table_lines(node: Node, styles: Styles, visible: bool) -> list[str]:
    """A table's caption and rows; columns as wide as their widest cell that
    spans no other (up to ``MAX_CELL``; longer ones run over), two spaces apart.
    Cells that span rows keep their columns in the rows below.  A row with a
    cell of more than ``MAX_CELL_LINES`` lines stands as blocks, cell after cell,
    and so does a table that would be mostly padding."""
    before: list[str] = []
    rows: list[list[tuple[list[str], int, int]]] = []  # lines, columns, first column
    held: list[list[int]] = []  # [first column, the one after the last, rows still taken]

    def place(cells: list[tuple[list[str], int, int]]) -> list[tuple[list[str], int, int]]:
        taken, free, out, column = sorted(held), 0, [], 0
        for cell in held:
            cell[2] -= 1
        for lines, span, down in cells:
            while free < len(taken) and taken[free][0] <= column:
                column = max(column, taken[free][1])
                free += 1
            out.append((lines, span, column))
            if down > 1:
                held.append([column, column + span, down - 1])
            column += span
        held[:] = [cell for cell in held if cell[2] > 0]
        return out

    def visit(part: Node, visible: bool) -> None:
        loose = Node("#loose", {})
        for child in part.children:
            own = styles.state(child, visible) if isinstance(child, Node) else visible
            if own is None:
                continue
            if isinstance(child, Node) and child.tag in ("thead", "tbody", "tfoot"):
                held.clear()
                visit(child, own)
                held.clear()
            elif isinstance(child, Node) and child.tag == "tr":
                cells, odd = [], Node("#odd", {})
                for cell in child.children:
                    if isinstance(cell, Node) and cell.tag in ("td", "th"):
                        shown = styles.state(cell, own)
                        if shown is not None:
                            cells.append((lines_under(cell, styles, shown), _span(cell, "colspan"), _span(cell, "rowspan")))
                    else:
                        odd.children.append(cell)
                before.extend(lines_under(odd, styles, own))
                placed = place(cells)
                if any(lines for lines, *_ in placed):
                    rows.append(placed)
            else:
                loose.children.append(child)  # captions and misplaced text stand before the table
        before.extend(lines_under(loose, styles, visible))

    visit(node, visible)
    widths: dict[int, int] = {}
    for cells in rows:
        for lines, span, column in cells:
            if span == 1:
                widths[column] = max([widths.get(column, 0), *(len(x) for x in lines if len(x) <= MAX_CELL)])
    known = sorted(widths)
    ends = [0]
    for column in known:
        ends.append(ends[-1] + widths[column] + 2)
    start = {c: ends[bisect_left(known, c)] for c in {c for cells in rows for _, _, c in cells}}
    height = lambda cells: max(len(lines) for lines, *_ in cells)
    text = sum(len(x) + 1 for cells in rows for lines, *_ in cells for x in lines)
    padded = sum(height(cells) * start[max(c for lines, _, c in cells if lines)] for cells in rows)
    out = before
    for cells in rows:
        if height(cells) > MAX_CELL_LINES or padded > 8 * text + 4000:
            if height(cells) == 1:
                out.append("  ".join(lines[0] for lines, *_ in cells if lines))
            else:
                for lines, *_ in cells:
                    out.extend(lines)
            continue
        for i in range(height(cells)):
            line = ""
            for lines, _, column in cells:
                if i < len(lines):
                    line = line.rstrip() + "  " if len(line.rstrip()) + 2 > start[column] and line.strip() else line
                    line = line.ljust(start[column]) + lines[i]
            out.append(line.rstrip())
    return out


def render_html(page: str | None) -> str:
    if not page:
        return ""
    root, styles, depth = build(page)
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 1000 + 8 * depth))  # nested elements are nested calls
    try:
        return "\n".join(lines_under(root, Styles(styles)))
    finally:
        sys.setrecursionlimit(limit)


def render_pages(pages: DataFrame, markup: str = "html") -> DataFrame:
    """``pages`` with text, the rendered page."""
    name, at = free_name(pages.columns, "text"), pages.columns.index(markup)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                text = pa.array([render_html(t) for t in texts(part.column(at))], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, name])

    return pages.mapInArrow(run, pages.withColumn(name, F.lit("").cast("string")).schema)


def op6_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = render_pages(table(spark, sf_dir, "pages").select("page_id", "html"))
    return rendered.select("page_id", F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"), "text")
