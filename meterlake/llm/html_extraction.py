"""Layout-aware rendering of web pages to text.

A tokenizer feeds a tree builder that supplies implied tags; a walk over the tree
leaves out what a browser would not show and writes the rest with its block
spacing, list markers and aligned table cells.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A quoted value begins only after a name and "="; quotes elsewhere are ordinary characters.
_NAME = r"(?:=[^\s>/=]*+|[^\s>/=]++)"
_VALUE = r"(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)"
TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                   rf"|<([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE}?)?)*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE})?)?")
NOTABLE = re.compile(r"hidden|style|open|span|start|value|type", re.IGNORECASE)
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([\w-]+)", re.IGNORECASE)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.IGNORECASE)

# Element names as HTML defines their roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object applet audio video canvas "
                   "svg math datalist title meta link base param source track col colgroup area map".split())
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu dir listing xmp".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer main nav address form li dt dd tr caption "
                           "thead tbody tfoot td th center details summary dialog figcaption hgroup legend option "
                           "optgroup search".split())
CLOSES_P = (BLOCK - frozenset("html body tr td th thead tbody tfoot caption option optgroup legend".split()))
LISTS = frozenset("ul ol menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("thead tbody tfoot".split())
# An opening tag ends the nearest open one of these, looked for up to the barrier.
ENDS = {"li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "thead": (SECTIONS, {"table"}), "tbody": (SECTIONS, {"table"}), "tfoot": (SECTIONS, {"table"}),
        "caption": (SECTIONS | {"caption"}, {"table"})}
P_BARRIER = frozenset("table td th caption button object template html".split())
TABLE_PARTS = SECTIONS | {"tr", "td", "th", "caption", "table"}

# A column is padded to its widest cell, but no further than this.
MAX_PAD = 60
MAX_SPAN, MAX_COLUMNS = 1000, 2000
# Elements nested deeper are laid out as text of the one at this depth; what they hide stays hidden.
MAX_DEPTH = 512
# Tables nested deeper are written as plain blocks.
MAX_TABLES = 20


STYLE_BLOCK = re.compile(r"<style(?=[\s/>])[^>]*>(.*?)(?:</style(?=[\s/>])|\Z)", re.IGNORECASE | re.DOTALL)
CSS_COMMENT, RULE = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL), re.compile(r"([^{}]*)\{([^{}]*)(?:\}|\Z)")
SELECTOR = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)")


class Styles:
    """What the page's style blocks say of display and visibility, by selectors of a
    tag, classes and an id.  Other selectors, and rules inside at-rules (such as those
    for printing), are left aside."""

    def __init__(self, source: str):
        self.rules: list[tuple[tuple, str, set[str], str, str | None, str | None]] = []
        if "<style" not in source and not re.search("<style", source, re.IGNORECASE):
            return
        for block in STYLE_BLOCK.findall(source):
            for selectors, body in RULE.findall(self._plain(CSS_COMMENT.sub(" ", block))):
                display, visible = DISPLAY.findall(body), VISIBILITY.findall(body)
                if display or visible:
                    for selector in selectors.split(","):
                        self._add(selector.strip(), display[-1].lower() if display else None, visible[-1].lower() if visible else None)

    @staticmethod
    def _plain(css: str) -> str:
        """Without at-rules and their blocks."""
        out, at = [], 0
        for rule in re.finditer("@", css):
            if rule.start() < at:
                continue
            out.append(css[at:rule.start()])
            depth, at = 0, len(css)
            for mark in re.finditer("[{};]", css[rule.start():]):
                depth += {"{": 1, "}": -1}.get(mark.group(), 0)
                if depth <= 0:
                    at = rule.start() + mark.end()
                    break
        out.append(css[at:])
        return "".join(out)

    def _add(self, selector: str, display: str | None, visible: str | None) -> None:
        found = SELECTOR.fullmatch(selector, 0) if selector and not selector[0].isupper() else SELECTOR.fullmatch(selector.lower())
        if not selector or not found:
            return
        tag, rest = (found.group(1) or "*").lower(), re.findall(r"[.#][\w-]+", found.group(2))
        classes, ids = {x[1:] for x in rest if x[0] == "."}, [x[1:] for x in rest if x[0] == "#"]
        if len(ids) < 2:
            weight = (len(ids), len(classes), tag != "*", len(self.rules))
            self.rules.append((weight, tag, classes, ids[0] if ids else "", display, visible))

    def of(self, tag: str, attributes: dict[str, str]) -> tuple[str | None, str | None]:
        """The display and visibility that the heaviest fitting rules give."""
        if not self.rules:
            return None, None
        classes, own = set(attributes.get("class", "").split()), attributes.get("id", "")
        fit = sorted(r for r in self.rules if r[1] in ("*", tag) and r[2] <= classes and r[3] in ("", own))
        return (next((r[4] for r in reversed(fit) if r[4]), None), next((r[5] for r in reversed(fit) if r[5]), None))


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _attributes(source: str, every: bool) -> dict[str, str]:
    if not every and not NOTABLE.search(source):
        return {}
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        if value[:1] in ("\"", "'"):
            value = value[1:].removesuffix(value[0])
        found.setdefault(name.lower(), html.unescape(value))
    return found


def _style(tag: str, attributes: dict[str, str], styles: Styles) -> None:
    """Resolve display and visibility: the style attribute over the style blocks."""
    display, visible = styles.of(tag, attributes)
    own = attributes.get("style", "") if attributes else ""
    display = (DISPLAY.findall(own) or [display])[-1]
    visible = (VISIBILITY.findall(own) or [visible])[-1]
    if display:
        attributes["-display"] = display.lower()
    if visible:
        attributes["-visibility"] = visible.lower()


def parse(source: str) -> Node:
    """The page's tree.  Missing end tags, ``p``, ``tbody`` and ``tr`` are
    supplied; end tags without a start are ignored (``</p>``: an empty paragraph);
    an end tag does not reach out of the cell it stands in."""
    root, styles = Node("html"), Styles(source)
    stack = [root]
    deep: list[tuple[str, bool, str | None]] = []  # open elements below MAX_DEPTH: tag, shown, visibility
    at, end = 0, len(source)

    def close(tags, barrier) -> None:
        for k in range(len(deep) - 1, -1, -1):
            if deep[k][0] in tags:
                del deep[k:]
                return
            if deep[k][0] in barrier:
                return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                deep.clear()
                return
            if stack[k].tag in barrier:
                return

    def push(tag: str, attributes: dict[str, str] | None = None) -> None:
        node = Node(tag, attributes)
        if len(stack) >= MAX_DEPTH:
            shown, rule = deep[-1][1:] if deep else (True, None)
            deep.append((tag, shown and _shown(node), node.attributes.get("-visibility", rule)))
            return
        stack[-1].children.append(node)
        stack.append(node)

    def put(piece: Node | str) -> None:
        """Add text or an empty element where it stands."""
        if deep:
            _, shown, rule = deep[-1]
            if not shown:
                return
            if rule:
                inner, piece = piece, Node("span", {"-visibility": rule})
                piece.children.append(inner)
        stack[-1].children.append(piece)

    def text(piece: str) -> None:
        if stack[-1].tag == "head" and not piece.isspace():
            stack.pop()
        put(html.unescape(piece) if "&" in piece else piece)

    while at < end:
        found = TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        if found.start() > at:
            text(source[at:found.start()])
        at = found.end()
        closing, opening = found.group(1), found.group(2)
        if closing:
            tag = closing.lower()
            if tag == "br":
                put(Node("br"))
            elif tag in ("body", "html"):
                continue  # what follows still belongs to the body
            elif tag == "table":
                close({"table"}, ())
            elif tag in TABLE_PARTS:
                close({tag}, {"table"})
            elif tag in HEADINGS:
                close(HEADINGS, {"table", "td", "th", "caption"})
            else:
                open_ = len(stack) + len(deep)
                close({tag}, {"table", "td", "th", "caption"})
                if tag == "p" and len(stack) + len(deep) == open_:
                    put(Node("p"))
            continue
        if not opening:
            continue
        tag = opening.lower()
        attributes = _attributes(found.group(3), bool(styles.rules)) if found.group(3) else {}
        _style(tag, attributes, styles)
        if tag == "html":
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            stack.pop()
        if tag == "body":
            root.attributes = {**attributes, **root.attributes}
            continue
        if tag in CLOSES_P:
            close({"p"}, P_BARRIER)
        if tag in HEADINGS and not deep and stack[-1].tag in HEADINGS:
            stack.pop()
        if tag in ENDS:
            close(*ENDS[tag])
        if deep:
            pass  # no rows and sections are supplied down there
        elif tag in ("td", "th") and stack[-1].tag != "tr" and any(n.tag == "table" for n in stack):
            while stack[-1].tag not in SECTIONS and stack[-1].tag != "table":
                stack.pop()
            if stack[-1].tag == "table":
                push("tbody")
            push("tr")
        elif tag == "tr" and any(n.tag == "table" for n in stack):
            while stack[-1].tag not in SECTIONS and stack[-1].tag != "table":
                stack.pop()
            if stack[-1].tag == "table":
                push("tbody")
        elif (tag in SECTIONS or tag == "caption") and any(n.tag == "table" for n in stack):
            while stack[-1].tag != "table":
                stack.pop()
        if tag in VOID:
            put(Node(tag, attributes))
            continue
        push(tag, attributes)
        if tag in RAW:
            close_at = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            raw = source[at:close_at.start() if close_at else end]
            raw = html.unescape(raw) if tag in ("textarea", "title") else raw
            if deep:
                put(raw)
                deep.pop()
            else:
                stack.pop().children.append(raw)
            at = close_at.end() if close_at else end
    return root


class Flow:
    """Lines of text with pending block spacing, indents and list markers."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.current: list[str] = []
        self.space = self.gap = False
        self.indents: list[list] = []  # [width, marker not yet written or None]

    def write(self, text: str) -> None:
        words = text.split()
        if not words:
            self.space = self.space or bool(text)
            return
        if self.current and (self.space or text[0].isspace()):
            self.current.append(" ")
        self.current.append(" ".join(words))
        self.space = text[-1].isspace()

    def write_lines(self, text: str) -> None:
        """Preformatted text."""
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.current.append(first)
        for line in rest:
            self.end_line(keep_empty=True)
            self.current.append(line)

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.current)
        if line.strip() or (keep_empty and self.current):
            self._put(line.rstrip())
        self.current, self.space = [], False

    def _put(self, line: str) -> None:
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        prefix = "".join(marker if marker is not None else " " * width for width, marker in self.indents)
        for indent in self.indents:
            indent[1] = None
        self.lines.append((prefix + line).rstrip())

    def put_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._put(line)


def _number(value: str | None, default: int, least: int, most: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(found.group(1)), least), most) if found else default


def _shown(node: Node) -> bool:
    if node.tag in UNSEEN:
        return False
    a = node.attributes
    if not a:
        return node.tag != "dialog"
    if "hidden" in a or (node.tag == "dialog" and "open" not in a) or a.get("-display") == "none":
        return False
    return not (node.tag == "input" and a.get("type", "").lower() == "hidden")


def _visibility(node: Node, seen: bool) -> bool:
    rule = node.attributes.get("-visibility") if node.attributes else None
    return rule == "visible" if rule else seen


def render(nodes: list, visible: bool = True, tables: int = 0) -> list[str]:
    """Lines of the nodes' visible text."""
    flow = Flow()
    numbers: list[int] = []  # next number of each open list; 0 or less of a bulleted one has no meaning
    kinds: list[str] = []
    todo: list = [("node", n, visible, False) for n in reversed(nodes)]
    while todo:
        step, node, seen, pre = todo.pop()
        if step == "exit":
            _leave(flow, node, numbers, kinds)
            continue
        if isinstance(node, str):
            if seen and node:
                (flow.write_lines if pre else flow.write)(node)
            continue
        if not _shown(node):
            continue
        tag = node.tag
        seen = _visibility(node, seen)
        if tag == "br":
            flow.end_line(keep_empty=bool(flow.current))
            continue
        if tag == "wbr":
            continue
        if tag == "hr":
            flow.end_line()
            flow.gap = True
            if seen:
                flow._put("----")
            flow.gap = True
            continue
        if tag == "table" and tables < MAX_TABLES:
            flow.end_line()
            flow.gap = True
            flow.put_lines(_table(node, seen, tables + 1))
            flow.gap = True
            continue
        if tag in BLOCK:
            flow.end_line()
            if tag in SPACED and not (tag in LISTS and kinds):
                flow.gap = True
            if tag in LISTS:
                kinds.append(tag)
                numbers.append(_number(node.attributes.get("start"), 1, -10 ** 9, 10 ** 9))
            elif tag == "li":
                marker = "- "
                if kinds and kinds[-1] == "ol":
                    number = _number(node.attributes.get("value"), numbers[-1], -10 ** 9, 10 ** 9)
                    numbers[-1] = number + 1
                    marker = f"{number}. "
                flow.indents.append([len(marker), marker if seen else None])
            elif tag in ("blockquote", "dd"):
                flow.indents.append([2, None])
            todo.append(("exit", node, seen, pre))
        children = node.children
        if tag == "details" and "open" not in node.attributes:
            children = [n for n in children if isinstance(n, Node) and n.tag == "summary"][:1]
        if tag in ("pre", "listing", "xmp", "textarea"):
            pre = True
            if children and isinstance(children[0], str) and children[0][:1] == "\n":
                children = [children[0][1:], *children[1:]]
        todo.extend(("node", n, seen, pre) for n in reversed(children))
    flow.end_line()
    while flow.lines and not flow.lines[-1]:
        flow.lines.pop()
    return flow.lines


def _leave(flow: Flow, node: Node, numbers: list[int], kinds: list[str]) -> None:
    flow.end_line()
    if node.tag in LISTS:
        kinds.pop()
        numbers.pop()
        flow.gap = flow.gap or not kinds
    elif node.tag in ("li", "blockquote", "dd"):
        flow.indents.pop()
    if node.tag in SPACED and node.tag not in LISTS:
        flow.gap = True


def _table(table: Node, seen: bool, depth: int) -> list[str]:
    """Caption and stray content first, then the rows with their cells in columns."""
    before: list = []
    rows: list[tuple[Node, bool]] = []

    def gather(node: Node, seen: bool) -> None:
        for child in node.children:
            if isinstance(child, Node) and child.tag in SECTIONS and node.tag == "table":
                if _shown(child):
                    gather(child, _visibility(child, seen))
            elif isinstance(child, Node) and child.tag == "tr":
                if _shown(child):
                    rows.append((child, _visibility(child, seen)))
            elif not isinstance(child, str) or not child.isspace():
                before.append(child)

    gather(table, seen)
    cells: list[tuple[int, int, int, list[str]]] = []  # row, column, columns, lines
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    columns = 0
    for y, (row, row_seen) in enumerate(rows):
        x, covered = 0, {c: n - 1 for c, n in taken.items() if n > 1}
        occupied, taken = set(taken), covered
        for child in row.children:
            if not isinstance(child, Node) or child.tag not in ("td", "th"):
                if not isinstance(child, str) or not child.isspace():
                    before.append(child)
                continue
            if not _shown(child):
                continue
            while x in occupied:
                x += 1
            across = min(_number(child.attributes.get("colspan"), 1, 1, MAX_SPAN), max(1, MAX_COLUMNS - x))
            down = _number(child.attributes.get("rowspan"), 1, 0, 65534) or len(rows)
            cells.append((y, x, across, render(child.children, _visibility(child, row_seen), depth)))
            if down > 1:
                taken.update({c: down - 1 for c in range(x, x + across)})
            x += across
        columns = max(columns, x)
    widths = [0] * columns
    for _, x, across, lines in cells:
        if across == 1:
            widths[x] = max(widths[x], min(MAX_PAD, max(map(len, lines), default=0)))
    by_row: dict[int, list] = {}
    for cell in cells:
        by_row.setdefault(cell[0], []).append(cell)
    out = render(before, seen, depth)
    starts = [0]
    for width in widths:
        starts.append(starts[-1] + width + (2 if width else 0))
    for y in sorted(by_row):
        for k in range(max((len(c[3]) for c in by_row[y]), default=0)):
            line = ""
            for _, x, _, lines in by_row[y]:
                if k < len(lines) and lines[k]:
                    gap = max(starts[x] - len(line), 2 if line else 0)
                    line += " " * gap + lines[k]
            out.append(line.rstrip())
    return out


def to_text(source: str | None) -> str:
    """Visible text of a page; empty for null, empty or wholly hidden pages."""
    if not source:
        return ""
    root = parse(source)
    return "\n".join(render(root.children, _visibility(root, True))) if _shown(root) else ""


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """page_id, text of every row.

    Null and empty pages give an empty text; pages of any length are rendered
    whole and in one pass; repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result.
    """
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([to_text(x) for x in part], dtype=object)

    return pages.select(F.col(id_column).alias("page_id"), run(F.col(html_column).cast("string")).alias("text"))
