"""Layout-aware HTML rendering to text.

A tree builder closes implied tags (p, li, dt, dd, option, rows and cells), drops unmatched end tags and reads script,
style and the like as raw text. Visibility rules leave out head, scripts, templates, what svg and math only define or
annotate, `hidden`, `popover`, a dialog or the body of details that is not open, display:none and visibility:hidden (which a
descendant may undo) in style attributes; rules of style sheets are not applied. The renderer emits all visible text: blocks on lines of their own,
paragraphs, headings, lists and tables set apart by a blank line, nested lists indented with their markers (numbers,
letters or Roman numbers, from `start`, `value` and `reversed`), buttons and text fields set apart by a space, table cells padded to the width of their column whatever it is, wide characters counted as two, cells that reach over several
rows keeping their column below, labels in drawings set apart by a space, white space collapsed
except in pre. Neither step recurses, so nesting may be as deep as it likes.

Defined cases: null or empty html gives an empty text; text outside any tag is kept; an unfinished tag or comment at
the end is dropped; repeated rows give repeated results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import lean

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes object video audio canvas datalist rp".split())
#: Set apart from the text around them by a space.
APART = frozenset("button textarea".split())
#: Within svg or math: what is defined, described or annotated there and not shown in its place.
NOT_DRAWN = frozenset("defs symbol desc metadata clippath mask pattern marker annotation annotation-xml".split())
LOOSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr form fieldset".split())
BLOCK = LOOSE | frozenset("html body div section article aside nav header footer main address li dt dd tr caption center figcaption details dialog summary legend option optgroup select thead tbody tfoot dir menu search hgroup".split())
#: A start tag of the key closes open elements of the value, up to the nearest of the barrier.
CLOSES_P = (BLOCK - frozenset("html body li dt dd tr caption option optgroup select thead tbody tfoot legend".split())) | {"li", "dt", "dd"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"tr", "table"}), "th": ({"td", "th", "caption"}, {"tr", "table"}), "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "body": ({"head"}, set())}
SCOPE = frozenset("table td th caption html body".split())
IN_HEAD = frozenset("meta link title base script style noscript template".split())
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")  # at once after the start, a comment is empty
QUOTED = re.compile(r"[\"'>]")
SPACES = re.compile(r"[ \t\n\r\f]+")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|$)", re.I | re.A) for tag in RAW}


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", data, {}), ("open", tag, attributes) and ("close", tag, {}) in order.

    An open tag within svg or math that ends in "/>" has the attribute "/".
    """
    at, n = 0, len(html)
    foreign = 0
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", html[at:lt], {}
        if lt == n:
            return
        if html.startswith("<!--", lt):
            end = COMMENT_END.search(html, lt + 4)
            at = end.end() if end else n
            continue
        if html.startswith(("<!", "<?"), lt):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        name = NAME.match(html, lt + 1)
        if not name:
            if html.startswith("</", lt):  # a bogus comment
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                yield "text", "<", {}
                at = lt + 1
            continue
        end = name.end()
        while (q := QUOTED.search(html, end)) and q[0] != ">":
            if q[0] in "\"'" and html[end : q.start()].rstrip().endswith("="):
                end = html.find(q[0], q.end()) + 1
                if not end:
                    return
            else:
                end = q.end()
        if not q:
            return
        tag, at = name[0].lower(), q.end()
        if tag[0] == "/":
            foreign -= foreign > 0 and tag[1:] in ("svg", "math")
            yield "close", tag[1:], {}
            continue
        attrs = {}
        for m in ATTR.finditer(html, name.end(), q.start()):
            attrs.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
        if (foreign or tag in ("svg", "math")) and html[q.start() - 1] == "/":
            attrs["/"] = ""
        elif tag in ("svg", "math"):
            foreign += 1
        yield "open", tag, attrs
        if tag in RAW and "/" not in attrs:
            found = RAW_END[tag].search(html, at)
            end = found.start() if found else n
            if end > at:
                yield "text", html[at:end], {}
            at = end


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def tree(html: str) -> Node:
    """The document with implied tags in place."""
    root = Node("html", {})
    stack, counts = [root], {"html": 1}

    def pop() -> None:
        counts[stack.pop().tag] -= 1

    def close(tags: set[str], barrier: set[str]) -> None:
        """Close up to the outermost open element of tags within the barrier."""
        if not any(counts.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in barrier:
                break
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()

    for kind, data, attrs in tokens(html):
        if kind == "text":
            if counts.get("head") and stack[-1].tag == "head" and data.strip():
                pop()
            stack[-1].children.append(data if stack[-1].tag in RAW - {"textarea", "title"} else unescape(data))
        elif kind == "open":
            if data == "html":
                root.attrs = {**attrs, **root.attrs}
                continue
            if stack[-1].tag == "head" and data not in IN_HEAD:
                pop()
            if data in CLOSES_P:
                close({"p"}, SCOPE)
            if data in CLOSES:
                close(*CLOSES[data])
            if data in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                stack[-1].children.append(row := Node("tr", {}))
                stack.append(row)
                counts["tr"] = counts.get("tr", 0) + 1
            node = Node("img" if data == "image" else data, attrs)
            stack[-1].children.append(node)
            if data not in VOID and "/" not in attrs:
                stack.append(node)
                counts[data] = counts.get(data, 0) + 1
        elif data == "br":
            stack[-1].children.append(Node("br", {}))
        elif data not in ("html", "body") and counts.get(data):
            barrier = {"table"} if data in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption") else SCOPE - {data}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == data:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i].tag in barrier and data != "table":
                    break
    return root


class Page:
    """Lines of text under way: what is pending before the next visible character."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks = self.brs = 0
        self.space = self.any = False
        self.indent = ""
        self.marker = ""

    def apart(self, lines: int) -> None:
        self.breaks, self.space = max(self.breaks, lines), False

    def br(self) -> None:
        self.brs, self.space = self.brs + 1, False

    def put(self, text: str) -> None:
        if self.any and (self.breaks or self.brs):
            self.parts.append("\n" * max(self.breaks, self.brs))
            self.parts.append(self.lead())
        elif not self.any:
            self.parts.append(self.lead())
        elif self.space:
            self.parts.append(" ")
        self.parts.append(text)
        self.breaks = self.brs = 0
        self.space, self.any = False, True

    def lead(self) -> str:
        out = self.indent[: len(self.indent) - len(self.marker)] + self.marker
        self.marker = ""
        return out

    def flow(self, text: str) -> None:
        words = SPACES.sub(" ", text)
        if words[:1] == " " and self.any and not (self.breaks or self.brs):
            self.space = True
        if body := words.strip(" "):
            self.put(body)
            self.space = words[-1] == " "

    def text(self) -> str:
        return "".join(self.parts)


def cell_width(text: str) -> int:
    """Columns that a text takes where wide characters take two and combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.category(c) in ("Mn", "Me", "Cf") else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, str, int]]]:
    """(column, text, columns) of the cells (text, columns, rows) of each row: cells that reach down from above keep their columns."""
    out, down = [], {}  # column: rows below that it still reaches
    for row in rows:
        at, cells, fresh = 0, [], {}
        for text, span, deep in row:
            while at in down:
                at += 1
            cells.append((at, text, span))
            if deep > 1:
                fresh.update((c, deep) for c in range(at, at + span))
            at += span
        out.append(cells)
        down = {c: k - 1 for c, k in (down | fresh).items() if k > 1}
    return out


def laid_out(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of a table: cells padded to their column's width, a cell of several lines going on below."""
    width: dict[int, int] = {}
    grid = [[(at, text.split("\n"), span) for at, text, span in row] for row in placed(rows)]
    for row in grid:
        for at, lines, span in row:
            for c in range(at, at + span):
                width.setdefault(c, 0)
            if span == 1:
                width[at] = max(width[at], *map(cell_width, lines))
    starts = list(itertools.accumulate((width.get(c, 0) + 2 for c in range(max(width, default=-1) + 1)), initial=0))
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, lines, _ in row), default=0)):
            line, reached = [], 0
            for at, lines, _ in row:
                if k < len(lines) and lines[k]:
                    gap = max(starts[at] - reached, 2 * (reached > 0))
                    line.append(" " * gap + lines[k])
                    reached += gap + cell_width(lines[k])
            out.append("".join(line).rstrip())
    return out


def _hidden(node: Node) -> bool:
    shut = node.tag == "dialog" and "open" not in node.attrs
    return shut or node.tag in HIDDEN or "hidden" in node.attrs or "popover" in node.attrs or bool(DISPLAY.search(node.attrs.get("style", "")))


def _shown(node: Node) -> list[Node | str]:
    """The children that are shown: of details that are not open, the first summary."""
    if node.tag != "details" or "open" in node.attrs:
        return node.children
    return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]


def _whole(text: str) -> int | None:
    found = re.match(r"\s*(-?\d{1,9})", text)
    return int(found[1]) if found else None


ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


def numeral(n: int, kind: str) -> str:
    """A list item's number: in letters for a and A, Roman for i and I where these can express it, else in digits."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(ord(kind) + k) + out
        return out
    if kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for value, letters in ROMAN:
            out += letters * (n // value)
            n %= value
        return out if kind == "i" else out.upper()
    return str(n)


class Numbers:
    """The count of a list: the next number, the step and the kind of numerals; none of a list without an order."""

    def __init__(self, node: Node) -> None:
        self.ordered, self.kind = node.tag == "ol", node.attrs.get("type", "1").strip()
        back = "reversed" in node.attrs
        first = _whole(node.attrs.get("start", ""))
        self.next = first if first is not None else sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if back else 1
        self.step = -1 if back else 1

    def mark(self, item: Node) -> str:
        if not self.ordered:
            return "- "
        value = _whole(item.attrs.get("value", ""))
        n = self.next if value is None else value
        self.next = n + self.step
        return f"{numeral(n, item.attrs.get('type', self.kind).strip())}. "


def _span(node: Node) -> int:
    found = re.match(r"\s*(\d{1,4})", node.attrs.get("colspan", ""))
    return min(max(int(found[1]), 1), 1000) if found else 1


def _deep(node: Node) -> int:
    """Rows that a cell reaches over; 0 means all that follow, which 65534, the most that HTML allows, stands for."""
    found = re.match(r"\s*(\d{1,5})", node.attrs.get("rowspan", ""))
    return min(int(found[1]), 65534) or 65534 if found else 1


def render(html: str | None) -> str:
    """All visible text of a page."""
    if not html:
        return ""
    pages, tables, lists = [Page()], [], []
    pre, seen, foreign = 0, [True], 0
    work: list[tuple[bool, Node | str]] = [(True, tree(html))]
    while work:
        enter, node = work.pop()
        page = pages[-1]
        if isinstance(node, str):
            if not seen[-1]:
                continue
            if pre:
                for i, line in enumerate(node.replace("\r\n", "\n").split("\n")):
                    if i:
                        page.br()
                    if line:
                        page.put(line)
            else:
                page.flow(node)
            continue
        tag = node.tag
        if enter:
            if _hidden(node) or foreign and tag in NOT_DRAWN:
                continue
            if tag == "br":
                page.br()
                continue
            if tag in VOID and tag != "hr":
                continue
            found = VISIBILITY.search(node.attrs.get("style", ""))
            seen.append(found[1].lower() == "visible" if found else seen[-1])
            work.append((False, node))
            work.extend((True, c) for c in reversed(_shown(node)))
            if tag == "table":
                page.apart(2)
                tables.append([])
                pages.append(Page())  # what stands in a table outside its cells comes before it
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                pages.append(Page())
            elif tag in ("ul", "ol", "menu", "dir"):
                page.apart(1 if lists else 2)
                lists.append(Numbers(node))
            elif tag == "li":
                page.apart(1)
                mark = lists[-1].mark(node) if lists else "- "
                node.attrs = {**node.attrs, "\0": mark}
                page.indent += " " * len(mark)
                page.marker = mark
            elif tag in ("dd", "blockquote"):
                page.apart(2 if tag in LOOSE else 1)
                page.indent += "  "
            elif tag in BLOCK:
                page.apart(2 if tag in LOOSE else 1)
            elif tag == "text" and foreign or tag in APART:
                page.space = page.any and not (page.breaks or page.brs)
            pre += tag == "pre"
            foreign += tag in ("svg", "math")
            continue
        seen.pop()
        pre -= tag == "pre"
        foreign -= tag in ("svg", "math")
        if tag == "table":
            outside, rows = pages.pop().text(), tables.pop()
            page = pages[-1]
            for line in [*(outside.split("\n") if outside else []), *(line for line in laid_out(rows) if line)]:
                if line:
                    page.put(line)
                page.br()
            page.brs = 0
            page.apart(2)
        elif tag in ("td", "th") and tables:
            cell = pages.pop().text()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((cell, _span(node), _deep(node)))
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
            page.apart(1 if lists else 2)
        elif tag == "li":
            page.indent = page.indent[: len(page.indent) - len(node.attrs["\0"])]
            page.marker = ""
            page.apart(1)
        elif tag in ("dd", "blockquote"):
            page.indent = page.indent[:-2]
            page.apart(2 if tag in LOOSE else 1)
        elif tag in BLOCK:
            page.apart(2 if tag in LOOSE else 1)
        elif tag == "text" and foreign or tag in APART:
            page.space = page.any and not (page.breaks or page.brs)
    return pages[0].text()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.slice(a, 200)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([render(h) for h in part.column("html").to_pylist()], pa.string())], names=["id", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(lean(run), f"id {kind}, text string")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select(F.col("id").alias("page_id"), "text", F.length("text").cast("bigint").alias("n_chars"))
