"""Visible text of HTML pages, laid out.

A tolerant tree builder supplies the tags that HTML lets authors leave out (head
and body, ends of paragraphs, items, rows and cells). Visibility rules drop what a
browser does not draw: the head, scripts, templates, ``hidden`` elements, and
elements that a ``style`` attribute or a rule of a style sheet hides on every screen
and that no rule could show again. The
renderer then writes blocks on lines of their own, a blank line around paragraphs
and headings, markers and indentation for lists, preformatted text as it is, and
the cells of a table padded to aligned columns.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD_ONLY = frozenset("base link meta script style title".split())
UNSEEN = frozenset(
    "head script style title template noscript noembed noframes iframe object audio video canvas "
    "datalist desc metadata defs symbol clippath annotation annotation-xml progress meter".split()
)
# Inputs whose value is not drawn as text.
UNREAD_INPUTS = frozenset("hidden password radio checkbox file range color image".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure hr fieldset".split())
BLOCKS = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header "
    "hgroup html legend li main menu nav optgroup option search section summary tbody td tfoot th thead tr".split()
)
CLOSES_P = BLOCKS - frozenset("html body caption td th tr tbody thead tfoot option optgroup".split())
# An opening tag ends these open elements, up to the given containers.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
}
# A part of a table ends what stands open inside the element that takes it.
TABLE_PARTS = {
    "td": {"tr", "tbody", "thead", "tfoot", "table"},
    "th": {"tr", "tbody", "thead", "tfoot", "table"},
    "tr": {"tbody", "thead", "tfoot", "table"},
    **dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup"), {"table"}),
}

REST_OF_GROUP = 1 << 30  # rows of a cell that spans all rows below it

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
_CSS_MARK = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[{};]", re.DOTALL)
_AT_RULE = re.compile(r"@([\w-]+)\s*(.*)", re.DOTALL)
_NAME = r"(?:[\w-]|\\.)+"
_SIMPLE = re.compile(rf"(?:\*|[a-zA-Z]{_NAME}|[a-zA-Z])?(?:[.#]{_NAME})*")
_MARK = re.compile(rf"(?:\A|[.#]){_NAME}")
# Rules for pseudo-elements, and for states that a page does not have as it is loaded.
_OTHER = re.compile(r"::|:(?:before|after|first-line|first-letter|hover|focus|active|target)\b", re.IGNORECASE)
_ASIDE = re.compile(r"\[[^\]]*\]|:[\w-]+(?:\([^)]*\))?|&")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_WHOLE = re.compile(r"-?[0-9]{1,6}")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def _whole(text: str | None, default: int) -> int:
    """A number in an attribute; ``default`` if it is none, or too long to be meant."""
    return int(text) if text and _WHOLE.fullmatch(text) else default


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


class TreeBuilder:
    """Builds the element tree of one page; ``sheets`` collects the style sheets."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]
        self.sheets: list[str] = []
        self.in_head = self.has_body = False

    def parse(self, html: str) -> Node:
        at = 0
        while True:
            found = _MARKUP.search(html, at)
            if not found:
                self._text(html[at:])
                return self.root
            self._text(html[at : found.start()])
            at = found.end()
            closing, tag, rest = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
                continue
            attributes = _attributes(rest) if rest.strip(" /\n\t") else {}
            self._start(tag, attributes, rest.endswith("/"))
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(html, at)
                raw = html[at : stop.start()] if stop else html[at:]
                if tag == "style":
                    media = attributes.get("media", "")
                    self.sheets.append(f"@media {media} {{{raw}}}" if media else raw)
                elif raw and self.open[-1].tag == tag:
                    self.open[-1].children.append(raw if tag in ("script", "xmp") else unescape(raw))
                at = stop.start() if stop else len(html)

    def _text(self, text: str) -> None:
        if not text:
            return
        if not text.isspace():
            self._enter_body()
        if not self.in_head:
            self.open[-1].children.append(unescape(text))

    def _enter_body(self) -> None:
        if self.in_head:
            self._leave_head()
        if not self.has_body and not any(n.tag == "body" for n in self.open):
            self._push(Node("body"))
        self.has_body = True

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def _start(self, tag: str, attributes: dict[str, str], slash: bool) -> None:
        if tag == "html":
            self.root.attributes.update(attributes)
            return
        if tag == "head":
            if not self.in_head and not self.has_body:
                self._push(Node("head", attributes))
                self.in_head = True
            return
        if tag == "body":
            if not self.has_body:
                if self.in_head:
                    self._leave_head()
                self._push(Node("body", attributes))
                self.has_body = True
            return
        if tag not in HEAD_ONLY and tag not in ("template", "noscript"):
            self._enter_body()
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "li", "div", "body"})
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in TABLE_PARTS:
            self._back_to(TABLE_PARTS[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr"))
        if tag == "tr" and self.open[-1].tag == "table":
            self._push(Node("tbody"))
        node = Node(tag, attributes)
        # A form between the parts of a table holds nothing.
        between = tag == "form" and self.open[-1].tag in TABLE_PARTS["td"]
        if tag in VOID or between or (slash and (tag in ("svg", "math") or self._in_drawing())):
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _close(self, tags: set[str], until: set[str]) -> None:
        """End the outermost open element of ``tags`` inside the nearest of ``until``."""
        last = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in until:
                break
            if self.open[i].tag in tags:
                last = i
        if last is not None:
            del self.open[last:]

    def _in_drawing(self) -> bool:
        nearest = (n.tag for n in reversed(self.open) if n.tag in ("svg", "math", "foreignobject"))
        return next(nearest, "") in ("svg", "math")

    def _back_to(self, tags: set[str]) -> None:
        """End what is open inside the nearest of ``tags``; text around a table stays where it is."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i + 1 :]
                return

    def _end(self, tag: str) -> None:
        if tag == "head" and self.in_head:
            self._leave_head()
            return
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._start("br", {}, False)
            return
        if tag == "p" and not any(n.tag == "p" for n in self.open):
            self._start("p", {}, False)
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("td", "th", "table", "body") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return

    def _leave_head(self) -> None:
        while self.open.pop().tag != "head":
            pass
        self.in_head = False


def _holds(rule: str) -> int:
    """Whether an at-rule's block holds on a screen: 2 always, 1 maybe, 0 never."""
    found = _AT_RULE.match(rule)
    name, condition = (found[1].lower(), found[2].lower().strip()) if found else ("", "")
    if name == "layer":
        return 2
    if name != "media":
        return 1 if name in ("supports", "container", "scope", "starting-style", "-moz-document") else 0
    best = 0 if condition else 2
    for query in condition.split(","):
        words = query.replace("(", " (").split()
        negated = words[:1] == ["not"]
        words = [w for w in words if w not in ("not", "only")]
        screen = not words or words[0].startswith("(") or words[0] in ("all", "screen")
        features = "(" in query
        if negated:
            best = max(best, (1 if features else 0) if screen else 2)
        elif screen and words:
            best = max(best, 1 if features else 2)
    return best


def _blocks(sheet: str) -> Iterator[tuple[str, str, int, bool]]:
    """Selectors, declarations, whether they hold (see ``_holds``), and whether in a layer."""
    sheet = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", sheet, flags=re.DOTALL)
    open_blocks: list[tuple[str, int, bool, list[str]]] = []
    begin = 0
    for at, end, mark in [*((m.start(), m.end(), m[0]) for m in _CSS_MARK.finditer(sheet)), (len(sheet), len(sheet), "")]:
        if mark[:1] in ("'", '"') and mark:
            continue
        text, begin = sheet[begin:at], end
        if mark == "{":
            rule = text.strip()
            selectors, holds, layered, _ = open_blocks[-1] if open_blocks else ("", 2, False, [])
            if rule.startswith("@"):
                layered = layered or rule[:6].lower() == "@layer"
                open_blocks.append((selectors, min(holds, _holds(rule)), layered, []))
            else:  # a rule inside a rule depends on the outer one
                open_blocks.append((rule, min(holds, 1) if selectors else holds, layered, []))
        elif open_blocks:
            open_blocks[-1][3].append(text)
            for _ in range({"}": 1, "": len(open_blocks)}.get(mark, 0)):
                selectors, holds, layered, body = open_blocks.pop()
                if selectors and holds:
                    yield selectors, ";".join(body), holds, layered


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """For ``display`` and ``visibility``, as far as they are set: whether hidden, and whether important."""
    out: dict[str, tuple[bool, bool]] = {}
    for part in body.split(";"):
        name, _, value = part.partition(":")
        name = name.strip().lower()
        if name in ("display", "visibility"):
            word, _, flag = value.lower().partition("!")
            important = flag.strip() == "important"
            if important or not out.get(name, (False, False))[1]:
                out[name] = (word.strip() in (("none",) if name == "display" else ("hidden", "collapse")), important)
    return out


class Styles:
    """What style sheets say about ``display`` and ``visibility``.

    An element is hidden if a rule hides it that surely matches (a selector of tag,
    classes and id alone, on every screen) and no rule of higher rank could show it
    (the last part of its selector matches, its block may hold on a screen).
    """

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list[tuple[frozenset[str], str, bool, tuple]]] = {}
        self.hides = False
        order = 0
        for sheet in sheets:
            for selectors, body, holds, layered in _blocks(sheet):
                declared = _declared(body)
                for selector in re.split(r",(?![^(]*\))", selectors) if declared else ():
                    order += 1
                    self._add(selector.strip(), declared, holds, layered, order)

    def _add(self, selector: str, declared: dict[str, tuple[bool, bool]], holds: int, layered: bool, order: int) -> None:
        if not selector or _OTHER.search(selector):
            return
        simple = _SIMPLE.fullmatch(selector) is not None
        parts = re.split(r"[\s>+~]+", _ASIDE.sub("", selector).strip() if not simple else selector)
        marks = {m.replace("\\", "") for m in _MARK.findall(parts[-1])}
        marks = frozenset(m if m[0] in ".#" else m.lower() for m in marks)
        rank = (
            len(re.findall(rf"#{_NAME}", selector)),
            len(re.findall(rf"\.{_NAME}|\[|:\w", selector)),
            sum(p[:1].isalpha() for p in parts),
        )
        for name, (hides, important) in declared.items():
            if hides and not (simple and holds == 2):
                continue
            self.hides |= hides
            key = max(marks, key=lambda m: ".#".find(m[0]), default="")
            self.rules.setdefault(key, []).append((marks, name, hides, (important, important == layered, 0, *rank, order)))

    def hidden(self, node: Node) -> bool:
        attributes = node.attributes
        own = _declared(attributes["style"]) if "style" in attributes else {}
        if not self.hides and not any(hides for hides, _ in own.values()):
            return False
        marks = {node.tag, *(f".{c}" for c in attributes.get("class", "").split()), f"#{attributes.get('id', '')}"}
        best = {name: ((important, True, 1), hides) for name, (hides, important) in own.items()}
        for key in ("", *marks):
            for needed, name, hides, rank in self.rules.get(key, ()):
                if needed <= marks and (name not in best or rank > best[name][0]):
                    best[name] = (rank, hides)
        return any(hides for _, hides in best.values())


def visible(node: Node, styles: Styles) -> bool:
    tag, attributes = node.tag, node.attributes
    if tag in UNSEEN or "hidden" in attributes or (tag == "dialog" and "open" not in attributes):
        return False
    if tag == "input" and attributes.get("type", "").lower() == "hidden":
        return False
    return not styles.hidden(node)


def _opened(node: Node) -> Node:
    """``node`` as it is drawn: closed details show their first summary only."""
    if node.tag != "details" or "open" in node.attributes:
        return node
    summaries = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"]
    return Node(node.tag, node.attributes, summaries[:1])


Walk = Generator["Walk", None, None]


class Renderer:
    """Writes the visible text of a tree as lines.

    The methods that go down the tree yield the steps to take next; ``render`` keeps
    them in a list, so a tree may be of any depth.
    """

    def __init__(self, styles: Styles):
        self.styles = styles
        self.lines: list[str] = []
        self.line = ""
        self.indent = ""
        self.marker = ""
        self.blank = False  # a blank line is due before the next text

    def render(self, node: Node) -> str:
        waiting = [self._element(node)]
        while waiting:
            step = next(waiting[-1], None)
            if step is None:
                waiting.pop()
            else:
                waiting.append(step)
        self._break()
        return "\n".join(self.lines)

    def _break(self, spaced: bool = False) -> None:
        text = self.line.rstrip(" ")
        if text:
            self._put(text)
        self.line = ""
        self.blank = self.blank or (spaced and bool(self.lines))

    def _put(self, text: str) -> None:
        if self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank = False
        lead = self.indent
        if self.marker:
            lead = self.indent[: len(self.indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + text).rstrip() if text else "")

    def _children(self, node: Node, pre: bool = False) -> Walk:
        for child in node.children:
            if isinstance(child, str):
                self._text(child, pre)
            elif visible(child, self.styles):
                yield self._element(child, pre)

    def _text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.line += first
            for part in rest:
                self._put(self.line)
                self.line = part
            return
        text = _BLANKS.sub(" ", text)
        self.line += text[1:] if text.startswith(" ") and (not self.line or self.line.endswith(" ")) else text

    def _element(self, node: Node, pre: bool = False) -> Walk:
        tag = node.tag
        if tag == "br":
            if self.line.strip(" "):
                self._break()
            elif self.lines and not self.blank:
                self._put("")
            self.line = ""
        elif tag == "hr":
            self._break(True)
            self._put("---")
            self._break(True)
        elif tag == "img":
            self._text(node.attributes.get("alt", ""), pre)
        elif tag == "input":
            kind = node.attributes.get("type", "").strip().lower()
            shown = "alt" if kind == "image" else "value"
            if shown == "alt" or kind not in UNREAD_INPUTS:
                self._text(node.attributes.get(shown, ""), pre)
        elif tag == "table":
            self._break(True)
            yield self._table(node)
            self._break(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            yield self._list(node)
        elif tag == "textarea":
            node.children = [c.removeprefix("\n") if isinstance(c, str) else c for c in node.children]
            yield self._children(node, True)
        elif tag == "svg":
            yield self._drawing(node)
        elif tag in BLOCKS:
            spaced = tag in SPACED and not (tag == "p" and self.marker)
            self._break(spaced)
            outer = self.indent
            if tag in ("dd", "blockquote"):
                self.indent += "    "
            yield self._children(_opened(node), pre or tag == "pre")
            self._break(spaced)
            self.indent = outer
        else:
            yield self._children(node, pre)

    def _drawing(self, node: Node) -> Walk:
        """Only the text elements of a drawing, and HTML in it, are drawn."""
        for child in node.children:
            if isinstance(child, Node) and visible(child, self.styles):
                if child.tag in ("text", "foreignobject"):
                    self._break()
                    yield self._children(child)
                    self._break()
                else:
                    yield self._drawing(child)

    def _list(self, node: Node) -> Walk:
        nested = bool(self.indent)
        self._break(not nested)
        outer = self.indent
        step = -1 if "reversed" in node.attributes else 1
        items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
        number = _whole(node.attributes.get("start"), 1 if step > 0 else items)
        for child in node.children:
            if isinstance(child, str) or child.tag != "li":
                if isinstance(child, Node) and visible(child, self.styles):
                    yield self._element(child)
                elif isinstance(child, str):
                    self._text(child, False)
                continue
            if not visible(child, self.styles):
                continue
            self._break()
            number = _whole(child.attributes.get("value"), number)
            self.marker = f"{number}. " if node.tag == "ol" else "- "
            number += step
            self.indent = outer + " " * len(self.marker)
            yield self._children(child)
            self._break()
            self.marker, self.indent = "", outer
        self._break(not nested)

    def _table(self, node: Node) -> Walk:
        rows: list[list[list[str]]] = []
        for part in node.children:
            below: dict[int, int] = {}
            if isinstance(part, Node) and part.tag in ("thead", "tbody", "tfoot"):
                if visible(part, self.styles):
                    for child in part.children:
                        yield self._part(child, rows, below)
            else:
                yield self._part(part, rows, below)
        self._break()
        rows = [r for r in rows if any(any(c) for c in r)]
        widths = [
            max((len(line) for r in rows if i < len(r) for line in r[i]), default=0)
            for i in range(max(map(len, rows), default=0))
        ]
        for row in rows:
            for i in range(max(map(len, row))):
                cells = [(cell[i] if i < len(cell) else "").ljust(w) for cell, w in zip(row, widths)]
                self._put(" | ".join(cells).rstrip())

    def _part(self, part: Node | str, rows: list[list[list[str]]], below: dict[int, int]) -> Walk:
        """A row of a table; what is none stands before the table."""
        if isinstance(part, Node) and part.tag == "tr":
            if visible(part, self.styles):
                rows.append([])
                yield self._cells(part, rows[-1], below)
        else:
            yield self._stray(part)

    def _stray(self, part: Node | str) -> Walk:
        if isinstance(part, str):
            self._text(part, False)
        elif visible(part, self.styles):
            yield self._element(part)

    def _cells(self, row: Node, cells: list[list[str]], below: dict[int, int]) -> Walk:
        """The lines of each cell; the other places that a cell spans are empty.

        ``below`` says for how many more rows of the group a column is taken by a cell
        from above.
        """
        taken = {column for column, rows in below.items() if rows > 0}
        for column in taken:
            below[column] -= 1
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                yield self._stray(cell)
            elif visible(cell, self.styles):
                inner = Renderer(self.styles)
                yield inner._children(cell)
                inner._break()
                while len(cells) in taken:
                    cells.append([])
                first = len(cells)
                cells.append([line for line in inner.lines if line])
                cells += [[] for _ in range(min(_whole(cell.attributes.get("colspan"), 1), 1000) - 1)]
                rows = _whole(cell.attributes.get("rowspan"), 1)
                for column in range(first, len(cells)):
                    below[column] = max((REST_OF_GROUP if rows == 0 else rows) - 1, below.get(column, 0), 0)
        while any(column >= len(cells) for column in taken):
            cells.append([])


def visible_text(html: str) -> str:
    """The laid-out visible text of one page."""
    builder = TreeBuilder()
    root = builder.parse(html)
    return Renderer(Styles(builder.sheets)).render(root)


def extract_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and ``text``, the visible text of the whole page.

    A null page has a null text, an empty one an empty text; broken markup is read
    as far as it makes sense and never fails, however deep its elements are nested.
    Repeated rows give repeated results, an empty table none.
    """
    rows = pages.select(*keep, F.col(html).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [None if h is None else visible_text(h) for h in part.column("_html").to_pylist()]
                columns = [*part.columns[:-1], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_html"]
    return rows.mapInArrow(run, ", ".join([*fields, "text string"]))
