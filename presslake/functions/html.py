"""Pick text nodes and attributes out of one HTML page.

A single tolerant pass over the tags; the open elements are kept on a stack and
every rule is matched against that stack, so no tree is built. What the picked
nodes mean is decided in Spark expressions (``operators.extract``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from html import unescape
from urllib.parse import urljoin

# Elements without content, elements an inline end tag must not
# close, and elements whose text is no markup.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "article aside body div footer head header html li main nav ol section table tbody td "
    "th thead tr ul".split()
)

RAW_TEXT = frozenset(("script", "style"))

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"  # comment
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"  # start or end tag
    r"|<[!?/][^>]*>",  # doctype and the like
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?"
)
_STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*)?(?:#(?P<id>[\w-]+))?(?:\.(?P<cls>[\w-]+))?$")


@dataclass(frozen=True)
class Rule:
    """What to pick: nodes under ``selectors`` (descendant chains, any may match).

    ``pick`` is ``text`` (direct text nodes), ``deep`` (all text nodes below) or
    one or more attribute names; several names give one tuple per element, a
    single name gives its value where the attribute is present. ``anywhere``
    ignores the container, ``contains`` filters the value, ``resolve`` makes it
    an absolute URL.
    """

    slot: str
    selectors: tuple[str, ...]
    pick: str | tuple[str, ...]
    anywhere: bool = False
    contains: str = ""
    resolve: bool = False


def _step(text: str):
    return _STEP.match(text).group("tag", "id", "cls")


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; the first of a repeated name counts."""
    values = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        values.setdefault(name.lower(), unescape(double or single or bare))
    return values


def _absolute(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:  # e.g. a broken IPv6 host: keep the link as it stands
        return link


class Element:
    """An open element: what rules may ask for, and the slots its text goes to."""

    __slots__ = ("tag", "id", "classes", "inside", "own", "deep")

    def __init__(self, tag: str, values: dict[str, str], parent: Element | None):
        self.tag = tag
        self.id = values.get("id")
        self.classes = values["class"].split() if "class" in values else ()
        self.inside = parent is not None and parent.inside
        self.own: list[str] = []
        self.deep = parent.deep if parent else ()

    def fits(self, step) -> bool:
        tag, ident, cls = step
        return (
            (tag is None or self.tag == tag)
            and (ident is None or self.id == ident)
            and (cls is None or cls in self.classes)
        )


class PagePicker:
    """Collects the values of every rule for one page after another."""

    def __init__(self, rules: Sequence[Rule], container: str | None):
        self.slots = [rule.slot for rule in rules]
        self.container = _step(container) if container else None
        # (rule number, rule, attribute it needs, last step, steps above it from
        # the inside out) per chain
        self.chains = []
        for number, rule in enumerate(rules):
            needs = rule.pick[0] if isinstance(rule.pick, tuple) and len(rule.pick) == 1 else None
            for chain in rule.selectors:
                *above, last = [_step(part.replace("*", "")) for part in chain.split(" ")]
                self.chains.append((number, rule, needs, last, above[::-1]))
        self.by_tag: dict[str, list] = {}

    def pick(self, html: str | None, url: str | None) -> dict[str, list] | None:
        """Values per slot, or None for a page without the container."""
        html = html or ""
        self.base = url or ""
        self.stack: list[Element] = []
        self.found = self.container is None
        self.out: dict[str, list] = {slot: [] for slot in self.slots}
        self.pending: list[str] = []
        at = 0
        while match := _TAG.search(html, at):
            if match.start() > at:
                self._text(html[at : match.start()])
            at = match.end()
            closing, tag, attributes = match.groups()
            if not tag:
                self._end_text()
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            self._open(tag, _attributes(attributes) if attributes else {})
            if tag in RAW_TEXT:
                end = re.compile(f"</{tag}", re.IGNORECASE).search(html, at)
                stop = end.start() if end else len(html)
                self._text(html[at:stop], raw=True)
                at = stop
        self._text(html[at:])
        self._end_text()
        return self.out if self.found else None

    def _open(self, tag: str, values: dict[str, str]) -> None:
        self._end_text()
        if tag == "base" and values.get("href"):
            self.base = _absolute(self.base, values["href"])
        if tag == "p":
            self._close("p")
        element = Element(tag, values, self.stack[-1] if self.stack else None)
        if self.container and not element.inside and element.fits(self.container):
            element.inside = self.found = True
        candidates = self.by_tag.get(tag)
        if candidates is None:
            candidates = [c for c in self.chains if c[3][0] in (None, tag)]
            self.by_tag[tag] = candidates
        taken = -1
        everywhere = element.inside or not self.container
        for number, rule, needs, last, above in candidates:
            if number == taken or not (everywhere or rule.anywhere):
                continue
            if needs is not None and needs not in values:
                continue
            if element.fits(last) and (not above or self._under(above, rule)):
                taken = number
                self._take(rule, element, values)
        if tag not in VOID:
            self.stack.append(element)

    def _under(self, above, rule: Rule) -> bool:
        """Whether the open elements contain the chain ``above``, inside out."""
        steps = iter(above)
        step = next(steps)
        for element in reversed(self.stack):
            if self.container and not rule.anywhere and not element.inside:
                return False
            if element.fits(step):
                step = next(steps, None)
                if step is None:
                    return True
        return False

    def _take(self, rule: Rule, element: Element, values: dict[str, str]) -> None:
        if rule.pick == "text":
            element.own.append(rule.slot)
        elif rule.pick == "deep":
            if rule.slot not in element.deep:
                element.deep = (*element.deep, rule.slot)
        elif len(rule.pick) > 1:
            self.out[rule.slot].append(tuple(values.get(name) for name in rule.pick))
        else:
            value = values[rule.pick[0]]
            if rule.contains in value:
                self.out[rule.slot].append(_absolute(self.base, value) if rule.resolve else value)

    def _close(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[depth].tag
            if open_tag == tag:
                self._end_text()
                del self.stack[depth:]
                return
            if open_tag in BLOCKS and tag not in BLOCKS:
                break
        if tag == "p":  # a stray </p> stands for an empty paragraph
            self._end_text()

    def _text(self, text: str, raw: bool = False) -> None:
        if text and self.stack and (self.stack[-1].own or self.stack[-1].deep):
            self.pending.append(text if raw else unescape(text))

    def _end_text(self) -> None:
        """A text node ends where an element opens or closes, or at a comment."""
        if self.pending:
            top = self.stack[-1]
            text = "".join(self.pending)
            self.pending.clear()
            for slot in (*top.own, *top.deep):
                self.out[slot].append(text)
