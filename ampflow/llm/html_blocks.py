"""Leaf blocks of an HTML page with the features a sequence model labels them by.

Markup is read leniently, as pages are often cut off or wrongly nested: a block is the text between two block-level
tags; it knows the elements that are open around it. Content of scripts, styles and the like is no text, and neither
is that of drawings, apart from the HTML that they embed.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Container
from dataclasses import dataclass, field

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|data-part)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Fixed values of HTML: elements whose content is no markup and no text, elements with markup whose text is not shown,
#: elements without content, and block-level elements.
RAW = {"script", "style", "textarea", "title", "iframe"}
HIDDEN = {"svg", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    *("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset").split(),
    *("figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu").split(),
    *("nav ol option p pre section select summary table tbody td tfoot th thead tr ul").split(),
}
#: Elements of another language, those inside them that hold HTML again, and the HTML tags that end them elsewhere.
FOREIGN = {"svg", "math"}
EMBEDS = {"foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext", "annotation-xml"}
ENDS_FOREIGN = BLOCK | set(
    ("b big br code em embed i img meta nobr ruby s small span strike strong sub sup tt u var").split()
)
#: A start tag ends open elements of these kinds, up to the element that may hold them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SECTIONS = {"article", "aside", "body", "div", "footer", "form", "header", "main", "nav", "section", "table"}


_HOLD_PARAGRAPHS = SECTIONS | {"li", "td", "blockquote", "object", "template", "foreignobject"}


class Element:
    """An open element with what its ancestors and itself make known, each worked out once when it opens."""

    def __init__(self, tag: str, attributes: str, parent: Element | None, place: int, known: Container[str] | None):
        self.tag, self.parent = tag, parent
        names, self.own_part = _names_of(attributes) if "=" in attributes else ((), None)
        self.names = names
        up = parent or _OUTSIDE
        self.part = self.own_part or up.part
        self.linked = up.linked or tag == "a"
        self.template = up.template or tag == "template"
        self.shown = tag not in HIDDEN and (not self.template if tag == "foreignobject" else up.shown)
        #: Place of the outermost element of another language that is open and not left for HTML again.
        self.foreign = up.foreign
        if tag in FOREIGN:
            self.foreign = place if up.foreign is None else up.foreign
        elif tag in EMBEDS:
            self.foreign = None
        self.block = place if tag in BLOCK else up.block
        self.leaf = tag if tag in BLOCK else up.leaf
        self.section = self if tag in SECTIONS else up.section
        own = {f"t:{tag}", *(f"c:{n}" for n in names), *(f"c4:{n[:4]}" for n in names)}
        if known is not None:
            own = {f for f in own if f in known}
        # Shared with the parent unless there is something new, so deep pages stay small.
        self.context = up.context if own <= up.context else up.context | own


class _Outside:
    part, linked, template, shown, foreign, block, leaf, section, context = None, False, False, True, None, -1, "none", None, frozenset()


_OUTSIDE = _Outside()


@dataclass
class Block:
    text: str
    element: Element | None
    link_chars: int
    features: list[str] = field(default_factory=list)

    @property
    def part(self) -> str | None:
        """The label that a training page gives the innermost element that has one."""
        return self.element.part if self.element else None


def _names_of(attributes: str) -> tuple[tuple[str, ...], str | None]:
    """Words of the naming attributes, and the label of a training page."""
    names, part = [], None
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() == "data-part":
            part = value
        else:
            names += [w.lower() for w in WORD.findall(value)]
    return tuple(names), part


class _Open:
    """The open elements, and where those of each tag are."""

    def __init__(self, known: Container[str] | None):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.known = known

    @property
    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def push(self, tag: str, attributes: str) -> None:
        place = len(self.stack)
        self.stack.append(Element(tag, attributes, self.top, place, self.known))
        self.places.setdefault(tag, []).append(place)

    def cut(self, place: int) -> None:
        """Closes the elements from a place on."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def innermost(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else -1

    def close(self, kinds: set[str], within: set[str]) -> None:
        """Ends the outermost open element of ``kinds`` that lies inside the innermost of ``within``."""
        floor = max(map(self.innermost, within)) + 1
        found = []
        for kind in kinds:
            places = self.places.get(kind, ())
            at = bisect_left(places, floor)
            found += places[at : at + 1]
        if found:
            self.cut(min(found))

    def end(self, tag: str) -> None:
        """Ends the innermost open element of a tag; an inline end tag does not end blocks."""
        place = self.innermost(tag)
        if place >= 0 and (tag in BLOCK or place > self.stack[-1].block):
            self.cut(place)


def blocks(page: str, known: Container[str] | None = None) -> list[Block]:
    """Blocks with text, in page order, white space turned into single spaces.

    The time is linear in the page, however deep it is. ``known`` names the features that matter to the caller.
    """
    out: list[Block] = []
    held = _Open(known)
    runs: list[str] = []
    link_chars = 0

    def end_block() -> None:
        nonlocal link_chars
        text = " ".join("".join(runs).split())
        if text:
            out.append(Block(text, held.top, link_chars))
        runs.clear()
        link_chars = 0

    at = 0
    while True:
        found = TAG.search(page, at)
        run = page[at : found.start()] if found else page[at:]
        around = held.top or _OUTSIDE
        if run and around.shown:
            shown = entities.unescape(run) if "&" in run else run
            runs.append(shown)
            if around.linked:
                link_chars += len(shown.strip())
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        tag = name.lower()
        foreign = around.foreign
        if foreign is not None and tag in ENDS_FOREIGN and not closing:
            held.cut(foreign)
            foreign = None
        if tag in RAW and not closing and (foreign is None or (tag in ("script", "style") and not attributes.endswith("/"))):
            ended = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = ended.end() if ended else len(page)
            continue
        if tag == "br":
            runs.append(" ")
            continue
        if tag in BLOCK:
            end_block()
        if closing:
            held.end(tag)
            continue
        if tag in BLOCK:
            held.close({"p"}, _HOLD_PARAGRAPHS)
        if tag in ENDS:
            held.close(*ENDS[tag])
        if tag not in VOID and not attributes.endswith("/"):
            held.push(tag, attributes)
    end_block()
    return out


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


def described(page: str, known: Container[str] | None = None) -> list[Block]:
    """Blocks of a page with their features: open elements and their names, and properties of the text."""
    found = blocks(page, known)
    total = len(found)
    for i, block in enumerate(found):
        text, around = block.text, block.element or _OUTSIDE
        words = text.count(" ") + 1
        section = around.section
        features = ["bias", *around.context, f"leaf:{around.leaf}", f"section:{section.tag if section else 'none'}"]
        if section:
            features += [f"near:{n}" for n in section.names] + [f"near4:{n[:4]}" for n in section.names]
            features.append(f"named:{bool(section.names)}")
        features += [f"words:{_bucket(words, (3, 8, 20, 60))}", f"links:{_bucket(block.link_chars / len(text), (0.01, 0.5, 0.9))}"]
        features += [f"place:{_bucket((i + 0.5) / total, (0.1, 0.9))}", f"end:{text[-1] in '.!?…'}"]
        if "©" in text or "copyright" in text.lower():
            features.append("copyright")
        block.features = features
    return found
