"""A small tolerant reader of HTML: elements, their parents, and text in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What they hold is no page text, and has no elements.
RAW = frozenset("script style template textarea title".split())
# In these an element may end itself.
FOREIGN = frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt "
    "s samp small span strike strong sub sup time tt u var math mrow mi mn mo ms mtext msup msub "
    "msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mfenced semantics".split()
)
# An open paragraph ends where one of these begins.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
    "summary table ul".split()
)
# Elements that end an open one of the same family, up to the family's container.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(_ENDS_P | {'body', 'html'}))})\b[^>]*>", re.I)

# Attributes that tell what an element is for.
_TELLING = frozenset({"class", "id", "role", "itemprop", "aria-label"})


@dataclass
class Page:
    """``tags``, ``hints`` and ``parents`` by element; ``events`` in page order.

    Element 0 is the page itself. An event is (element, text), or (element,
    None) where a block begins or ends.
    """

    tags: list[str] = field(default_factory=lambda: ["#page"])
    hints: list[str] = field(default_factory=lambda: [""])
    marks: list[str | None] = field(default_factory=lambda: [None])
    parents: list[int] = field(default_factory=lambda: [-1])
    events: list[tuple[int, str | None]] = field(default_factory=list)


def read(source: str) -> Page:
    """Elements of a page. Inline elements without a telling attribute belong to their parent.

    Ends that are missing are added as browsers do for paragraphs, list items
    and table cells; ends that fit nothing are ignored, and what is no tag is
    text. An unfinished script or the like ends at the next tag of a block,
    which it cannot hold, and an unfinished comment at the next ``>``.
    """
    page = Page()
    # Open elements: (tag, number of the element that holds its text).
    stack: list[tuple[str, int]] = [("#page", 0)]

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag, node = stack.pop()
            if tag not in INLINE:
                page.events.append((stack[-1][1], None))

    def add_text(text: str) -> None:
        if text:
            page.events.append((stack[-1][1], html.unescape(text)))

    def open_tag(tag: str, rest: str) -> None:
        if tag in _ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        if tag in _SIBLINGS:
            family, walls = _SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in family:
                    close(depth)
                    if tag != "tr" or depth == 1 or stack[depth - 1][0] not in family:
                        break
                elif stack[depth][0] in walls:
                    break
        hint, mark = "", None
        if "=" in rest:
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                if name.lower() in _TELLING:
                    hint += " " + (a or b or c)
                elif name == "data-label":
                    mark = a or b or c
            hint = hint.lower()
        if tag == "br":
            page.events.append((stack[-1][1], " "))
            return
        if tag in VOID:
            if tag == "hr":
                page.events.append((stack[-1][1], None))
            return
        owner = stack[-1][1]
        if tag not in INLINE or hint or mark:
            node = len(page.tags)
            page.tags.append(tag)
            page.hints.append(hint)
            page.marks.append(mark)
            page.parents.append(owner)
            owner = node
        if tag not in INLINE:
            page.events.append((owner, None))
        stack.append((tag, owner))

    at, end = 0, len(source)
    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            add_text(source[at:])
            break
        if lt > at:
            add_text(source[at:lt])
        if source.startswith("<!--", lt):
            stop = source.find("-->", lt + 4)
            if stop < 0:
                stop = source.find(">", lt + 4) - 2
            at = end if stop < lt else stop + 3
            continue
        if source.startswith(("<!", "<?"), lt):
            stop = source.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        found = _TAG.match(source, lt)
        if not found:
            add_text("<")
            at = lt + 1
            continue
        at = found.end()
        tag = found[2].lower()
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag in RAW and not found[3].endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            block = None if stop else _BLOCK.search(source, at)
            at = stop.end() if stop else block.start() if block else end
            continue
        open_tag(tag, found[3])
        if found[3].endswith("/") and tag not in VOID and stack[-1][0] == tag:
            if tag in FOREIGN or any(own in FOREIGN for own, _ in stack):
                close(len(stack) - 1)
    close(1)
    return page


def squeezed(text: str) -> str:
    return _SPACE.sub(" ", text).strip(" ")
