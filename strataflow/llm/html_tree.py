"""A page as a tree of block elements with runs of text as leaves, in page order.

It follows the HTML rules that matter to where text stands: implied end tags, scopes of end tags, raw text,
comments, stray markup. Inline elements make no nodes: their text belongs to the run around it.
"""

from __future__ import annotations

import re
from html import unescape

# Elements of HTML by what they mean for the tree.
INLINE = set(
    "a abbr acronym area b base bdi bdo big br cite code col data del dfn em embed font i img input ins kbd "
    "label link map mark meta meter nobr output param picture progress q rp rt ruby s samp small source span "
    "strike strong sub sup time track tt u var wbr".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = RAW | set(
    "audio button canvas datalist noscript object select svg template video".split()
)
FRAME = {"html", "head", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CELLS = {"td", "th", "caption"}
TABLE_PARTS = CELLS | {"table", "thead", "tbody", "tfoot", "tr"}
LISTS = {"ul", "ol", "menu", "dir", "dl"}
# What a start tag closes: open elements of these names, looked for up to one of the others.
CLOSES = {
    "li": ({"li"}, LISTS | TABLE_PARTS),
    "dt": ({"dt", "dd"}, LISTS | TABLE_PARTS),
    "dd": ({"dt", "dd"}, LISTS | TABLE_PARTS),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
TEXT = "#text"

_MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
# Quotes count after an equals sign only; one that is never closed is an ordinary character.
_REST = re.compile(r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+>""")
_COMMENT_END = re.compile(r"--!?>")
_NAMES = re.compile(
    r"""(?<![\w-])(class|id|role|data-content)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tree:
    """Nodes in page order, node 0 being the page: parent, tag, words of its names, text, link share.

    ``given`` is what a labelled page says of an element by its attribute data-content ("1", "0" or "").
    """

    def __init__(self) -> None:
        self.parent, self.tag, self.names = [-1], ["body"], [[]]
        self.text, self.linked, self.given = [""], [0], [""]

    def add(self, parent: int, tag: str, names: list[str], text: str, linked: int, given: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.given.append(given)
        return len(self.tag) - 1


def _attributes(rest: str) -> tuple[list[str], str]:
    """Words of an element's names, in lower case, and its label."""
    names, given = [], ""
    for name, a, b, c in _NAMES.findall(rest):
        if name.lower() == "data-content":
            given = a or b or c
        else:
            names += [part.lower() for part in _PART.findall(a or b or c)]
    return names, given


class _Builder:
    def __init__(self) -> None:
        self.tree = Tree()
        self.open, self.count = [0], {}
        self.pieces: list[str] = []
        self.link_chars, self.link_at = 0, None

    def text(self, raw: str) -> None:
        if raw:
            piece = unescape(raw) if "&" in raw else raw
            self.pieces.append(piece)
            if self.link_at is not None:
                self.link_chars += len(piece)

    def flush(self) -> None:
        """What has come since the last edge of a block becomes a leaf, unless it is white."""
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            linked = min(self.link_chars, len(text))
            self.tree.add(self.open[-1], TEXT, [], text, linked, "")
        self.pieces, self.link_chars = [], 0

    def pop(self) -> str:
        node = self.open.pop()
        tag = self.tree.tag[node]
        self.count[tag] -= 1
        if self.link_at == node:
            self.link_at = None
        return tag

    def pop_through(self, wanted: set[str], limits: set[str]) -> None:
        """Close the innermost open element of these names, unless a limit stands before it."""
        if not any(self.count.get(tag) for tag in wanted):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tree.tag[self.open[depth]]
            if tag in wanted:
                while len(self.open) > depth:
                    self.pop()
                return
            if tag in limits:
                return

    def start(self, tag: str, rest: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "a":
                self.link_at = self.open[-1]
            return
        self.flush()
        if tag in FRAME or tag == "hr":
            if tag == "body":
                self.tree.given[0] = _attributes(rest)[1] or self.tree.given[0]
            return
        top = self.tree.tag[self.open[-1]]
        if top == "p" or (top in HEADINGS and tag in HEADINGS):
            self.pop()
        if tag in CLOSES:
            self.pop_through(*CLOSES[tag])
        names, given = _attributes(rest)
        self.open.append(self.tree.add(self.open[-1], tag, names, "", 0, given))
        self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.link_at = None
            elif tag == "br":
                self.pieces.append(" ")
            return
        self.flush()
        if tag in FRAME:
            return
        if tag in TABLE_PARTS:
            limits = {"table"}
        elif tag == "li":
            limits = TABLE_PARTS | LISTS
        else:
            limits = CELLS | {"table"}
        self.pop_through(HEADINGS if tag in HEADINGS else {tag}, limits - {tag})


def parse(html: str) -> Tree:
    """The tree of a page. Any string gives one, in time and memory in proportion to its length."""
    builder, at, absent = _Builder(), 0, set()
    while True:
        found = _MARKUP.search(html, at)
        if not found:
            builder.text(html[at:])
            break
        builder.text(html[at : found.start()])
        comment, closing, tag = found.groups()
        if comment:
            # "<!-->" and "<!--->" are whole comments.
            short = re.compile(r"-?>").match(html, found.end())
            stop = short or _COMMENT_END.search(html, found.end())
        elif tag is None:
            stop = re.compile(">").search(html, found.end())
        else:
            stop = _REST.match(html, found.end())
        if not stop:
            break
        at = stop.end()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            builder.end(tag)
            continue
        if tag in UNSEEN and tag not in absent:
            closed = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            if closed:
                at = closed.end()
                continue
            if tag in RAW:
                break
            absent.add(tag)
        if tag not in UNSEEN:
            builder.start(tag, stop.group())
    builder.flush()
    return builder.tree
