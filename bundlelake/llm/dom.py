"""HTML to a tree of nodes, by the rules that matter for text: raw-text
elements, void elements, implied end tags, ignored stray end tags."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe svg object canvas audio video map noembed noframes "
                   "textarea select option button datalist title".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table "
                  "tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
# start tag -> open elements it ends, up to the element that holds them
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
                    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass
class Tree:
    """Nodes in page order; a text node has tag ``#text``."""
    tag: list = field(default_factory=list)
    parent: list = field(default_factory=list)
    attrs: list = field(default_factory=list)
    text: list = field(default_factory=list)

    def add(self, tag: str, parent: int, attrs: str = "", text: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        self.text.append(text)
        return len(self.tag) - 1


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(source):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(page: str | None) -> Tree:
    """The tree of a page; node 0 is the document."""
    page, tree = page or "", Tree()
    tree.add("#document", -1)
    stack, at, size = [0], 0, len(page)
    places: dict[str, list[int]] = {}  # of a tag's open elements in the stack

    def text(upto: int) -> None:
        if upto > at:
            words = html.unescape(page[at:upto])
            if tree.tag[-1] == "#text" and tree.parent[-1] == stack[-1]:
                tree.text[-1] += words
            else:
                tree.add("#text", stack[-1], text=words)

    def innermost(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names, holders) -> None:
        """Ends the innermost of ``names`` unless a holder is open inside it."""
        i = innermost(names)
        if i and i >= innermost(holders):
            for node in stack[i:]:
                places[tree.tag[node]].pop()
            del stack[i:]

    while at < size:
        lt = page.find("<", at)
        m = _TOKEN.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:  # a bare "<" is text
            lt = page.find("<", lt + 1)
            m = _TOKEN.match(page, lt) if lt >= 0 else None
        if m is None:
            text(size)
            break
        text(lt)
        at = m.end()
        end, start = m.group(1), m.group(2) or m.group(4)
        if end:
            end = end.lower()
            if end not in VOID:
                close({end}, {"td", "th", "table"} if end not in {"td", "th", "tr", "tbody", "thead", "tfoot", "table", "body", "html"} else set())
        elif start:
            start = start.lower()
            if start in CLOSES_P:
                close({"p"}, {"button", "td", "th", "table"})
            for _ in range(3):  # a cell, its row, its section
                if start in ENDS:
                    close(*ENDS[start])
            if start in {"html", "head", "body"} and places.get(start):
                continue
            if start == "body":
                close({"head"}, set())
            attrs = m.group(3) if m.group(2) else m.group(5)
            node = tree.add(start, stack[-1], attrs or "")
            if start in RAW:
                found = re.compile(f"</{re.escape(start)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = found.end() if found else size
            elif start not in VOID:
                places.setdefault(start, []).append(len(stack))
                stack.append(node)  # as in HTML, a slash at the end does not end it
    return tree
