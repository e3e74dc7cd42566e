"""Pages as trees of blocks, read forgivingly.

A page becomes nodes in page order: block elements, and leaves that hold the text between block tags. Inline elements only mark
letters as link letters. Scripts, styles, comments and the head carry no text. An opening tag closes what cannot contain it (a
paragraph, an item, a cell); an end tag without its start is ignored; what is still open at the end of the page is closed there.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements without text of a page, those of them that hold no tags, elements without content, inline elements, what an opening tag closes.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head title".split())
RAW = frozenset("script style title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CONTROLS = frozenset("input select textarea button option label".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in RAW}
_NESTED = {name: re.compile(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*+>?", re.I | re.A) for name in SILENT - RAW}
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Nodes by number: ``tag``, ``parent``, ``tokens`` (of class, id and role), ``text`` (of leaves), ``links`` (letters in links), ``controls``."""

    def __init__(self, html: str):
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.tokens: list[tuple[str, ...]] = [()]
        self.text: list[str] = [""]
        self.links: list[int] = [0]
        self.anchors: list[int] = [0]
        self.controls: list[int] = [0]
        self.children: list[int] = [0]
        self._read(html)

    def _add(self, tag: str, parent: int, tokens: tuple[str, ...]) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.tokens.append(tokens)
        self.text.append("")
        self.links.append(0)
        self.anchors.append(0)
        self.controls.append(0)
        self.children.append(0)
        self.children[parent] += 1
        return len(self.tag) - 1

    def _flush(self, node: int, run: list[str], linked: list[int], closing: bool) -> None:
        text = " ".join("".join(run).split())
        if text:
            at = node if closing and not self.children[node] and node else self._add("#text", node, ())
            self.text[at], self.links[at], self.anchors[at] = text, linked[0], linked[1]
        run.clear()
        linked[:] = [0, 0]

    def _read(self, html: str) -> None:
        stack, run, linked = [0], [], [0, 0]
        at, in_link, ends = 0, False, {}

        def words(piece: str) -> None:
            piece = unescape(piece) if "&" in piece else piece
            run.append(piece)
            if in_link:
                linked[0] += len(piece)

        while found := _TAG.search(html, at):
            if found.start() > at:
                words(html[at:found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                if name in INLINE:
                    in_link = in_link and name != "a"
                elif name in self._open(stack):
                    while True:
                        self._flush(stack[-1], run, linked, True)
                        if self.tag[stack.pop()] == name:
                            break
                    in_link = False
                elif name == "p" or name == "br":
                    self._flush(stack[-1], run, linked, False) if name == "p" else run.append(" ")
                continue
            if name == "head":  # holds silent and void elements only; whatever else comes ends it
                continue
            if name in SILENT:
                if name == "title" or not found[3].endswith("/>"):
                    at = self._silent_end(html, name, found.start(), at, ends)
                continue
            if name in INLINE:
                if name == "a":
                    in_link = True
                    linked[1] += 1
                continue
            if name in ("br", "wbr", "img"):
                run.append(" " if name == "br" else "")
                continue
            if name in CONTROLS:
                self.controls[stack[-1]] += 1
            if name in VOID:
                if name == "hr":
                    self._flush(stack[-1], run, linked, False)
                continue
            if name in ("html", "body"):
                continue
            self._make_room(name, stack, run, linked)
            self._flush(stack[-1], run, linked, False)
            tokens = ()
            if found[3] and "=" in found[3]:
                tokens = tuple(p.lower() for m in _NAMED.finditer(found[3]) for p in _PART.findall(m[1] or m[2] or m[3] or ""))
            stack.append(self._add(name, stack[-1], tokens))
            in_link = False
        if at < len(html):
            words(html[at:])
        while stack:
            self._flush(stack[-1], run, linked, True)
            stack.pop()

    @staticmethod
    def _silent_end(html: str, name: str, start: int, at: int, ends: dict[str, dict[int, int]]) -> int:
        """Where reading goes on after a silent element's opening tag ``html[start:at]``; ``ends`` keeps the ends found by name."""
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            if not end:
                return len(html) if name != "title" else max(html.find("<", at), at)
            close = html.find(">", end.end())
            return len(html) if close < 0 else close + 1
        if name not in ends:
            opened, ends[name] = [], {}
            for tag in _NESTED[name].finditer(html):
                if not tag[1]:
                    if not tag[0].endswith("/>"):
                        opened.append(tag.start())
                elif opened:
                    ends[name][opened.pop()] = tag.end()
        return ends[name].get(start, at)  # one that is never closed hides its tag alone

    def _open(self, stack: list[int]) -> list[str]:
        return [self.tag[i] for i in stack[1:]]

    def _make_room(self, name: str, stack: list[int], run: list[str], linked: list[int]) -> None:
        shut, inside = CLOSES.get(name, ({"p"}, None))
        if inside is None:  # any other block ends a paragraph
            if self.tag[stack[-1]] == "p":
                self._flush(stack[-1], run, linked, True)
                stack.pop()
            return
        names = self._open(stack)
        last = next((k for k in range(len(names) - 1, -1, -1) if names[k] in shut or names[k] in inside), None)
        while last is not None and names[last] in shut and len(stack) - 1 > last:
            self._flush(stack[-1], run, linked, True)
            stack.pop()
            if len(stack) - 1 == last:
                break
        if last is not None and names[last] in shut and name in ("tr", "tbody", "tfoot"):  # a row also ends the cell and the row around it
            self._make_room(name, stack, run, linked)
