"""A forgiving reader of HTML: a tree of elements and texts."""

from __future__ import annotations

from collections.abc import Iterator
import html
import re

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split())
#: What an opening tag ends when it is open, and what stops the search.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}


class Element:
    __slots__ = ("name", "marks", "children")

    def __init__(self, name: str, marks: str = ""):
        self.name, self.marks = name, marks
        self.children: list[Element | str] = []

    @property
    def sign(self) -> str:
        """Name and class, id and role, without digits: alike for the same part of a template."""
        return f"{self.name}.{self.marks}" if self.marks else self.name

    def texts(self) -> Iterator[str]:
        """All texts below, in order; without recursion, as pages may be nested without end."""
        todo = [iter(self.children)]
        while todo:
            for child in todo[-1]:
                if isinstance(child, str):
                    yield child
                else:
                    todo.append(iter(child.children))
                    break
            else:
                todo.pop()


def _marks(rest: str) -> str:
    if "=" not in rest:
        return ""
    found = {name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(rest)}
    words = " ".join(found[name] for name in ("class", "id", "role", "itemprop") if name in found)
    return " ".join(re.sub(r"\d+", "", words).lower().split())


def parse(text: str) -> Element:
    """The tree of a page. Scripts, styles, titles and other raw content are left out; tags that
    are not closed end with what they are in."""
    root = Element("#root")
    stack = [root]
    at = 0

    def add_text(part: str) -> None:
        if part:
            stack[-1].children.append(html.unescape(part) if "&" in part else part)

    while (tag := _TAG.search(text, at)) is not None:
        add_text(text[at:tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["end"] or tag["end2"]:
            _close(stack, name)
            continue
        if name not in INLINE and (name not in VOID or name == "hr"):
            _end_open(stack, name)
        rest = tag["rest"] or tag["rest2"] or ""
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[^>]*>", re.IGNORECASE).search(text, at)
            at = end.end() if end else len(text)
            continue
        element = Element(name, _marks(rest))
        stack[-1].children.append(element)
        if name not in VOID and not rest.endswith("/") or name in ("p", "div", "a"):
            stack.append(element)
    add_text(text[at:])
    return root


def _close(stack: list[Element], name: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name == name:
            del stack[depth:]
            return
        if name in INLINE and stack[depth].name not in INLINE:
            return


def _end_open(stack: list[Element], name: str) -> None:
    """End the paragraph, item or cell that a block tag cannot be in."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name == "p":
            del stack[depth:]
            break
        if stack[depth].name not in INLINE:
            break
    ended, stop = _ENDS.get(name, (None, ()))
    if ended:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in ended:
                del stack[depth:]
                return
            if stack[depth].name in stop:
                return
