"""A small element tree on the standard library's HTML tokeniser, with the selectors that cleaning needs.

Repair covers void elements, implied ends of paragraphs, list items, cells, rows and options, and raw script and
style text. It isn't the repair of a browser.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable, Iterator
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: A start tag on the left ends an open element on the right, up to a boundary.
IMPLIED = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("td", "th", "tr"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


class Element:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str] | None = None, parent: Element | None = None):
        self.name, self.attrs, self.parent = name, attrs or {}, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """The elements below this one, in document order."""
        stack = [x for x in reversed(self.children) if isinstance(x, Element)]
        while stack:
            node = stack.pop()
            yield node
            stack += [x for x in reversed(node.children) if isinstance(x, Element)]

    def strings(self) -> Iterator[str]:
        stack: list[Element | str] = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node.name not in RAW:
                stack += reversed(node.children)

    def text(self, separator: str = " ") -> str:
        """The stripped strings, joined."""
        return separator.join(s for x in self.strings() if (s := x.strip()))

    def find(self, *names: str) -> Element | None:
        return next((x for x in self.walk() if x.name in names), None)

    def find_all(self, *names: str) -> list[Element]:
        return [x for x in self.walk() if x.name in names]

    def select(self, selector: str) -> list[Element]:
        test = matcher(selector)
        return [x for x in self.walk() if test(x)]

    def select_one(self, selector: str) -> Element | None:
        test = matcher(selector)
        return next((x for x in self.walk() if test(x)), None)

    def ancestors(self) -> Iterator[Element]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def remove_all(self, found: Collection[Element]) -> None:
        """Takes elements out from below this one, each parent's list being gone through once."""
        gone = {id(x) for x in found}
        for parent in {id(x.parent): x.parent for x in found if x.parent is not None}.values():
            parent.children = [x for x in parent.children if id(x) not in gone]
        for x in found:
            x.parent = None

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [x for x in self.parent.children if x is not self]
            self.parent = None

    def replace(self, other: Element | str) -> None:
        if self.parent is not None:
            self.parent.children = [other if x is self else x for x in self.parent.children]
            if isinstance(other, Element):
                other.parent = self.parent
            self.parent = None

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def html(self) -> str:
        out: list[str] = []
        stack: list[Element | str | tuple[str]] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                out.append(node[0])
            elif isinstance(node, str):
                out.append(escape(node, quote=False))
            else:
                out.append(f"<{node.name}{''.join(f' {k}="{escape(v)}"' for k, v in node.attrs.items())}>")
                if node.name not in VOID:
                    stack.append((f"</{node.name}>",))
                    if node.name in RAW:
                        stack += [(x,) for x in reversed(node.children) if isinstance(x, str)]
                    else:
                        stack += reversed(node.children)
        return "".join(out)


class Builder(HTMLParser):
    """literal: its input has each & as &amp;, so that references come out as they stood."""

    def __init__(self, literal: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.literal = literal
        self.top = Element("document")
        self.open = [self.top]

    def close_until(self, names: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name in names:
                del self.open[k:]
                return
            if self.open[k].name in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.close_until(("p",), ("table", "td", "th", "button", "object", "div", "section", "article", "li"))
        if tag in IMPLIED:
            names, bounds = IMPLIED[tag]
            for name in names:
                self.close_until((name,), bounds)
        own: dict[str, str] = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        node = Element(tag, own, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        if self.literal and self.open[-1].name in RAW:  # the tokeniser resolves nothing there
            data = data.replace("&amp;", "&")
        self.open[-1].children.append(data)


def parse(html: str | None, literal: bool = False) -> Element:
    """The document of a text; a body is made where there is none. literal: character references stay as they stand."""
    builder = Builder(literal)
    builder.feed((html or "").replace("&", "&amp;") if literal else html or "")
    builder.close()
    top = builder.top
    if top.find("body") is None:
        body = Element("body", {}, top)
        body.children = top.children
        for x in body.children:
            if isinstance(x, Element):
                x.parent = body
        top.children = [body]
    return top


PART = re.compile(r"([.#]?[A-Za-z_][\w-]*|\*)|\[([\w-]+)(?:([*^$]?=)['\"]?([^\]'\"]*)['\"]?)?\]")
TESTS = {"=": str.__eq__, "*=": str.__contains__, "^=": str.startswith, "$=": str.endswith}


def compound(source: str) -> Callable[[Element], bool]:
    tests: list[Callable[[Element], bool]] = []
    for name, attr, how, value in PART.findall(source):
        if name.startswith("#"):
            tests.append(lambda x, v=name[1:]: x.attrs.get("id") == v)
        elif name.startswith("."):
            tests.append(lambda x, v=name[1:]: v in x.classes)
        elif name and name != "*":
            tests.append(lambda x, v=name: x.name == v)
        elif attr and not how:
            tests.append(lambda x, a=attr: a in x.attrs)
        elif attr:
            tests.append(lambda x, a=attr, h=TESTS[how], v=value: a in x.attrs and h(x.attrs[a], v))
    return lambda x: all(t(x) for t in tests)


@lru_cache(maxsize=512)
def matcher(selector: str) -> Callable[[Element], bool]:
    """Tags, #id, .class, [a], [a=v], [a*=v], [a^=v], [a$=v], descendants, children and lists."""
    chains = []
    for one in selector.split(","):
        steps = re.findall(r"(>?)\s*([^\s>]+)", one.strip())
        chains.append([(child == ">", compound(source)) for child, source in steps])

    def fits(x: Element, chain: list[tuple[bool, Callable[[Element], bool]]]) -> bool:
        child, test = chain[-1]
        if not test(x):
            return False
        if len(chain) == 1:
            return True
        above = [x.parent] if child and x.parent is not None else [] if child else x.ancestors()
        return any(fits(a, chain[:-1]) for a in above)

    return lambda x: any(fits(x, c) for c in chains)


class Rules:
    """Selectors with what belongs to them, kept by the id, class, tag or attribute that their last step names, so that
    an element meets only those that may fit it."""

    def __init__(self, rules: Iterable[tuple[str, object]]):
        self.of: dict[tuple[str, str], list[tuple[int, Callable[[Element], bool], object]]] = {}
        for n, (selector, own) in enumerate(rules):
            for one in selector.split(","):
                last = re.findall(r"[^\s>]+", one)[-1]
                names = [(name, attr) for name, attr, _, _ in PART.findall(last)]
                keys = [("id", x[1:]) for x, _ in names if x[:1] == "#"] + [("class", x[1:]) for x, _ in names if x[:1] == "."]
                keys += [("attr", a) for _, a in names if a] + [("tag", x) for x, _ in names if x and x[0] not in "#.*"]
                self.of.setdefault(keys[0] if keys else ("any", ""), []).append((n, matcher(one), own))
        self.any = self.of.get(("any", ""), [])

    def fitting(self, x: Element) -> list:
        """What belongs to the selectors that fit, each once, in their order."""
        of, found = self.of, list(self.any)
        for kind, names in (("tag", (x.name,)), ("id", (x.attrs.get("id", ""),)), ("class", x.classes), ("attr", x.attrs)):
            for name in names:
                if own := of.get((kind, name)):
                    found += own
        return [own for _, own in sorted({n: own for n, fits, own in found if fits(x)}.items())] if found else []
