"""Element index of a page: one pass over its tags, then range lookups.

Each element has its start tag, the range of its content, its depth and the range of
elements that it contains, so "the first span of this class in that card" is a binary
search in the sorted places of such spans, however often fields ask. Elements may nest,
tags may be in any case, attributes in any order and quoted either way or
not at all; comments, scripts and styles hold no elements and no text. An
element that is never closed runs to the end of its parent.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html.entities import name2codepoint

# The named character references of HTML 4 and the apostrophe, from the standard library.
NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'"}
REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);")
SPACE = " \t\n\u000b\f\r\u00a0"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",  # a quote that is never closed
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
SEEN_TAGS, SEEN_LENGTH = 5000, 200
# Elements without content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# The attributes that elements are looked up by.
MARKS = ("class", "data-testid", "format")


def reference_value(name: str) -> str | None:
    """The character of a reference without its ``&`` and ``;``; None if it is unknown."""
    if name[0] != "#":
        return NAMED.get(name)
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


class Decoder:
    """Character references as characters, and start tags as their parts; each distinct one is read once.

    One object serves a batch of pages; the tags it remembers are bounded."""

    def __init__(self) -> None:
        self.known: dict[str, str] = {}
        self.seen: dict[str, tuple] = {}

    def start_tag(self, whole: str, m: re.Match) -> tuple[str, dict[str, str], list[tuple[str, str, str]], bool]:
        """Name, attributes (undecoded), the keys that the element is found by, and whether it has no content."""
        parts = self.seen.get(whole)
        if parts is None:
            name, text = (m.group(3) or m.group(6)).lower(), m.group(4) or m.group(7) or ""
            attributes: dict[str, str] = {}
            for key, double, single, bare in ATTRIBUTE.findall(text):
                attributes.setdefault(key.lower(), double or single or bare)
            keys = [(name, "", "")]
            for mark in MARKS:
                value = attributes.get(mark)
                if value:
                    tokens = {value, *value.split()} if mark == "class" else (value,)
                    keys += [(name, mark, token) for token in tokens]
            parts = name, attributes, keys, name in VOID or text.endswith("/")
            if len(self.seen) < SEEN_TAGS and len(whole) <= SEEN_LENGTH:
                self.seen[whole] = parts
        return parts

    def one(self, match: re.Match) -> str:
        whole = match.group()
        if whole not in self.known:
            value = reference_value(match.group(1))
            self.known[whole] = whole if value is None else value
        return self.known[whole]

    def __call__(self, text: str) -> str:
        return REFERENCE.sub(self.one, text) if "&" in text else text


class ElementIndex:
    """Elements of ``page`` in document order; -1 stands for the page itself."""

    def __init__(self, page: str, decode: Decoder):
        self.page, self.decode = page, decode
        self.tags: list[str] = []
        self.starts: list[int] = []  # of the start tag
        self.inner: list[int] = []  # where the content starts
        self.stops: list[int] = []  # where it ends
        self.ends: list[int] = []  # of the end tag
        self.last: list[int] = []  # number after the last contained element
        self.depth: list[int] = []
        self.attributes: list[dict[str, str]] = []
        self.places: dict[tuple[str, str, str], list[int]] = {}  # (tag, attribute, value or class token) -> elements
        self.tokens: dict[tuple[str, str], set[str]] = {}
        self._read()

    def _read(self) -> None:
        stack: list[int] = []
        tags, places, ends, stops, last = self.tags, self.places, self.ends, self.stops, self.last
        size, start_tag = len(self.page), self.decode.start_tag
        for m in TAG.finditer(self.page):
            whole = m.group()
            if whole[1] == "!" or m.group(1):
                continue
            if whole[1] == "/":
                name = (m.group(3) or m.group(6)).lower()
                for k in range(len(stack) - 1, -1, -1):
                    if tags[stack[k]] == name:
                        # what is still open inside ends with it
                        for i in stack[k:]:
                            stops[i] = ends[i] = m.start()
                            last[i] = len(tags)
                        ends[stack[k]] = m.end()
                        del stack[k:]
                        break
                continue
            name, attributes, keys, closed = start_tag(whole, m)
            i = len(tags)
            tags.append(name)
            self.starts.append(m.start())
            self.inner.append(m.end())
            self.depth.append(len(stack))
            self.attributes.append(attributes)
            for key in keys:
                if key in places:
                    places[key].append(i)
                else:
                    places[key] = [i]
            if closed:
                stops.append(m.end())
                ends.append(m.end())
                last.append(i + 1)
            else:
                stops.append(size)
                ends.append(size)
                last.append(-1)
                stack.append(i)
        for i in stack:
            last[i] = len(tags)
        for tag, mark, token in places:
            if mark:
                self.tokens.setdefault((tag, mark), set()).add(token)

    def _range(self, i: int) -> tuple[int, int]:
        return (0, len(self.tags)) if i < 0 else (i + 1, self.last[i])

    def find(self, i: int | None, tag: str, mark: str = "", value: str = "") -> int | None:
        """First element in ``i`` with this tag and attribute value (or class token)."""
        if i is None:
            return None
        places = self.places.get((tag, mark, value))
        if not places:
            return None
        a, b = self._range(i)
        k = bisect_left(places, a)
        return places[k] if k < len(places) and places[k] < b else None

    def find_all(self, i: int | None, tag: str, mark: str = "", value: str = "", prefix: bool = False) -> list[int]:
        """All elements in ``i`` with this tag and value (or a class token that starts with it), in document order."""
        if i is None:
            return []
        a, b = self._range(i)
        wanted = [value]
        if prefix:
            wanted = [t for t in self.tokens.get((tag, mark), ()) if t.startswith(value)]
        found: set[int] = set()
        for token in wanted:
            places = self.places.get((tag, mark, token), [])
            found.update(places[bisect_left(places, a) : bisect_left(places, b)])
        return sorted(found)

    def outer(self, i: int) -> str:
        return self.page[self.starts[i] : self.ends[i]]

    def text(self, i: int | None) -> str | None:
        """Visible text of an element, trimmed; None if there is no element or no text."""
        if i is None:
            return None
        part = self.page[self.inner[i] : self.stops[i]]
        if "<" in part:
            part = TAG.sub("", part)
        return self.decode(part).strip(SPACE) or None

    def attribute(self, i: int | None, name: str) -> str | None:
        value = None if i is None else self.attributes[i].get(name)
        return self.decode(value) if value else None


# --------------------------------------------------------------------------- cards of the three dialects


def find_cards(index: ElementIndex, spec: dict, limit: int | None) -> list[int]:
    """The product cards of a page in document order; cards inside cards count too."""
    regions = [-1]
    if "card_region" in spec:
        regions = index.find_all(-1, *spec["card_region"])
        if "card" in spec:  # one list element a page
            regions = regions[:1]
    cards: set[int] = set()
    for region in regions:
        if "card" in spec:
            cards.update(index.find_all(region, *spec["card"]))
        else:
            cards.update(index.find_all(region, "div", "class", spec["card_class_prefix"], prefix=True))
    found = sorted(cards)
    return found[:limit] if limit else found


def card_texts(index: ElementIndex, card: int, spec: dict) -> tuple:
    """What a card shows, as text: ``FIELDS`` in order; None where the card has no such element."""
    marks = spec["fields"]
    at = {name: index.find(card, *mark) for name, mark in marks.items()}
    text = index.text
    if "title" not in marks:  # the card is the link
        rating = at["rating"]
        if "score" in marks:
            rating = index.find(rating, *marks["score"])
        return (text(at["name"]), index.attribute(card, "href"), text(at["price"]), None, text(at["installment"]), None, None,
                index.attribute(at["image"], "src"), text(rating))
    plan = at["installment"]
    image = index.attribute(at["image"], "src")
    if image and image.startswith("data:image"):
        image = index.attribute(at["image"], "data-src")
    rating = None
    if at["rating"] is not None:
        rating = " ".join(filter(None, (text(index.find(at["rating"], *marks[k])) for k in ("score", "users"))))
    return (text(at["title"]), index.attribute(at["title"], "href"), text(at["price"]), text(at["cents"]),
            None if plan is None else text(plan) or "", text(index.find(plan, *marks["price"])),
            text(index.find(plan, *marks["plan_cents"])), image, rating)


FIELDS = ("t_name", "t_href", "t_price", "t_cents", "t_plan", "t_plan_price", "t_plan_cents", "t_image", "t_rating")
