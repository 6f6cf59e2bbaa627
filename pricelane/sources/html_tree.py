"""A small tolerant HTML tree for use inside Spark tasks.

Elements and texts of a page lie in one list in document order, and each
element knows where its content ends, so everything below an element is a
slice. No recursion: broken pages may nest thousands of unclosed tags.

Clean markup is read with one pattern per tag, several times faster than the
standard parser; a page with anything unusual is read by the standard parser.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from html import unescape
from html.parser import HTMLParser

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Texts in these are no page text.
UNSEEN_TEXT_TAGS = frozenset("script style template rt rp".split())
KEEP_SPACE_TAGS = frozenset(("pre", "textarea"))
SPECIAL_TEXT_TAGS = UNSEEN_TEXT_TAGS | KEEP_SPACE_TAGS
# Elements that start and end a line of visible text.
LINE_TAGS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select table "
    "tbody tfoot thead tr ul".split()
)
CELL_TAGS = frozenset(("td", "th"))

# Clean markup: comments, a doctype, and tags with quoted or plain attributes.
_ATTR = r"""\s+([a-zA-Z_:@][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([-\w.]+)))?"""
_CLEAN = re.compile(
    r"<(?:!--(?!-?>)((?:(?!--!?>).)*)-->|!doctype[^>\[]*>|(/?)([a-z][-a-z0-9]*)((?:"
    + re.sub(r"\((?!\?)", "(?:", _ATTR)
    + r")*)\s*(/?)>)",
    re.ASCII | re.IGNORECASE | re.DOTALL,
)
_ATTRS = re.compile(_ATTR, re.ASCII)
_RAW_END = {
    tag: re.compile(rf"</{tag}\s*>", re.ASCII | re.IGNORECASE) for tag in ("script", "style")
}
# Tags whose content parsers read in special ways.
_UNCLEAN_TAGS = frozenset("textarea iframe noembed noframes xmp plaintext svg math".split())
_SPACES = re.compile(r"[ \t\n\r\f]+")
_OPEN_REFERENCE = re.compile(r"&(?!#?\w+;)")


class Element:
    __slots__ = ("tag", "attrs", "classes", "class_name", "parent", "start", "end", "no", "end_no")

    def __init__(self, tag, attrs, parent, start, no):
        self.tag = tag
        self.attrs = attrs
        if "class" in attrs:
            self.classes = attrs["class"].split()
            self.class_name = " ".join(self.classes)
        else:
            self.classes = ()
            self.class_name = ""
        self.parent = parent
        self.start = start
        self.end = start + 1
        self.no = no
        self.end_no = no + 1

    def has_class(self, name: str) -> bool:
        return name in self.classes


#: Tags by their markup, as read: layouts repeat most of theirs. Bounded in number and length.
_KNOWN_TAGS: dict[str, tuple] = {}
_KNOWN_COUNT, _KNOWN_LENGTH = 20_000, 300


def _read_tag(closing: str, name: str, attributes: str, self_closing: str) -> tuple | None:
    """(tag, attributes, classes, class text, closes itself, needs no special care); no attributes: an end tag; None: unclean."""
    tag = name.lower()
    if tag in _UNCLEAN_TAGS:
        return None
    plain = tag not in SPECIAL_TEXT_TAGS and tag not in VOID_TAGS and tag != "title"
    if closing:
        return None if attributes or self_closing else (tag, None, (), "", False, plain)
    attrs = {}
    if attributes:
        if "&" in attributes and _OPEN_REFERENCE.search(attributes):
            return None
        for key, double, single, bare in _ATTRS.findall(attributes):
            value = double or single or bare
            attrs[key.lower()] = unescape(value) if "&" in value else value
    classes = attrs["class"].split() if "class" in attrs else ()
    return tag, attrs, classes, " ".join(classes), bool(self_closing), plain


class HtmlTree:
    def __init__(self, html: str):
        if not self._read_clean(html):
            _StandardReader(self).read(html)
        self._finish_text()
        while self._open:
            self._close_last()

    # -- building ---------------------------------------------------------
    def _restart(self) -> None:
        self.items: list[Element | str] = []
        self.owners: list[Element | None] = []  # the element each item lies directly in
        self.elements: list[Element] = []
        self._open: list[Element] = []
        self._open_tags: dict[str, int] = defaultdict(int)
        self._pending: list[str] = []
        self._unseen = 0
        self._kept_space = 0
        self.root = self.start_tag("[page]", {})

    def start_tag(self, tag: str, attrs: dict[str, str]) -> Element:
        if self._pending:
            self._finish_text()
        parent = self._open[-1] if self._open else None
        element = Element(tag, attrs, parent, len(self.items), len(self.elements))
        self.items.append(element)
        self.elements.append(element)
        self.owners.append(parent)
        if tag not in VOID_TAGS:
            self._open.append(element)
            self._open_tags[tag] += 1
            if tag in SPECIAL_TEXT_TAGS:
                self._unseen += tag in UNSEEN_TEXT_TAGS
                self._kept_space += tag in KEEP_SPACE_TAGS
        return element

    def end_tag(self, tag: str) -> None:
        if self._pending:
            self._finish_text()
        if self._open_tags[tag]:
            while self._close_last() != tag:
                pass

    def _close_last(self) -> str:
        element = self._open.pop()
        tag = element.tag
        self._open_tags[tag] -= 1
        element.end = len(self.items)
        element.end_no = len(self.elements)
        if tag in SPECIAL_TEXT_TAGS:
            self._unseen -= tag in UNSEEN_TEXT_TAGS
            self._kept_space -= tag in KEEP_SPACE_TAGS
        return tag

    def add_text(self, text: str) -> None:
        self._pending.append(text)

    def break_text(self) -> None:
        self._finish_text()

    def _finish_text(self) -> None:
        pending = self._pending
        text = pending[0] if len(pending) == 1 else "".join(pending)
        pending.clear()
        if not text or self._unseen:
            return
        if not self._kept_space and not text.strip(" \n\t\f\r"):
            text = "\n" if "\n" in text else " "
        self.items.append(text)
        self.owners.append(self._open[-1])

    def _read_clean(self, html: str) -> bool:
        """Read clean markup; False as soon as something else turns up."""
        self._restart()
        at = 0
        find, match, pending = html.find, _CLEAN.match, self._pending
        items, owners, elements, opened, open_tags = self.items, self.owners, self.elements, self._open, self._open_tags
        while (tag_at := find("<", at)) >= 0:
            if tag_at > at:
                text = html[at:tag_at]
                pending.append(unescape(text) if "&" in text else text)
            # a tag that was read before as a whole, up to its only >, reads the same here
            raw = html[tag_at : find(">", tag_at) + 1]
            known = _KNOWN_TAGS.get(raw)
            if known is None:
                token = match(html, tag_at)
                if token is None:
                    return False
                at = token.end()
                _, closing, name, attributes, self_closing = token.groups()
                if name is None:
                    self._finish_text()
                    continue
                known = _read_tag(closing, name, attributes, self_closing)
                if known is None:
                    return False
                if len(raw) == at - tag_at <= _KNOWN_LENGTH:
                    if len(_KNOWN_TAGS) >= _KNOWN_COUNT:
                        _KNOWN_TAGS.clear()
                    _KNOWN_TAGS[raw] = known
            else:
                at = tag_at + len(raw)
            tag, attrs, classes, class_name, self_closing, plain = known
            if pending:
                self._finish_text()
            if attrs is None:
                if plain and opened[-1].tag == tag:
                    element = opened.pop()
                    open_tags[tag] -= 1
                    element.end, element.end_no = len(items), len(elements)
                else:
                    self.end_tag(tag)
                continue
            if not plain:
                self.start_tag(tag, attrs)
            else:
                parent = opened[-1]
                element = Element.__new__(Element)
                element.tag, element.attrs, element.classes, element.class_name, element.parent = tag, attrs, classes, class_name, parent
                element.start, element.no = start, no = len(items), len(elements)
                element.end, element.end_no = start + 1, no + 1
                items.append(element)
                elements.append(element)
                owners.append(parent)
                opened.append(element)
                open_tags[tag] += 1
                if not self_closing:
                    continue
            if self_closing:
                if tag in _RAW_END or tag == "title":
                    return False
                if tag not in VOID_TAGS:
                    self.end_tag(tag)
            elif tag in _RAW_END:
                raw_end = _RAW_END[tag].search(html, at)
                if raw_end is None or "<!--" in html[at : raw_end.start()]:
                    return False
                at = raw_end.end()
                self.end_tag(tag)
            elif tag == "title":
                close_at = html.find("<", at)
                if html[close_at : close_at + 8].lower() != "</title>":
                    return False
        tail = html[at:]
        if tail:
            self._pending.append(unescape(tail) if "&" in tail else tail)
        return True

    # -- reading ----------------------------------------------------------
    def below(self, element: Element) -> list[Element]:
        return self.elements[element.no + 1 : element.end_no]

    def find_all(self, keep: Callable[[Element], bool], within: Element | None = None):
        return [e for e in self.below(within or self.root) if keep(e)]

    def find(self, keep: Callable[[Element], bool], within: Element | None = None):
        return next((e for e in self.below(within or self.root) if keep(e)), None)

    def texts(self, element: Element | None, skip: tuple[Element | None, ...] = ()) -> list[str]:
        if element is None:
            return []
        gaps = [(s.start, s.end) for s in skip if s is not None]
        if not gaps:
            return [item for item in self.items[element.start : element.end] if isinstance(item, str)]
        return [
            item
            for at, item in enumerate(self.items[element.start : element.end], element.start)
            if isinstance(item, str) and not any(a <= at < b for a, b in gaps)
        ]

    def text(self, element: Element | None, skip=(), joint: str = "") -> str | None:
        return None if element is None else joint.join(self.texts(element, skip))

    def stripped(self, element: Element | None) -> list[str]:
        return [t for t in (text.strip() for text in self.texts(element)) if t]

    def packed(self, element: Element | None) -> str | None:
        """All texts, each stripped, joined without a gap."""
        return None if element is None else "".join(self.stripped(element))

    def own_texts(self, element: Element) -> list[str]:
        """Texts that lie directly in the element."""
        return [
            item
            for at, item in enumerate(self.items[element.start : element.end], element.start)
            if isinstance(item, str) and self.owners[at] is element
        ]

    def lines(self, element: Element | None) -> list[str]:
        """Visible text as a reader sees it: one entry per non-empty line.

        A stored page tells hidden parts only by the ``hidden`` attribute or an
        inline ``display:none``; those are left out.
        """
        if element is None:
            return []
        breaks = set()  # item positions before which a line ends
        hidden_until = element.start
        pieces: list[str] = []
        for at, item in enumerate(self.items[element.start : element.end], element.start):
            if at in breaks:
                pieces.append("\n")
            if at < hidden_until:
                continue
            if isinstance(item, str):
                kept = self.owners[at].tag == "pre"
                pieces.append(item if kept else _SPACES.sub(" ", item))
                continue
            attrs = item.attrs
            if attrs and ("hidden" in attrs or "style" in attrs and "display:none" in attrs["style"].replace(" ", "").lower()):
                hidden_until = item.end
            elif item.tag in LINE_TAGS:
                pieces.append("\n")
                breaks.add(item.end)
            elif item.tag in CELL_TAGS:
                pieces.append("\t")
        return [t for t in (line.strip() for line in "".join(pieces).split("\n")) if t]

    def shown(self, element: Element | None) -> str | None:
        """The text of an element as a reader sees it."""
        return None if element is None else "\n".join(self.lines(element))


class _StandardReader(HTMLParser):
    """Fills a tree through the standard parser."""

    def __init__(self, tree: HtmlTree):
        super().__init__(convert_charrefs=True)
        self.tree = tree

    def read(self, html: str) -> None:
        self.tree._restart()
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tree.start_tag(tag, {key: value or "" for key, value in attrs})

    def handle_endtag(self, tag):
        self.tree.end_tag(tag)

    def handle_data(self, data):
        self.tree.add_text(data)

    def handle_comment(self, data):
        self.tree.break_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.tree.break_text()
        if data.upper().startswith("CDATA["):
            self.tree.add_text(data[6:])
            self.tree.break_text()
