"""Title and description of HTML pages, from the tags a parser sees.

Python's ``html.parser`` cuts a page into tags, text and comments in one pass;
``PageHead`` keeps the stack of open elements, the text of the first title and
the first description tag, and stops as soon as both are settled.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without an end tag, and elements whose text is none
# of their parents'.
VOID = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input", "isindex", "keygen", "link",
    "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr"))
APART = frozenset(("script", "style", "template", "rt", "rp"))

_TITLE, _META = re.compile("<title", re.I), re.compile("<meta", re.I)
_DESCRIPTION = re.compile("description|&#")  # the value may be written in references


class _Settled(Exception):
    pass


class PageHead(HTMLParser):
    """``title``: text of the first title element, each piece between tags
    decoded and stripped, None without one. The element ends with its end tag,
    with that of an element around it, or with the page. ``description``:
    content of the first meta element named description."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def read(self, page: str) -> tuple[str | None, str | None]:
        self.reset()
        self.open, self.apart, self.title, self.at = [], 0, None, None
        self.description, self.text = None, ""
        self.wants = [bool(_TITLE.search(page)), bool(_META.search(page) and _DESCRIPTION.search(page))]
        if any(self.wants):
            try:
                self.feed(page)
                self.close()
            except _Settled:
                pass
            except AssertionError:  # markup that the parser gives up on
                return None, None
            self._end_text()
        return None if self.title is None else "".join(self.title), self.description

    def _settle(self, k: int) -> None:
        self.wants[k] = False
        if not any(self.wants):
            raise _Settled

    def _end_text(self, *_) -> None:
        """A piece of text goes up to the next tag, comment or declaration."""
        if self.text:
            self.title.append(self.text.strip())
            self.text = ""

    handle_comment = handle_decl = handle_pi = unknown_decl = _end_text

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        if tag == "title" and self.title is None:
            self.title, self.at = [], len(self.open)
        if tag == "meta" and self.wants[1]:
            values = dict(attrs)  # of a repeated attribute the last value
            if values.get("name") == "description":
                self.description = values.get("content") or ""
                self._settle(1)
        if tag not in VOID:
            self.open.append(tag)
            self.apart += tag in APART

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if tag in self.open:
            k = len(self.open) - 1 - self.open[::-1].index(tag)
            self.apart -= sum(t in APART for t in self.open[k:])
            del self.open[k:]
            if self.at is not None and k <= self.at:
                self.at = None
                self._settle(0)

    def handle_data(self, data: str) -> None:
        if self.at is not None and not self.apart:
            self.text += data
