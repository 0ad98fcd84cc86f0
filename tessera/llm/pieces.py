"""Texts as segments whose tokens do not depend on their surroundings.

The byte-level pre-tokenisation pattern lets a match take one leading space
and never lets other characters join across white space, so a text may be cut
before every single space between two other characters. Segments (a word with
its punctuation) repeat a lot; what a tokenizer says about one is kept in a
bounded per-worker table.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

#: Fixed value: the pattern of the byte-level vocabularies, with white space
#: spelled out as the Unicode property (control codes 1C-1F are not in it).
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")

#: Segments longer than this are computed anew each time; entries kept.
KEEP_CHARS, KEEP_ENTRIES = 64, 400_000


class Kept(dict):
    """Values of ``compute`` by key, forgotten together when there are too many."""

    def __init__(self, compute: Callable, limit: int = KEEP_ENTRIES):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= KEEP_CHARS:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def loose(part: str) -> bool:
    """Whether white space touches the space this part was cut at."""
    return not part or part[0].isspace() or part[-1].isspace()


def segments(text: str) -> list[str]:
    """The segments of a text, without the space that each but the first has."""
    parts = text.split(" ")
    return _CUT.split(text) if any(map(loose, set(parts))) else parts


class SegmentTable:
    """value(" " + segment) by segment for all segments of a text but the first."""

    def __init__(self, value: Callable[[str], object], limit: int = KEEP_ENTRIES):
        self.value = value
        self.kept = Kept(lambda s: None if loose(s) else value(" " + s), limit)

    def of(self, text: str, combine: Callable) -> object:
        """combine(values of the text's segments in order)."""
        head, *rest = text.split(" ")
        if not rest:
            return combine([self.value(head)] if head else [])
        if not loose(head):
            try:
                return combine([self.value(head), *map(self.kept.__getitem__, rest)])
            except TypeError:  # a None: white space beside a space somewhere
                pass
        head, *rest = _CUT.split(text)
        return combine([self.value(head), *(self.value(" " + s) for s in rest)])
