"""Cutting a text where no token of a space-led tokenizer can cross, so that equal parts are encoded once.

A cut lies before a single space between two characters that are not white space.  Byte-level BPE splits there
by its own pattern; piece BPE has no piece with a space mark behind another character (``pieces_keep_spaces``
checks the model), so no merge crosses it.  Encoding the parts one by one therefore gives the tokens of the whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

#: Characters of parts that a task remembers before it starts anew.
CACHE_CHARS = 6_000_000


def _sticks(left: str, right: str) -> bool:
    return not left or not right or left[-1].isspace() or right[0].isspace()


# white space other than the space and the line feed: rare, so first only looked for
_CONTROLS = [c for c in map(chr, range(128)) if c.isspace() and c not in " \n"]
_BEYOND = [c for c in map(chr, range(128, 0x3001)) if c.isspace()]
_beyond = re.compile(f"[{''.join(_BEYOND)}]").search


def _touches(text: str, c: str) -> bool:
    return f" {c}" in text or f"{c} " in text


def _is_plain(text: str) -> bool:
    """No single space of the text touches white space or an end of the text."""
    if "  " in text or _touches(text, "\n") or any(c in text and _touches(text, c) for c in _CONTROLS):
        return False
    return text.isascii() or not _beyond(text) or not any(c in text and _touches(text, c) for c in _BEYOND)


def units_of(text: str) -> list[str]:
    """Parts with ``" ".join(parts) == text``; every space between two parts is a safe cut."""
    words = text.split(" ")
    if words[0] and words[-1] and _is_plain(text):
        return words
    out, held = [], [words[0]]
    for w in words[1:]:
        if _sticks(held[-1], w):
            held.append(w)
        else:
            out.append(" ".join(held))
            held = [w]
    return [*out, " ".join(held)]


def pieces_keep_spaces(pieces: Iterable[str], mark: str = "▁") -> bool:
    """No piece has the space mark behind another character."""
    return not any(mark in p.lstrip(mark) for p in pieces)


class UnitCache(dict):
    """Part -> value, filled for many parts by one call of ``make``.

    When it has grown large, only what is wanted again is kept.
    """

    def __init__(self, make, limit: int = CACHE_CHARS):
        super().__init__()
        self.make, self.limit, self.chars, self.before = make, limit, 0, {}

    def learn(self, lists: Iterable[list[str]]) -> None:
        """Have a value for every part of the lists."""
        if self.chars > self.limit:
            self.before = dict(self)
            self.clear()
            self.chars = 0
        missing = set(chain.from_iterable(lists)).difference(self)
        known = missing & self.before.keys()
        self.update((u, self.before[u]) for u in known)
        new = list(missing - known)
        if new:
            self.update(zip(new, self.make(new), strict=True))
        self.chars += sum(map(len, missing))
