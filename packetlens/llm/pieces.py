"""Pieces of texts that tokenizers treat alone, and a bounded memory of what they yield.

A text is cut at single spaces and line feeds between other characters, and before a comma or
full stop after a letter or digit. Tokenizers whose pattern lets white space only begin a
token, or drops it, and keeps letters, digits and other signs apart, never join characters
across such a cut, so the tokens of a text are those of its pieces in order. Each distinct
piece is handled once as long as it is remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# White space in a row, and a comma or full stop that may belong to what precedes it; the latter
# is written so that the search runs from one of these signs to the next.
IN_A_ROW = re.compile(r"\s\s")
AFTER_SIGN = re.compile(r"[.,](?<![^\W_][.,])")
# A space before something else starts a piece; longer white space stays with what precedes it.
CUT = re.compile(r"(?= [^\s])")
# The white space of Unicode.
WHITE = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
# Pieces remembered by one Python process, and characters of all of them.
REMEMBERED = 1_000_000
REMEMBERED_CHARS = 32 << 20


# White space of regular expressions other than space and line feed, in ASCII and beyond.
RARE = [c for c in map(chr, range(128)) if c.isspace() and c not in " \n"]
RARER = [c for c in map(chr, range(128, 0x3001)) if c.isspace()]


def unsafe(text: str) -> bool:
    """Whether ``text`` has white space in a row, a comma or full stop after something other
    than a letter or digit, or the mark that the cutting uses."""
    if "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    rare = any(c in text for c in RARE) or not text.isascii() and any(c in text for c in RARER)
    return bool(rare and IN_A_ROW.search(text) or AFTER_SIGN.search(text))


def cut(text: str) -> list[str]:
    """The pieces of ``text``; joined they are the text. A space stays with the word after it."""
    if unsafe(text):
        return [p for p in CUT.split(text) if p]
    marked = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    return marked.replace(",", "\0,").replace(".", "\0.").split("\0")


class Memory(dict):
    """Piece to result; filled from ``work`` for many pieces at once.

    Pieces are held in two halves. When the younger one is full it becomes the older one, and a
    piece that is met again moves from there to the younger, so frequent pieces stay. The number
    of pieces and their characters are bounded, but for the pieces of one call."""

    def __init__(self, work: Callable[[list[str]], Iterable], most: int = REMEMBERED):
        super().__init__()
        self.work, self.most, self.chars = work, most, 0
        self.older: dict = {}

    def learn(self, pieces: Iterable[str]) -> None:
        wanted = set(pieces)
        new = wanted.difference(self)
        chars = sum(map(len, new))
        if 2 * (len(self) + len(new)) > self.most or 2 * (self.chars + chars) > REMEMBERED_CHARS:
            self.older = dict(self)
            self.clear()
            new, self.chars = wanted, 0
            chars = sum(map(len, new))
        self.chars += chars
        again = new & self.older.keys()
        self.update((p, self.older[p]) for p in again)
        new = list(new - again)
        if new:
            self.update(zip(new, self.work(new), strict=True))


# Kept while a Python process serves one task after the other; of one kind at a time.
_held: dict[str, Memory] = {}


def memory(
    kind: str, make: Callable[[], Callable[[list[str]], Iterable]], most: int = REMEMBERED
) -> Memory:
    """The memory of this process for ``kind``; ``make()`` gives the work when it is new."""
    if kind not in _held:
        _held.clear()
        _held[kind] = Memory(make(), most)
    return _held[kind]
