"""Encoding of texts by byte-level BPE vocabularies, with a cache of what stands between two spaces.

The splitting pattern of these vocabularies never joins a character with the space after it, and a single
space between two other characters always opens a new pre-token.  So a text falls apart at its spaces (where no
other white space is next to them), and each part with its leading space is encoded once while it is cached.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

PLAIN_END = frozenset(".,;:!?)")
LAST_PLAIN = "\u2000"  # letters below it are the same in all versions of the character tables


#: Runs of one kind in printable ASCII without spaces.
_KINDS = re.compile("[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+")


class _Spaces(Exception):
    """White space next to a space: the text must be encoded as a whole."""


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes()


class ChunkCache(dict):
    """Word -> ids (packed) of a space and the word.

    Two generations of at most `most` entries each: when the young one is full it becomes the old one, and
    what is asked for again moves back, so frequent words stay.
    """

    def __init__(self, pretoken: Callable[[str], bytes], whole: Callable[[str], bytes], most: int, lead: str = " ", apart: tuple[str, ...] = ()) -> None:
        """`pretoken` encodes one pre-token, `whole` any text; `lead` is what stands before each word.

        Words with one of `apart` (strings without spaces) in them are left to `whole`.
        """
        super().__init__()
        self.pretoken, self.whole, self.most, self.lead, self.apart = pretoken, whole, most, lead, apart
        self.old: dict[str, bytes] = {}
        self.ends = {c: pretoken(c) for c in PLAIN_END}
        self.bare = ChunkCache(pretoken, whole, most // 8, "", apart) if lead else self
        self.line = pretoken("\n")

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._new(word)
            if len(word) > 64 or "\n" in word:
                return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _new(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Spaces
        if any(special in word for special in self.apart):
            return self.whole(self.lead + word)
        if max(word) < LAST_PLAIN:
            if word.isalpha():
                return self.pretoken(self.lead + word)
            if word[-1] in PLAIN_END and word[:-1].isalpha():
                return self[word[:-1]] + self.ends[word[-1]]
        if "\n" in word:
            first, *rest = word.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in (first, *rest)):
                return self.line.join([self[first], *map(self.bare.__getitem__, rest)])
        elif word.isascii() and word.isprintable() and "'" not in word:
            first, *rest = _KINDS.findall(word)
            return b"".join(map(self.pretoken, [self.lead + first, *rest]))
        return self.whole(self.lead + word)

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if rest:
                return self.bare[first] + b"".join(map(self.__getitem__, rest))
        except _Spaces:
            pass
        return self.whole(text)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 characters for
    themselves, the others in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def byte_names(text: str, letters: dict[int, str]) -> str:
    """The text's bytes, each as its letter."""
    if text.isascii():
        return text.translate(letters)
    return text.encode().decode("latin-1").translate(letters)
