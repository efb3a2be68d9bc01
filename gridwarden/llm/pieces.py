"""Safe boundaries of byte-level BPE texts, and per-worker caches of what pieces encode to.

The pattern of this family of tokenizers never lets a match run from a visible character into the
blank after it, and looks ahead only past blanks. So a text may be cut in front of each run of
blanks that follows a visible character, and the pieces encode to what the whole encodes to. Special
strings hold no blanks, so no cut falls into one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# The blanks in front of which a piece begins, and other white space beside which it mustn't.
PLAIN = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+\Z")
ODD = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
CAREFUL = re.compile(r"(?<=\S)(?=[ \t\n\r])")

CACHED_PIECES = 300_000
CACHED_LENGTH = 48


def cut(text: str) -> list[str]:
    """The pieces of a text, in order; joined they are the text again."""
    return CAREFUL.split(text) if ODD.search(text) else PLAIN.findall(text)


class PieceCache:
    """Values of pieces, worked out a batch at a time and kept while they fit."""

    def __init__(self, encode: Callable[[list[str]], Iterable]):
        self.encode = encode
        self.known: dict[str, object] = {}

    def values(self, texts: list[list[str]]) -> list[list]:
        """For each text, what its pieces encode to."""
        if len(self.known) > CACHED_PIECES:
            self.known = {}
        wanted = set().union(*texts) - self.known.keys() if texts else set()
        new = list(wanted)
        found = dict(zip(new, self.encode(new), strict=True)) if new else {}
        lookup = self.known
        lookup.update(found)
        out = [list(map(lookup.__getitem__, pieces)) for pieces in texts]
        for piece in new:
            if len(piece) > CACHED_LENGTH:
                del lookup[piece]
        return out
