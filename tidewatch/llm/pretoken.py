"""Pre-tokenisation of byte-level BPE without a regular expression.

Every code point has a class. Where a slice begins depends on the classes of a
character and its neighbours, because each class's transition is a constant
function: it leads to the same state from every other. Only an apostrophe looks
ahead, for the English endings. So composing the transitions over a text (an
associative scan) comes down to comparisons of shifted class arrays.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# The white space of Unicode and the endings that the pattern splits off.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for hit in regex.finditer(name, every):
            a, b = ord(every[hit.start()]), ord(every[hit.end() - 1])
            table[a : b + 1] = kind
    table[list(WHITE_SPACE)] = SPACE
    return table


def slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where slices begin (with the end of the data last), and per row its first slice."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    chars = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[chars]
    n = len(chars)
    edge = np.zeros(n + 1, bool)  # a row begins here
    edge[np.searchsorted(at, offsets)] = True
    space = kind == SPACE
    begin = np.ones(n, bool)
    before, here = kind[:-1], kind[1:]
    # another class than the character before; after white space, unless that is a plain blank
    begin[1:] = np.where(space[:-1], chars[:-1] != 32, before != here)
    inner = space[1:] & space[:-1]
    follows = np.zeros(n, bool)
    follows[:-1] = ~space[1:] & ~edge[1:n]
    begin[1:] = np.where(inner, follows[1:], begin[1:])
    begin |= edge[:n]
    _endings(chars, begin, edge)
    starts = np.append(at[begin], len(data))
    return starts, np.searchsorted(starts, offsets)


def _endings(chars: np.ndarray, begin: np.ndarray, edge: np.ndarray) -> None:
    """An apostrophe that begins a slice takes its ending along; what follows begins anew."""
    n = len(chars)
    quotes = np.flatnonzero((chars == 39) & begin)
    for ending in ENDINGS:
        k = len(ending)
        q = quotes[quotes + k < n]
        for j, letter in enumerate(ending, 1):
            q = q[(chars[q + j] == ord(letter)) & ~edge[q + j]]
        begin[q + 1] = False
        after = q + k + 1
        begin[after[after < n]] = True
