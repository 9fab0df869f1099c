"""Words of letters and digits, cut from whole texts in pieces of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Runs of bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are in lower case: digits, a-z and all beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Never part of a word, so no word reaches from one text into the next.
SENTINEL = b"\x00"
PIECE = 1 << 20


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text in lower case (A-Z only), cut between words into pieces of about `size` bytes; a longer word stays whole."""
    at = 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        if gap is None:
            break
        yield text[at:gap.start()].lower()
        at = gap.start()
    yield text[at:].lower()


def joined(texts: list[bytes], size: int = PIECE) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(first, data, ends): consecutive whole texts in lower case, joined by sentinels to about `size` bytes. Text
    `first + i` ends at `ends[i]` of `data`. A longer text comes alone."""

    def group(held: list[bytes]) -> tuple[bytes, np.ndarray]:
        return SENTINEL.join(held).lower(), np.cumsum([len(t) + 1 for t in held]) - 1

    first, held, room = 0, [], size
    for i, text in enumerate(texts):
        if held and len(text) > room:
            yield first, *group(held)
            first, held, room = i, [], size
        held.append(text)
        room -= len(text) + 1
    if held:
        yield first, *group(held)
