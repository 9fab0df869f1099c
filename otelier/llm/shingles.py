"""Hashed word shingles of texts, in NumPy."""

from __future__ import annotations

import numpy as np

from otelier.llm.ragged import mix, span_hashes

_PIECE = 500_000


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def _hash_words(data: np.ndarray) -> np.ndarray:
    blank = _blank(data)
    word = ~blank
    start, stop = word.copy(), word.copy()
    start[1:] &= blank[:-1]
    stop[:-1] &= blank[1:]
    upper = (data >= 0x41) & (data <= 0x5A)
    return span_hashes(data + upper * np.uint8(32), np.flatnonzero(start), np.flatnonzero(stop) + 1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of UTF-8 text with A-Z in lower case, piece by piece."""
    data = np.frombuffer(text, dtype=np.uint8)
    out, at = [], 0
    while len(data) - at > _PIECE:
        cut = at + _PIECE
        while cut < len(data):  # on to the next blank
            ahead = np.flatnonzero(_blank(data[cut:cut + _PIECE]))
            if len(ahead):
                cut += int(ahead[0])
                break
            cut = min(cut + _PIECE, len(data))
        out.append(_hash_words(data[at:cut]))
        at = cut
    out.append(_hash_words(data[at:]))
    return np.concatenate(out)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; texts are hashed together where they are short."""
    out, batch, room = [], [], _PIECE
    for t in texts:
        batch.append(t.encode("utf-8", "surrogatepass"))
        room -= len(batch[-1])
        if room <= 0:
            out += _sets(batch, size)
            batch, room = [], _PIECE
    return out + _sets(batch, size) if batch else out


def _sets(encoded: list[bytes], size: int) -> list[np.ndarray]:
    lengths = np.array([len(e) + 1 for e in encoded])
    data = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)
    if len(data) <= 2 * _PIECE:
        blank = _blank(data)
        first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        counts = np.bincount(np.searchsorted(np.cumsum(lengths), first, side="right"), minlength=len(encoded))
        words = np.split(_hash_words(data), np.cumsum(counts)[:-1])
    else:
        words = [word_hashes(e) for e in encoded]
    return [_shingles(w, size) for w in words]


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    width = min(size, len(words))
    h = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        h = mix(h + words[i:i + n])
    return np.unique(h)


def set_signature(hashes: np.ndarray) -> bytes:
    """16 bytes that tell sets of hashes apart."""
    with np.errstate(over="ignore"):
        a, b = mix(hashes).sum(dtype=np.uint64), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "little") + int(b).to_bytes(8, "little")
