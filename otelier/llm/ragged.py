"""Arrays of arrays in NumPy: flat values with offsets, and hashes of words cut from one long array of characters."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each span in turn."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, kept and doubled as needed."""
    have = _POWERS.get(name)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _POWERS[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of `values`, from prefix sums of a polynomial, so the cost is one pass over `values`."""
    n = len(values)
    if not n:
        return np.zeros(len(starts), dtype=np.uint64)
    terms = mix(values.astype(np.uint64) + np.uint64(1)) * _powers("base", _BASE, n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=prefix[1:])
    inverse = _powers("inverse", pow(_BASE, -1, 1 << 64), n)
    h = (prefix[ends] - prefix[starts]) * inverse[np.minimum(starts, n - 1)]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
