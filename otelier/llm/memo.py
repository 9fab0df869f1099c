"""Objects that a Python worker builds once, such as an encoder."""

from __future__ import annotations

from collections.abc import Callable

_LOADED: dict = {}


def once(key, build: Callable):
    """Per Python process: `build()` for the first call with `key`, the same object after that."""
    if key not in _LOADED:
        _LOADED[key] = build()
    return _LOADED[key]
