"""What a Python worker keeps between tasks. Workers are reused by later stages, so only one operator's stores stay at a time."""

from __future__ import annotations

import gc

_stores: dict[str, dict] = {}


def store(owner: str) -> dict:
    """The store of an operator in this worker; the stores of all others are dropped."""
    others = [o for o in _stores if o != owner]
    for o in others:
        _stores.pop(o).clear()
    if others:
        gc.collect()
    return _stores.setdefault(owner, {})
