"""What a Python worker keeps between its tasks: one thing at a time, so that memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_HELD: dict[Hashable, Any] = {}


def held(mark: Hashable, make: Callable[[], Any]) -> Any:
    """The object of this mark; making it lets go of what the worker held for other operators."""
    if mark not in _HELD:
        let_go()
        _HELD[mark] = make()
    return _HELD[mark]


def let_go() -> None:
    """Nothing is held any more: for operators that hold nothing but may follow one that does."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()
