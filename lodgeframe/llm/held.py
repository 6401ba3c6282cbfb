"""What a Python worker keeps between tasks: the one large object it used last."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

Made = TypeVar("Made")
_HELD: dict[Hashable, object] = {}


def held(name: Hashable, make: Callable[[], Made]) -> Made:
    """The object of that name, made if it is not the last one used; a worker serves many kinds of tasks, and
    models and caches of all of them together would outgrow its memory."""
    if name not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[name] = make()
    return _HELD[name]
