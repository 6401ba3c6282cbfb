"""Column names that no caller's column has."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(base: str, taken: Iterable[str]) -> str:
    """``base``, with underscores added until no column of ``taken`` has that name, in whatever case."""
    used = {t.lower() for t in taken}
    while base.lower() in used:
        base += "_"
    return base
