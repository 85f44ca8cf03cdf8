"""Registered queries over the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

FAMILIES = [
    "layers", "features", "exploration", "charts", "density", "quality", "tables",
    "learning",
]


def collect() -> dict[str, tuple[Callable, str | None]]:
    """All (query, SQL or None) pairs by name."""
    found: dict[str, tuple[Callable, str | None]] = {}
    for family in FAMILIES:
        for name, pair in import_module(f"{__name__}.{family}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name!r} is registered twice")
            found[name] = pair
    return found
