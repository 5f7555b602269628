"""Settings from the environment: a value that can't be read is the default."""

from __future__ import annotations

import os
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
#: What counts as on.
ON = ("1", "true", "yes", "on")


def setting(names: str | tuple[str, ...], default: T, read: Callable[[str], T] | None = None, allowed: Callable[[T], bool] = lambda v: True) -> T:
    """The first of the names that is set, read as the default's type (a switch is on for 1, true, yes and on)."""
    of = read or ((lambda x: x.strip().lower() in ON) if isinstance(default, bool) else type(default))
    for name in (names,) if isinstance(names, str) else names:
        if (given := os.environ.get(name)) is not None:
            try:
                value = of(given)
            except ValueError:
                continue
            if allowed(value):
                return value
    return default
