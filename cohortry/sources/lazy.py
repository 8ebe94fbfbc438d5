"""Named inputs that are opened when first used."""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

T = TypeVar("T")


class OpenedOnUse(Generic[T]):
    """The annotated names of a subclass, each passed to ``open_input`` once, on first use."""

    def __init__(self, open_input: Callable[[str], T]) -> None:
        self._open_input = open_input

    def __getattr__(self, name: str) -> T:
        if name not in type(self).__annotations__:
            raise AttributeError(f"{type(self).__name__} has no input {name!r}")
        opened = self._open_input(name)
        setattr(self, name, opened)
        return opened

    def open_all(self) -> None:
        """Open every input now, so that a missing one is reported before work starts."""
        for name in type(self).__annotations__:
            getattr(self, name)
