"""A read-only mapping whose values are built on first access.

Table dictionaries (booking model, history layer) hold lazy DataFrames; a
query touching two of fourteen tables only pays for building those two plans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class LazyTables(Mapping):
    def __init__(self, factories: Mapping[str, Callable[[], Any]]):
        self._factories = dict(factories)
        self._built: dict[str, Any] = {}

    def __getitem__(self, name: str) -> Any:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)

    def __contains__(self, name: object) -> bool:
        return name in self._factories
