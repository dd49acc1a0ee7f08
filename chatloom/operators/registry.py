"""Registries of named parts, and the registry of dataset transforms.

A transform maps a dataset's own columns to one ``messages`` column. The built-in
form is a *builder*: ``fn(schema, on_bad_row) -> Column``. It sees the input schema once,
on the driver, and returns a native expression.

``@register_transform(name, row_function=True)`` also takes a plain
``dict -> {"messages": [...]}`` function; it runs in Arrow batches with the
narrow message schema. Use it only where no column expression can do the job.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from typing import Generic, TypeVar

logger = logging.getLogger(__name__)

V = TypeVar("V")


class Registry(Generic[V]):
    """Values by name; *replace* says whether a name may be given again, with a warning."""

    def __init__(self, kind: str, replace: bool = False):
        self.kind = kind
        self.replace = replace
        self._values: dict[str, V] = {}

    def add(self, name: str, value: V) -> None:
        if name in self._values:
            if not self.replace:
                raise ValueError(f"There is already a {self.kind} with the name '{name}'.")
            logger.warning("Replacing the %s '%s'.", self.kind, name)
        self._values[name] = value

    def get(self, name: str) -> V:
        try:
            return self._values[name]
        except KeyError:
            raise KeyError(f"No {self.kind} is called '{name}'; known are: {', '.join(self.names())}") from None

    def names(self) -> list[str]:
        return sorted(self._values)

    def values(self) -> list[V]:
        return [self._values[n] for n in self.names()]


@dataclass(frozen=True)
class Transform:
    name: str
    fn: Callable
    row_function: bool = False


_TRANSFORMS: Registry[Transform] = Registry("transform")


def register_transform(name: str, row_function: bool = False) -> Callable:
    """Decorator that registers a builder, or a row function, under *name*."""

    def register(fn: Callable) -> Callable:
        _TRANSFORMS.add(name, Transform(name, fn, row_function))
        return fn

    return register


def get_transform(name: str) -> Transform:
    return _TRANSFORMS.get(name)


def transform_names() -> list[str]:
    return _TRANSFORMS.names()
