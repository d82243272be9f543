"""Nested values by dotted paths, where ``*`` stands for every item of a list."""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator


def _places(value: object, keys: list[str]) -> Iterator[tuple[object, object]]:
    """(container, key) of every string at the end of a path."""
    key, rest = keys[0], keys[1:]
    if key == "*":
        inside = enumerate(value) if isinstance(value, list) else ()
    else:
        inside = ((key, value[key]),) if isinstance(value, dict) and key in value else ()
    for k, x in inside:
        if rest:
            yield from _places(x, rest)
        elif isinstance(x, str):
            yield value, k


def extract(record: dict, path: str) -> list[str]:
    """Strings at a path, in order."""
    return [container[key] for container, key in _places(record, path.split("."))]


def replace(record: dict, path: str, values: list[str]) -> dict:
    """A copy with the strings at a path replaced in order; with too few values the last ones stay."""
    out = copy.deepcopy(record)
    for (container, key), value in zip(list(_places(out, path.split("."))), values, strict=False):
        container[key] = value
    return out


def parse(value: object) -> object | None:
    """A dict or list, given as such or in JSON; None for anything else."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
    return value if isinstance(value, dict | list) else None
