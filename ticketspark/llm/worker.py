"""Helpers that a Python worker keeps from task to task: vocabularies, dictionaries, remembered costs.

A worker is used again by the tasks of later stages. It keeps the helpers of one operator at a time,
so what an earlier operator remembered does not stay in the executor's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_HELD: dict[tuple[str, Hashable], Any] = {}


def only(owner: str) -> None:
    """Drops what other operators than ``owner`` keep and gives their memory back."""
    others = [k for k in _HELD if k[0] != owner]
    if others:
        import gc

        import pyarrow as pa

        for k in others:
            del _HELD[k]
        gc.collect()
        pa.default_memory_pool().release_unused()


def held(owner: str, name: Hashable, make: Callable[[], Any]) -> Any:
    """The helper ``name`` of an operator, made when it is first asked for."""
    only(owner)
    if (owner, name) not in _HELD:
        _HELD[owner, name] = make()
    return _HELD[owner, name]
