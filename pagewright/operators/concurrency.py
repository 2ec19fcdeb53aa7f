"""A bounded, ordered map for small lists on the driver; data goes through DataFrames instead."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

A, B = TypeVar("A"), TypeVar("B")


def map_limit(values: Iterable[A], limit: int, fn: Callable[[A], B]) -> list[B]:
    """fn of each value, in order, at most `limit` at a time; the first error ends it."""
    with ThreadPoolExecutor(max_workers=max(1, int(limit))) as pool:
        return list(pool.map(fn, values))
