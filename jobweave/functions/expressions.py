"""Small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, wherever it is used inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
