"""Small helpers for column expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: str) -> Column:
    """The text column, NULL as empty."""
    return F.coalesce(F.col(text), F.lit(""))
