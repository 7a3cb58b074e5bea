"""Binding a value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, even where body uses it in a lambda:
    there a column's expression would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)
