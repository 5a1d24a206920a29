"""Columns over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that it uses several times, worked out once."""
    return F.transform(F.array(value), body)[0]
