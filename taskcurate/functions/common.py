"""Small helpers shared by the Column builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; otherwise it is inlined per use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Trim white space of any kind on both ends."""
    return F.regexp_replace(text, r"^\s+|\s+\z", "")

