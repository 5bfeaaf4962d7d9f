"""Evaluate an expression once although it is used several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value bound to a lambda variable.

    The optimizer copies an aliased expression to each place it is used when it
    merges projections or pushes filters; with long text functions that makes
    plans grow without bound. A lambda variable is not copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
