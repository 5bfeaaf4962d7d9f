"""Exact sums, guarded ratios and the stored precision of results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_QTY = "decimal(15,5)"


def or_zero(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(0).cast(ZERO_QTY))


def total(col: Column | str) -> Column:
    """Sum that is 0 for no rows."""
    return F.coalesce(F.sum(col), F.lit(0).cast(ZERO_QTY))


def ratio(num: Column, den: Column) -> Column:
    """num / den in double; NULL where den is 0.

    Sums stay decimal, so they do not depend on row order; only the last
    division leaves decimals.
    """
    return F.try_divide(num.cast("double"), den.cast("double"))


def rounded(col: Column, scale: int, precision: int = 18) -> Column:
    """Half-up rounding to a decimal of the given scale."""
    return F.round(col, scale).cast(f"decimal({precision},{scale})")


def percent(part: Column, whole: Column, scale: int) -> Column:
    """part / whole * 100, rounded; 0 where whole is not positive."""
    value = F.when(whole > 0, F.round(ratio(part, whole) * 100, scale))
    return F.coalesce(value, F.lit(0.0))


def value_of(qty: str = "qty", cost: str = "unit_cost") -> Column:
    return F.col(qty) * F.col(cost)


def text_of(col: Column, scale: int) -> Column:
    """A number as text with a fixed number of decimals."""
    return F.round(col, scale).cast(f"decimal(38,{scale})").cast("string")


def fill(template: str, *numbers: Column) -> Column:
    """Put columns in the {} places of a text; NULL if any column is NULL."""
    parts: list[Column] = []
    pieces = template.split("{}")
    for i, piece in enumerate(pieces):
        if piece:
            parts.append(F.lit(piece))
        if i < len(numbers):
            parts.append(numbers[i])
    return F.concat(*parts)
