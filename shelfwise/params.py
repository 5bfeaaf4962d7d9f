"""Tunable thresholds, with the defaults the business rules use."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    critical_days: int = 3
    low_days: int = 7
    medium_days: int = 15
    over_factor: float = 1.5
    slow_units: int = 3
    slow_turn: float = 0.5
    short_days: int = 7
    month_days: int = 30
    long_days: int = 90
    default_cover: int = 30
    default_lead: int = 15
    reorder_safety: float = 1.2
    safety_days: int = 7
    no_sales_days: int = 9999
    buy_margin_days: int = 7
    stockout_critical_daily: Decimal = Decimal("1")
    stockout_high_daily: Decimal = Decimal("0.3")
    #: "units" compares days with twice the maximum stock in units, as the
    #: business rule is written; "days" compares with twice the cover target.
    over_level_rule: str = "units"
    #: rows of one product in one cell of the transfer match; a product with
    #: more warehouses than this is split over several tasks.
    match_cell_rows: int = 1000


DEFAULTS = Params()
