"""Inventory and sales analytics over a network of warehouses, as Spark jobs."""

from shelfwise.params import Params
from shelfwise.tables import Tables

__all__ = ["Params", "Tables"]
