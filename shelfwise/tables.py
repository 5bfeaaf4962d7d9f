"""The model tables as one bundle, and the bounded checks made on its dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.sizes import BROADCAST_ROWS, bound_tasks, small_ones

DIMENSIONS = ("warehouse_types", "regions", "warehouses", "brands", "products")


@dataclass(frozen=True)
class Tables:
    sales: DataFrame
    stock: DataFrame
    products: DataFrame
    brands: DataFrame
    warehouses: DataFrame
    regions: DataFrame
    warehouse_types: DataFrame | None = None
    stock_daily: DataFrame | None = None
    small: frozenset[str] = field(default_factory=frozenset)

    def checked(self, max_rows: int = BROADCAST_ROWS) -> Tables:
        """Count each dimension up to max_rows and hint the small ones for broadcast.

        A dimension over the bound keeps no hint, and its joins are shuffled
        with AQE splitting skewed keys. What a task takes is bounded by the rows of sales.
        """
        bound_tasks(self.sales.sparkSession, self.sales.count())
        frames = {n: getattr(self, n) for n in DIMENSIONS if getattr(self, n) is not None}
        small = small_ones(frames, max_rows)
        hinted = {n: F.broadcast(frames[n]) for n in small}
        return replace(self, **hinted, small=frozenset(small))

    @property
    def product_brand(self) -> DataFrame:
        """Products with the attributes of their brand, one row per product."""
        joined = product_brand(self.products, self.brands)
        return F.broadcast(joined) if "products" in self.small else joined


def product_brand(products: DataFrame, brands: DataFrame) -> DataFrame:
    b = brands.select(
        "brand_id",
        F.col("name").alias("brand_name"),
        "category",
        "abc_class",
        "cover_days",
        "dc_lead",
    )
    p = products.select("product_id", F.col("name").alias("product_name"), "brand_id")
    return p.join(b, "brand_id", "left").select(
        "product_id", "product_name", "brand_id", "brand_name",
        "category", "abc_class", "cover_days", "dc_lead",
    )
