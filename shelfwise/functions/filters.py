"""Shared predicates: lists, tags, look-backs and semi/anti restrictions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K


def parse_list(value: str | Sequence[str] | None) -> list:
    """Comma list to values; blank means no filter."""
    if not value:
        return []
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    return list(value)


def is_one_of(col: str | Column, values: Sequence) -> Column:
    """IN filter; an empty list lets every row pass, NULLs too."""
    if not values:
        return F.lit(True)
    return (F.col(col) if isinstance(col, str) else col).isin(list(values))


def tag_matches(tag: str | Column, tags: Sequence[str]) -> Column:
    """Stock-tag filter. The plain tag stands for NULL and empty; others match exactly.

    On the right side of a left join the plain tag therefore also keeps rows
    without a partner, and any other tag drops them.
    """
    col = F.col(tag) if isinstance(tag, str) else tag
    if not tags:
        return F.lit(True)
    named = [t for t in tags if t != K.TAG_PLAIN]
    checks = []
    if K.TAG_PLAIN in tags:
        checks.append(F.coalesce(col, F.lit("")) == "")
    if named:
        checks.append(col.isin(named))
    return checks[0] if len(checks) == 1 else checks[0] | checks[1]


@dataclass(frozen=True)
class Filters:
    """The filter set of a dashboard request."""

    regions: Sequence = field(default_factory=list)
    warehouses: Sequence = field(default_factory=list)
    brands: Sequence = field(default_factory=list)
    tags: Sequence[str] = field(default_factory=list)

    @classmethod
    def parse(cls, regions=None, warehouses=None, brands=None, tags=None) -> Filters:
        return cls(*(parse_list(v) for v in (regions, warehouses, brands, tags)))

    def place(self) -> Column:
        """Region and warehouse filter, on columns region_id and warehouse_id."""
        return is_one_of("region_id", self.regions) & is_one_of("warehouse_id", self.warehouses)


NO_FILTERS = Filters()


def days_before(as_of: dt.date, days: int) -> Column:
    """A date literal, so that partitions are pruned while planning."""
    return F.lit(as_of - dt.timedelta(days=days))


def look_back(df: DataFrame, as_of: dt.date, days: int, date_col: str = "sale_date") -> DataFrame:
    """Rows of the last ``days`` days: lower bound inclusive, as_of the last day."""
    return df.filter(F.col(date_col).between(days_before(as_of, days), F.lit(as_of)))


def sales_points(warehouses: DataFrame) -> DataFrame:
    return warehouses.filter(F.col("wtype") == K.SALES_POINT)


def places(warehouses: DataFrame, filters: Filters = NO_FILTERS, sales_point: bool = True) -> DataFrame:
    """Warehouse ids (with region) that pass the filters."""
    chosen = sales_points(warehouses) if sales_point else warehouses
    return chosen.filter(filters.place()).select("warehouse_id", "region_id")


def at_places(
    df: DataFrame, warehouses: DataFrame, filters: Filters = NO_FILTERS, sales_point: bool = True
) -> DataFrame:
    """Rows of df in the chosen warehouses. warehouse_id is unique there, so a semi-join does."""
    return df.join(
        places(warehouses, filters, sales_point).select("warehouse_id"), "warehouse_id", "left_semi"
    )


def of_brands(df: DataFrame, products: DataFrame, brands: Sequence) -> DataFrame:
    """Rows whose product belongs to one of the brands; no list, no join."""
    if not brands:
        return df
    chosen = products.filter(is_one_of("brand_id", brands)).select("product_id")
    return df.join(chosen, "product_id", "left_semi")


def tagged_keys(stock: DataFrame, tags: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Distinct keys having a stock row with a matching tag.

    Distinct combines on the map side, so a product with very many stock rows
    reaches the join as one row.
    """
    return stock.filter(tag_matches("stock_tag", tags)).select(*keys).distinct()


def with_tagged_stock(
    df: DataFrame, stock: DataFrame, tags: Sequence[str], keys: Sequence[str] = ("product_id",)
) -> DataFrame:
    """Keep rows whose key has stock with a matching tag; no tags, no join."""
    if not tags:
        return df
    return df.join(tagged_keys(stock, tags, keys), list(keys), "left_semi")


def without_projects(df: DataFrame, stock: DataFrame) -> DataFrame:
    """Drop products that have any stock row tagged as project stock."""
    return df.join(tagged_keys(stock, [K.TAG_PROJECTS], ["product_id"]), "product_id", "left_anti")
