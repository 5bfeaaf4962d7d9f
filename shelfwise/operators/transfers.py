"""Transfer recommendations: surplus of one warehouse offered to needs of others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.sizes import is_small
from shelfwise.params import DEFAULTS, Params

TRANSFER_COLUMNS = [
    "product_id", "from_id", "to_id", "to_region", "qty", "days_from", "days_to",
    "category", "abc_class", "priority",
]
SIDE_COLUMNS = [
    "product_id", "warehouse_id", "region_id", "wtype", "in_catalog", "stock", "days_of_stock",
    "daily", "reorder_point", "stock_max", "category", "abc_class",
]


def _zero_or_more(col: Column) -> Column:
    return F.greatest(col, F.lit(0).cast("decimal(15,5)"))


def is_need(p: Params = DEFAULTS) -> Column:
    return (
        (F.col("stock") > 0)
        & F.col("in_catalog")
        & (F.col("wtype") == K.SALES_POINT)
        & (F.col("days_of_stock") < p.medium_days)
        & (F.col("daily") > 0)
    )


def is_surplus() -> Column:
    return (
        (F.col("stock") > 0)
        & F.col("in_catalog")
        & F.col("wtype").isNotNull()
        & (F.col("stock") > F.col("stock_max"))
    )


def either_side(position: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The positions that are a need or a surplus, with what both are made of."""
    return position.filter(is_need(p) | is_surplus()).select(*SIDE_COLUMNS)


def needs(position: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Sales points running short: how much they lack to the reorder point."""
    return position.filter(is_need(p)).select(
        "product_id",
        F.col("warehouse_id").alias("to_id"),
        F.col("region_id").alias("to_region"),
        F.col("days_of_stock").alias("days_to"),
        _zero_or_more(F.col("reorder_point") - F.col("stock")).alias("needed"),
        "category",
        "abc_class",
    )


def surpluses(position: DataFrame) -> DataFrame:
    """Warehouses of any type with more than the maximum stock."""
    return position.filter(is_surplus()).select(
        "product_id",
        F.col("warehouse_id").alias("from_id"),
        F.col("days_of_stock").alias("days_from"),
        _zero_or_more(F.col("stock") - F.col("stock_max")).alias("available"),
    )


def priority(p: Params = DEFAULTS) -> Column:
    days, main = F.col("days_to"), F.col("category") == K.MAIN_BRANDS
    return (
        F.when((days < p.critical_days) & main & (F.col("abc_class") == "A"), K.URGENT)
        .when((days < p.low_days) & main, K.HIGH)
        .when(days < p.medium_days, K.MID)
        .otherwise(K.LOWEST)
    )


def _cells(need: DataFrame, surplus: DataFrame, p: Params) -> DataFrame:
    """Cell grid of each product whose match is too large for one task."""
    n = need.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    m = surplus.groupBy("product_id").agg(F.count(F.lit(1)).alias("m"))
    size = float(p.match_cell_rows)
    return (
        n.join(m, "product_id")
        .select(
            "product_id",
            F.ceil(F.col("n") / size).cast("int").alias("need_cells"),
            F.ceil(F.col("m") / size).cast("int").alias("surplus_cells"),
        )
        .filter((F.col("need_cells") > 1) | (F.col("surplus_cells") > 1))
    )


def _into_cells(df: DataFrame, grid: DataFrame, place: str, own: str, other: str) -> DataFrame:
    """Put each row in one cell of its own axis and copy it along the other axis."""
    one = F.lit(1)
    cells = lambda axis: F.coalesce(F.col(f"{axis}_cells"), one)
    return (
        df.join(grid, "product_id", "left")
        .withColumn(f"{own}_cell", F.pmod(F.xxhash64(place), cells(own)).cast("int"))
        .withColumn(f"{other}_cell", F.explode(F.sequence(F.lit(0), cells(other) - 1)))
        .drop("need_cells", "surplus_cells")
    )


def match(need: DataFrame, surplus: DataFrame, split: bool, p: Params = DEFAULTS) -> DataFrame:
    """Every surplus offered to every need of the same product in another warehouse.

    One surplus may serve several needs; nothing is allocated. With ``split``,
    a product with many rows is cut into a grid of cells: needs along one axis,
    surpluses along the other, each pair meeting in exactly one cell, so no
    product is matched in one task.
    """
    need = need.filter(F.col("needed") > 0)
    surplus = surplus.filter(F.col("available") > 0)
    keys = ["product_id"]
    if split:
        grid = _cells(need, surplus, p)
        need = _into_cells(need, grid, "to_id", "need", "surplus")
        surplus = _into_cells(surplus, grid, "from_id", "surplus", "need")
        keys += ["need_cell", "surplus_cell"]
    return (
        need.join(surplus, keys)
        .filter(F.col("from_id") != F.col("to_id"))
        .withColumn("qty", F.least("available", "needed").cast("decimal(15,5)"))
        .withColumn("priority", priority(p))
        .select(*TRANSFER_COLUMNS)
    )


def transfers(position: DataFrame, warehouses: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """All transfer recommendations.

    (product, warehouse) is unique, so a product has at most as many rows as
    there are warehouses: with few warehouses (counted) its match is bounded
    and no cells are needed.
    """
    split = not is_small(warehouses, p.match_cell_rows)
    return match(needs(position, p), surpluses(position), split, p)


def brand_rank() -> Column:
    main = F.col("category") == K.MAIN_BRANDS
    return F.when(main & (F.col("abc_class") == "A"), 1).when(main, 2).otherwise(3)


def in_order(transfer_rows: DataFrame) -> DataFrame:
    """Presentation order: important brands first, then the shortest stock."""
    keyed = transfer_rows.withColumn("brand_rank", brand_rank())
    return keyed.orderBy("brand_rank", "days_to", "product_id", "to_id", "from_id")


def transfer_counts(position: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Number of transfers per (product, destination region), without forming the pairs.

    Every need of a product meets every surplus of it except one in its own
    warehouse, so the count is needs x surpluses minus the positions that are both.
    """
    short = (
        (F.col("stock") > 0)
        & F.col("in_catalog")
        & (F.col("wtype") == K.SALES_POINT)
        & (F.col("days_of_stock") < p.medium_days)
        & (F.col("daily") > 0)
        & (F.col("reorder_point") > F.col("stock"))
    )
    over = (
        (F.col("stock") > 0)
        & F.col("in_catalog")
        & F.col("wtype").isNotNull()
        & (F.col("stock") > F.col("stock_max"))
    )
    flagged = position.select(
        "product_id", "region_id",
        F.coalesce(short, F.lit(False)).alias("short"),
        F.coalesce(over, F.lit(False)).alias("over"),
    ).filter(F.col("short") | F.col("over"))
    by_region = flagged.groupBy("product_id", "region_id").agg(
        F.count_if("short").alias("n"),
        F.count_if("over").alias("m"),
        F.count_if(F.col("short") & F.col("over")).alias("own"),
    )
    offers = by_region.groupBy("product_id").agg(F.sum("m").alias("offers"))
    return (
        by_region.filter(F.col("n") > 0)
        .join(offers, "product_id")
        .select(
            "product_id",
            F.col("region_id").alias("to_region"),
            (F.col("n") * F.col("offers") - F.col("own")).alias("transfers"),
        )
        .filter(F.col("transfers") > 0)
    )
