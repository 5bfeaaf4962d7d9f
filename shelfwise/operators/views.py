"""The analytical views.

Two of the views join sales rows and stock rows of a warehouse many-to-many, so
their sums are inflated. The default (``corrected=False``) gives those sums by
algebra, without the fan-out; ``corrected=True`` leaves the inflation out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import look_back, sales_points
from shelfwise.functions.numeric import or_zero, ratio, total, value_of
from shelfwise.params import DEFAULTS, Params


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _per_warehouse(
    sales: DataFrame, stock: DataFrame, warehouses: DataFrame, as_of: dt.date, p: Params
) -> DataFrame:
    """Sales points with their sales sums and stock sums, each joined as one row."""
    sold = (
        look_back(sales, as_of, p.month_days)
        .groupBy("warehouse_id", "product_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("qty").alias("qty"),
            F.sum("amount").alias("amount"),
        )
        .groupBy("warehouse_id")
        .agg(
            F.sum("rows").alias("sales_rows"),
            F.count("product_id").alias("products_sold"),
            F.sum("qty").alias("sold_units"),
            F.sum("amount").alias("sold_amount"),
        )
    )
    held = stock.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("stock_rows"),
        F.count("product_id").alias("products_stocked"),
        F.sum("qty").alias("stock_units"),
        F.sum(value_of()).alias("stock_value"),
    )
    return (
        sales_points(warehouses)
        .select("warehouse_id", "name", "wtype", "region_id")
        .join(sold, "warehouse_id", "left")
        .join(held, "warehouse_id", "left")
    )


def _inflated(df: DataFrame, corrected: bool) -> DataFrame:
    """Each sales row meets every stock row of the warehouse and the other way round."""
    if corrected:
        return df
    per_sale = F.greatest(_zero("stock_rows"), F.lit(1))
    per_stock = F.greatest(_zero("sales_rows"), F.lit(1))
    wide = "decimal(38,5)"
    return df.withColumns(
        {
            "mean_stock": ratio(F.col("stock_units"), F.col("stock_rows")),
            "sold_units": (F.col("sold_units") * per_sale).cast(wide),
            "sold_amount": (F.col("sold_amount") * per_sale).cast(wide),
            "stock_units": (F.col("stock_units") * per_stock).cast(wide),
            "stock_value": (F.col("stock_value") * per_stock).cast(wide),
        }
    )


def warehouse_efficiency(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    corrected: bool = False,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Sales of the month against the stock of each sales point."""
    base = _per_warehouse(sales, stock, warehouses, as_of, p).withColumn(
        "mean_stock", ratio(F.col("stock_units"), F.col("stock_rows"))
    )
    rows = _inflated(base, corrected)
    mean = F.coalesce("mean_stock", F.lit(0.0))
    pct = F.round(ratio(or_zero("sold_units"), F.col("mean_stock")) * 100, 2)
    return rows.select(
        "warehouse_id", "name", "wtype", "region_id",
        or_zero("sold_units").alias("sold_units"),
        or_zero("sold_amount").alias("sold_amount"),
        F.round(mean, 6).alias("mean_stock"),
        or_zero("stock_value").alias("stock_value"),
        F.when(mean == 0, 0.0).otherwise(pct).alias("sold_over_available_pct"),
        _zero("products_sold").alias("products_sold"),
        _zero("products_stocked").alias("products_stocked"),
    )


def region_efficiency(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    regions: DataFrame,
    as_of: dt.date,
    corrected: bool = False,
    p: Params = DEFAULTS,
) -> DataFrame:
    """The same per region; regions without sales points stay with zeros."""
    per = _inflated(_per_warehouse(sales, stock, warehouses, as_of, p), corrected)
    sums = per.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("sales_points"),
        F.sum("sold_units").alias("sold_units"),
        F.sum("sold_amount").alias("sold_amount"),
        F.sum("stock_units").alias("stock_units"),
        F.sum("stock_value").alias("stock_value"),
    )
    units = or_zero("stock_units")
    pct = F.round(ratio(or_zero("sold_units"), units) * 100, 2)
    return (
        regions.select("region_id", "name")
        .join(sums, "region_id", "left")
        .select(
            "region_id", "name",
            _zero("sales_points").alias("sales_points"),
            or_zero("sold_amount").alias("sold_amount"),
            or_zero("stock_value").alias("stock_value"),
            F.when(units == 0, 0.0).otherwise(pct).alias("sold_over_available_pct"),
        )
    )


def stock_by_type(
    warehouse_types: DataFrame, warehouses: DataFrame, stock: DataFrame
) -> DataFrame:
    """Stock per warehouse type; types without warehouses or stock stay.

    Sums per (type, product) come first, so one large type is spread over tasks.
    """
    w = warehouses.select("warehouse_id", "wtype")
    held = (
        stock.join(w, "warehouse_id")
        .groupBy("wtype", "product_id")
        .agg(
            F.sum("qty").alias("qty"),
            F.sum(value_of()).alias("cost_value"),
            F.sum(value_of(cost="unit_price")).alias("sale_value"),
        )
        .groupBy("wtype")
        .agg(
            F.count("product_id").alias("products"),
            F.sum("qty").alias("units"),
            F.sum("cost_value").alias("cost_value"),
            F.sum("sale_value").alias("sale_value"),
        )
    )
    counted = w.groupBy("wtype").agg(F.count(F.lit(1)).alias("warehouses"))
    return (
        warehouse_types.select("wtype")
        .join(counted, "wtype", "left")
        .join(held, "wtype", "left")
        .select(
            "wtype",
            _zero("warehouses").alias("warehouses"),
            _zero("products").alias("products"),
            or_zero("units").alias("units"),
            or_zero("cost_value").alias("cost_value"),
            or_zero("sale_value").alias("sale_value"),
        )
    )


def _described(metrics: DataFrame, product_brand: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Metrics of branded products in known warehouses, with names."""
    w = warehouses.select(
        "warehouse_id", F.col("name").alias("warehouse_name"), "wtype", "region_id"
    )
    branded = product_brand.filter(F.col("brand_name").isNotNull())
    return metrics.join(branded, "product_id").join(w, "warehouse_id")


#: who is looked after first: brand category and class (fixed values); all others come last
ATTENTION = {
    (K.MAIN_BRANDS, "A"): 1,
    (K.MAIN_BRANDS, "B"): 2,
    (K.OTHER_BRANDS, "A"): 3,
    (K.MAIN_BRANDS, "C"): 4,
    (K.OTHER_BRANDS, "B"): 5,
}


def critical_products(
    metrics: DataFrame, product_brand: DataFrame, warehouses: DataFrame, p: Params = DEFAULTS
) -> DataFrame:
    """Items short of stock at sales points, ranked by brand category and class."""
    short = metrics.filter((F.col("days_of_stock") < p.medium_days) & (F.col("daily") > 0))
    days = F.col("days_of_stock")
    ranks = F.create_map(*(F.lit(x) for pair in ATTENTION.items() for x in ("/".join(pair[0]), pair[1])))
    place = F.concat_ws("/", "category", "abc_class")
    attention = F.coalesce(F.try_element_at(ranks, place), F.lit(len(ATTENTION) + 1))
    band = (
        F.when(days < p.critical_days, K.BAND_CRITICAL)
        .when(days < p.low_days, K.BAND_HIGH)
        .when(days < p.medium_days, K.BAND_MEDIUM)
    )
    return _described(short, product_brand, sales_points(warehouses)).select(
        "product_id", "product_name", "brand_name", "category", "abc_class", "warehouse_id",
        "warehouse_name", "region_id", "stock", "daily", "days_of_stock", "stock_state",
        "reorder_point",
        attention.alias("attention_rank"),
        band.alias("message"),
    )


def overstock(
    metrics: DataFrame, product_brand: DataFrame, warehouses: DataFrame, p: Params = DEFAULTS
) -> DataFrame:
    """Items above 1.5 times the brand's cover; brands without a cover target drop out."""
    days, cover = F.col("days_of_stock"), F.col("cover_days")
    over = days.cast("double") > cover * F.lit(p.over_factor)
    return _described(metrics, product_brand, warehouses).filter(over).select(
        "product_id", "product_name", "brand_name", "category", "abc_class", "warehouse_id",
        "warehouse_name", "wtype", "region_id", "stock", "daily", "days_of_stock",
        cover.alias("target_days"),
        (days - cover).cast("decimal(18,2)").alias("excess_days"),
        "stock_value",
    )


def low_rotation(
    metrics: DataFrame, product_brand: DataFrame, warehouses: DataFrame, p: Params = DEFAULTS
) -> DataFrame:
    """Items that hardly sell, labelled by how little and whether that is expected."""
    turn = F.col("turn").cast("double")
    slow = metrics.filter(
        (F.col("stock") > 0) & ((F.col("q90") < p.slow_units) | (turn < 2 * p.slow_turn))
    )
    label = (
        F.when(F.col("abc_class") == "D", K.ROTATION_EXPECTED)
        .when(F.col("q90") == 0, K.ROTATION_NONE)
        .when(turn < p.slow_turn, K.ROTATION_VERY_LOW)
        .otherwise(K.ROTATION_LOW)
    )
    return _described(slow, product_brand, warehouses).select(
        "product_id", "product_name", "brand_name", "category", "abc_class", "warehouse_id",
        "warehouse_name", "wtype", "stock", "q90", "turn", "stock_value",
        label.alias("rotation"),
    )


def brand_summary(
    brands: DataFrame,
    products: DataFrame,
    stock: DataFrame,
    sales: DataFrame,
    as_of: dt.date,
    corrected: bool = False,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Products, stock and sales per brand.

    By default a product's sales count once per stock row and "days" is sold
    over stock, as the view has it; ``corrected`` counts sales once and gives
    stock over sold.
    """
    held = stock.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("stock_rows"),
        F.sum("qty").alias("qty"),
        F.sum(value_of()).alias("value"),
        F.max(F.col("qty") > 0).alias("in_stock"),
    )
    sold = look_back(sales, as_of, p.month_days).groupBy("product_id").agg(
        F.sum("qty").alias("sold_qty"), F.sum("amount").alias("sold_value")
    )
    times = F.lit(1) if corrected else F.greatest(_zero("stock_rows"), F.lit(1))
    per_product = (
        products.filter(F.col("brand_id").isNotNull())
        .select("product_id", "brand_id")
        .join(held, "product_id", "left")
        .join(sold, "product_id", "left")
    )
    wide = "decimal(38,5)"
    sums = per_product.groupBy("brand_id").agg(
        F.count("product_id").alias("products"),
        F.count_if("in_stock").alias("products_in_stock"),
        F.sum("qty").alias("units"),
        F.sum("value").alias("stock_value"),
        F.sum((F.col("sold_qty") * times).cast(wide)).alias("sold_units"),
        F.sum((F.col("sold_value") * times).cast(wide)).alias("sold_amount"),
    )
    units, sold_units = or_zero("units"), or_zero("sold_units")
    part, whole = (units, sold_units) if corrected else (sold_units, units)
    days = F.round(ratio(part, whole) * p.month_days, 1)
    return brands.join(sums, "brand_id", "left").select(
        "brand_id", F.col("name").alias("brand_name"), "category", "abc_class",
        "buy_every_days", "cover_days", "total_cover",
        _zero("products").alias("products"),
        _zero("products_in_stock").alias("products_in_stock"),
        units.alias("units"),
        or_zero("stock_value").alias("stock_value"),
        sold_units.alias("sold_units"),
        or_zero("sold_amount").alias("sold_amount"),
        F.when(whole == 0, 0.0).otherwise(days).alias("mean_days"),
    )


def in_view_order(name: str, df: DataFrame) -> DataFrame:
    """The row order a view is shown in; the views themselves stay unsorted."""
    main_first = lambda: F.when(F.col("category") == K.MAIN_BRANDS, 1).otherwise(2)
    orders = {
        "stock_by_type": lambda: [F.col("cost_value").desc()],
        "critical_products": lambda: [F.col("attention_rank"), F.col("days_of_stock")],
        "overstock": lambda: [F.col("stock_value").desc()],
        "low_rotation": lambda: [main_first(), F.col("stock_value").desc()],
        "brand_summary": lambda: [main_first(), F.col("abc_class")],
    }
    return df.orderBy(*orders[name]())
