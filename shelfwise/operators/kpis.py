"""Dashboard indicators. Each returns one row, or one row per class."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import (
    NO_FILTERS,
    Filters,
    at_places,
    is_one_of,
    look_back,
    of_brands,
    tag_matches,
    with_tagged_stock,
    without_projects,
)
from shelfwise.functions.numeric import or_zero, percent, total, value_of
from shelfwise.operators.purchases import shortfalls
from shelfwise.params import DEFAULTS, Params

PAIR = ["product_id", "warehouse_id"]


def _stock_in_view(
    stock: DataFrame, warehouses: DataFrame, products: DataFrame, f: Filters
) -> DataFrame:
    chosen = at_places(stock, warehouses, f).filter(tag_matches("stock_tag", f.tags))
    return of_brands(chosen, products, f.brands)


def inventory(
    stock: DataFrame, warehouses: DataFrame, products: DataFrame, f: Filters = NO_FILTERS
) -> DataFrame:
    """Products, warehouses, units and value held at sales points.

    Two plain aggregates, each combined on the map side, in place of one with two distinct
    counts, which would multiply every row.
    """
    rows = _stock_in_view(stock, warehouses, products, f)
    per_product = rows.groupBy("product_id").agg(total("qty").alias("units"), total(value_of()).alias("value"))
    places = rows.groupBy("warehouse_id").agg(F.lit(1).alias("one")).agg(F.count("warehouse_id").alias("n")).scalar()
    return per_product.agg(
        F.count("product_id").alias("products"),
        total("units").alias("units"),
        total("value").alias("stock_value"),
    ).select("products", places.alias("warehouses"), "units", "stock_value")


def projects(
    stock: DataFrame, warehouses: DataFrame, products: DataFrame, f: Filters = NO_FILTERS
) -> DataFrame:
    """Stock reserved for projects at sales points."""
    tagged = stock.filter((F.col("stock_tag") == K.TAG_PROJECTS) & (F.col("qty") > 0))
    return _stock_in_view(tagged, warehouses, products, f).agg(
        F.count_distinct(*PAIR).alias("items"),
        total("qty").alias("units"),
        total(value_of()).alias("stock_value"),
    )


def sales_totals(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Sales of the month look-back, all warehouse types. The brand filter does not apply.

    With a tag filter, sales are first summed per product, so a best-seller
    meets the semi-join as one row.
    """
    recent = at_places(look_back(sales, as_of, p.month_days), warehouses, f, sales_point=False)
    if not f.tags:
        return recent.agg(
            F.count(F.lit(1)).alias("sales_rows"), total("qty").alias("units"), total("amount").alias("amount")
        )
    per_product = recent.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("qty").alias("qty"), F.sum("amount").alias("amount")
    )
    kept = with_tagged_stock(per_product, stock, f.tags)
    return kept.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("sales_rows"),
        total("qty").alias("units"),
        total("amount").alias("amount"),
    )


def pending_alerts(
    alerts: DataFrame, stock: DataFrame, warehouses: DataFrame, f: Filters = NO_FILTERS
) -> DataFrame:
    """Pending alerts by type. The brand filter does not apply."""
    pending = at_places(
        alerts.filter(F.col("state") == K.PENDING), warehouses, f, sales_point=False
    )
    kept = with_tagged_stock(pending, stock, f.tags, PAIR)
    return kept.agg(*_type_counts(), F.count(F.lit(1)).alias("total"))


def _type_counts() -> list[Column]:
    t = F.col("alert_type")
    return [
        F.count_if(t == K.ALERT_CRITICAL).alias("critical"),
        F.count_if(t == K.ALERT_LOW).alias("low"),
        F.count_if(t == K.ALERT_OVER).alias("over"),
        F.count_if(t == K.ALERT_NO_ROTATION).alias("no_rotation"),
        F.count_if(t == K.ALERT_STOCKOUT).alias("stockout"),
    ]


def pending_transfers(transfers: DataFrame, f: Filters = NO_FILTERS) -> DataFrame:
    """Pending transfers; only the destination region filters."""
    return transfers.filter(
        (F.col("state") == K.PENDING) & is_one_of("to_region", f.regions)
    ).agg(F.count(F.lit(1)).alias("pending"))


def pending_transfers_from_counts(counts: DataFrame, f: Filters = NO_FILTERS) -> DataFrame:
    """The same from counts by region (``offers.region_counts``, ``transfers.transfer_counts``), where no pair was formed."""
    return counts.filter(is_one_of("to_region", f.regions)).agg(
        F.coalesce(F.sum("transfers"), F.lit(0)).alias("pending")
    )


def pending_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.filter(F.col("state") == K.PENDING).agg(
        F.count(F.lit(1)).alias("purchases"), total("purchase_value").alias("purchase_value")
    )


def purchases_estimate(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Count and value of purchases with the default cover and lead for every product."""
    return shortfalls(sales, stock, None, warehouses, as_of, p=p).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.coalesce(F.sum("purchase_value"), F.lit(0.0)).alias("purchase_value"),
    )


def health_items(
    sales: DataFrame,
    stock: DataFrame,
    alerts: DataFrame,
    warehouses: DataFrame,
    products: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Each stock row at a sales point with its best (lowest) health class.

    Two aggregates, one over recent sales and one over pending alerts, replace
    a lookup per class; both are unique per (product, warehouse) before the join.
    """
    sold = (
        at_places(look_back(sales, as_of, p.month_days), warehouses)
        .select(*PAIR)
        .distinct()
        .withColumn("sold", F.lit(True))
    )
    t = F.col("alert_type")
    rank = (
        F.when(t == K.ALERT_CRITICAL, 2)
        .when(t == K.ALERT_LOW, 3)
        .when(t == K.ALERT_OVER, 4)
        .when(t == K.ALERT_SLOW, 5)
    )
    flagged = (
        alerts.filter(
            (F.col("state") == K.PENDING)
            & t.isin(K.ALERT_CRITICAL, K.ALERT_LOW, K.ALERT_OVER, K.ALERT_SLOW)
        )
        .groupBy(*PAIR)
        .agg(F.min(rank).alias("alert_rank"))
    )
    items = _stock_in_view(stock.filter(F.col("qty") >= 0), warehouses, products, f)
    was_sold = F.coalesce("sold", F.lit(False))
    empty = F.col("qty") == 0
    health = (
        F.when(empty & was_sold, 1)
        .when(F.col("alert_rank").isNotNull(), F.col("alert_rank"))
        .when(empty | ~was_sold, 6)
        .otherwise(7)
    )
    return (
        items.join(sold, PAIR, "left")
        .join(flagged, PAIR, "left")
        .select(*PAIR, value_of().alias("stock_value"), health.alias("health_rank"))
    )


def _health_name() -> Column:
    rank = F.col("health_rank")
    name = F.when(rank == 1, K.HEALTH[1])
    for i in range(2, len(K.HEALTH) + 1):
        name = name.when(rank == i, K.HEALTH[i])
    return name


def health(items: DataFrame) -> DataFrame:
    """Products and value per class; a product takes the best class over its warehouses."""
    per_product = items.groupBy("product_id").agg(
        F.sum("stock_value").alias("stock_value"), F.min("health_rank").alias("health_rank")
    )
    return (
        per_product.groupBy("health_rank")
        .agg(F.count(F.lit(1)).alias("products"), total("stock_value").alias("stock_value"))
        .select(_health_name().alias("health"), "products", "stock_value")
    )


def health_shares(health_rows: DataFrame, alerts: DataFrame) -> DataFrame:
    """All classes with their share of value, and totals.

    The out-of-stock count is raised to the number of products with a pending
    stock-out alert, which also covers products without a stock row.
    """
    spark = health_rows.sparkSession
    names = spark.range(1, len(K.HEALTH) + 1).select(
        F.col("id").cast("int").alias("health_rank")
    ).select(_health_name().alias("health"))
    out = K.HEALTH[1]
    alerted = (
        alerts.filter((F.col("alert_type") == K.ALERT_STOCKOUT) & (F.col("state") == K.PENDING))
        .agg(F.count_distinct("product_id").alias("n"))
        .scalar()
    )
    everything = Window.partitionBy(F.lit(1))  # seven rows, one per class
    n = F.coalesce("products", F.lit(0))
    return (
        F.broadcast(names)
        .join(health_rows, "health", "left")
        .withColumn("alerted", alerted)
        .withColumn("products", F.when(F.col("health") == out, F.greatest(n, "alerted")).otherwise(n))
        .withColumn("stock_value", or_zero("stock_value"))
        .withColumn("total_products", F.sum("products").over(everything))
        .withColumn("total_value", F.sum("stock_value").over(everything))
        .withColumn("value_pct", percent(F.col("stock_value"), F.col("total_value"), 1))
        .select("health", "products", "stock_value", "value_pct", "total_products", "total_value")
    )


def lost_sales(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Recent sales of items now without stock. Only region and warehouse filter."""
    sold = (
        at_places(look_back(sales, as_of, p.month_days), warehouses, f)
        .groupBy(*PAIR)
        .agg(F.sum("qty").alias("sold_units"), F.sum("amount").alias("sold_amount"))
        .filter(F.col("sold_units") > 0)
    )
    gone = sold.join(stock.select(*PAIR, "qty"), PAIR, "left").filter(or_zero("qty") == 0)
    return without_projects(gone, stock).agg(
        F.count(F.lit(1)).alias("items"),  # a row a pair
        total("sold_amount").alias("amount"),
        total("sold_units").alias("units"),
    )


def legacy_inventory(stock: DataFrame) -> DataFrame:
    return stock.agg(
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("warehouse_id").alias("warehouses"),
        total("qty").alias("units"),
        total(value_of()).alias("stock_value"),
    )


def legacy(
    sales: DataFrame,
    stock: DataFrame,
    alerts: DataFrame,
    pending_transfer_row: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """The older single-row indicator set: all warehouse types, no filters."""
    t, pending = F.col("alert_type"), alerts.filter(F.col("state") == K.PENDING)
    sold = look_back(sales, as_of, p.month_days).agg(
        F.count(F.lit(1)).alias("sales_rows"),
        total("qty").alias("sold_units"),
        total("amount").alias("sold_amount"),
    )
    raised = pending.agg(
        F.count_if(t == K.ALERT_CRITICAL).alias("critical"),
        F.count_if(t == K.ALERT_LOW).alias("low"),
        F.count_if(t == K.ALERT_OVER).alias("over"),
        F.count(F.lit(1)).alias("alerts"),
    )
    moves = pending_transfer_row.select(F.col("pending").alias("transfers"))
    return one_row(legacy_inventory(stock), sold, raised, moves)


def one_row(*single_rows: DataFrame) -> DataFrame:
    """Put one-row frames side by side: union them, then take each column's only value."""
    merged = single_rows[0]
    for frame in single_rows[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*(F.max(c).alias(c) for c in merged.columns))
