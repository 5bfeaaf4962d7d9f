"""Purchase recommendations for the network, precomputed or computed live."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import (
    is_one_of,
    look_back,
    tag_matches,
    with_tagged_stock,
)
from shelfwise.functions.numeric import or_zero, ratio
from shelfwise.operators.metrics import network_sales, network_stock
from shelfwise.params import DEFAULTS, Params

PURCHASE_COLUMNS = [
    "product_id", "brand_id", "category", "abc_class", "stock_network", "projected",
    "qty", "cover_now", "cover_target", "unit_cost", "purchase_value", "order_date",
    "priority",
]
NETWORK_QTY = "decimal(25,5)"


def class_rank(labels: Sequence[str]) -> Column:
    """1 for the first class, 2 for the second, ...; anything else comes last."""
    rank = F.when(F.col("abc_class") == labels[0], 1)
    for i, label in enumerate(labels[1:], 2):
        rank = rank.when(F.col("abc_class") == label, i)
    return rank.otherwise(len(labels) + 1)


def coverage(
    sales: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Days the network stock of each selling product lasts.

    Only products with sales remain, so the plan starts from the aggregated
    sales and every join is on one row per product.
    """
    sold = network_sales(sales, warehouses, as_of, p).filter(F.col("q30") > 0)
    held = or_zero("stock_network").cast(NETWORK_QTY)
    cover = ratio(held * p.month_days, F.col("q30"))
    return (
        sold.join(product_brand, "product_id")
        .join(network_stock(stock), "product_id", "left")
        .withColumn("stock_network", held)
        .withColumn("unit_cost", F.coalesce("unit_cost", F.lit(0.0)))
        .withColumn("cover_now", F.round(cover, 2).cast("decimal(18,2)"))
    )


def purchases(
    sales: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """What to buy of the main brands so that stock covers target plus lead time."""
    cov = coverage(sales, stock, product_brand, warehouses, as_of, p)
    now, target, lead = F.col("cover_now"), F.col("cover_days"), F.col("dc_lead")
    short = cov.filter((F.col("category") == K.MAIN_BRANDS) & (now < target + lead))
    lacking = (target + lead) * F.col("q30").cast("double") / p.month_days - F.col(
        "stock_network"
    ).cast("double")
    wait = F.floor(F.greatest(now - lead - p.buy_margin_days, F.lit(0).cast("decimal(18,2)")))
    level = (
        F.when(now < lead, K.URGENT)
        .when(now < lead + p.buy_margin_days, K.HIGH)
        .when(now < target, K.MID)
        .otherwise(K.LOWEST)
    )
    return (
        short.withColumn("qty", F.greatest(F.round(lacking, 0), F.lit(0.0)).cast(NETWORK_QTY))
        .filter(F.col("qty") > 0)
        .withColumn("projected", F.col("q30").cast(NETWORK_QTY))
        .withColumn("cover_target", target)
        .withColumn(
            "purchase_value",
            F.round(F.col("qty").cast("double") * F.col("unit_cost"), 2).cast("decimal(18,2)"),
        )
        .withColumn("unit_cost", F.round("unit_cost", 5).cast("decimal(15,5)"))
        .withColumn("order_date", F.date_add(F.lit(as_of), wait.cast("int")))
        .withColumn("priority", level)
        .select(*PURCHASE_COLUMNS)
    )


def purchase_order(purchase_rows: DataFrame) -> DataFrame:
    """Presentation order: class A, class B, the rest; then the shortest cover."""
    return purchase_rows.orderBy(class_rank(["A", "B"]), "cover_now", "product_id")


def _network_demand(
    sales: DataFrame, warehouses: DataFrame, as_of: dt.date, p: Params
) -> DataFrame:
    """Per product: units sold at sales points, and the mean sale value over all warehouses."""
    points = warehouses.filter(F.col("wtype") == K.SALES_POINT).select(
        "warehouse_id", F.lit(True).alias("at_point")
    )
    sold = F.col("qty") > 0
    return (
        look_back(sales, as_of, p.month_days)
        .join(points, "warehouse_id", "left")
        .groupBy("product_id")
        .agg(
            F.sum(F.when(F.col("at_point"), F.col("qty"))).alias("q30"),
            F.sum(F.when(sold, F.col("amount"))).alias("paid"),
            F.sum(F.when(sold, F.col("qty"))).alias("units"),
        )
        .filter(F.col("q30") > 0)
        .select(
            "product_id",
            "q30",
            F.round(ratio(F.col("paid"), F.col("units")), 0).alias("sale_cost"),
        )
    )


def _network_supply(stock: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Per product, in one pass: stock, mean non-zero cost, project flag, tag flag."""
    cost = F.col("unit_cost")
    priced = cost > 0
    return stock.groupBy("product_id").agg(
        F.sum("qty").alias("stock_network"),
        ratio(F.sum(F.when(priced, cost)), F.count_if(priced)).alias("stock_cost"),
        F.max(F.coalesce(F.col("stock_tag") == K.TAG_PROJECTS, F.lit(False))).alias("for_projects"),
        F.max(F.coalesce(tag_matches("stock_tag", tags), F.lit(False))).alias("tag_ok"),
    )


def shortfalls(
    sales: DataFrame,
    stock: DataFrame,
    brand_terms: DataFrame | None,
    warehouses: DataFrame,
    as_of: dt.date,
    tags: Sequence[str] = (),
    p: Params = DEFAULTS,
) -> DataFrame:
    """Selling products whose network stock is under (cover + lead) days of sales.

    ``brand_terms`` has product_id, cover and lead; without it the defaults hold
    for every product. Products with project stock are left out. Costs fall
    back from stock to sales to 0.
    """
    days = F.col("cover") + F.col("lead")
    target = days * F.col("q30").cast("double") / p.month_days
    held = or_zero("stock_network").cast(NETWORK_QTY)
    demand = _network_demand(sales, warehouses, as_of, p)
    if brand_terms is None:
        demand = demand.withColumns(
            {"cover": F.lit(p.default_cover), "lead": F.lit(p.default_lead)}
        )
    else:
        demand = demand.join(brand_terms, "product_id")
    out = demand.join(_network_supply(stock, tags), "product_id", "left").filter(
        ~F.coalesce("for_projects", F.lit(False))
    )
    if tags:
        out = out.filter(F.coalesce("tag_ok", F.lit(False)))
    return (
        out.withColumn("stock_network", held)
        .withColumn("target", target)
        .filter(F.col("stock_network").cast("double") < F.col("target"))
        .withColumn(
            "qty",
            F.greatest(F.ceil(F.col("target") - F.col("stock_network").cast("double")), F.lit(0))
            .cast(NETWORK_QTY),
        )
        .withColumn("unit_cost", F.coalesce("stock_cost", "sale_cost", F.lit(0.0)))
        .withColumn("purchase_value", F.col("qty").cast("double") * F.col("unit_cost"))
    )


def purchases_live(
    sales: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    limit: int | None = 50,
    priority: str | None = None,
    brands: Sequence = (),
    tags: Sequence[str] = (),
    filter_after_limit: bool = False,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Purchases for all brands, computed from sales and stock.

    The priority filter comes before the limit; ``filter_after_limit`` applies
    it to the limited list instead, as the dashboard used to.
    """
    terms = product_brand.filter(is_one_of("brand_id", brands)).select(
        "product_id", "product_name", "brand_name", "category", "abc_class",
        F.coalesce("cover_days", F.lit(p.default_cover)).alias("cover"),
        F.coalesce("dc_lead", F.lit(p.default_lead)).alias("lead"),
    )
    lacking = shortfalls(sales, stock, terms, warehouses, as_of, tags, p)
    cover_now = ratio(F.col("stock_network") * p.month_days, F.col("q30"))
    empty = F.col("stock_network") == 0
    level = (
        F.when(empty | (cover_now < F.col("lead")), K.URGENT)
        .when(cover_now < F.col("lead") + p.buy_margin_days, K.HIGH)
        .when(cover_now < F.col("cover"), K.MID)
        .otherwise(K.LOWEST)
    )
    rows = lacking.select(
        "product_id", "product_name", "brand_name", "category", "abc_class", "stock_network",
        F.col("q30").cast(NETWORK_QTY).alias("projected"),
        "qty",
        F.round(cover_now, 1).cast("decimal(18,1)").alias("cover_now"),
        F.col("cover").alias("cover_target"),
        "unit_cost", "purchase_value",
        F.lit(None).cast("date").alias("order_date"),
        level.alias("priority"),
        F.lit(K.COMPUTED).alias("state"),
    )
    wanted = F.lit(True) if priority is None else F.col("priority") == priority
    if not filter_after_limit:
        rows = rows.filter(wanted)
    if limit is not None:
        main_first = F.when(F.col("category") == K.MAIN_BRANDS, 0).otherwise(1)
        rows = rows.orderBy(
            F.when(F.col("stock_network") == 0, 0).otherwise(1),
            main_first,
            class_rank(["A", "B", "C"]),
            "cover_now",
            "product_id",
        ).limit(limit)
    return rows.filter(wanted) if filter_after_limit else rows


PRIORITY_RANK = [K.URGENT, K.HIGH, K.MID, K.LOWEST]


def priority_key(order: str) -> Column:
    """"text" sorts priorities as words, as stored lists do; "rank" by urgency."""
    if order == "text":
        return F.col("priority")
    return F.array_position(F.array(*(F.lit(x) for x in PRIORITY_RANK)), F.col("priority"))


def purchase_list(
    stored: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    brand_names: DataFrame,
    limit: int = 50,
    priority: str | None = None,
    brands: Sequence = (),
    tags: Sequence[str] = (),
    order: str = "text",
) -> DataFrame:
    """Stored pending purchases with product and brand names."""
    names = product_brand.select("product_id", "product_name")
    b = brand_names.select("brand_id", F.col("name").alias("brand_name"))
    rows = stored.filter((F.col("state") == K.PENDING) & is_one_of("brand_id", brands))
    if priority is not None:
        rows = rows.filter(F.col("priority") == priority)
    rows = with_tagged_stock(rows, stock, tags)
    by = [priority_key(order), "cover_now", "product_id"]
    top = rows.orderBy(*by).limit(limit)
    return (
        top.join(names, "product_id", "left")
        .join(b, "brand_id", "left")
        .select(
            "product_id", "product_name", "brand_name", "category", "abc_class",
            "stock_network", "projected", "qty", "cover_now", "cover_target",
            "unit_cost", "purchase_value", "order_date", "priority", "state",
        )
        .orderBy(*by)
    )


def has_pending(stored: DataFrame | None) -> bool:
    """Probe: one row is enough, so the scan stops there."""
    return stored is not None and not stored.filter(F.col("state") == K.PENDING).isEmpty()
