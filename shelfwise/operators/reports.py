"""Lists, rankings, series and breakdowns of the dashboard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import (
    NO_FILTERS,
    Filters,
    at_places,
    is_one_of,
    look_back,
    sales_points,
    tag_matches,
    with_tagged_stock,
)
from shelfwise.functions.numeric import or_zero, percent, ratio, total, value_of
from shelfwise.operators.offers import first_pairs
from shelfwise.operators.purchases import priority_key
from shelfwise.params import DEFAULTS, Params

PAIR = ["product_id", "warehouse_id"]


# --- choices -----------------------------------------------------------------


def active_regions(regions: DataFrame) -> DataFrame:
    return regions.filter("active").select("region_id", "name").orderBy("name", "region_id")


def active_sales_points(warehouses: DataFrame) -> DataFrame:
    rows = sales_points(warehouses).filter("active")
    return rows.select("warehouse_id", "name", "region_id").orderBy("name", "warehouse_id")


def active_brands(brands: DataFrame) -> DataFrame:
    rows = brands.filter("active").select("brand_id", "name", "category", "abc_class")
    return rows.orderBy("category", "abc_class", "name", "brand_id")


def tag_choices(stock: DataFrame) -> DataFrame:
    """Stock tags with their number of products; blank tags count as plain.

    Distinct per (tag, product) comes first: one tag may hold most rows.
    """
    tag = F.coalesce(F.nullif(F.trim("stock_tag"), F.lit("")), F.lit(K.TAG_PLAIN))
    pairs = stock.select(tag.alias("tag"), "product_id").distinct()
    return pairs.groupBy("tag").agg(F.count("product_id").alias("products"))


def fetched(few: DataFrame) -> DataFrame:
    """A list bounded by its limit as a local table, so that all who use it read the same rows."""
    return few.sparkSession.createDataFrame(few.toArrow(), schema=few.schema)


# --- lists -------------------------------------------------------------------


def alert_list(
    alerts: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    limit: int = 50,
    state: str | None = K.PENDING,
    alert_type: str | None = None,
    level: str | None = None,
    f: Filters = NO_FILTERS,
) -> DataFrame:
    """Newest alerts with names, local stock value and national stock, and who handled them when.

    The limit is taken first, once (at most ``limit`` rows come to the driver), and stock is
    read afterwards, only for the products of the limited list. A tag
    filter needs stock before the limit and then joins it.
    """
    rows = alerts
    for name, wanted in (("state", state), ("alert_type", alert_type), ("level", level)):
        if wanted:
            rows = rows.filter(F.col(name) == wanted)
    w = warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"), "region_id")
    names = product_brand.select("product_id", "product_name", "brand_id")

    def named(df: DataFrame) -> DataFrame:
        return df.join(names, "product_id", "left").join(w, "warehouse_id", "left")

    # look-ups come before the limit only where a filter needs them
    early = bool(f.regions or f.warehouses or f.brands)
    if early:
        rows = named(rows).filter(f.place() & is_one_of("brand_id", f.brands))
    if f.tags:
        tags = stock.select(*PAIR, "stock_tag")
        rows = rows.join(tags, PAIR, "left").filter(tag_matches("stock_tag", f.tags))
    order = [F.col("generated_on").desc(), "alert_type", "product_id", "warehouse_id"]
    top = fetched(rows.orderBy(*order).limit(limit))
    if not early:
        top = named(top)
    wanted = F.broadcast(top.select("product_id").distinct())
    near = stock.join(wanted, "product_id", "left_semi")
    handling = [c for c in ("handled_by", "handled_at") if c in alerts.columns]
    national = near.groupBy("product_id").agg(F.sum("qty").alias("national_stock"))
    local = near.select(*PAIR, value_of().alias("stock_value"))
    return (
        top.join(local, PAIR, "left")
        .join(national, "product_id", "left")
        .select(
            "alert_type", "level", "product_id", "product_name", "warehouse_id",
            "warehouse_name", "stock", "days_of_stock", "daily", "message", "generated_on",
            "state", "region_id", "category", "abc_class", "brand_id",
            or_zero("stock_value").alias("stock_value"),
            or_zero("national_stock").alias("national_stock"),
            *handling,
        )
        .orderBy(*order)
    )


def alert_list_by_level(
    alerts: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    limit: int = 50,
    alert_type: str | None = None,
    level: str | None = None,
    order: str = "text",
) -> DataFrame:
    """Pending alerts by level, then shortest stock. "text" sorts levels as words."""
    rows = alerts.filter(F.col("state") == K.PENDING)
    for name, wanted in (("alert_type", alert_type), ("level", level)):
        if wanted:
            rows = rows.filter(F.col(name) == wanted)
    if order == "text":
        first = F.col("level").desc()
    else:
        urgency = [K.LEVEL_CRITICAL, K.LEVEL_HIGH, K.LEVEL_MEDIUM]
        first = F.array_position(F.array(*(F.lit(x) for x in urgency)), F.col("level")).asc()
    by = [first, "days_of_stock", "alert_type", "product_id", "warehouse_id"]
    top = rows.orderBy(*by).limit(limit)
    w = warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"))
    names = product_brand.select("product_id", "product_name")
    return (
        top.join(names, "product_id", "left")
        .join(w, "warehouse_id", "left")
        .select(
            "alert_type", "level", "product_id", "product_name", "warehouse_id",
            "warehouse_name", "stock", "days_of_stock", "daily", "message", "generated_on",
        )
        .orderBy(*by)
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    pending = alerts.filter(F.col("state") == K.PENDING)
    return pending.groupBy("alert_type", "level").agg(F.count(F.lit(1)).alias("alerts"))


#: what comes before the days of the destination: nothing, the priority as a word descending, or its rank
def _priority_first(order: str) -> list:
    return {"days": [], "text": [priority_key("text").desc()], "rank": [priority_key("rank").asc()]}[order]


def _named_transfers(top: DataFrame, product_brand: DataFrame, warehouses: DataFrame, by: list) -> DataFrame:
    """A limited list with the names of products and of both warehouses, in its order."""
    names = product_brand.select("product_id", "product_name")

    def named(role: str) -> DataFrame:
        return warehouses.select(
            F.col("warehouse_id").alias(f"{role}_id"), F.col("name").alias(f"{role}_name")
        )

    return (
        top.join(names, "product_id", "left")
        .join(named("from"), "from_id", "left")
        .join(named("to"), "to_id", "left")
        .select(
            "product_id", "product_name", "from_id", "from_name", "to_id", "to_name",
            "to_region", "qty", "days_from", "days_to", "priority", "state",
        )
        .orderBy(*by)
    )


def transfer_list(
    needs: DataFrame,
    offers: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    limit: int = 50,
    state: str | None = K.PENDING,
    priority: str | None = None,
    f: Filters = NO_FILTERS,
    order: str = "days",
    handled: DataFrame | None = None,
) -> DataFrame:
    """Transfers to the warehouses that run out first, with both warehouse names.

    order "days" is by destination days; "text" puts priority, as a word
    descending, before it; "rank" puts the urgent ones first. The pairs are formed only for
    the needs that reach the limit (see ``offers``).
    """
    rows = needs.filter(is_one_of("to_region", f.regions))
    if priority:
        rows = rows.filter(F.col("priority") == priority)
    rows = with_tagged_stock(rows, stock, f.tags)
    by = [*_priority_first(order), "days_to"]
    top = first_pairs(rows, offers, limit, by, state, handled)
    return _named_transfers(top, product_brand, warehouses, [*by, "product_id", "to_id", "from_id"])


def warehouse_list(
    warehouses: DataFrame,
    metrics: DataFrame,
    f: Filters = NO_FILTERS,
    wtype: str | None = K.SALES_POINT,
    active_only: bool = True,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Warehouses with today's metrics; mean days leave out items without sales.

    (product, warehouse) is unique per day, so counting rows counts products.
    """
    rows = warehouses.filter(is_one_of("region_id", f.regions))
    if active_only:
        rows = rows.filter("active")
    if wtype:
        rows = rows.filter(F.col("wtype") == wtype)
    days = F.when(F.col("days_of_stock") < p.no_sales_days, F.col("days_of_stock"))
    per = metrics.groupBy("warehouse_id").agg(
        F.count("product_id").alias("products"),
        F.sum("stock").alias("units"),
        F.sum("stock_value").alias("stock_value"),
        F.round(ratio(F.sum(days), F.count(days)), 6).alias("mean_days"),
    )
    return rows.join(per, "warehouse_id", "left").select(
        "warehouse_id", "name", "wtype", "region_id", "is_dc",
        F.coalesce("products", F.lit(0)).alias("products"),
        or_zero("units").alias("units"),
        or_zero("stock_value").alias("stock_value"),
        "mean_days",
    )


def by_value(df: DataFrame, key: str = "warehouse_id") -> DataFrame:
    """Presentation order: largest stock value first."""
    return df.orderBy(F.col("stock_value").desc_nulls_last(), key)


def warehouse_top(
    metrics: DataFrame, product_brand: DataFrame, warehouse_id, limit: int = 100
) -> DataFrame:
    """The most valuable items of one warehouse."""
    by = [F.col("stock_value").desc(), "product_id"]
    top = metrics.filter(F.col("warehouse_id") == warehouse_id).orderBy(*by).limit(limit)
    names = product_brand.select("product_id", "product_name")
    return top.join(names, "product_id", "left").select(
        "product_id", "product_name", "stock", "stock_value", "q30", "daily",
        "days_of_stock", "turn", "stock_state",
    ).orderBy(*by)


# --- series and rankings -------------------------------------------------------


def daily_sales(
    sales: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    days: int = 30,
    f: Filters = NO_FILTERS,
) -> DataFrame:
    recent = at_places(look_back(sales, as_of, days), warehouses, f, sales_point=False)
    return recent.groupBy("sale_date").agg(
        F.count(F.lit(1)).alias("sales_rows"),
        total("qty").alias("units"),
        total("amount").alias("amount"),
    )


def inventory_value(
    stock: DataFrame, warehouses: DataFrame, f: Filters = NO_FILTERS
) -> DataFrame:
    rows = at_places(stock, warehouses, f).filter(tag_matches("stock_tag", f.tags))
    return rows.agg(total(value_of()).alias("inventory_value"))


def daily_efficiency(
    sales: DataFrame,
    stock: DataFrame,
    stock_daily: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Sales of a day as a share of the inventory value of that day.

    The value is the day's snapshot if there is one, else today's value plus
    all later sales. The suffix sum runs over one row per day of the look-back.
    """
    recent = at_places(look_back(sales, as_of, p.month_days), warehouses, f, sales_point=False)
    if f.tags:
        per_product = recent.groupBy("sale_date", "product_id").agg(F.sum("amount").alias("amount"))
        recent = with_tagged_stock(per_product, stock, f.tags)
    daily = recent.groupBy("sale_date").agg(total("amount").alias("amount"))
    snapshots = (
        at_places(look_back(stock_daily, as_of, p.month_days, "snapshot_date"), warehouses, f)
        .filter(tag_matches("stock_tag", f.tags))
        .groupBy(F.col("snapshot_date").alias("sale_date"))
        .agg(total(value_of()).alias("snapshot_value"))
    )
    today = inventory_value(stock, warehouses, f).scalar()
    later = Window.orderBy(F.col("sale_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        daily.withColumn("later", or_zero(F.sum("amount").over(later)))
        .join(snapshots, "sale_date", "left")
        .withColumn("today_value", today)
        .withColumn(
            "inventory", F.coalesce("snapshot_value", F.col("today_value") + F.col("later"))
        )
        .select(
            "sale_date", "amount", "inventory",
            percent(F.col("amount"), F.col("inventory"), 4).alias("efficiency"),
            "today_value",
        )
    )


def top_products(
    sales: DataFrame,
    stock: DataFrame,
    products: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    limit: int = 20,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Best-selling products of the month look-back.

    Sums per (product, warehouse) first: the second level then counts
    warehouses without a distinct, and names are joined after the limit.
    """
    recent = at_places(look_back(sales, as_of, p.month_days), warehouses, f, sales_point=False)
    per_product = (
        recent.groupBy(*PAIR)
        .agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
        .groupBy("product_id")
        .agg(
            total("qty").alias("units"),
            total("amount").alias("amount"),
            F.count("warehouse_id").alias("warehouses"),
        )
    )
    names = products.select("product_id", F.col("name").alias("product_name"), "brand_id")
    if f.brands:
        chosen = names.filter(is_one_of("brand_id", f.brands)).select("product_id")
        per_product = per_product.join(chosen, "product_id", "left_semi")
    by = [F.col("units").desc(), "product_id"]
    top = with_tagged_stock(per_product, stock, f.tags).orderBy(*by).limit(limit)
    return (
        top.join(names, "product_id", "left")
        .select("product_id", "product_name", "units", "amount", "warehouses")
        .orderBy(*by)
    )


# --- products -----------------------------------------------------------------


def product_search(
    products: DataFrame, brands: DataFrame, stock: DataFrame, query: str, limit: int = 30
) -> DataFrame:
    """Products whose name, id or code contains the text, by total stock.

    ``%`` and ``_`` in the text act as wildcards, a backslash stands for itself. Shorter than two characters
    finds nothing.
    """
    pattern = f"%{query}%".lower().replace("\\", "\\\\")
    fields = [F.col("name"), F.col("product_id").cast("string"), F.col("code")]
    hit = F.lit(False)
    for field in fields:
        hit = hit | F.coalesce(F.lower(field).like(pattern), F.lit(False))
    hits = products.filter(hit if len(query) >= 2 else F.lit(False))
    held = (
        stock.join(hits.select("product_id"), "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("stock"), F.count_if(F.col("qty") > 0).alias("warehouses"))
    )
    b = brands.select("brand_id", F.col("name").alias("brand_name"))
    return (
        hits.join(held, "product_id", "left")
        .join(b, "brand_id", "left")
        .select(
            "product_id", F.col("name").alias("product_name"), "code", "brand_name",
            or_zero("stock").alias("stock"),
            F.coalesce("warehouses", F.lit(0)).alias("warehouses"),
        )
        .orderBy(F.col("stock").desc(), "product_id")
        .limit(limit)
    )


def product_header(product_brand: DataFrame, products: DataFrame, product_id) -> DataFrame:
    one = F.col("product_id") == product_id
    codes = products.filter(one).select("product_id", "code")
    return product_brand.filter(one).join(codes, "product_id").select(
        "product_id", "product_name", "code", "brand_name", "category", "abc_class", "cover_days"
    )


def product_stock(
    stock: DataFrame, warehouses: DataFrame, metrics: DataFrame, product_id
) -> DataFrame:
    """Stock of one product per warehouse with today's metrics."""
    one = F.col("product_id") == product_id
    m = metrics.filter(one).select("warehouse_id", "daily", "days_of_stock", "stock_state")
    w = warehouses.select("warehouse_id", "name", "wtype", "region_id")
    return (
        stock.filter(one & (F.col("qty") > 0))
        .join(w, "warehouse_id")
        .join(m, "warehouse_id", "left")
        .select(
            "warehouse_id", "name", "wtype", "region_id", F.col("qty").alias("stock"), "unit_cost",
            or_zero("daily").alias("daily"),
            or_zero("days_of_stock").alias("days_of_stock"),
            F.coalesce("stock_state", F.lit(K.NO_DATA)).alias("stock_state"),
        )
    )


def product_sales(
    sales: DataFrame, as_of: dt.date, product_id, p: Params = DEFAULTS
) -> DataFrame:
    rows = look_back(sales, as_of, p.month_days).filter(F.col("product_id") == product_id)
    return rows.groupBy("sale_date").agg(
        F.sum("qty").alias("units"), F.sum("amount").alias("amount")
    )


# --- cards and breakdowns -------------------------------------------------------


def _stock_per_warehouse(stock: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Stock rows, matching rows and their units and value, per warehouse."""
    ok = F.coalesce(tag_matches("stock_tag", tags), F.lit(False))
    return stock.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("stock_rows"),
        F.count_if(ok).alias("products"),
        F.sum(F.when(ok, F.col("qty"))).alias("units"),
        F.sum(F.when(ok, value_of())).alias("stock_value"),
    )


def _survives_tags(tags: Sequence[str]) -> Column:
    """A warehouse stays if a stock row matches; without stock rows only the plain tag keeps it."""
    if not tags:
        return F.lit(True)
    bare = F.col("stock_rows").isNull() & F.lit(K.TAG_PLAIN in tags)
    return bare | (F.coalesce("products", F.lit(0)) > 0)


def _tagged_value(stock: DataFrame, tags: Sequence[str]) -> Column:
    return (
        stock.filter(tag_matches("stock_tag", tags))
        .agg(total(value_of()).alias("inventory_value"))
        .scalar()
    )


def _sales_per_warehouse(sales: DataFrame, as_of: dt.date, p: Params) -> DataFrame:
    return look_back(sales, as_of, p.month_days).groupBy("warehouse_id").agg(
        F.sum("qty").alias("sold_units"), F.sum("amount").alias("sold_amount")
    )


def region_cards(
    regions: DataFrame,
    warehouses: DataFrame,
    stock: DataFrame,
    sales: DataFrame,
    alerts: DataFrame,
    transfers_by_region: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> DataFrame:
    """One row per active region; every fact is summed per warehouse before it is joined.

    ``transfers_by_region`` has to_region and transfers (pending ones).
    """
    w = warehouses.select("warehouse_id", "wtype", "region_id")
    pending = (
        alerts.filter(F.col("state") == K.PENDING)
        .groupBy("warehouse_id")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.count_if(F.col("level") == K.LEVEL_CRITICAL).alias("critical"),
        )
    )
    facts = (
        w.filter(F.col("region_id").isNotNull())
        .join(_sales_per_warehouse(sales, as_of, p), "warehouse_id", "left")
        .join(pending, "warehouse_id", "left")
        .groupBy("region_id")
        .agg(
            F.sum("sold_amount").alias("sold_amount"),
            F.sum("alerts").alias("alerts"),
            F.sum("critical").alias("critical"),
        )
    )
    held = (
        regions.filter(F.col("active") & is_one_of("region_id", f.regions))
        .select("region_id", "name")
        .join(w, "region_id", "left")
        .join(_stock_per_warehouse(stock, f.tags), "warehouse_id", "left")
        .filter(_survives_tags(f.tags))
        .groupBy("region_id", "name")
        .agg(
            F.count_if(F.col("wtype") == K.SALES_POINT).alias("sales_points"),
            total("stock_value").alias("stock_value"),
        )
    )
    moves = transfers_by_region.groupBy(F.col("to_region").alias("region_id")).agg(
        F.sum("transfers").alias("transfers")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        held.join(facts, "region_id", "left")
        .join(moves, "region_id", "left")
        .withColumn("inventory_value", _tagged_value(stock, f.tags))
        .select(
            "region_id", "name", "sales_points", "stock_value",
            or_zero("sold_amount").alias("sold_amount"),
            percent(F.col("stock_value"), F.col("inventory_value"), 1).alias("stock_pct"),
            zero("alerts"), zero("critical"), zero("transfers"), "inventory_value",
        )
    )


def warehouse_cards(
    warehouses: DataFrame,
    stock: DataFrame,
    sales: DataFrame,
    alerts: DataFrame,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    wtype: str | None = K.SALES_POINT,
    p: Params = DEFAULTS,
) -> DataFrame:
    """One row per active warehouse; (product, warehouse) is unique in stock."""
    rows = warehouses.filter(F.col("active") & is_one_of("region_id", f.regions))
    if wtype:
        rows = rows.filter(F.col("wtype") == wtype)
    t = F.col("alert_type")
    pending = (
        alerts.filter(F.col("state") == K.PENDING)
        .groupBy("warehouse_id")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.count_if(F.col("level") == K.LEVEL_CRITICAL).alias("critical_level"),
            F.count_if(t == K.ALERT_CRITICAL).alias("critical"),
            F.count_if(t == K.ALERT_LOW).alias("low"),
            F.count_if(t == K.ALERT_OVER).alias("over"),
            F.count_if(t == K.ALERT_NO_ROTATION).alias("no_rotation"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    counts = ["alerts", "critical_level", "critical", "low", "over", "no_rotation"]
    value, sold = or_zero("stock_value"), or_zero("sold_amount")
    return (
        rows.join(_stock_per_warehouse(stock, f.tags), "warehouse_id", "left")
        .filter(_survives_tags(f.tags))
        .join(_sales_per_warehouse(sales, as_of, p), "warehouse_id", "left")
        .join(pending, "warehouse_id", "left")
        .withColumn("inventory_value", _tagged_value(stock, f.tags))
        .select(
            "warehouse_id", "name", "wtype", "region_id", "is_dc",
            zero("products"),
            or_zero("units").alias("units"),
            value.alias("stock_value"),
            percent(value, F.col("inventory_value"), 1).alias("stock_pct"),
            or_zero("sold_units").alias("sold_units"),
            sold.alias("sold_amount"),
            *(zero(c) for c in counts),
            percent(sold, value, 1).alias("turn_pct"),
            "inventory_value",
        )
    )


def brand_breakdown(
    stock: DataFrame,
    sales: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    f: Filters = NO_FILTERS,
    wtype: str | None = K.SALES_POINT,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Stock per brand with shares of the total and the sales of a date range.

    Brandless products form one row; it meets the brandless sales by a
    null-safe join. Totals cover all stock rows, the brand rows only stock above 0.
    """
    date_to = date_to or as_of
    date_from = date_from or as_of - dt.timedelta(days=p.month_days)
    chosen = warehouses.filter(f.place())
    here = chosen if not wtype else chosen.filter(F.col("wtype") == wtype)
    in_view = stock.filter(tag_matches("stock_tag", f.tags)).join(
        here.select("warehouse_id"), "warehouse_id", "left_semi"
    )
    totals = in_view.agg(
        F.struct(
            total("qty").alias("total_units"), total(value_of()).alias("total_value")
        ).alias("totals")
    ).scalar()
    brand = product_brand.select("product_id", "brand_id", "brand_name", "category", "abc_class")
    group = ["brand_key", "brand_name", "category", "abc_class"]
    branded = (
        in_view.filter(F.col("qty") > 0)
        .join(brand, "product_id")
        .withColumn("brand_key", F.when(F.col("brand_name").isNotNull(), F.col("brand_id")))
    )
    # first per product and per place, so that no row is multiplied for its distinct counts
    held = (
        branded.groupBy(*group, "product_id")
        .agg(total("qty").alias("units"), total(value_of()).alias("stock_value"))
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("units").alias("units"),
            F.sum("stock_value").alias("stock_value"),
        )
    )
    places = branded.groupBy(*group, "warehouse_id").agg(F.lit(1).alias("one"))
    places = places.groupBy(*(F.col(c).alias(f"of_{c}") for c in group)).agg(F.count(F.lit(1)).alias("warehouses"))
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group))
    held = held.join(places, same)
    points = sales_points(chosen).select("warehouse_id")
    sold_by_product = (
        sales.filter(F.col("sale_date").between(F.lit(date_from), F.lit(date_to)))
        .join(points, "warehouse_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("sold_units"), F.sum("amount").alias("sold_amount"))
    )
    sold = (
        with_tagged_stock(sold_by_product, stock, f.tags)
        .join(product_brand.select("product_id", "brand_id"), "product_id")
        .groupBy(F.col("brand_id").alias("sold_brand"))
        .agg(F.sum("sold_units").alias("sold_units"), F.sum("sold_amount").alias("sold_amount"))
    )
    joined = held.join(sold, F.col("brand_key").eqNullSafe(F.col("sold_brand")), "left")
    sold_amount = or_zero("sold_amount")
    return joined.withColumn("totals", totals).select(
        F.col("brand_key").alias("brand_id"),
        F.coalesce("brand_name", F.lit(K.BRAND_MISSING)).alias("brand_name"),
        "category", "abc_class", "products", "warehouses", "units", "stock_value",
        percent(F.col("units"), F.col("totals.total_units"), 2).alias("units_pct"),
        percent(F.col("stock_value"), F.col("totals.total_value"), 2).alias("value_pct"),
        or_zero("sold_units").alias("sold_units"),
        sold_amount.alias("sold_amount"),
        percent(sold_amount, F.col("stock_value"), 2).alias("turn_pct"),
        F.col("totals.total_units").alias("total_units"),
        F.col("totals.total_value").alias("total_value"),
        F.lit(max((date_to - date_from).days, 1)).alias("range_days"),
    )


def tag_summary(stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Rows, units and value per raw tag at sales points, stock above 0."""
    rows = at_places(stock.filter(F.col("qty") > 0), warehouses)
    return (
        rows.groupBy("stock_tag")
        .agg(
            F.count(F.lit(1)).alias("items"),
            total("qty").alias("units"),
            total(value_of()).alias("stock_value"),
        )
        .withColumn("stock_tag", F.coalesce("stock_tag", F.lit(K.TAG_MISSING)))
    )
