"""Stock metrics per product and warehouse, and the network and region roll-ups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import days_before, look_back, sales_points
from shelfwise.functions.numeric import or_zero, percent, ratio, rounded, total
from shelfwise.functions.sizes import Scratch
from shelfwise.params import DEFAULTS, Params

KEY = ["product_id", "warehouse_id"]
METRIC_COLUMNS = [
    "calc_date", "product_id", "warehouse_id", "stock", "stock_value", "q7", "q30",
    "q90", "sales_rows_30d", "daily", "days_of_stock", "turn", "reorder_point",
    "safety_stock", "stock_max", "stock_state", "needs_transfer", "needs_purchase",
]


def sales_lookback(
    sales: DataFrame, warehouses: DataFrame, as_of: dt.date, p: Params = DEFAULTS
) -> DataFrame:
    """Sums of the short, month and long look-back per product and sales point.

    One pass and one aggregation, combined on the map side, so a product or
    warehouse with very many sales rows shuffles as partial sums.
    """

    def since(days: int) -> Column:
        return F.col("sale_date") >= days_before(as_of, days)

    recent = look_back(sales, as_of, p.long_days)
    here = sales_points(warehouses).select("warehouse_id")
    return (
        recent.join(here, "warehouse_id", "left_semi")
        .groupBy(*KEY)
        .agg(
            F.sum(F.when(since(p.short_days), F.col("qty")).otherwise(0)).alias("q7"),
            F.sum(F.when(since(p.month_days), F.col("qty")).otherwise(0)).alias("q30"),
            F.sum("qty").alias("q90"),
            F.count_if(since(p.month_days)).alias("sales_rows_30d"),
        )
    )


def stock_state(days: Column, cover: Column, p: Params = DEFAULTS) -> Column:
    """State of a stock row. Days of exactly 0 count as "no sales", cover of 0 as default."""
    d = F.coalesce(F.nullif(days, F.lit(0)), F.lit(p.no_sales_days)).cast("double")
    c = F.coalesce(F.nullif(cover, F.lit(0)), F.lit(p.default_cover)).cast("double")
    return (
        F.when(d < p.critical_days, K.CRITICAL)
        .when(d < p.low_days, K.LOW)
        .when(d < p.medium_days, K.MEDIUM)
        .when(d > c * p.over_factor, K.EXCESS)
        .when(d > c, K.OVER)
        .otherwise(K.NORMAL)
    )


def _days_of(stock: Column, sold: Column, p: Params) -> Column:
    kind = "decimal(18,2)"
    days = F.round(ratio(stock * p.month_days, sold), 2)
    return F.when(sold > 0, days.cast(kind)).otherwise(F.lit(float(p.no_sales_days)).cast(kind))


def with_metrics(df: DataFrame, as_of: dt.date, p: Params = DEFAULTS) -> DataFrame:
    """Add the derived metrics to rows with qty, unit_cost, look-back sums and brand data.

    A double is rounded by way of its text, so rows without sales, which most are, skip that.
    """
    q30 = F.col("q30").cast("double")
    unsold = F.col("q30") == 0
    cover = F.coalesce(F.col("cover_days"), F.lit(p.default_cover))
    lead = F.coalesce(F.col("dc_lead"), F.lit(p.default_lead))

    def if_sold(value: Column, kind: str) -> Column:
        return F.when(unsold, F.lit(0).cast(kind)).otherwise(value.cast(kind))

    def of_daily(factor: Column) -> Column:
        return if_sold(rounded(q30 * factor / p.month_days, 2), "decimal(15,5)")

    turn = F.when(F.col("qty") > 0, F.round(ratio(q30, F.col("qty")), 4)).otherwise(0.0)
    out = df.withColumns({c: or_zero(c) for c in ("q7", "q30", "q90")}).withColumn(
        "sales_rows_30d", F.coalesce("sales_rows_30d", F.lit(0))
    )
    out = out.withColumns(
        {
            "calc_date": F.lit(as_of),
            "stock": F.col("qty"),
            "stock_value": (F.col("qty") * F.col("unit_cost")).cast("decimal(18,2)"),
            "daily": if_sold(rounded(q30 / p.month_days, 5, 15), "decimal(15,5)"),
            "days_of_stock": _days_of(F.col("qty"), F.col("q30"), p),
            "turn": if_sold(turn, "decimal(18,4)"),
            "reorder_point": of_daily(lead * F.lit(p.reorder_safety)),
            "safety_stock": of_daily(F.lit(p.safety_days)),
            "stock_max": of_daily(cover),
        }
    )
    state = F.col("stock_state")
    return (
        out.withColumn("stock_state", stock_state(F.col("days_of_stock"), cover, p))
        .withColumn("needs_transfer", state.isin(K.CRITICAL, K.LOW, K.EXCESS))
        .withColumn("needs_purchase", state.isin(K.CRITICAL, K.LOW))
    )


def with_dims(df: DataFrame, product_brand: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Attach brand data and warehouse data; unknown keys keep NULLs."""
    pb = product_brand.withColumn("in_catalog", F.lit(True))
    w = warehouses.select("warehouse_id", "wtype", "region_id")
    return df.join(pb, "product_id", "left").join(w, "warehouse_id", "left")


def stock_position(
    sales: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Every (product, warehouse) with stock or recent sales, with dimensions and metrics.

    The single base of metrics, alerts and transfers: sales and stock are read
    once and meet in one join on (product, warehouse), a key that is unique on
    both sides by then. ``stock_qty`` stays NULL where there is no stock row.
    """
    return position_of_sold(sales_lookback(sales, warehouses, as_of, p), stock, product_brand, warehouses, as_of, p)


def position_of_sold(
    sold: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """The same from look-back sums, whatever they were formed of."""
    held = stock.select(*KEY, F.col("qty").alias("stock_qty"), "unit_cost")
    joined = held.join(sold, KEY, "full").withColumn("qty", or_zero("stock_qty"))
    return with_metrics(with_dims(joined, product_brand, warehouses), as_of, p)


def metrics_of(position: DataFrame) -> DataFrame:
    """The metrics table: positions with stock above zero."""
    return position.filter(F.col("stock_qty") > 0).select(*METRIC_COLUMNS)


def stock_metrics(
    sales: DataFrame,
    stock: DataFrame,
    product_brand: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    return metrics_of(stock_position(sales, stock, product_brand, warehouses, as_of, p))


def network_stock(stock: DataFrame) -> DataFrame:
    """Stock and plain mean cost per product over all warehouses."""
    return stock.groupBy("product_id").agg(
        F.sum("qty").alias("stock_network"),
        ratio(F.sum("unit_cost"), F.count("unit_cost")).alias("unit_cost"),
    )


def network_sales(
    sales: DataFrame, warehouses: DataFrame, as_of: dt.date, p: Params = DEFAULTS
) -> DataFrame:
    """Units sold per product in the month look-back, sales points only."""
    recent = look_back(sales, as_of, p.month_days)
    here = sales_points(warehouses).select("warehouse_id")
    return (
        recent.join(here, "warehouse_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("q30"))
        .withColumn("daily", rounded(F.col("q30").cast("double") / p.month_days, 5))
    )


def network_metrics(
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    as_of: dt.date,
    scratch: Scratch,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Stock, sales and ABC class per product over the network.

    No reference semantics: only the column names are given. ABC: a product is
    A while the products that sold for more make less than 80 % of all sales
    value, B below 95 %, else C. Ties share a class.
    """
    w = warehouses.select("warehouse_id", "wtype")
    at_point = F.col("wtype") == K.SALES_POINT
    qty = F.col("qty")
    held = (
        stock.join(w, "warehouse_id", "left")
        .groupBy("product_id")
        .agg(
            F.sum("qty").alias("stock"),
            total(qty * F.col("unit_cost")).cast("decimal(18,2)").alias("stock_value"),
            F.coalesce(F.sum(F.when(at_point, qty)), F.lit(0).cast("decimal(25,5)")).alias(
                "sales_point_stock"
            ),
            F.count_if(qty > 0).alias("warehouses_with_stock"),
            F.count_if((qty > 0) & at_point).alias("sales_points_with_stock"),
            F.count_if((qty <= 0) & at_point).alias("sales_points_without_stock"),
            rounded(F.stddev_pop(qty.cast("double")), 4).alias("stock_spread"),
        )
    )
    here = sales_points(warehouses).select("warehouse_id")
    sold = (
        look_back(sales, as_of, p.month_days)
        .join(here, "warehouse_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("q30"), total("amount").alias("sales_value"))
    )
    both = held.join(abc_classes(sold, "sales_value", "product_id", scratch), "product_id", "left")
    q30 = or_zero("q30")
    days = _days_of(F.col("stock"), q30, p)
    return both.select(
        F.lit(as_of).alias("calc_date"),
        "product_id", "stock", "stock_value", "sales_point_stock",
        "warehouses_with_stock", "sales_points_with_stock",
        "sales_points_without_stock", "stock_spread",
        q30.alias("q30"),
        rounded(q30.cast("double") / p.month_days, 5).alias("daily"),
        days.alias("days_of_stock"),
        rounded(F.coalesce(ratio(q30, F.col("stock")), F.lit(0.0)), 4).alias("turn"),
        F.coalesce("abc_class", F.lit("C")).alias("abc_class"),
        stock_state(days, F.lit(p.default_cover), p).alias("stock_state"),
    )


def abc_classes(df: DataFrame, value: str, spread: str, scratch: Scratch) -> DataFrame:
    """Add abc_class by the share of all value held by strictly larger rows.

    A running sum over all rows would be one task. The rows are dealt by ranges of
    their value, larger ones first, and of the column ``spread``, so that equal values may
    fill several partitions; there are as many partitions as the data need. The table is
    kept with its partition numbers. A second pass takes each partition's total, and its
    equal values at either end; a row a partition gives every partition what lies before it.
    Equal values are not larger than one another wherever they lie, so the cuts do not show
    in the result, and no row is joined by its value.
    """
    v = F.col(value)
    dealt = df.repartitionByRange(v.desc(), F.col(spread)).withColumn("part", F.spark_partition_id())
    kept = scratch.keep(dealt)
    ends = kept.groupBy("part").agg(F.sum(v).alias("total"), F.max(v).alias("top"), F.min(v).alias("bottom"))
    # equal values at the bottom of a partition may go on at the top of the next ones
    tails = kept.join(F.broadcast(ends.select("part", "bottom")), "part").filter(v == F.col("bottom"))
    tails = tails.groupBy("part", "bottom").agg(F.sum(v).alias("tail"))
    events = ends.select("part", F.col("top").alias("v"), F.lit(0).alias("kind"), F.lit(None).alias("tail"))
    events = events.unionByName(tails.select("part", F.col("bottom").alias("v"), F.lit(1).alias("kind"), "tail"))
    at_value = Window.partitionBy("v").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    same = events.withColumn("same", F.coalesce(F.sum("tail").over(at_value), F.lit(0)))
    same = same.filter("kind = 0").select("part", "same")
    # a row a partition: windows without a key are bounded by their number
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ends.select(
        "part",
        "top",
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"),
        F.sum("total").over(whole).alias("grand"),
    ).join(same, "part")
    inside = Window.partitionBy("part").orderBy(v.desc())
    larger = F.sum(v).over(inside) - F.sum(v).over(Window.partitionBy("part", value))
    rows = kept.withColumn("larger", larger).join(F.broadcast(offsets), "part")
    first = v == F.col("top")
    share = ratio(F.col("offset") + F.when(first, -F.col("same")).otherwise(F.col("larger")), F.col("grand"))
    abc = F.when(share < 0.8, "A").when(share < 0.95, "B").otherwise("C")
    return rows.select(*df.columns, abc.alias("abc_class"))


def region_metrics(
    metrics: DataFrame,
    sales: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    regions: DataFrame,
    as_of: dt.date,
    p: Params = DEFAULTS,
) -> DataFrame:
    """Value, sales, counts and rates per region (sales points).

    No reference semantics: only the column names are given.
    """
    w = sales_points(warehouses).select("warehouse_id", "region_id")
    sold = (
        look_back(sales, as_of, p.month_days)
        .groupBy("warehouse_id")
        .agg(total("amount").alias("amount"), total("qty").alias("units"))
        .join(w, "warehouse_id")
        .groupBy("region_id")
        .agg(F.sum("amount").alias("amount"), F.sum("units").alias("units"))
    )
    # two levels: region x product first, so that no distinct set is held per region
    per_product = (
        stock.join(w, "warehouse_id")
        .groupBy("region_id", "product_id")
        .agg(F.sum("qty").alias("qty"), F.sum(F.col("qty") * F.col("unit_cost")).alias("value"))
    )
    held = per_product.groupBy("region_id").agg(
        F.sum("qty").alias("held_units"),
        F.sum("value").alias("value"),
        F.count_if(F.col("qty") > 0).alias("in_stock"),
        F.count_if(F.col("qty") <= 0).alias("out_of_stock"),
    )
    state = F.col("stock_state")
    rates = (
        metrics.join(w, "warehouse_id")
        .groupBy("region_id", "product_id")
        .agg(
            F.max(state == K.CRITICAL).alias("critical"),
            F.max(state.isin(K.OVER, K.EXCESS)).alias("over"),
            F.sum("turn").alias("turn"),
            F.count("turn").alias("n"),
        )
        .groupBy("region_id")
        .agg(
            F.count_if("critical").alias("critical"),
            F.count_if("over").alias("over"),
            ratio(F.sum("turn"), F.sum("n")).alias("turn"),
        )
    )
    out = regions.select("region_id")
    for part in (sold, held, rates):
        out = out.join(part, "region_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        F.lit(as_of).alias("calc_date"),
        "region_id",
        or_zero("value").cast("decimal(18,2)").alias("stock_value"),
        or_zero("amount").cast("decimal(18,2)").alias("sales_value_30d"),
        zero("in_stock").alias("products_in_stock"),
        zero("out_of_stock").alias("products_out_of_stock"),
        zero("critical").alias("critical_products"),
        zero("over").alias("overstocked_products"),
        rounded(F.coalesce("turn", F.lit(0.0)), 4).alias("mean_turn"),
        rounded(percent(F.col("units"), F.col("held_units"), 4), 4).alias("sold_over_available_pct"),
    )
