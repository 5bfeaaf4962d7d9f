"""Declared table schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

QTY = T.DecimalType(15, 5)
MONEY = T.DecimalType(18, 2)
DAYS = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 4)
PERCENT = T.DecimalType(10, 5)
TAX = T.DecimalType(5, 2)


def _table(**columns: T.DataType | str) -> T.StructType:
    schema = T.StructType()
    for name, dtype in columns.items():
        schema.add(name, dtype)
    return schema


WAREHOUSE_TYPES = _table(
    wtype="string", description="string", in_sales_analysis="boolean",
    in_stock_analysis="boolean", active="boolean",
)
REGIONS = _table(region_id="string", name="string", active="boolean")
WAREHOUSES = _table(
    warehouse_id="string", name="string", wtype="string", region_id="string",
    is_dc="boolean", active="boolean",
)
BRAND_CLASSES = _table(
    category="string", abc_class="string", category_text="string",
    class_text="string", buy_priority="integer",
)
#: ``total_cover`` is not stored; the reader derives it.
BRANDS = _table(
    brand_id="string", name="string", source_name="string", category="string",
    abc_class="string", buy_every_days="integer", cover_days="integer",
    supplier_lead="integer", dc_lead="integer", supplier_type="string",
    origin="string", active="boolean",
)
PRODUCTS = _table(
    product_id="string", code="string", name="string", uom="string",
    product_class="string", product_group="string", product_line="string",
    brand_id="string", model="string", active="boolean",
)
SELLERS = _table(seller_id="string", name="string", warehouse_id="string", active="boolean")
SALES = _table(
    doc_type="string", doc_prefix="string", doc_no="string", sale_date="date",
    sale_time="string", customer_id="string", customer_name="string",
    section_id="string", section_name="string", warehouse_id="string",
    product_id="string", qty=QTY, unit_price=QTY, amount=QTY,
    discount_pct=PERCENT, discount=QTY, cost=QTY, margin=QTY,
    margin_pct=PERCENT, tax_pct=TAX, seller_id="string", seller_name="string",
    batch_id="string",
)
#: sums of a day's sales, and of the look-backs at a closed day
DAILY_SUMS = _table(
    sale_date="date", product_id="string", warehouse_id="string", units=T.DecimalType(25, 5), sales_rows="long",
)
ROLLING_SUMS = _table(
    as_of="date", product_id="string", warehouse_id="string", q7=T.DecimalType(25, 5), q30=T.DecimalType(25, 5),
    q90=T.DecimalType(25, 5), sales_rows_30d="long", sales_rows_90d="long",
)
#: outcome of each slice of a back-load
BACKLOAD_SLICES = _table(
    start_date="date", end_date="date", status="string", loaded="long", products="long", errors="long", message="string",
)
STOCK = _table(
    warehouse_id="string", product_id="string", qty=QTY, unit_cost=QTY,
    unit_price=QTY, stock_tag="string", updated_at="timestamp", part="integer",
)
STOCK_DAILY = _table(
    snapshot_date="date", warehouse_id="string", product_id="string", qty=QTY,
    unit_cost=QTY, unit_price=QTY, stock_tag="string",
)
#: daily stock as what changed, and whole snapshots of some days
STOCK_CHANGES = T.StructType([*STOCK_DAILY.fields, T.StructField("gone", T.BooleanType())])
METRICS = _table(
    calc_date="date", product_id="string", warehouse_id="string", stock=QTY,
    stock_value=MONEY, q7=QTY, q30=QTY, q90=QTY, sales_rows_30d="long", daily=QTY,
    days_of_stock=DAYS, turn=RATE, reorder_point=QTY, safety_stock=QTY,
    stock_max=QTY, stock_state="string", needs_transfer="boolean",
    needs_purchase="boolean",
)
ALERTS = _table(
    alert_type="string", level="string", product_id="string",
    warehouse_id="string", stock=QTY, days_of_stock=DAYS, daily=QTY,
    category="string", abc_class="string", message="string", state="string",
    handled_by="string", handled_at="timestamp", generated_on="date", done="boolean",
)
TRANSFERS = _table(
    product_id="string", from_id="string", to_id="string", to_region="string",
    qty=QTY, days_from=DAYS, days_to=DAYS, category="string",
    abc_class="string", priority="string", state="string", executed="boolean",
    executed_at="timestamp", generated_on="date", done="boolean",
)
#: transfers as their two sides; a need's state is that of its pairs
TRANSFER_NEEDS = _table(
    product_id="string", to_id="string", to_region="string", days_to=DAYS, needed=QTY,
    category="string", abc_class="string", priority="string", state="string", generated_on="date",
)
TRANSFER_OFFERS = _table(
    product_id="string", from_id="string", days_from=DAYS, available=QTY, generated_on="date",
)
PURCHASES = _table(
    product_id="string", brand_id="string", category="string",
    abc_class="string", stock_network=T.DecimalType(25, 5),
    projected=T.DecimalType(25, 5), qty=T.DecimalType(25, 5), cover_now=DAYS,
    cover_target=DAYS, unit_cost=QTY, purchase_value=MONEY, order_date="date",
    priority="string", state="string", generated_on="date", done="boolean",
)
NETWORK_METRICS = _table(
    calc_date="date", product_id="string", stock=T.DecimalType(25, 5),
    stock_value=MONEY, sales_point_stock=T.DecimalType(25, 5),
    warehouses_with_stock="long", sales_points_with_stock="long",
    sales_points_without_stock="long", stock_spread=RATE, q30=T.DecimalType(25, 5),
    daily=QTY, days_of_stock=DAYS, turn=RATE, abc_class="string", stock_state="string",
)
REGION_METRICS = _table(
    calc_date="date", region_id="string", stock_value=MONEY, sales_value_30d=MONEY,
    products_in_stock="long", products_out_of_stock="long", critical_products="long",
    overstocked_products="long", mean_turn=RATE, sold_over_available_pct=RATE,
)

TABLES = {
    "warehouse_types": WAREHOUSE_TYPES,
    "regions": REGIONS,
    "warehouses": WAREHOUSES,
    "brand_classes": BRAND_CLASSES,
    "brands": BRANDS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "sales": SALES,
    "backload_slices": BACKLOAD_SLICES,
    "daily_sums": DAILY_SUMS,
    "rolling_sums": ROLLING_SUMS,
    "stock_daily": STOCK_DAILY,
    "stock_changes": STOCK_CHANGES,
    "stock_bases": STOCK_DAILY,
    "stock": STOCK,
    "metrics": METRICS,
    "alerts": ALERTS,
    "transfers": TRANSFERS,
    "transfer_needs": TRANSFER_NEEDS,
    "transfer_offers": TRANSFER_OFFERS,
    "purchases": PURCHASES,
    "network_metrics": NETWORK_METRICS,
    "region_metrics": REGION_METRICS,
}
#: columns that only say where a row is kept: by the load that stored it, or apart from what a run replaces;
#: readers do not see them
HIDDEN = {"sales": ["batch_id"], "stock": ["part"], "alerts": ["done"], "transfers": ["done"], "purchases": ["done"]}
#: parts of the stock, by a hash of the warehouse: their number stays the same however many warehouses there are
STOCK_PARTS = 64
#: partition columns of the tables on disk
PARTITIONS = {
    "sales": ["sale_date", "batch_id"],
    "backload_slices": ["start_date"],
    "daily_sums": ["sale_date"],
    "rolling_sums": ["as_of"],
    "stock_daily": ["snapshot_date"],
    "stock_changes": ["snapshot_date"],
    "stock_bases": ["snapshot_date"],
    "stock": ["part"],
    "metrics": ["calc_date"],
    "alerts": ["generated_on", "done"],
    "transfers": ["generated_on", "done"],
    "transfer_needs": ["generated_on"],
    "transfer_offers": ["generated_on"],
    "purchases": ["generated_on", "done"],
    "network_metrics": ["calc_date"],
    "region_metrics": ["calc_date"],
}
