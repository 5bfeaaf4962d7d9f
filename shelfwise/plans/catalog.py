"""Every operator as a query over the benchmark tables, seen as the inventory model."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import constants as K
from shelfwise.functions.bind import let
from shelfwise.functions import sizes
from shelfwise.functions.filters import Filters, look_back
from shelfwise.operators import alerts as A
from shelfwise.operators import kpis, lifecycle, merges, metrics, offers, purchases, reports, transfers, views
from shelfwise.plans import backload, daily, load
from shelfwise.sources import calendar, pages, payloads, records, storage
from shelfwise.sources import tpch_model as M
from shelfwise.sources.changelog import ChangeLog, tag_stock
from shelfwise.sources.intervals import SnapshotHistory
from shelfwise.sources.ledger import SalesKeys
from shelfwise.sources.rolling import RollingSales
from shelfwise.sources.trigrams import NameIndex
from shelfwise.streaming import ingest
from shelfwise.tables import Tables

AS_OF = M.AS_OF
Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

#: request parameters used by the registered queries
SOME_REGIONS = Filters.parse(regions="ASIA, EUROPE")
TAGGED = Filters.parse(tags="INVENTARIO,OUTLET")
OUTLET = Filters.parse(tags="OUTLET")
MIXED = Filters.parse(regions="ASIA,EUROPE,AFRICA", brands="Brand#1,Brand#2,Brand#12", tags="INVENTARIO")
SAMPLE_WAREHOUSE = 3
SAMPLE_PRODUCT = 14
SEARCH_TEXT = "Ring"


def query(fn: Callable[[Tables, SparkSession, str], DataFrame]) -> Callable:
    """Register a query under its function name."""
    CATALOG[fn.__name__] = lambda spark, sf_dir: fn(M.model(spark, sf_dir), spark, sf_dir)
    return fn


def plain(build: Query) -> Query:
    """Show decimals as doubles and dates as text, which any engine prints alike."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        return df.select(*(_plain_column(f) for f in df.schema))

    return run


def _plain_column(f: T.StructField):
    col = F.col(f.name)
    if isinstance(f.dataType, T.DecimalType):
        col = col.cast(f"decimal(38,{min(f.dataType.scale, 5)})").cast("double")
    elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
        col = col.cast("string")
    elif isinstance(f.dataType, T.IntegerType):
        col = col.cast("long")
    return col.alias(f.name)


def _position(t: Tables) -> DataFrame:
    return daily.position_of(t, AS_OF)


def _pending_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending transfers by region, from needs and surpluses."""
    stored = M.stored(spark, sf_dir)
    return offers.region_counts(stored.needs, stored.offers)


def _purchases(t: Tables) -> DataFrame:
    return purchases.purchases(t.sales, t.stock, t.product_brand, t.warehouses, AS_OF)


# --- metrics --------------------------------------------------------------------


@query
def sales_lookback(t, spark, sf_dir):
    return metrics.sales_lookback(t.sales, t.warehouses, AS_OF)


@query
def stock_metrics(t, spark, sf_dir):
    return metrics.stock_metrics(t.sales, t.stock, t.product_brand, t.warehouses, AS_OF)


@query
def network_metrics(t, spark, sf_dir):
    return metrics.network_metrics(t.sales, t.stock, t.warehouses, AS_OF, sizes.Scratch(spark))


@query
def region_metrics(t, spark, sf_dir):
    return metrics.region_metrics(M.stored(spark, sf_dir).metrics, t.sales, t.stock, t.warehouses, t.regions, AS_OF)


# --- alerts ---------------------------------------------------------------------


@query
def alerts_low(t, spark, sf_dir):
    return A.alerts(_position(t), ["low"])


@query
def alerts_over(t, spark, sf_dir):
    return A.alerts(_position(t), ["over"])


@query
def alerts_slow(t, spark, sf_dir):
    return A.alerts(_position(t), ["slow"])


@query
def alerts_no_rotation(t, spark, sf_dir):
    return A.alerts(_position(t), ["no_rotation"])


@query
def alerts_stockout(t, spark, sf_dir):
    return A.alerts(_position(t), ["stockout"])


@query
def alerts_all(t, spark, sf_dir):
    return A.alerts(_position(t))


@query
def alert_counts(t, spark, sf_dir):
    return A.alert_counts(A.alerts(_position(t)))


@query
def alerts_rebuild(t, spark, sf_dir):
    unmoved = A.unmoved_stock(t.sales, t.stock, t.warehouses, AS_OF)
    return A.rebuild_no_rotation(M.stored(spark, sf_dir).alerts, unmoved, AS_OF)


@query
def alerts_rebuild_counts(t, spark, sf_dir):
    unmoved = A.unmoved_stock(t.sales, t.stock, t.warehouses, AS_OF)
    return A.rebuild_counts(M.stored(spark, sf_dir).alerts, unmoved)


# --- transfers ------------------------------------------------------------------


@query
def transfer_needs(t, spark, sf_dir):
    return transfers.needs(_position(t))


@query
def transfer_surplus(t, spark, sf_dir):
    return transfers.surpluses(_position(t))


@query
def transfers_all(t, spark, sf_dir):
    return transfers.transfers(_position(t), t.warehouses)


CATALOG["transfers"] = CATALOG.pop("transfers_all")


@query
def transfers_ordered(t, spark, sf_dir):
    return transfers.in_order(transfers.transfers(_position(t), t.warehouses))


@query
def transfers_first(t, spark, sf_dir):
    """The first hundred of them in the same order, without forming the others."""
    stored = M.stored(spark, sf_dir)
    by = [transfers.brand_rank(), "days_to"]
    rows = offers.first_pairs(stored.needs, stored.offers, 100, by, state=None)
    return rows.drop("state")


@query
def transfer_counts(t, spark, sf_dir):
    return transfers.transfer_counts(_position(t))


# --- purchases ------------------------------------------------------------------


@query
def network_stock(t, spark, sf_dir):
    return metrics.network_stock(t.stock).withColumn("unit_cost", F.round("unit_cost", 6))


@query
def network_sales(t, spark, sf_dir):
    return metrics.network_sales(t.sales, t.warehouses, AS_OF)


@query
def coverage(t, spark, sf_dir):
    rows = purchases.coverage(t.sales, t.stock, t.product_brand, t.warehouses, AS_OF)
    return rows.withColumn("unit_cost", F.round("unit_cost", 6))


@query
def purchases_stored(t, spark, sf_dir):
    return _purchases(t)


CATALOG["purchases"] = CATALOG.pop("purchases_stored")


def _money(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"unit_cost": F.round("unit_cost", 4), "purchase_value": F.round("purchase_value", 2)}
    )


@query
def purchases_live(t, spark, sf_dir):
    return _money(
        purchases.purchases_live(
            t.sales, t.stock, t.product_brand, t.warehouses, AS_OF, limit=None
        )
    )


@query
def purchases_live_top(t, spark, sf_dir):
    return _money(
        purchases.purchases_live(
            t.sales, t.stock, t.product_brand, t.warehouses, AS_OF,
            limit=50, priority=K.URGENT, tags=TAGGED.tags,
        )
    )


@query
def purchases_list(t, spark, sf_dir):
    stored = _purchases(t).withColumn("state", F.lit(K.PENDING))
    return daily.purchase_list(t, stored, AS_OF)


# --- indicators -----------------------------------------------------------------


@query
def kpi_inventory(t, spark, sf_dir):
    return kpis.inventory(t.stock, t.warehouses, t.products)


@query
def kpi_inventory_filtered(t, spark, sf_dir):
    return kpis.inventory(t.stock, t.warehouses, t.products, MIXED)


@query
def kpi_projects(t, spark, sf_dir):
    return kpis.projects(t.stock, t.warehouses, t.products)


@query
def kpi_sales(t, spark, sf_dir):
    return kpis.sales_totals(t.sales, t.stock, t.warehouses, AS_OF)


@query
def kpi_sales_filtered(t, spark, sf_dir):
    return kpis.sales_totals(t.sales, t.stock, t.warehouses, AS_OF, MIXED)


@query
def kpi_alerts(t, spark, sf_dir):
    return kpis.pending_alerts(M.stored(spark, sf_dir).alerts, t.stock, t.warehouses, TAGGED)


@query
def kpi_transfers(t, spark, sf_dir):
    return kpis.pending_transfers_from_counts(_pending_moves(spark, sf_dir), SOME_REGIONS)


@query
def kpi_purchases(t, spark, sf_dir):
    stored = _purchases(t).withColumn("state", F.lit(K.PENDING))
    return daily.kpi_purchases(t, stored, AS_OF)


@query
def kpi_purchases_live(t, spark, sf_dir):
    rows = daily.kpi_purchases(t, None, AS_OF)
    return rows.withColumn("purchase_value", F.round("purchase_value", 2))


def _health_items(t: Tables, alerts: DataFrame, f: Filters = Filters()) -> DataFrame:
    return kpis.health_items(t.sales, t.stock, alerts, t.warehouses, t.products, AS_OF, f)


@query
def health(t, spark, sf_dir):
    return kpis.health(_health_items(t, M.stored(spark, sf_dir).alerts))


@query
def health_filtered(t, spark, sf_dir):
    return kpis.health(_health_items(t, M.stored(spark, sf_dir).alerts, MIXED))


@query
def health_pct(t, spark, sf_dir):
    alerts = M.stored(spark, sf_dir).alerts
    return kpis.health_shares(kpis.health(_health_items(t, alerts)), alerts)


@query
def kpi_transfers_live(t, spark, sf_dir):
    """Transfers by the counting form, from today's positions."""
    return kpis.pending_transfers_from_counts(transfers.transfer_counts(_position(t)), SOME_REGIONS)


@query
def lost_sales(t, spark, sf_dir):
    return kpis.lost_sales(t.sales, t.stock, t.warehouses, AS_OF)


@query
def kpi_legacy(t, spark, sf_dir):
    pending = kpis.pending_transfers_from_counts(_pending_moves(spark, sf_dir))
    return kpis.legacy(t.sales, t.stock, M.stored(spark, sf_dir).alerts, pending, AS_OF)


# --- lists and reports ------------------------------------------------------------


@query
def filter_regions(t, spark, sf_dir):
    return reports.active_regions(t.regions)


@query
def filter_warehouses(t, spark, sf_dir):
    return reports.active_sales_points(t.warehouses)


@query
def filter_brands(t, spark, sf_dir):
    return reports.active_brands(t.brands)


@query
def filter_tags(t, spark, sf_dir):
    return reports.tag_choices(t.stock)


@query
def alert_list(t, spark, sf_dir):
    return reports.alert_list(M.stored(spark, sf_dir).alerts, t.stock, t.product_brand, t.warehouses)


@query
def alert_list_filtered(t, spark, sf_dir):
    return reports.alert_list(
        M.stored(spark, sf_dir).alerts, t.stock, t.product_brand, t.warehouses, limit=40, level=K.LEVEL_HIGH, f=MIXED
    )


@query
def alert_list_text_order(t, spark, sf_dir):
    return reports.alert_list_by_level(M.stored(spark, sf_dir).alerts, t.product_brand, t.warehouses)


@query
def alert_summary(t, spark, sf_dir):
    return reports.alert_summary(M.stored(spark, sf_dir).alerts)


@query
def transfer_list(t, spark, sf_dir):
    stored = M.stored(spark, sf_dir)
    return reports.transfer_list(stored.needs, stored.offers, t.stock, t.product_brand, t.warehouses)


@query
def transfer_list_text_order(t, spark, sf_dir):
    stored = M.stored(spark, sf_dir)
    return reports.transfer_list(
        stored.needs, stored.offers, t.stock, t.product_brand, t.warehouses, f=OUTLET, order="text"
    )


@query
def warehouse_list(t, spark, sf_dir):
    return reports.warehouse_list(t.warehouses, M.stored(spark, sf_dir).metrics)


@query
def warehouse_top(t, spark, sf_dir):
    return reports.warehouse_top(M.stored(spark, sf_dir).metrics, t.product_brand, SAMPLE_WAREHOUSE)


@query
def daily_sales(t, spark, sf_dir):
    return reports.daily_sales(t.sales, t.warehouses, AS_OF)


@query
def daily_efficiency(t, spark, sf_dir):
    return reports.daily_efficiency(t.sales, t.stock, t.stock_daily, t.warehouses, AS_OF)


@query
def daily_efficiency_filtered(t, spark, sf_dir):
    return reports.daily_efficiency(t.sales, t.stock, t.stock_daily, t.warehouses, AS_OF, MIXED)


@query
def top_products(t, spark, sf_dir):
    return reports.top_products(t.sales, t.stock, t.products, t.warehouses, AS_OF)


@query
def top_products_filtered(t, spark, sf_dir):
    return reports.top_products(t.sales, t.stock, t.products, t.warehouses, AS_OF, 10, MIXED)


@query
def product_search(t, spark, sf_dir):
    return reports.product_search(t.products, t.brands, t.stock, SEARCH_TEXT)


@query
def product_header(t, spark, sf_dir):
    return reports.product_header(t.product_brand, t.products, SAMPLE_PRODUCT)


@query
def product_stock(t, spark, sf_dir):
    return reports.product_stock(t.stock, t.warehouses, M.stored(spark, sf_dir).metrics, SAMPLE_PRODUCT)


@query
def product_sales(t, spark, sf_dir):
    return reports.product_sales(t.sales, AS_OF, SAMPLE_PRODUCT)


@query
def region_cards(t, spark, sf_dir):
    return reports.region_cards(
        t.regions, t.warehouses, t.stock, t.sales, M.stored(spark, sf_dir).alerts,
        _pending_moves(spark, sf_dir), AS_OF,
    )


@query
def warehouse_cards(t, spark, sf_dir):
    return reports.warehouse_cards(t.warehouses, t.stock, t.sales, M.stored(spark, sf_dir).alerts, AS_OF)


@query
def warehouse_cards_filtered(t, spark, sf_dir):
    return reports.warehouse_cards(t.warehouses, t.stock, t.sales, M.stored(spark, sf_dir).alerts, AS_OF, MIXED)


@query
def brand_breakdown(t, spark, sf_dir):
    return reports.brand_breakdown(t.stock, t.sales, t.product_brand, t.warehouses, AS_OF)


@query
def brand_breakdown_filtered(t, spark, sf_dir):
    return reports.brand_breakdown(
        t.stock, t.sales, t.product_brand, t.warehouses, AS_OF,
        dt.date(2001, 9, 1), dt.date(2001, 10, 15), TAGGED,
    )


@query
def tag_summary(t, spark, sf_dir):
    return reports.tag_summary(t.stock, t.warehouses)


# --- views -----------------------------------------------------------------------


def _two_digits(df: DataFrame) -> DataFrame:
    sums = [c for c in ("sold_units", "sold_amount", "stock_value") if c in df.columns]
    return df.withColumns({c: F.round(c, 2) for c in sums})


@query
def warehouse_efficiency(t, spark, sf_dir):
    return _two_digits(views.warehouse_efficiency(t.sales, t.stock, t.warehouses, AS_OF))


@query
def warehouse_efficiency_corrected(t, spark, sf_dir):
    return _two_digits(
        views.warehouse_efficiency(t.sales, t.stock, t.warehouses, AS_OF, corrected=True)
    )


@query
def region_efficiency(t, spark, sf_dir):
    return _two_digits(
        views.region_efficiency(t.sales, t.stock, t.warehouses, t.regions, AS_OF)
    )


@query
def stock_by_type(t, spark, sf_dir):
    return views.stock_by_type(t.warehouse_types, t.warehouses, t.stock)


@query
def critical_products(t, spark, sf_dir):
    return views.critical_products(M.stored(spark, sf_dir).metrics, t.product_brand, t.warehouses)


@query
def overstock(t, spark, sf_dir):
    return views.overstock(M.stored(spark, sf_dir).metrics, t.product_brand, t.warehouses)


@query
def low_rotation(t, spark, sf_dir):
    return views.low_rotation(M.stored(spark, sf_dir).metrics, t.product_brand, t.warehouses)


@query
def brand_summary(t, spark, sf_dir):
    return _two_digits(views.brand_summary(t.brands, t.products, t.stock, t.sales, AS_OF))


@query
def brand_summary_corrected(t, spark, sf_dir):
    return _two_digits(
        views.brand_summary(t.brands, t.products, t.stock, t.sales, AS_OF, corrected=True)
    )


# --- loads and merges --------------------------------------------------------------

DOC_ORDER = ["line_no", "warehouse_id", "sale_date", "qty", "amount"]
NO_PREFIX = 97


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales documents; some lack their prefix, so that they never conflict."""
    docs = M.sales_documents(spark, sf_dir)
    return docs.withColumn(
        "doc_prefix", F.when(F.col("doc_no") % NO_PREFIX != 0, F.col("doc_prefix"))
    )


@query
def sales_insert_ignore(t, spark, sf_dir):
    """Documents up to a line number are stored; all documents arrive again as the batch."""
    docs = _documents(spark, sf_dir)
    first_load = docs.filter(F.col("line_no") <= 3)
    existing = merges.new_sales(None, first_load, DOC_ORDER)
    return merges.merge_sales(existing, docs, DOC_ORDER)


@query
def sales_insert_bucketed(t, spark, sf_dir):
    """The same load against keys that are stored in buckets by an earlier batch."""
    docs = _documents(spark, sf_dir)
    named = docs.withColumns({k: F.col(k).cast("string") for k in merges.SALES_KEY})
    first = merges.new_sales(None, named.filter(F.col("line_no") <= 3), DOC_ORDER)
    keys = SalesKeys(spark, _root(spark))
    keys.add(first, "first")
    keys.compact()
    fresh = merges.new_sales(keys.stored(without="second"), named, DOC_ORDER, large=True)
    both = first.unionByName(fresh)
    return both.withColumns({k: F.col(k).cast(docs.schema[k].dataType) for k in merges.SALES_KEY})


@query
def stock_upsert(t, spark, sf_dir):
    """Stock of every third warehouse arrives twice with new quantities; the last one wins."""
    existing = t.stock
    feed = t.stock.filter(F.col("warehouse_id") % 3 == 0)
    again = F.explode(F.array(F.lit(1), F.lit(2)))
    batch = feed.withColumn("seq", again).withColumn(
        "qty", (F.col("qty") + F.col("seq")).cast("decimal(15,5)")
    )
    return merges.merge_stock(existing, batch, ["seq"])


@query
def snapshot_upsert(t, spark, sf_dir):
    batch = t.stock.select(
        F.lit(AS_OF).alias("snapshot_date"), "warehouse_id", "product_id",
        (F.col("qty") * 10).cast("decimal(15,5)").alias("qty"),
        "unit_cost", "unit_price", "stock_tag", F.lit(1).alias("seq"),
    ).filter(F.col("product_id") % 2 == 0)
    return merges.merge_snapshot(t.stock_daily, batch, ["seq"])


@query
def product_upsert(t, spark, sf_dir):
    """Known products arrive renamed and rebranded, and as many new ones arrive."""
    known = t.products.withColumn("active", F.lit(True))
    renamed = known.filter(F.col("product_id") % 4 == 0).select(
        "product_id", F.concat("code", F.lit("X")).alias("code"),
        F.upper("name").alias("name"), F.lit("Brand#99").alias("brand_id"),
    )
    shift = F.lit(1_000_000_000)
    new = known.filter(F.col("product_id") % 4 == 1).select(
        (F.col("product_id") + shift).alias("product_id"), "code", "name", "brand_id"
    )
    return merges.merge_products(known, renamed.unionByName(new), ["code", "name"])


@query
def product_last_wins(t, spark, sf_dir):
    """Distinct products of a sales feed: the last line of each product gives its data."""
    return records.product_rows(_sales_feed(spark, sf_dir), "REFER").select(
        "product_id", "code", "name", "source_brand"
    )


def _sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as source records (text fields), in document order."""
    s = F.col
    text = lambda c: s(c).cast("string")
    return M.sales_documents(spark, sf_dir).select(
        F.struct("doc_no", "line_no", "warehouse_id", "qty", "amount", "sale_date").alias("seq"),
        s("doc_prefix").alias("PREFIJO"),
        text("doc_no").alias("NUMDOC"),
        text("sale_date").alias("FECHA"),
        text("warehouse_id").alias("BODEGA"),
        text("product_id").alias("REFER"),
        F.lit(None).cast("string").alias("REFERENCIA"),
        text("line_no").alias("CODIGO"),
        F.lit("").alias("NOMBRE"),
        F.concat(F.lit("doc "), text("doc_no")).alias("NOMREF"),
        *(F.lit(None).cast("string").alias(c)
          for c in ("UNIDADMED", "UNDMED", "CLASE", "GRUPO", "LINEA")),
        s("doc_prefix").alias("MARCA"),
        F.when(s("doc_no") % 41 == 0, F.lit("n/a")).otherwise(text("qty")).alias("CANTID"),
        text("amount").alias("VALTOT"),
        *(F.lit(None).cast("string").alias(c)
          for c in ("VALUND", "PORDES", "VALDES", "VCOSTO", "VALUTI", "PORUTI", "PORIVA")),
    )


PAGE_DOCUMENTS = 200
#: of a landed page, some megabytes of text
MOST_PAGE_DOCUMENTS = 8000
SOURCES = 50


def _pages(records: DataFrame, fields: list[str], page) -> DataFrame:
    """Records as JSON, many to a text: all records of a page, which holds a bounded range of keys."""
    body = F.to_json(F.struct(*fields)).alias("record")
    return records.select(page.alias("page"), body).groupBy("page").agg(F.listagg("record", ",").alias("records"))


def _enveloped(pages: DataFrame, envelope) -> DataFrame:
    """The pages as landed texts, in each accepted form in turn."""
    form, records = F.pmod("page", F.lit(6)), F.col("records")
    in_xml = lambda inner: F.concat(
        F.lit("<e><n:SalesResult>"), inner, F.lit("</n:SalesResult></e>")
    )
    spaced = F.concat(F.lit("[ "), records, F.lit(" ]"))
    under = lambda key: F.concat(F.lit(f'{{"{key}": '), spaced, F.lit("}"))
    body = (
        F.when(form == 0, in_xml(spaced))
        .when(form == 1, F.concat(F.lit("["), records, F.lit("]<env><ok/></env>")))
        .when(form == 2, in_xml(under(envelope[0])))
        .when(form == 3, in_xml(F.replace(under(envelope[1]), F.lit('"'), F.lit("&quot;"))))
        .when(form == 4, in_xml(F.replace(under(envelope[2]), F.lit('"'), F.lit("&#34;"))))
        .otherwise(F.concat(F.lit("noise "), F.lit("["), records, F.lit("] noise")))
    )
    return pages.select(F.concat(F.lit("page "), "page").alias("source"), "page", body.alias("body"))


@query
def payload_sales(t, spark, sf_dir):
    """Sales lines in texts of many records, in every accepted envelope, parsed back to typed rows."""
    feed = _sales_feed(spark, sf_dir)
    fields = [c for c in feed.columns if c != "seq"]
    landed = _enveloped(_pages(feed, fields, F.floor(F.col("NUMDOC").cast("long") / PAGE_DOCUMENTS)), payloads.SALES_ENVELOPE)
    lists = payloads.record_lists(payloads.decode(landed, "Result"), payloads.SALES_ENVELOPE)
    rows = records.sales_rows(records.explode_records(lists, records.SALES_RECORD))
    return rows.select(
        "sale_date", "doc_prefix", "doc_no", "warehouse_id", "product_id", "qty", "unit_price", "amount"
    )


def _line_payloads(feed: DataFrame) -> DataFrame:
    """Each sales line as a landed text of its own, unreadable for every fifth document."""
    doc = F.col("NUMDOC").cast("long")
    record = F.to_json(F.struct(*[c for c in feed.columns if c != "seq"]))
    inner = F.when(doc % 5 == 4, F.concat("NUMDOC", F.lit(" and no record"))).otherwise(
        F.concat(F.lit("["), record, F.lit("]"))
    )
    return feed.select(
        F.concat(F.lit("page "), (doc % SOURCES).cast("string")).alias("source"),
        F.lit(1).cast("long").alias("page"),
        F.when((doc % 5 == 4) & (doc % 2 == 0), "<e><Other>nothing here</Other></e>")
        .otherwise(F.concat(F.lit("<e><SalesResult>"), inner, F.lit("</SalesResult></e>")))
        .alias("body"),
    )


@query
def payload_errors(t, spark, sf_dir):
    """Unreadable texts among all by source: an element that is no JSON, or no element at all."""
    landed = _line_payloads(_sales_feed(spark, sf_dir))
    bad = payloads.quarantine(payloads.decode(landed, "Result"))
    return bad.groupBy("source", "status").agg(F.count(F.lit(1)).alias("payloads"))


@query
def payload_stock(t, spark, sf_dir):
    """Stock rows as a stock feed in every accepted envelope, parsed back."""
    text = lambda c: F.col(c).cast("string")
    feed = t.stock.select(
        text("warehouse_id").alias("BODEGA"),
        text("product_id").alias("REFERENCIA"),
        text("qty").alias("CANTIDAD"),
        text("unit_cost").alias("VCOSTO"),
        text("unit_price").alias("VVENTA"),
        F.concat(F.lit(" "), F.coalesce("stock_tag", F.lit("")), F.lit(" ")).alias("OBSERV1"),
    )
    landed = _enveloped(_pages(
        feed, feed.columns, F.floor(F.col("REFERENCIA").cast("long") / PAGE_DOCUMENTS)
    ), payloads.STOCK_ENVELOPE)
    lists = payloads.record_lists(payloads.decode(landed, "Result"), payloads.STOCK_ENVELOPE)
    rows = records.stock_rows(records.explode_records(lists, records.STOCK_RECORD))
    return rows.select("warehouse_id", "product_id", "qty", "unit_cost", "unit_price", "stock_tag")


@query
def bad_records(t, spark, sf_dir):
    return records.bad_sales(_sales_feed(spark, sf_dir)).select("NUMDOC", "REFER", "CANTID")


@query
def history_summary(t, spark, sf_dir):
    span = t.sales.agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b")).first()
    return load.history_summary(spark, _sales_feed(spark, sf_dir), span["a"], span["b"])


@query
def week_ranges(t, spark, sf_dir):
    """The slices of the period the sales cover."""
    return calendar.weeks_of(t.sales.agg(F.min("sale_date").alias("first"), F.max("sale_date").alias("last")))


# --- lifecycle ---------------------------------------------------------------------

DONE_AT = dt.datetime(2001, 11, 5, 8, 0, 0)


def _changes(rows: DataFrame, keys: list[str], states: list[str]) -> DataFrame:
    """Two changes per third row: a valid one and a later one, valid for even products."""
    valid, later = states
    p = F.col("product_id")
    picked = rows.filter(p % 3 == 0).select(*keys)
    seq = F.explode(F.array(F.lit(1), F.lit(2)))
    return picked.withColumn("seq", seq).select(
        *keys,
        "seq",
        F.when(F.col("seq") == 1, valid).when(p % 2 == 0, later).otherwise("?").alias("state"),
        F.concat(F.lit("user "), F.col("seq").cast("string")).alias("user"),
        F.lit(DONE_AT).cast("timestamp_ntz").alias("at"),
    )


@query
def apply_alert_status(t, spark, sf_dir):
    rows = M.stored(spark, sf_dir).alerts.withColumn("handled_by", F.lit(None).cast("string")).withColumn(
        "handled_at", F.lit(None).cast("timestamp_ntz")
    )
    changes = _changes(rows, lifecycle.ALERT_KEY, ["VISTA", "IGNORADA"])
    out = lifecycle.apply_alert_status(rows, changes)
    return out.withColumn("handled_at", F.date_format("handled_at", "yyyy-MM-dd HH:mm:ss"))


@query
def apply_transfer_status(t, spark, sf_dir):
    stored = M.stored(spark, sf_dir)
    pairs = transfers.match(stored.needs.drop("state", "generated_on"), stored.offers, split=False)
    rows = M.with_state(pairs).withColumn("executed", F.lit(False)).withColumn(
        "executed_at", F.lit(None).cast("timestamp_ntz")
    )
    changes = _changes(rows, lifecycle.TRANSFER_KEY, ["APROBADO", "EJECUTADO"])
    out = lifecycle.apply_transfer_status(rows, changes)
    return out.withColumn("executed_at", F.date_format("executed_at", "yyyy-MM-dd HH:mm:ss"))


@query
def retag_stock(t, spark, sf_dir):
    items = t.stock.filter(F.col("qty") == 0).select("product_id", "warehouse_id")
    return lifecycle.retag_stock(t.stock, items, " AGOTADOS ")


# --- sinks: written and read back --------------------------------------------------


def _root(spark: SparkSession) -> str:
    """A new folder for tables in the one that all executors share."""
    return f"{sizes.shared_folder(spark)}/tables-{uuid.uuid4().hex}"


@query
def stored_sales_window(t, spark, sf_dir):
    """Sales stored by date; the month's rows are read back from their partitions only."""
    root = _root(spark)
    storage.append_sales(t.sales, root)
    month = look_back(storage.read_table(spark, root, "sales"), AS_OF, 30)
    return month.groupBy("sale_date").agg(F.count(F.lit(1)).alias("sales_rows"), F.sum("qty").alias("units"))


@query
def metrics_sink(t, spark, sf_dir):
    """The day's metrics written twice: the second run replaces the first."""
    root, found = _root(spark), M.stored(spark, sf_dir).metrics
    for _ in range(2):
        storage.write_metrics(found, root, AS_OF)
    stored = storage.read_table(spark, root, "metrics")
    return stored.groupBy("stock_state").agg(F.count(F.lit(1)).alias("items"), F.sum("stock").alias("units"))


@query
def alerts_sink(t, spark, sf_dir):
    """Pending alerts of the day replaced twice; those handled in between stay beside the new ones."""
    root, raised = _root(spark), A.alerts(_position(t))
    storage.replace_pending(raised, root, "alerts", AS_OF)
    pending = storage.read_table(spark, root, "alerts")
    handled = F.when(F.col("product_id").cast("long") % 3 == 0, F.lit("VISTA")).otherwise(F.col("state"))
    changed = _root(spark)
    storage.replace_partitions(pending.withColumn("state", handled), changed, "alerts")
    storage.replace_pending(raised, changed, "alerts", AS_OF)
    stored = storage.read_table(spark, changed, "alerts")
    return stored.groupBy("alert_type", "state").agg(F.count(F.lit(1)).alias("alerts"))


@query
def page_report(t, spark, sf_dir):
    """Is a paged extraction of the sales lines complete?"""
    feed = _sales_feed(spark, sf_dir)
    page = F.floor(F.col("NUMDOC").cast("long") / PAGE_DOCUMENTS).alias("page")
    return payloads.page_report(feed.groupBy(page).agg(F.count(F.lit(1)).alias("records")))


# --- loads: landed, stored and read back -------------------------------------------


def _landed_documents(last: int) -> int:
    """Documents of a landed page: more where there are more, so that pages stay about a thousand, up to a bounded text."""
    return min(max(PAGE_DOCUMENTS, last // 1000), MOST_PAGE_DOCUMENTS)


def _landed_sales(spark: SparkSession, sf_dir: str) -> str:
    """The sales lines as payload files, one for each page; some lines lack their document's prefix."""
    feed = _sales_feed(spark, sf_dir)
    last = M.sales(spark, sf_dir).agg(F.coalesce(F.max("doc_no"), F.lit(0)).alias("last")).first()["last"]
    feed = feed.withColumn("PREFIJO", F.when(F.col("NUMDOC").cast("long") % NO_PREFIX != 0, F.col("PREFIJO")))
    fields = [c for c in feed.columns if c != "seq"]
    pages = _pages(feed, fields, F.floor(F.col("NUMDOC").cast("long") / _landed_documents(last)))
    folder = f"{_root(spark)}/sales"
    rows = _enveloped(pages, payloads.SALES_ENVELOPE).select("body", "page")
    rows.write.partitionBy("page").option("compression", "gzip").text(folder)  # a page is a row by now
    sizes.free_shuffles(spark)
    return folder


@query
def ingest_sales_stream(t, spark, sf_dir):
    """Payload files of all sales lines through the recurring ingest, whose last batch is lost and repeated.

    Rows with a whole key are stored once, rows without one as often as they came.
    """
    landing, root, checkpoint = _landed_sales(spark, sf_dir), _root(spark), _root(spark)
    ingest.ingest_sales(spark, landing, root, checkpoint).awaitTermination()
    ingest.forget_last_batch(spark, checkpoint)
    ingest.ingest_sales(spark, landing, root, checkpoint).awaitTermination()
    stored = storage.read_table(spark, root, "sales")
    return stored.groupBy("doc_prefix").agg(F.count(F.lit(1)).alias("sales_rows"))


@query
def load_selection(t, spark, sf_dir):
    """Sales of the window that a load takes by default, that of the day before."""
    chosen = calendar.select_load(AS_OF, "sales")
    sold = t.sales.filter(F.col("sale_date").between(F.lit(chosen.sales_from), F.lit(chosen.sales_to)))
    return sold.groupBy("sale_date", "warehouse_id").agg(F.count(F.lit(1)).alias("sales_rows"), F.sum("qty").alias("units"))


@query
def csv_export(t, spark, sf_dir):
    """The warehouse list written as CSV and read back."""
    path = f"{_root(spark)}/csv"
    storage.export_csv(reports.warehouse_list(t.warehouses, M.stored(spark, sf_dir).metrics), "warehouses", path)
    rows = spark.read.csv(path, header=True, escape='"')
    names = {"Código": "code", "Nombre": "name", "Tipo": "wtype", "Regional": "region"}
    return rows.select(
        *(F.col(k).alias(v) for k, v in names.items()),
        F.col("Productos").cast("long").alias("products"),
        F.col("Unidades").cast("double").alias("units"),
        F.col("Valor Inventario").cast("double").alias("stock_value"),
    )


def _stored_world(t: Tables, spark: SparkSession) -> str:
    """The model's tables as a folder of stored ones."""
    root = _root(spark)
    storage.append_sales(t.sales, root)
    storage.replace_partitions(t.stock, root, "stock", spread=True)
    for name in ("products", "brands", "warehouses", "regions", "warehouse_types"):
        storage.replace_table(getattr(t, name), root, name)
    return root


@query
def end_to_end_run(t, spark, sf_dir):
    """The daily run over stored tables, twice; what the second one says it has written."""
    root = _stored_world(t, spark)
    daily.run_daily(spark, root, AS_OF)
    done = daily.run_daily(spark, root, AS_OF)
    counts = {"metrics": done["metrics"], "alerts": done["alerts"]["total"], **{k: done[k] for k in ("transfers", "purchases")}}
    stored = storage.read_table(spark, root, "transfer_needs").agg(F.count(F.lit(1)).alias("needs"))
    return stored.select(*(F.lit(n).cast("long").alias(k) for k, n in counts.items()), "needs")


def _logged(rows: DataFrame, states: list[str]) -> tuple[DataFrame, DataFrame]:
    """A first and a second batch of changes, as ``_changes`` gives them."""
    changes = _changes(rows, lifecycle.ALERT_KEY, states)
    return changes.filter("seq = 1"), changes.filter("seq = 2")


@query
def alert_changes(t, spark, sf_dir):
    """Changes of alerts appended in two batches, the first folded into the table, and read back with it."""
    root = _root(spark)
    storage.replace_partitions(M.with_state(A.alerts(_position(t))), root, "alerts")
    log = ChangeLog(spark, root, "alerts")
    sizes.free_shuffles(spark)
    for n, name in enumerate("ab"):
        rows = storage.read_table(spark, root, "alerts")  # a compaction writes its files anew, with the same keys
        log.append(_logged(rows, ["VISTA", "IGNORADA"])[n], name)
        if name == "a":
            log.compact()
    return log.current().groupBy("alert_type", "state").agg(
        F.count(F.lit(1)).alias("alerts"), F.count("handled_by").alias("handled")
    )


@query
def transfer_changes(t, spark, sf_dir):
    """The first transfers are handled one by one; the next pending ones, without a list of pairs."""
    stored, root = M.stored(spark, sf_dir), _root(spark)
    log = ChangeLog(spark, root, "transfers")
    first = offers.first_pairs(stored.needs, stored.offers, 60, state=None)
    state = F.when(F.col("product_id") % 2 == 0, "APROBADO").otherwise("EJECUTADO").alias("state")
    at = F.lit(DONE_AT).cast("timestamp").alias("at")
    log.append(first.select(*offers.PAIR, F.lit(AS_OF).alias("generated_on"), state, at, F.lit(1).alias("seq")), "a")
    handled = log.changes().select(*(F.col(k).cast("long").alias(k) for k in offers.PAIR), "state")
    rows = offers.first_pairs(stored.needs, stored.offers, 40, handled=handled)
    return rows.select("days_to", *offers.PAIR, "to_region", "qty", "state")


@query
def stock_tags(t, spark, sf_dir):
    """Items without stock are tagged, then the tag of even products is cleared again; stock as it is read then."""
    root = _root(spark)
    storage.replace_partitions(t.stock, root, "stock", spread=True)
    items = t.stock.filter(F.col("qty") == 0).select("product_id", "warehouse_id")
    tagged = tag_stock(spark, root, items, " AGOTADOS ", 1, "a")
    tag_stock(spark, root, items.filter(F.col("product_id") % 2 == 0), " ", 2, "b")
    rows = ChangeLog(spark, root, "stock").current()
    return rows.groupBy("stock_tag").agg(F.count(F.lit(1)).alias("items"), F.lit(tagged).cast("long").alias("tagged"))


@query
def alerts_rebuild_written(t, spark, sf_dir):
    """No-rotation alerts rebuilt in their table: what is stored then, and how many went and came."""
    root = _root(spark)
    storage.replace_partitions(M.stored(spark, sf_dir).alerts, root, "alerts")
    done = storage.rebuild_no_rotation(A.unmoved_stock(t.sales, t.stock, t.warehouses, AS_OF), root, AS_OF)
    rows = storage.read_table(spark, root, "alerts").groupBy("alert_type", "state").agg(F.count(F.lit(1)).alias("alerts"))
    return rows.select("*", *(F.lit(n).cast("long").alias(k) for k, n in done.items()))


@query
def rolling_lookback(t, spark, sf_dir):
    """Look-back sums that were moved on over three days, one of which has brought its sales late."""
    root = _root(spark)
    late = F.pmod(F.col("doc_no"), F.lit(3)) == 0
    last = F.col("sale_date") == F.lit(AS_OF - dt.timedelta(days=1))
    for name, some in (("a", t.sales.filter(~(late & last))), ("b", t.sales.filter(late & last))):
        storage.append_sales(some, root, name)
        RollingSales.mark(some, root, name)
        sums = RollingSales(spark, root, lag=1)
        for back in (2, 1, 0):
            sums.move_to(AS_OF - dt.timedelta(days=back))
    rows = sums.lookback(AS_OF, t.warehouses)
    return rows.withColumns({k: F.col(k).cast("long") for k in metrics.KEY})


FEED_PAGES = 40


@query
def page_gaps(t, spark, sf_dir):
    """What feeds of forty pages of sales lines lack after every seventh page was lost."""
    page = F.floor(F.col("NUMDOC").cast("long") / PAGE_DOCUMENTS)
    sent = _sales_feed(spark, sf_dir).groupBy(page.alias("n")).agg(F.count(F.lit(1)).alias("records"))
    feed = F.concat(F.lit("feed "), F.floor(F.col("n") / FEED_PAGES).cast("string"))
    sent = sent.filter(F.col("n") % 7 != 3).select(feed.alias("feed"), (F.col("n") % FEED_PAGES + 1).alias("page"), "records")
    return pages.page_gaps(sent, 100, FEED_PAGES)


@query
def back_load(t, spark, sf_dir):
    """All sales lines loaded week by week, in two calls of which the second finds nothing to do."""
    span = t.sales.agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b")).first()
    half = span["a"] + dt.timedelta(days=55)
    with sizes.Scratch(spark) as scratch:  # both calls read the records that were parsed once
        root, feed = _root(spark), scratch.keep(load.sales_records(payloads.read_payloads(spark, _landed_sales(spark, sf_dir))))
        backload.back_load(spark, root, feed, span["a"], half)
        backload.back_load(spark, root, feed, span["a"], span["b"])
        rows = backload.back_load(spark, root, feed, span["a"], span["b"])
    return rows.select("start_date", "end_date", "status", "loaded", "products", "errors")


@query
def product_search_indexed(t, spark, sf_dir):
    """The search by an index of the product texts, to which half of the products were added later."""
    index = NameIndex(spark, _root(spark))
    odd = F.col("product_id") % 2 == 1
    index.build(t.products.filter(~odd))
    index.add(t.products.filter(odd))
    return index.search(t.products, t.brands, t.stock, SEARCH_TEXT)


@query
def daily_efficiency_intervals(t, spark, sf_dir):
    """The report over snapshots that were stored as changes and are rebuilt from them."""
    history = SnapshotHistory(spark, _root(spark), base_days=10)
    days = [AS_OF - dt.timedelta(days=7 * k) for k in sorted(M.SNAPSHOT_WEEKS, reverse=True)]
    with sizes.Scratch(spark) as scratch:
        snapshots = M.stock_daily(scratch.keep(t.stock))
        for day in days:
            history.store(day, snapshots.filter(F.col("snapshot_date") == F.lit(day)))
    rebuilt = history.days(days).withColumns({k: F.col(k).cast("long") for k in merges.STOCK_KEY})
    return reports.daily_efficiency(t.sales, t.stock, rebuilt, t.warehouses, AS_OF)
