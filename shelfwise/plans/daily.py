"""The daily analytics run and the dashboard bundles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.filters import NO_FILTERS, Filters
from shelfwise.functions.sizes import Scratch, is_small
from shelfwise.operators import alerts as A
from shelfwise.operators import kpis, metrics, offers, purchases, reports, transfers
from shelfwise.params import DEFAULTS, Params
from shelfwise.sources import storage
from shelfwise.sources.changelog import ChangeLog
from shelfwise.sources.rolling import RollingSales
from shelfwise.tables import Tables


def position_of(t: Tables, as_of: dt.date, p: Params = DEFAULTS) -> DataFrame:
    return metrics.stock_position(t.sales, t.stock, t.product_brand, t.warehouses, as_of, p)


def run_daily(
    spark: SparkSession, root: str, as_of: dt.date, p: Params = DEFAULTS, rolling: bool = False
) -> dict[str, object]:
    """Metrics, alerts, transfers and purchases of a day, written to their tables.

    The positions are computed once and kept as a table; every output reads them.
    Changes that were logged since the last run are folded in first, so that what was handled
    is out of the run's way. With ``rolling`` the look-backs are moved on from stored sums
    in place of being formed of three months of sales. Transfers are stored as needs and surpluses, not as pairs (``write_transfer_pairs``).
    """
    for name in ("alerts", "transfers", "stock"):
        ChangeLog(spark, root, name).compact()
    t = storage.open_tables(spark, root)
    with Scratch(spark) as scratch:
        if rolling:
            sums = RollingSales(spark, root, p=p)
            sums.move_to(as_of)
            sold = sums.lookback(as_of, t.warehouses)
            today = metrics.position_of_sold(sold, t.stock, t.product_brand, t.warehouses, as_of, p)
        else:
            today = position_of(t, as_of, p)
        position = scratch.keep(today)
        written = storage.write_metrics(metrics.metrics_of(position), root, as_of)
        raised = storage.replace_pending(A.alerts(position, p=p), root, "alerts", as_of)
        day = F.lit(as_of).alias("generated_on")
        needs = offers.open_needs(position, p).select("*", F.lit(K.PENDING).alias("state"), day)
        storage.write_day(needs, root, "transfer_needs", as_of)
        storage.write_day(offers.open_offers(position).select("*", day), root, "transfer_offers", as_of)
        moves = offers.pair_total(position, p).first()["transfers"]
    buys = storage.replace_pending(
        purchases.purchases(t.sales, t.stock, t.product_brand, t.warehouses, as_of, p),
        root, "purchases", as_of,
    )
    return {
        "date": as_of.isoformat(),
        "metrics": written,
        "alerts": raised,
        "transfers": moves,
        "purchases": buys["total"],
    }


def write_transfer_pairs(spark: SparkSession, root: str, as_of: dt.date, p: Params = DEFAULTS) -> int:
    """All pairs of a day's needs and surpluses as rows, for whoever wants them; their number.

    Pending rows of the day are replaced, handled ones stay.
    """
    day = F.col("generated_on") == F.lit(as_of)
    needs, surplus = (
        storage.read_table(spark, root, n).filter(day).drop("generated_on")
        for n in ("transfer_needs", "transfer_offers")
    )
    split = not is_small(storage.read_table(spark, root, "warehouses"), p.match_cell_rows)
    rows = transfers.match(needs, surplus, split, p).withColumn("executed", F.lit(False))
    return storage.replace_pending(rows, root, "transfers", as_of)["total"]


def write_rollups(spark: SparkSession, root: str, as_of: dt.date, p: Params = DEFAULTS) -> None:
    """Network and region roll-ups of a day whose metrics are written."""
    t = storage.open_tables(spark, root)
    with Scratch(spark) as scratch:
        network = metrics.network_metrics(t.sales, t.stock, t.warehouses, as_of, scratch, p)
        storage.write_day(network, root, "network_metrics", as_of)
    today = storage.read_table(spark, root, "metrics").filter(F.col("calc_date") == F.lit(as_of))
    region = metrics.region_metrics(
        today, t.sales, t.stock, t.warehouses, t.regions, as_of, p
    )
    storage.write_day(region, root, "region_metrics", as_of)


def purchase_list(
    t: Tables,
    stored: DataFrame | None,
    as_of: dt.date,
    limit: int = 50,
    priority: str | None = None,
    brands=(),
    tags=(),
    p: Params = DEFAULTS,
) -> DataFrame:
    """Stored pending purchases if there are any, otherwise computed ones."""
    if purchases.has_pending(stored):
        return purchases.purchase_list(
            stored, t.stock, t.product_brand, t.brands, limit, priority, brands, tags
        )
    return purchases.purchases_live(
        t.sales, t.stock, t.product_brand, t.warehouses, as_of, limit, priority, brands, tags, p=p
    )


def kpi_purchases(t: Tables, stored: DataFrame | None, as_of: dt.date, p: Params = DEFAULTS) -> DataFrame:
    if purchases.has_pending(stored):
        return kpis.pending_purchases(stored)
    return kpis.purchases_estimate(t.sales, t.stock, t.warehouses, as_of, p)


def kpi_board(
    t: Tables,
    alerts: DataFrame,
    transfer_counts: DataFrame,
    purchase_rows: DataFrame | None,
    as_of: dt.date,
    f: Filters = NO_FILTERS,
    p: Params = DEFAULTS,
) -> dict[str, DataFrame]:
    """All indicator blocks; each honours its own part of the filters.

    transfer_counts: pending transfers by to_region, as ``offers.region_counts`` gives them.
    """
    items = kpis.health_items(
        t.sales, t.stock, alerts, t.warehouses, t.products, as_of, f, p
    )
    return {
        "inventory": kpis.inventory(t.stock, t.warehouses, t.products, f),
        "projects": kpis.projects(t.stock, t.warehouses, t.products, f),
        "sales": kpis.sales_totals(t.sales, t.stock, t.warehouses, as_of, f, p),
        "alerts": kpis.pending_alerts(alerts, t.stock, t.warehouses, f),
        "transfers": kpis.pending_transfers_from_counts(transfer_counts, f),
        "purchases": kpi_purchases(t, purchase_rows, as_of, p),
        "health": kpis.health_shares(kpis.health(items), alerts),
        "lost_sales": kpis.lost_sales(t.sales, t.stock, t.warehouses, as_of, f, p),
    }


def choices(t: Tables) -> dict[str, DataFrame | list[str]]:
    """What the dashboard offers to filter by."""
    return {
        "regions": reports.active_regions(t.regions),
        "warehouses": reports.active_sales_points(t.warehouses),
        "brands": reports.active_brands(t.brands),
        "tags": reports.tag_choices(t.stock).orderBy(F.col("products").desc(), "tag"),
        **K.CHOICES,
    }


def product_detail(
    t: Tables, today_metrics: DataFrame, as_of: dt.date, product_id, p: Params = DEFAULTS
) -> dict[str, DataFrame]:
    return {
        "product": reports.product_header(t.product_brand, t.products, product_id),
        "warehouses": reports.product_stock(t.stock, t.warehouses, today_metrics, product_id).orderBy(
            F.col("stock").desc(), "warehouse_id"
        ),
        "sales": reports.product_sales(t.sales, as_of, product_id, p).orderBy("sale_date"),
    }
