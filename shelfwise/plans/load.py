"""Loads: landed payload files into the stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.sizes import Scratch
from shelfwise.operators.merges import (
    map_brands,
    merge_products,
    merge_snapshot,
    merge_stock,
    new_sales,
)
from shelfwise.sources import records as R
from shelfwise.sources.calendar import Load, slice_start, week_ranges
from shelfwise.sources.payloads import (
    SALES_ENVELOPE,
    STOCK_ENVELOPE,
    decode,
    quarantine,
    read_payloads,
    record_lists,
)
from shelfwise.sources.ledger import SalesKeys
from shelfwise.sources.pages import page_gaps, page_records, split_complete
from shelfwise.sources.rolling import RollingSales
from shelfwise.sources.storage import (
    append_sales,
    new_batch,
    read_table,
    replace_partitions,
    replace_table,
    stock_part,
    table_path,
)
from shelfwise.sources.trigrams import NameIndex

#: name part of the result element in each feed (fixed values)
SALES_TAG = "Result"
STOCK_TAG = "Result"
ORDER = ["seq"]


def sales_records(landed: DataFrame, result_tag: str = SALES_TAG) -> DataFrame:
    lists = record_lists(decode(landed, result_tag), SALES_ENVELOPE)
    return R.explode_records(lists, R.SALES_RECORD)


def stock_records(landed: DataFrame, result_tag: str = STOCK_TAG) -> DataFrame:
    lists = record_lists(decode(landed, result_tag), STOCK_ENVELOPE)
    return R.explode_records(lists, R.STOCK_RECORD)


def _load_products(
    spark: SparkSession, root: str, records: DataFrame, key_field: str, scratch: Scratch
) -> int:
    rows = scratch.keep(R.product_rows(records, key_field))
    batch = map_brands(rows, read_table(spark, root, "brands"))
    known = read_table(spark, root, "products")
    merged, index = merge_products(known, batch), NameIndex(spark, root)
    if index.exists():  # only it asks which texts have changed
        merged, texts = scratch.keep(merged), ["product_id", "name", "code"]
        changed = scratch.keep(merged.select(*texts).exceptAll(known.select(*texts)))
        replace_table(merged, root, "products")
        index.add(changed)
    else:
        replace_table(merged, root, "products")
    return rows.count()


def load_sales(
    spark: SparkSession, root: str, records: DataFrame,
    first: dt.date | None = None, last: dt.date | None = None, batch: str | None = None, kept: bool = False,
) -> dict[str, int]:
    """Products first, then sales that are not stored yet.

    The window is what the source was asked for; late records that it sends all the
    same are stored like all others, and are counted as ``outside``. Rows whose key is
    complete are stored once however often they come. A named batch that is repeated replaces
    what it has left before: its rows, those with a NULL in the key too, and its
    quarantined records. ``kept`` records are read from a table and are not kept again.
    """
    name = batch or new_batch()
    with Scratch(spark) as scratch:
        records = records if kept else scratch.keep(records)
        rows, seen = R.sales_rows(records), Observation()
        day = F.col("FECHA").try_cast("date")
        outside = F.lit(False) if first is None else ~day.between(F.lit(first), F.lit(last or first))
        counted = records.observe(seen, F.count_if(day.isNotNull()).alias("processed"), F.count_if(outside).alias("outside"))
        products = _load_products(spark, root, counted, "REFER", scratch)
        counts = seen.get
        bad = _keep_bad(R.bad_sales(records), root, "sales_records", batch)
        keys = SalesKeys(spark, root)
        fresh = scratch.keep(new_sales(keys.stored(without=name), rows, ORDER, scratch=scratch, buckets=keys.buckets))
        inserted = append_sales(fresh, root, name)
        # a batch lost in between does not meet its own keys when it is repeated
        keys.add(fresh, name)
        RollingSales.mark(fresh, root, name)
        return {
            "processed": counts["processed"],
            "outside": counts["outside"],
            "inserted": inserted,
            "products": products,
            "quarantined": bad,
        }


def load_stock(
    spark: SparkSession, root: str, records: DataFrame, day: dt.date,
    zero_missing: bool = False, batch: str | None = None,
) -> dict[str, int]:
    """Products, current stock and the day's snapshot."""
    with Scratch(spark) as scratch:
        records = scratch.keep(records)
        products = _load_products(spark, root, records, "REFERENCIA", scratch)
        bad = _keep_bad(R.bad_stock(records), root, "stock_records", batch)
        rows = R.stock_rows(records)
        stored = read_table(spark, root, "stock", hidden=True)
        if not zero_missing:
            # only parts with warehouses of the feed are read (dynamic pruning) and rewritten; a row a part
            touched = F.broadcast(rows.select(stock_part().alias("part")).distinct())
            stored = stored.join(touched, "part", "left_semi")
        stored = stored.drop("part")
        current = merge_stock(stored, rows, ORDER, zero_missing=zero_missing)
        replace_partitions(current, root, "stock", spread=True)
        snapshot = rows.withColumn("snapshot_date", F.lit(day))
        same_day = F.col("snapshot_date") == F.lit(day)
        today = read_table(spark, root, "stock_daily").filter(same_day)
        replace_partitions(merge_snapshot(today, snapshot, ORDER), root, "stock_daily")
        return {"processed": rows.count(), "products": products, "quarantined": bad}


def _keep_bad(bad: DataFrame, root: str, kind: str, batch: str | None) -> int:
    """Bad records go to a JSON folder of their kind; a named batch has a folder of its own there. Returns their number."""
    path, seen = table_path(root, f"quarantine/{kind}"), Observation()
    bad = bad.observe(seen, F.count(F.lit(1)).alias("rows"))
    if batch is None:
        bad.write.mode("append").json(path)
    else:
        bad.write.mode("overwrite").json(f"{path}/batch={batch}")
    return seen.get["rows"]


def keep_bad_payloads(
    landed: DataFrame, root: str, feed: str, result_tag: str, batch: str | None = None
) -> None:
    _keep_bad(quarantine(decode(landed, result_tag)), root, f"{feed}_payloads", batch)


def complete_pages(
    landed: DataFrame, result_tag: str, envelope: tuple[str, ...], page_size: int
) -> tuple[DataFrame, list[dict]]:
    """Pages of the feeds that are whole, and what the others lack: a row a gap of a held feed."""
    gaps = page_gaps(page_records(landed, result_tag, envelope), page_size)
    return split_complete(landed, gaps)[0], [r.asDict() for r in gaps.orderBy("feed", "first_page").collect()]


def run_load(
    spark: SparkSession, root: str, load: Load, sales_path: str | None, stock_path: str | None,
    page_size: int | None = None,
) -> dict[str, dict[str, int]]:
    """A batch load of what ``load`` selects.

    With a page size, feeds that lack pages are not loaded; ``held`` tells which pages they lack.
    """
    result = {}
    if load.sales_from and sales_path:
        landed, held = read_payloads(spark, sales_path), None
        if page_size:
            landed, held = complete_pages(landed, SALES_TAG, SALES_ENVELOPE, page_size)
        keep_bad_payloads(landed, root, "sales", SALES_TAG)
        result["sales"] = load_sales(
            spark, root, sales_records(landed), load.sales_from, load.sales_to
        )
        if held is not None:
            result["sales"]["held"] = held
    if load.stock_date and stock_path:
        landed, held = read_payloads(spark, stock_path), None
        if page_size:
            landed, held = complete_pages(landed, STOCK_TAG, STOCK_ENVELOPE, page_size)
        keep_bad_payloads(landed, root, "stock", STOCK_TAG)
        result["stock"] = load_stock(spark, root, stock_records(landed), load.stock_date)
        if held is not None:
            result["stock"]["held"] = held
    return result


def history_summary(
    spark: SparkSession, records: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """What a back-load would find per week slice: records, products, errors (``backload`` loads them).

    All slices are one job. A record's slice is computed from its date; weeks
    without records stay with zeros. Records without a readable date belong to
    no slice and are found with ``bad_sales``.
    """
    day = F.col("FECHA").try_cast("date")
    bad = R._bad_numbers(R.SALES_NUMBERS)
    per_product = (
        records.filter(day.between(F.lit(first), F.lit(last)))
        .select(slice_start(day, first).alias("start_date"), "REFER", bad.alias("bad"))
        .groupBy("start_date", "REFER")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("errors"))
    )
    filled = F.coalesce(F.col("REFER"), F.lit("")) != ""
    per_slice = per_product.groupBy("start_date").agg(
        F.sum("rows").alias("loaded"),
        F.count_if(filled).alias("products"),
        F.sum("errors").alias("errors"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        week_ranges(spark, first, last)
        .join(per_slice, "start_date", "left")
        .select("start_date", "end_date", zero("loaded"), zero("products"), zero("errors"))
    )
