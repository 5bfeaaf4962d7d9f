"""Idempotent merges of a batch into the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.sizes import Scratch, hash_if_bounded

SALES_KEY = ["doc_prefix", "doc_no", "product_id"]
STOCK_KEY = ["warehouse_id", "product_id"]


def _has_key(keys: list[str]) -> Column:
    full = F.lit(True)
    for key in keys:
        full = full & F.col(key).isNotNull()
    return full


def one_per_key(batch: DataFrame, keys: list[str], order: list[str], last: bool) -> DataFrame:
    """The first or last row of each key, as an aggregate that combines on the map side.

    The row begins with what orders it, so no column is shuffled twice; rows equal in that
    are told apart by their other columns.
    """
    rest = [c for c in batch.columns if c not in [*keys, *order]]
    pick = (F.max if last else F.min)(F.struct(*order, *rest))
    grouped = batch.groupBy(*keys).agg(pick.alias("r"))
    return grouped.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in batch.columns])


def new_sales(
    existing: DataFrame | None,
    batch: DataFrame,
    order: list[str],
    keys: list[str] | None = None,
    large: bool = False,
    scratch: Scratch | None = None,
    buckets: int = 1,
) -> DataFrame:
    """Rows of the batch to append: first row per key, unless the key is stored already.

    Rows with a NULL in the key never conflict; they skip the aggregation and
    the join, where they would all meet in one task. The stored history is
    read for its keys only. While the batch's keys are few enough for Spark to
    broadcast, by their measured size, it is filtered where it is read. Beyond that a
    history in buckets by key (``ledger.SalesKeys``) meets them bucket by bucket and stays
    where it is; any other one is shuffled. A batch known to be ``large`` meets the history
    at once, without forming its keys a second time for the broadcast. With a scratch folder,
    for a batch that is read from a table, only keys are shuffled to find those that came twice or
    are stored, and whole rows only of these; ``buckets`` are those of the history.
    """
    keys = keys or SALES_KEY
    if scratch is not None and existing is not None:
        return _new_by_contested(existing, batch, order, keys, scratch, buckets)
    keyed = one_per_key(batch.filter(_has_key(keys)), keys, order, last=False)
    if existing is not None:
        known = existing.select(*keys)
        if not large:
            known = known.join(keyed.select(*keys), keys, "left_semi")
        keyed = keyed.join(known, keys, "left_anti")
    return keyed.unionByName(batch.filter(~_has_key(keys)))


def _new_by_contested(
    existing: DataFrame, batch: DataFrame, order: list[str], keys: list[str], scratch: Scratch, buckets: int
) -> DataFrame:
    """The rows of ``new_sales``; a row whose key came once and is not stored is taken as it is read."""
    keyed = batch.filter(_has_key(keys))
    counted = scratch.keep(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")))
    known = existing.select(*keys).join(hash_if_bounded(counted.select(*keys), buckets), keys, "left_semi")
    again = counted.filter("times > 1").select(*keys, F.lit(False).alias("known"))
    found = again.unionByName(known.withColumn("known", F.lit(True)))
    contested = scratch.keep(found.groupBy(*keys).agg(F.max("known").alias("known")))
    stored, contested = contested.filter("known").select(*keys), contested.select(*keys)
    single = keyed.join(contested, keys, "left_anti")
    first = one_per_key(keyed.join(contested, keys, "left_semi"), keys, order, last=False).join(stored, keys, "left_anti")
    return single.unionByName(first).unionByName(batch.filter(~_has_key(keys)))


def merge_sales(existing: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """The whole table after an insert-ignore; a load appends ``new_sales`` instead."""
    fresh = new_sales(existing, batch, order).select(*existing.columns)
    return existing.unionByName(fresh)


def merge_stock(
    existing: DataFrame | None,
    batch: DataFrame,
    order: list[str],
    keys: list[str] | None = None,
    zero_missing: bool = False,
) -> DataFrame:
    """Current stock after a batch: last row per key wins, other rows stay.

    The feed leaves out items without balance, so stale rows stay as they are;
    ``zero_missing`` sets their quantity to 0 instead.
    """
    keys = keys or STOCK_KEY
    fresh = one_per_key(batch, keys, order, last=True)
    if existing is None:
        return fresh.drop(*[c for c in order if c not in keys])
    columns = existing.columns
    kept = existing.join(fresh.select(*keys), keys, "left_anti")
    if zero_missing:
        kept = kept.withColumn("qty", F.lit(0).cast(existing.schema["qty"].dataType))
    return kept.select(*columns).unionByName(fresh, allowMissingColumns=True).select(*columns)


def merge_snapshot(existing: DataFrame | None, batch: DataFrame, order: list[str]) -> DataFrame:
    """The same for the daily snapshot, keyed by date as well."""
    return merge_stock(existing, batch, order, ["snapshot_date", *STOCK_KEY])


PRODUCT_UPDATED = ["code", "name", "uom", "product_class", "product_group", "product_line"]


def map_brands(batch: DataFrame, brands: DataFrame) -> DataFrame:
    """Replace the source's brand text by the brand key; unknown text stays as it is."""
    known = brands.filter(F.col("source_name").isNotNull()).select(
        F.col("source_name").alias("source_brand"), F.col("brand_id").alias("mapped")
    )
    return (
        batch.join(known, "source_brand", "left")
        .withColumn("brand_id", F.coalesce("mapped", "source_brand"))
        .drop("mapped", "source_brand")
    )


def merge_products(
    existing: DataFrame, batch: DataFrame, updated: list[str] | None = None
) -> DataFrame:
    """Products after a batch: all fields follow the batch, except the brand.

    The brand is set when a product first appears and then stays, even if NULL.
    The batch has one row per product.
    """
    updated = updated or PRODUCT_UPDATED
    o = existing.withColumn("was", F.lit(True))
    n = batch.select(
        "product_id",
        F.lit(True).alias("now"),
        *(F.col(c).alias(f"new_{c}") for c in [*updated, "brand_id"]),
    )
    both = o.join(n, "product_id", "full")
    is_new, is_touched = F.col("was").isNull(), F.col("now").isNotNull()

    def column(c: str) -> Column:
        if c in updated:
            return F.when(is_touched, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
        if c == "brand_id":
            return F.when(is_new, F.col("new_brand_id")).otherwise(F.col(c)).alias(c)
        if c == "active":
            return F.when(is_new, F.lit(True)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return both.select(*(column(c) for c in existing.columns))
