"""The benchmark's TPC-H-like tables seen as the inventory model.

All rules are integer arithmetic on the keys, so another engine computes the
same rows. Fact tables are derived lazily from ``lineitem``; nothing is copied.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.sizes import Scratch
from shelfwise.operators.alerts import alerts
from shelfwise.operators.metrics import metrics_of, stock_position
from shelfwise.operators.offers import open_needs, open_offers
from shelfwise.operators.transfers import either_side
from shelfwise.tables import Tables

#: last ship date of the generated data, the same at every scale
AS_OF = dt.date(2001, 11, 4)
QTY = "decimal(15,5)"
MONEY = "decimal(15,2)"
SNAPSHOT_WEEKS = (0, 1, 2, 3)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sale_date() -> Column:
    """Ship dates folded into the last 120 days, so that look-backs are well filled."""
    age = F.datediff(F.lit(AS_OF), F.col("l_shipdate").cast("date"))
    return F.date_sub(F.lit(AS_OF), age % 120)


def _amount() -> Column:
    price = F.col("l_extendedprice").cast(MONEY)
    keep = F.lit(1).cast(MONEY) - F.col("l_discount").cast(MONEY)
    return (price * keep).cast(QTY)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        _sale_date().alias("sale_date"),
        F.col("l_quantity").cast(QTY).alias("qty"),
        _amount().alias("amount"),
        F.col("l_linenumber").alias("line_no"),
    )


def sales_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with the document prefix, which only the insert-ignore load reads."""
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_no"), F.col("o_orderstatus").alias("doc_prefix")
    )
    return sales(spark, sf_dir).join(orders, "doc_no")


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _read(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    return (
        _read(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("warehouse_id"),
            F.col("s_name").alias("name"),
            F.when(key % 5 == 0, "Reserva").otherwise(K.SALES_POINT).alias("wtype"),
            F.col("r_name").alias("region_id"),
            (key % 20 == 1).alias("is_dc"),
            (key % 50 != 7).alias("active"),
        )
    )


def warehouse_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouses(spark, sf_dir).select("wtype").distinct()


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region").select(
        F.col("r_name").alias("region_id"),
        F.concat(F.lit("Region "), "r_name").alias("name"),
        F.lit(True).alias("active"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("brand_no")
    main = n <= 10
    by_three = lambda *v: F.when(
        main, F.when(n % 3 == 0, v[0]).when(n % 3 == 1, v[1]).otherwise(v[2])
    )
    return (
        _read(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .withColumn("brand_no", F.expr("cast(substr(p_brand, 7) as int)"))
        .select(
            F.col("p_brand").alias("brand_id"),
            F.concat(F.lit("Marca "), F.col("brand_no").cast("string")).alias("name"),
            F.when(main, K.MAIN_BRANDS).otherwise(K.OTHER_BRANDS).alias("category"),
            F.substring(F.lit("ABCD"), n % 4 + 1, F.lit(1)).alias("abc_class"),
            F.when(main, n * 7).alias("buy_every_days"),
            by_three(15, 30, 60).alias("cover_days"),
            by_three(22, 10, 105).alias("dc_lead"),
        )
        .withColumn("total_cover", F.col("cover_days") + F.col("dc_lead"))
        .withColumn("active", F.lit(True))
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _read(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.concat(F.lit("C"), (key + 1000).cast("string")).alias("code"),
        F.col("p_name").alias("name"),
        F.when(key % 29 != 0, F.col("p_brand")).alias("brand_id"),
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    mix = p * 31 + s * 17
    units = (
        F.when((p * 7 + s) % 9 == 0, F.lit(0))
        .when(p % 3 == 0, mix % (p % 40 + 4))
        .otherwise(mix % 240)
    )
    pairs = (
        _read(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey")
        .filter((p + s) % 11 != 0)
        .distinct()
    )
    price = _read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    list_price = F.col("p_retailprice").cast(MONEY)
    return pairs.join(price, p == F.col("p_partkey")).select(
        p.alias("product_id"),
        s.alias("warehouse_id"),
        units.cast(QTY).alias("qty"),
        F.when(p % 13 == 0, F.lit(0).cast(QTY))
        .otherwise((list_price * F.lit(0.6).cast("decimal(2,1)")).cast(QTY))
        .alias("unit_cost"),
        list_price.cast(QTY).alias("unit_price"),
        F.when(p % 10 == 0, K.TAG_PROJECTS)
        .when(p % 10 == 1, "OUTLET")
        .when(p % 10 == 2, "  ")
        .alias("stock_tag"),
    )


def stock_daily(current: DataFrame) -> DataFrame:
    week = F.explode(F.array(*(F.lit(k) for k in SNAPSHOT_WEEKS)))
    return current.withColumn("week", week).select(
        F.date_sub(F.lit(AS_OF), F.col("week") * 7).alias("snapshot_date"),
        "warehouse_id",
        "product_id",
        (F.col("qty") * (F.col("week") + 1)).cast(QTY).alias("qty"),
        "unit_cost",
        "unit_price",
        "stock_tag",
    )


def open_tables(spark: SparkSession, sf_dir: str) -> Tables:
    current = stock(spark, sf_dir)
    return Tables(
        sales=sales(spark, sf_dir),
        stock=current,
        products=products(spark, sf_dir),
        brands=brands(spark, sf_dir),
        warehouses=warehouses(spark, sf_dir),
        regions=regions(spark, sf_dir),
        warehouse_types=warehouse_types(spark, sf_dir),
        stock_daily=stock_daily(current),
    ).checked()


@lru_cache(maxsize=8)
def _opened(_app: str, spark: SparkSession, sf_dir: str) -> Tables:
    return open_tables(spark, sf_dir)


def model(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables, with the dimension checks made once per session and folder."""
    return _opened(spark.sparkContext.applicationId, spark, sf_dir)


class Stored:
    """What a daily run leaves behind: today's metrics, alerts with states, and both sides of transfers.

    Each table is written when it is first read, from the positions and without a copy of
    them. Needs and surpluses share the positions that are one or the other.
    """

    def __init__(self, t: Tables) -> None:
        self._scratch = Scratch(t.sales.sparkSession)
        self._position = stock_position(t.sales, t.stock, t.product_brand, t.warehouses, AS_OF)

    @cached_property
    def metrics(self) -> DataFrame:
        return self._scratch.keep(metrics_of(self._position))

    @cached_property
    def alerts(self) -> DataFrame:
        return self._scratch.keep(with_state(alerts(self._position)))

    @cached_property
    def _sides(self) -> DataFrame:
        return self._scratch.keep(either_side(self._position))

    @cached_property
    def needs(self) -> DataFrame:
        return self._scratch.keep(with_state(open_needs(self._sides)))

    @cached_property
    def offers(self) -> DataFrame:
        return self._scratch.keep(open_offers(self._sides))


@lru_cache(maxsize=8)
def _stored(_app: str, spark: SparkSession, sf_dir: str) -> Stored:
    return Stored(model(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> Stored:
    """The outputs of the daily run over the model, each written once per session and folder.

    The dashboard reads these tables, as it does in production.
    """
    return _stored(spark.sparkContext.applicationId, spark, sf_dir)


def with_state(df: DataFrame) -> DataFrame:
    """Give derived alerts or needs a lifecycle state, to exercise state filters."""
    handled = F.col("product_id") % 7 == 0
    return df.withColumn("state", F.when(handled, "ATENDIDA").otherwise(K.PENDING)).withColumn(
        "generated_on", F.lit(AS_OF)
    )
