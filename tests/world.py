"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.tables import Tables

TODAY = dt.date(2025, 6, 30)

WAREHOUSES = [
    ("W1", "One", "Venta", "NORTH", False, True),
    ("W2", "Two", "Venta", "NORTH", False, True),
    ("W3", "Three", "Venta", "SOUTH", False, True),
    ("R1", "Store", "Reserva", "SOUTH", True, True),
]
REGIONS = [("NORTH", "North", True), ("SOUTH", "South", True), ("EMPTY", "Empty", True)]
#: brand, category, class, cover, lead
BRANDS = [
    ("A", "PRINCIPAL", "A", 30, 10),
    ("D", "OTRAS", "D", None, None),
    ("S", "PRINCIPAL", "B", 2, 5),
]


def dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.00001"))


def days_ago(n: int) -> dt.date:
    return TODAY - dt.timedelta(days=n)


def frame(spark: SparkSession, data, ddl: str):
    """Rows as a local relation; plain createDataFrame would start Python workers."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*data, strict=True)) if data else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=schema)


def tables(
    spark: SparkSession, sales=(), stock=(), products=(("P", "A"),), brands=BRANDS,
    warehouses=WAREHOUSES, regions=REGIONS, stock_daily=(),
) -> Tables:
    """sales: product, warehouse, days ago, qty, amount. stock: product, warehouse, qty, cost, tag."""
    q = "decimal(15,5)"
    pad = lambda row, n: tuple(row) + (None,) * (n - len(row))
    return Tables(
        sales=frame(
            spark, [(p, w, days_ago(n), dec(x), dec(a)) for p, w, n, x, a in (pad(r, 5) for r in sales)],
            f"product_id string, warehouse_id string, sale_date date, qty {q}, amount {q}",
        ),
        stock=frame(
            spark, [(p, w, dec(x), dec(c), dec(c), t) for p, w, x, c, t in (pad(r, 5) for r in stock)],
            f"product_id string, warehouse_id string, qty {q}, unit_cost {q}, unit_price {q},"
            " stock_tag string",
        ),
        products=frame(
            spark, [(p, f"C{p}", f"Name {p}", b) for p, b in products],
            "product_id string, code string, name string, brand_id string",
        ),
        brands=frame(
            spark, [(b, f"Brand {b}", c, k, 30, v, d, True) for b, c, k, v, d in brands],
            "brand_id string, name string, category string, abc_class string, buy_every_days int,"
            " cover_days int, dc_lead int, active boolean",
        ).selectExpr("*", "cover_days + dc_lead AS total_cover"),
        warehouses=frame(
            spark, list(warehouses),
            "warehouse_id string, name string, wtype string, region_id string, is_dc boolean,"
            " active boolean",
        ),
        regions=frame(
            spark, list(regions), "region_id string, name string, active boolean"
        ),
        warehouse_types=frame(spark, [("Venta",), ("Reserva",), ("Otro",)], "wtype string"),
        stock_daily=frame(
            spark, [(days_ago(n), w, p, dec(x), dec(c), t) for p, w, n, x, c, t in stock_daily],
            f"snapshot_date date, warehouse_id string, product_id string, qty {q}, unit_cost {q},"
            " stock_tag string",
        ),
    )


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def one(df, *cols):
    found = rows(df, *cols)
    assert len(found) == 1, found
    return found[0]
