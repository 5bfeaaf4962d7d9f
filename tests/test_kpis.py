from decimal import Decimal

from world import TODAY, one, rows, tables

from shelfwise.functions.filters import Filters
from shelfwise.operators import kpis
from shelfwise.plans import daily

ALERT = "alert_type string, level string, product_id string, warehouse_id string, state string"


def alerts(spark, *found):
    return spark.createDataFrame(
        [(t, "ALTO", p, w, s) for t, p, w, s in found], ALERT
    )


def health_of(spark, alert_rows=(), f=Filters(), **world):
    t = tables(spark, **world)
    a = alerts(spark, *alert_rows)
    return kpis.health_items(t.sales, t.stock, a, t.warehouses, t.products, TODAY, f), a


def test_health_classes_and_precedence(spark):
    pend = "PENDIENTE"
    items, _ = health_of(
        spark,
        [("STOCK_CRITICO", "B", "W1", pend), ("SOBREINVENTARIO", "B", "W1", pend),
         ("STOCK_BAJO", "C", "W1", "VISTA"), ("BAJA_ROTACION", "D", "W1", pend)],
        products=[(p, "A") for p in "ABCDEFGH"],
        stock=[("A", "W1", 0, 1), ("B", "W1", 5, 1), ("C", "W1", 5, 1), ("D", "W1", 5, 1),
               ("E", "W1", 5, 1), ("F", "W1", 0, 1), ("G", "W1", -1, 1), ("H", "R1", 5, 1)],
        sales=[("A", "W1", 1, 1), ("C", "W1", 1, 1)],
    )
    assert rows(items, "product_id", "health_rank") == [
        ("A", 1), ("B", 2), ("C", 7), ("D", 5), ("E", 6), ("F", 6),
    ]


def test_product_takes_its_best_class_and_all_its_value(spark):
    items, _ = health_of(
        spark, [("STOCK_CRITICO", "P", "W2", "PENDIENTE")],
        stock=[("P", "W1", 5, 2), ("P", "W2", 1, 2)], sales=[("P", "W1", 1, 1)],
    )
    assert one(kpis.health(items), "health", "products", "stock_value") == ("critico", 1, Decimal("12.0000000000"))


def test_shares_list_every_class_and_raise_the_stockouts(spark):
    items, a = health_of(
        spark, [("STOCK_AGOTADO", "X", "W1", "PENDIENTE"), ("STOCK_AGOTADO", "Y", "W1", "PENDIENTE"),
                ("STOCK_AGOTADO", "X", "W2", "PENDIENTE"), ("STOCK_AGOTADO", "Z", "W2", "VISTA")],
        products=[("P", "A"), ("Q", "A")],
        stock=[("P", "W1", 1, 2), ("Q", "W1", 2, 3)], sales=[("P", "W1", 1, 1)],
    )
    got = rows(kpis.health_shares(kpis.health(items), a), "health", "products", "value_pct", "total_products")
    assert got == [
        ("agotado", 2, 0.0, 4), ("baja_rotacion", 0, 0.0, 4), ("bajo", 0, 0.0, 4), ("critico", 0, 0.0, 4),
        ("sano", 1, 25.0, 4), ("sin_rotacion", 1, 75.0, 4), ("sobreinventario", 0, 0.0, 4),
    ]


def test_lost_sales_counts_missing_and_empty_stock(spark):
    t = tables(
        spark, products=[("P", "A"), ("Q", "A")],
        stock=[("P", "W1", 0, 1), ("P", "W2", 1, 1), ("Q", "W3", 0, 1), ("Q", "R1", 4, 1, "PROYECTOS")],
        sales=[("P", "W1", 1, 2, 20), ("P", "W2", 1, 2, 20), ("P", "W3", 1, 3, 30), ("Q", "W3", 1, 1, 9)],
    )
    got = one(kpis.lost_sales(t.sales, t.stock, t.warehouses, TODAY))
    assert [int(x) for x in got] == [2, 50, 5]
    north = Filters.parse(regions="NORTH")
    assert [int(x) for x in one(kpis.lost_sales(t.sales, t.stock, t.warehouses, TODAY, north))] == [1, 20, 2]


def test_sales_totals_ignore_brands_and_count_all_warehouses(spark):
    t = tables(
        spark, products=[("P", "A"), ("Q", "A")], stock=[("P", "W1", 1, 1, "OUTLET"), ("P", "W2", 1, 1, "OUTLET")],
        sales=[("P", "W1", 1, 2, 20), ("P", "R1", 1, 2, 20), ("Q", "W1", 31, 5, 5), ("Q", "W1", 30, 5, 5)],
    )
    run = lambda **f: [int(x) for x in one(kpis.sales_totals(t.sales, t.stock, t.warehouses, TODAY, Filters.parse(**f)))]
    assert run(brands="NOPE") == [3, 9, 45]
    assert run(tags="OUTLET") == [2, 4, 40]
    assert run(regions="SOUTH") == [1, 2, 20]
    assert run(warehouses="W1") == [2, 7, 25]


def test_empty_tables_give_zeros(spark):
    t = tables(spark)
    assert [int(x) for x in one(kpis.inventory(t.stock, t.warehouses, t.products))] == [0, 0, 0, 0]
    assert [int(x) for x in one(kpis.projects(t.stock, t.warehouses, t.products))] == [0, 0, 0]
    assert [int(x) for x in one(kpis.sales_totals(t.sales, t.stock, t.warehouses, TODAY))] == [0, 0, 0]
    assert [int(x) for x in one(kpis.purchases_estimate(t.sales, t.stock, t.warehouses, TODAY))] == [0, 0]


def test_pending_alert_tags_need_the_same_warehouse(spark):
    t = tables(spark, stock=[("P", "W1", 1, 1, "OUTLET"), ("P", "W2", 1, 1)])
    a = alerts(spark, ("STOCK_BAJO", "P", "W1", "PENDIENTE"), ("STOCK_BAJO", "P", "W2", "PENDIENTE"), ("STOCK_BAJO", "P", "W9", "PENDIENTE"))
    got = kpis.pending_alerts(a, t.stock, t.warehouses, Filters.parse(tags="OUTLET"))
    assert one(got, "low", "total") == (1, 1)
    assert one(kpis.pending_alerts(a, t.stock, t.warehouses), "low", "total") == (2, 2)


def test_board_has_every_block_and_legacy_has_one_row(spark):
    t = tables(spark, stock=[("P", "W1", 1, 1)], sales=[("P", "W1", 1, 30, 60)])
    a = alerts(spark, ("STOCK_CRITICO", "P", "W1", "PENDIENTE"))
    moves = spark.createDataFrame([("NORTH", 1)], "to_region string, transfers long")
    board = daily.kpi_board(t, a, moves, None, TODAY)
    assert {k: v.count() for k, v in board.items()} == {
        "inventory": 1, "projects": 1, "sales": 1, "alerts": 1, "transfers": 1, "purchases": 1,
        "health": 7, "lost_sales": 1,
    }
    got = one(kpis.legacy(t.sales, t.stock, a, board["transfers"], TODAY))
    assert [int(x) for x in got] == [1, 1, 1, 1, 1, 30, 60, 1, 0, 0, 1, 1]
