from decimal import Decimal

import pytest
from world import TODAY, one, rows, tables

from shelfwise import Params
from shelfwise.operators import alerts as A
from shelfwise.operators import metrics
from shelfwise.plans import daily


def alerts_for(spark, kinds=None, p=Params(), **world):
    return A.alerts(daily.position_of(tables(spark, **world), TODAY, p), kinds, p)


@pytest.mark.parametrize(
    "stock, kind, level",
    [(2.9, "STOCK_CRITICO", "CRITICO"), (3, "STOCK_BAJO", "ALTO"), (7, "STOCK_MEDIO", "MEDIO")],
)
def test_low_stock_bands(spark, stock, kind, level):
    got = alerts_for(spark, ["low"], stock=[("P", "W1", stock, 1)], sales=[("P", "W1", 1, 30)])
    assert one(got, "alert_type", "level") == (kind, level)


def test_low_stock_message_and_bound(spark):
    world = dict(stock=[("P", "W1", 2.25, 1), ("P", "W2", 15, 1)], sales=[("P", "W1", 1, 30), ("P", "W2", 1, 30)])
    assert one(alerts_for(spark, ["low"], **world), "message") == (
        "Stock para 2.3 días. Venta diaria: 1.00 uds. Se recomienda reabastecer.",
    )


def test_low_stock_only_at_sales_points_and_when_selling(spark):
    got = alerts_for(spark, ["low"], stock=[("P", "R1", 1, 1), ("P", "W1", 1, 1)], sales=[("P", "R1", 1, 30)])
    assert rows(got) == []


def test_rounded_to_zero_days_is_critical(spark):
    got = alerts_for(spark, ["low"], stock=[("P", "W1", 0.001, 1)], sales=[("P", "W1", 1, 30000)])
    assert one(got, "alert_type", "days_of_stock") == ("STOCK_CRITICO", Decimal("0.00"))


def test_overstock_level_compares_days_with_units_by_default(spark):
    # 46 days, target 30, stock_max 30 units: 46 > 60 is false; with few units sold it is true
    slow = dict(stock=[("P", "W1", 4.6, 1)], sales=[("P", "W1", 1, 3)])
    got = alerts_for(spark, ["over"], **slow)
    assert one(got, "level", "message") == (
        "ALTO", "Stock para 46 días (objetivo: 30). Considerar traslado a otro almacén.",
    )
    other = alerts_for(spark, ["over"], Params(over_level_rule="days"), **slow)
    assert one(other, "level") == ("MEDIO",)


def test_overstock_bound_is_strict(spark):
    got = alerts_for(spark, ["over"], stock=[("P", "W1", 45, 1)], sales=[("P", "W1", 1, 30)])
    assert rows(got) == []


def test_slow_needs_a_class_other_than_d(spark):
    world = dict(
        products=[("P", "A"), ("Q", "D"), ("N", None)],
        stock=[("P", "R1", 100, 2), ("Q", "W1", 100, 2), ("N", "W1", 100, 2)],
    )
    got = alerts_for(spark, ["slow"], **world)
    assert one(got, "product_id", "level", "message") == (
        "P", "ALTO", "Sin movimiento en 90 días. Valor en stock: $200",
    )


def test_slow_message_with_some_sales(spark):
    got = alerts_for(spark, ["slow"], stock=[("P", "W1", 100, 2)], sales=[("P", "W1", 50, 2)])
    assert one(got, "level", "message") == (
        "MEDIO", "Solo 2.00000 uds vendidas en 90 días. Evaluar promoción o descontinuar.",
    )


def test_returns_that_cancel_out_are_not_unmoved(spark):
    sales = [("P", "W1", 5, 5), ("P", "W1", 4, -5)]
    got = alerts_for(spark, ["no_rotation"], stock=[("P", "W1", 9, 1), ("P", "W2", 9.5, 1.5)], sales=sales)
    assert one(got, "warehouse_id", "level", "message") == (
        "W2", "ALTO",
        "Sin ventas en 30 días. Stock: 10 uds. Valor: $14. Evaluar promoción/oferta o redistribución.",
    )


def test_stockout_needs_positive_sales_and_no_stock(spark):
    got = alerts_for(
        spark, ["stockout"],
        stock=[("P", "W1", 0, 1), ("P", "W2", 5, 1)],
        sales=[("P", "W1", 1, 30), ("P", "W2", 1, 30), ("P", "W3", 1, 9), ("P", "R1", 1, 9)],
    )
    assert rows(got, "warehouse_id", "level", "stock", "days_of_stock", "daily") == [
        ("W1", "CRITICO", Decimal("0.00000"), Decimal("0.00"), Decimal("1.00000")),
        ("W3", "ALTO", Decimal("0.00000"), Decimal("0.00"), Decimal("0.30000")),
    ]
    medium = alerts_for(spark, ["stockout"], sales=[("P", "W1", 1, 8.99), ("P", "W2", 1, -2)])
    assert one(medium, "level", "message") == (
        "MEDIO", "Agotado con demanda activa. Venta diaria: 0.30 uds (8.99000 en 30d). Reabastecer urgente.",
    )


def test_products_outside_the_catalog_raise_nothing(spark):
    got = alerts_for(spark, stock=[("X", "W1", 1, 1)], sales=[("X", "W1", 1, 30), ("X", "W2", 1, 30)])
    assert rows(got) == []


def test_all_kinds_equal_the_union_of_each(spark):
    world = dict(
        stock=[("P", "W1", 2, 1), ("P", "W2", 400, 1), ("P", "W3", 9, 1), ("P", "R1", 0, 1)],
        sales=[("P", "W1", 1, 30), ("P", "W2", 1, 30), ("P", "W3", 80, 1)],
    )
    every = alerts_for(spark, **world)
    parts = [r for k in A.rules() for r in rows(alerts_for(spark, [k], **world))]
    assert sorted(map(str, parts)) == sorted(str(r) for r in rows(every))
    counts = one(A.alert_counts(every), "low", "over", "slow", "no_rotation", "stockout", "total")
    assert sum(counts[:5]) == counts[5] == len(parts)


def test_alerts_from_stored_metrics_equal_alerts_from_positions(spark):
    t = tables(
        spark, stock=[("P", "W1", 2, 1), ("P", "W2", 400, 1), ("P", "W3", 9, 1)],
        sales=[("P", "W1", 1, 30), ("P", "W2", 1, 30)],
    )
    position = daily.position_of(t, TODAY)
    stored = metrics.with_dims(metrics.metrics_of(position), t.product_brand, t.warehouses)
    kinds = ["low", "over", "slow", "no_rotation"]
    assert rows(A.alerts(stored, kinds)) == rows(A.alerts(position, kinds))


def test_rebuild_replaces_only_pending_no_rotation(spark):
    t = tables(spark, stock=[("P", "W1", 3, 1), ("P", "W2", 3, 1), ("P", "W3", 3, 1)], sales=[("P", "W1", 60, 1), ("P", "W2", 10, 1)])
    unmoved = A.unmoved_stock(t.sales, t.stock, t.warehouses, TODAY)
    assert rows(unmoved, "warehouse_id", "level") == [("W1", "MEDIO"), ("W3", "ALTO")]
    old = spark.createDataFrame(
        [("SIN_ROTACION", "PENDIENTE"), ("SIN_ROTACION", "VISTA"), ("STOCK_BAJO", "PENDIENTE"), ("SIN_ROTACION", None)],
        "alert_type string, state string",
    )
    new = A.rebuild_no_rotation(old, unmoved, TODAY)
    assert rows(new.groupBy("alert_type", "state").count()) == [
        ("SIN_ROTACION", "PENDIENTE", 2), ("SIN_ROTACION", "VISTA", 1), ("SIN_ROTACION", None, 1),
        ("STOCK_BAJO", "PENDIENTE", 1),
    ]
    assert one(A.rebuild_counts(old, unmoved)) == (1, 2)
