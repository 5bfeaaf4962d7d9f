import datetime as dt
from decimal import Decimal

import pytest
from world import TODAY, one, rows, tables

from shelfwise.operators import purchases as P
from shelfwise.plans import daily


def stored(spark, **world):
    t = tables(spark, **world)
    return P.purchases(t.sales, t.stock, t.product_brand, t.warehouses, TODAY)


def live(spark, limit=None, world=None, **kw):
    t = tables(spark, **world)
    return P.purchases_live(t.sales, t.stock, t.product_brand, t.warehouses, TODAY, limit=limit, **kw)


@pytest.mark.parametrize(
    "stock, priority", [(9, "URGENTE"), (16, "ALTA"), (29, "MEDIA"), (39, "BAJA"), (40, None)]
)
def test_priority_bands(spark, stock, priority):
    got = stored(spark, stock=[("P", "W1", stock, 2)], sales=[("P", "W1", 1, 30)])
    assert rows(got, "priority") == ([(priority,)] if priority else [])


def test_amounts_and_order_date(spark):
    got = stored(
        spark,
        brands=[("A", "PRINCIPAL", "A", 60, 22)],
        stock=[("P", "W1", 50.7, 2), ("P", "R1", 0, 4)],
        sales=[("P", "W1", 1, 30)],
    )
    assert one(got, "stock_network", "projected", "qty", "cover_now", "unit_cost", "purchase_value", "order_date") == (
        Decimal("50.70000"), Decimal("30.00000"), Decimal("31.00000"), Decimal("50.70"),
        Decimal("3.00000"), Decimal("93.00"), TODAY + dt.timedelta(days=21),
    )


def test_only_main_brands_with_terms(spark):
    got = stored(
        spark,
        products=[("P", "D"), ("N", None)],
        sales=[("P", "W1", 1, 30), ("N", "W1", 1, 30)],
    )
    assert rows(got) == []


def test_quantity_rounding_to_zero_drops_the_row(spark):
    got = stored(spark, stock=[("P", "W1", 0.01, 1)], sales=[("P", "W1", 1, 0.3)])
    assert rows(got) == []


def test_live_covers_all_brands_with_defaults_and_ceil(spark):
    got = live(spark, world=dict(products=[("P", None)], stock=[("P", "W1", 0.5, 2)], sales=[("P", "W1", 1, 2)]))
    assert one(got, "qty", "priority", "cover_now", "unit_cost", "state") == (
        Decimal("3.00000"), "URGENTE", Decimal("7.5"), 2.0, "CALCULADO",
    )


def test_live_cost_falls_back_to_sales_then_zero(spark):
    world = dict(
        products=[("P", "A"), ("Q", "A")],
        stock=[("P", "W1", 1, 0)],
        sales=[("P", "W1", 1, 3, 31), ("P", "R1", 1, 1, 9), ("Q", "W1", 1, 3, 0)],
    )
    assert rows(live(spark, world=world), "product_id", "unit_cost") == [("P", 10.0), ("Q", 0.0)]


def test_live_leaves_out_project_products_and_filters_tags(spark):
    world = dict(
        products=[("P", "A"), ("Q", "A"), ("R", "A")],
        stock=[("P", "W1", 1, 1, "PROYECTOS"), ("P", "W2", 1, 1), ("Q", "W1", 1, 1, "OUTLET")],
        sales=[(p, "W1", 1, 30) for p in "PQR"],
    )
    assert rows(live(spark, world=world), "product_id") == [("Q",), ("R",)]
    assert rows(live(spark, world=world, tags=["OUTLET"]), "product_id") == [("Q",)]
    assert rows(live(spark, world=world, tags=["INVENTARIO"]), "product_id") == []


def test_priority_filter_before_or_after_the_limit(spark):
    world = dict(
        products=[("P", "A"), ("Q", "A")],
        stock=[("Q", "W1", 29, 1)],
        sales=[("P", "W1", 1, 30), ("Q", "W1", 1, 30)],
    )
    assert rows(live(spark, 1, world, priority="MEDIA"), "product_id") == [("Q",)]
    assert rows(live(spark, 1, world, priority="MEDIA", filter_after_limit=True)) == []


def test_list_uses_stored_rows_if_any_are_pending(spark):
    t = tables(spark, stock=[("P", "W1", 9, 2)], sales=[("P", "W1", 1, 30)])
    fresh = P.purchases(t.sales, t.stock, t.product_brand, t.warehouses, TODAY).selectExpr("*", "'PENDIENTE' AS state")
    assert one(daily.purchase_list(t, fresh, TODAY), "state", "brand_name") == ("PENDIENTE", "Brand A")
    done = fresh.drop("state").selectExpr("*", "'HECHA' AS state")
    for nothing in (done, None):
        assert one(daily.purchase_list(t, nothing, TODAY), "state") == ("CALCULADO",)
    assert one(daily.kpi_purchases(t, fresh, TODAY), "purchases", "purchase_value") == (1, Decimal("62.00"))
    assert one(daily.kpi_purchases(t, None, TODAY), "purchases", "purchase_value") == (1, 72.0)
