from decimal import Decimal

import pytest
from world import TODAY, days_ago, one, rows, tables

from shelfwise.functions.filters import Filters
from shelfwise.operators import metrics, reports, views
from shelfwise.plans import daily
from shelfwise.sources.trigrams import NameIndex


def alert_rows(spark, n=4, days=0):
    return spark.createDataFrame(
        [("STOCK_BAJO", "ALTO", "P", f"W{i % 3 + 1}", Decimal(i), Decimal(i), Decimal(1), "x", "y", f"m{i}",
          "PENDIENTE", days_ago(days + i)) for i in range(n)],
        "alert_type string, level string, product_id string, warehouse_id string, stock decimal(15,5),"
        " days_of_stock decimal(18,2), daily decimal(15,5), category string, abc_class string,"
        " message string, state string, generated_on date",
    )


def test_alert_list_is_newest_first_with_values(spark):
    t = tables(spark, stock=[("P", "W1", 5, 2), ("P", "R1", 7, 2)])
    got = reports.alert_list(alert_rows(spark), t.stock, t.product_brand, t.warehouses, limit=2)
    assert rows(got, "warehouse_id", "stock_value", "national_stock", "product_name") == [
        ("W1", Decimal("10.0000000000"), Decimal("12.00000"), "Name P"),
        ("W2", Decimal("0E-10"), Decimal("12.00000"), "Name P"),
    ]


def test_alert_list_tag_filter_on_a_left_join(spark):
    """The plain tag keeps alerts without a stock row; another tag drops them."""
    t = tables(spark, stock=[("P", "W1", 5, 2, "OUTLET")])
    run = lambda tags: rows(
        reports.alert_list(alert_rows(spark, 3), t.stock, t.product_brand, t.warehouses, f=Filters.parse(tags=tags)),
        "warehouse_id",
    )
    assert run("INVENTARIO") == [("W2",), ("W3",)]
    assert run("OUTLET") == [("W1",)]


def test_lists_keep_their_order_without_broadcasts(spark):
    t = tables(spark, stock=[("P", f"W{i}", i, 2) for i in (1, 2, 3)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = reports.alert_list(alert_rows(spark, 9), t.stock, t.product_brand, t.warehouses).collect()
        assert [r["message"] for r in got] == [f"m{i}" for i in range(9)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_search_takes_a_backslash_as_it_is(spark):
    t = tables(spark, products=[("P\\1", "A")], stock=[("P\\1", "W1", 1, 1)])
    assert rows(reports.product_search(t.products, t.brands, t.stock, "P\\1"), "product_id") == [("P\\1",)]


def test_levels_sort_as_text_or_by_urgency(spark):
    a = alert_rows(spark, 3).drop("level").join(
        spark.createDataFrame([("m0", "ALTO"), ("m1", "CRITICO"), ("m2", "MEDIO")], "message string, level string"), "message"
    )
    t = tables(spark)
    run = lambda order: [
        r["level"] for r in reports.alert_list_by_level(a, t.product_brand, t.warehouses, 1, order=order).collect()
    ]
    assert run("text") == ["MEDIO"] and run("rank") == ["CRITICO"]


def test_suffix_sum_of_daily_efficiency(spark):
    t = tables(
        spark, stock=[("P", "W1", 10, 1)],
        sales=[("P", "W1", 3, 1, 1), ("P", "W1", 2, 1, 2), ("P", "W1", 1, 1, 3)],
    )
    got = reports.daily_efficiency(t.sales, t.stock, t.stock_daily, t.warehouses, TODAY).orderBy("sale_date").collect()
    assert [int(r["inventory"]) for r in got] == [15, 13, 10]
    assert [r["efficiency"] for r in got] == [6.6667, 15.3846, 30.0]


def test_snapshots_take_precedence_and_zero_inventory_is_zero(spark):
    t = tables(
        spark, stock=[("P", "W1", 10, 1)], sales=[("P", "W1", 2, 1, 5), ("P", "W1", 1, 1, 5)],
        stock_daily=[("P", "W1", 2, 50, 1, None), ("P", "W1", 1, 0, 1, None)],
    )
    got = reports.daily_efficiency(t.sales, t.stock, t.stock_daily, t.warehouses, TODAY).orderBy("sale_date").collect()
    assert [(int(r["inventory"]), r["efficiency"]) for r in got] == [(50, 10.0), (0, 0.0)]


@pytest.mark.parametrize(
    "text, found", [("name", ["P", "Q"]), ("NAME q", ["Q"]), ("cP", ["P"]), ("N_me", ["P", "Q"]), ("x", []), ("zz", []), ("q%", ["Q"])]
)
def test_product_search(spark, text, found):
    t = tables(spark, products=[("P", "A"), ("Q", None)], stock=[("P", "W1", 5, 1), ("P", "W2", 0, 1)])
    got = reports.product_search(t.products, t.brands, t.stock, text)
    assert sorted(r["product_id"] for r in got.collect()) == found
    if "P" in found:
        p = next(r for r in got.collect() if r["product_id"] == "P")
        assert (int(p["stock"]), p["warehouses"], p["brand_name"]) == (5, 1, "Brand A")


def test_product_detail(spark):
    t = tables(spark, stock=[("P", "W1", 5, 1), ("P", "R1", 9, 1), ("P", "W2", 0, 1)], sales=[("P", "W1", 1, 3, 6), ("P", "W9", 1, 1, 1)])
    m = metrics.metrics_of(daily.position_of(t, TODAY)).filter("warehouse_id = 'W1'")
    parts = daily.product_detail(t, m, TODAY, "P")
    assert one(parts["product"], "brand_name", "cover_days") == ("Brand A", 30)
    assert [(r["warehouse_id"], r["stock_state"]) for r in parts["warehouses"].collect()] == [("R1", "SIN_DATOS"), ("W1", "EXCESO")]
    assert [int(x) for x in one(parts["sales"], "units", "amount")] == [4, 7]


def test_top_products_count_warehouses_once(spark):
    t = tables(spark, products=[("P", "A"), ("Q", "D")], sales=[("P", "W1", 1, 2, 1), ("P", "W1", 2, 2, 1), ("P", "R1", 1, 1, 1), ("Q", "W2", 1, 9, 9)])
    run = lambda n, **f: [
        (r["product_id"], int(r["units"]), r["warehouses"])
        for r in reports.top_products(t.sales, t.stock, t.products, t.warehouses, TODAY, n, Filters.parse(**f)).collect()
    ]
    assert run(1) == [("Q", 9, 1)]
    assert run(5, brands="A") == [("P", 5, 2)]


def test_warehouse_list_leaves_unsold_items_out_of_the_mean(spark):
    t = tables(spark, products=[("P", "A"), ("Q", "A")], stock=[("P", "W1", 10, 1), ("Q", "W1", 10, 1), ("P", "W2", 1, 9)], sales=[("P", "W1", 1, 30)])
    m = metrics.metrics_of(daily.position_of(t, TODAY))
    got = reports.by_value(reports.warehouse_list(t.warehouses, m)).collect()
    assert [(r["warehouse_id"], r["products"], r["mean_days"]) for r in got] == [("W1", 2, 10.0), ("W2", 1, None), ("W3", 0, None)]


def empty_alerts(spark):
    return alert_rows(spark, 0 + 1).filter("false")


@pytest.mark.parametrize(
    "tags, kept",
    [("", ["EMPTY", "NORTH", "SOUTH"]), ("INVENTARIO", ["EMPTY", "NORTH", "SOUTH"]), ("OUTLET", ["NORTH"])],
)
def test_region_cards_and_tags(spark, tags, kept):
    t = tables(spark, stock=[("P", "W1", 5, 2, "OUTLET"), ("P", "W2", 5, 4)], sales=[("P", "R1", 1, 1, 7)])
    moves = spark.createDataFrame([("NORTH", 3)], "to_region string, transfers long")
    got = reports.region_cards(t.regions, t.warehouses, t.stock, t.sales, empty_alerts(spark), moves, TODAY, Filters.parse(tags=tags))
    found = {r["region_id"]: r for r in got.collect()}
    assert sorted(found) == kept
    assert found["NORTH"]["transfers"] == 3
    expected = {"": (2, 30, 100.0), "INVENTARIO": (1, 20, 100.0), "OUTLET": (1, 10, 100.0)}[tags]
    north = found["NORTH"]
    assert (north["sales_points"], int(north["stock_value"]), north["stock_pct"]) == expected
    if "SOUTH" in found:
        assert int(found["SOUTH"]["sold_amount"]) == 7


def test_warehouse_cards_turnover(spark):
    t = tables(spark, stock=[("P", "W1", 5, 2)], sales=[("P", "W1", 1, 1, 3)])
    a = alert_rows(spark, 3)
    got = {r["warehouse_id"]: r for r in reports.warehouse_cards(t.warehouses, t.stock, t.sales, a, TODAY).collect()}
    assert got["W1"]["turn_pct"] == 30.0 and got["W2"]["turn_pct"] == 0.0 and got["W1"]["low"] == 1
    assert sorted(got) == ["W1", "W2", "W3"]


def test_brand_breakdown_with_brandless_products(spark):
    t = tables(
        spark, products=[("P", "A"), ("N", None), ("M", None)],
        stock=[("P", "W1", 3, 1), ("N", "W1", 1, 1), ("M", "W2", 0, 1), ("X", "W1", 6, 1)],
        sales=[("N", "W1", 10, 2, 4), ("M", "W1", 10, 1, 1), ("P", "W1", 40, 9, 9)],
    )
    got = reports.brand_breakdown(t.stock, t.sales, t.product_brand, t.warehouses, TODAY)
    assert rows(got, "brand_id", "brand_name", "products", "value_pct", "sold_amount", "turn_pct", "range_days") == [
        ("A", "Brand A", 1, 30.0, Decimal("0.00000"), 0.0, 30),
        (None, "Sin marca", 1, 10.0, Decimal("5.00000"), 500.0, 30),
    ]
    same_day = reports.brand_breakdown(t.stock, t.sales, t.product_brand, t.warehouses, TODAY, days_ago(40), days_ago(40))
    assert ("A", Decimal("9.00000"), 1) in rows(same_day, "brand_id", "sold_amount", "range_days")


def test_tag_choices_and_summary(spark):
    t = tables(spark, stock=[("P", "W1", 1, 1, "  "), ("P", "W2", 1, 1), ("Q", "W1", 1, 1, "OUTLET"), ("Q", "W2", 0, 1, "OUTLET")])
    assert rows(reports.tag_choices(t.stock)) == [("INVENTARIO", 1), ("OUTLET", 1)]
    assert rows(reports.tag_summary(t.stock, t.warehouses), "stock_tag", "items") == [("  ", 1), ("OUTLET", 1), ("SIN_OBSERVACION", 1)]


def test_choices(spark):
    got = daily.choices(tables(spark))
    assert [r["region_id"] for r in got["regions"].collect()] == ["EMPTY", "NORTH", "SOUTH"]
    assert [r["name"] for r in got["warehouses"].collect()] == ["One", "Three", "Two"]
    assert got["priorities"][0] == "URGENTE" and got["tags"].count() == 0


FAN = dict(
    products=[("P", "A"), ("Q", "A")],
    stock=[("P", "W1", 10, 1), ("Q", "W1", 30, 2), ("P", "W2", 5, 1)],
    sales=[("P", "W1", 1, 2, 20), ("P", "W1", 2, 3, 30), ("Q", "W1", 2, 1, 5), ("P", "W3", 1, 4, 40)],
)


def test_views_repeat_sums_unless_corrected(spark):
    t = tables(spark, **FAN)
    pick = ("warehouse_id", "sold_units", "stock_value", "mean_stock", "products_sold", "products_stocked")
    run = lambda c: {r[0]: [float(x) for x in r[1:]] for r in rows(views.warehouse_efficiency(t.sales, t.stock, t.warehouses, TODAY, c), *pick)}
    assert run(False) == {"W1": [12, 210, 20, 2, 2], "W2": [0, 5, 5, 0, 1], "W3": [4, 0, 0, 1, 0]}
    assert run(True) == {"W1": [6, 70, 20, 2, 2], "W2": [0, 5, 5, 0, 1], "W3": [4, 0, 0, 1, 0]}
    region = lambda c: {r[0]: [float(x) for x in r[1:]] for r in rows(views.region_efficiency(t.sales, t.stock, t.warehouses, t.regions, TODAY, c), "region_id", "sales_points", "stock_value", "sold_over_available_pct")}
    assert region(False) == {"NORTH": [2, 215, 9.6], "SOUTH": [1, 0, 0], "EMPTY": [0, 0, 0]}
    assert region(True) == {"NORTH": [2, 75, 13.33], "SOUTH": [1, 0, 0], "EMPTY": [0, 0, 0]}


def test_brand_summary_modes(spark):
    t = tables(spark, **FAN)
    pick = ("brand_id", "products", "units", "sold_units", "mean_days")
    run = lambda c: {r[0]: [float(x) for x in r[1:]] for r in rows(views.brand_summary(t.brands, t.products, t.stock, t.sales, TODAY, c), *pick)}
    assert run(False)["A"] == [2, 45, 19, 12.7] and run(True)["A"] == [2, 45, 10, 135.0]
    assert run(False)["D"] == [0, 0, 0, 0]


def test_stock_by_type_keeps_empty_types(spark):
    t = tables(spark, **FAN)
    assert rows(views.stock_by_type(t.warehouse_types, t.warehouses, t.stock), "wtype", "warehouses", "products") == [
        ("Otro", 0, 0), ("Reserva", 1, 0), ("Venta", 3, 2),
    ]


def test_views_on_metrics(spark):
    t = tables(
        spark, products=[("P", "A"), ("Q", "D"), ("N", None)],
        stock=[("P", "W1", 2, 1), ("P", "R1", 100, 1), ("Q", "W1", 100, 1), ("N", "W1", 2, 1)],
        sales=[("P", "W1", 1, 30), ("N", "W1", 1, 30)],
    )
    m = metrics.metrics_of(daily.position_of(t, TODAY))
    args = (m, t.product_brand, t.warehouses)
    assert one(views.critical_products(*args), "product_id", "attention_rank", "message") == ("P", 1, "CRÍTICO - Menos de 3 días")
    assert one(views.overstock(*args), "product_id", "warehouse_id", "excess_days") == ("P", "R1", Decimal("9969.00"))
    low = views.low_rotation(*args)
    assert rows(low, "product_id", "rotation") == [("P", "SIN MOVIMIENTO 90 DÍAS"), ("Q", "ESPERADO (Marca clase D)")]
    assert [r["product_id"] for r in views.in_view_order("low_rotation", low).collect()] == ["P", "Q"]


@pytest.mark.parametrize("text", ["ring", "RING", "r_ng", "ri%g", "in", "a%b", "x1y", "P\\1", "ñandú", "ring 2", "zzz", "%", "ng 2"])
def test_search_by_index_equals_a_full_scan(spark, tmp_path, text):
    names = ["Ring 2 mm", "Spring", "r-ng", "RiNg", "ranger", "Ñandú", "a very long b", "x", None]
    t = tables(spark)
    products = spark.createDataFrame(
        [(f"P\\{i}" if i == 1 else f"P{i}", n, None if i == 3 else f"X{i}Y{i}", "A") for i, n in enumerate(names)],
        "product_id string, name string, code string, brand_id string",
    )
    index = NameIndex(spark, str(tmp_path))
    assert index.candidates("ring") is None  # nothing was built
    index.build(products.filter("product_id < 'P4'"))
    index.add(products.filter("product_id >= 'P4'"))
    got = rows(index.search(products, t.brands, t.stock, text), "product_id")
    assert got == rows(reports.product_search(products, t.brands, t.stock, text), "product_id")


def test_a_search_reads_only_its_postings(spark, tmp_path):
    products = spark.createDataFrame([(f"P{i}", f"name {i}", "A", "A") for i in range(50)], "product_id string, name string, code string, brand_id string")
    index = NameIndex(spark, str(tmp_path))
    index.build(products)
    plan = spark._jvm.PythonSQLUtils.explainString(index.candidates("ame 49")._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram" in plan
    assert rows(index.candidates("ame 49"), "product") == [("P49",)]
