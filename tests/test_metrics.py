import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from world import TODAY, one, rows, tables

from shelfwise import Params
from shelfwise.functions.sizes import Scratch
from shelfwise.operators import metrics
from shelfwise.plans import daily


def metrics_for(spark, **world):
    return metrics.metrics_of(daily.position_of(tables(spark, **world), TODAY))


@pytest.mark.parametrize(
    "days, cover, state",
    [
        ("2.99", 30, "CRITICO"), ("3", 30, "BAJO"), ("6.99", 30, "BAJO"), ("7", 30, "MEDIO"),
        ("14.99", 30, "MEDIO"), ("15", 30, "NORMAL"), ("30", 30, "NORMAL"), ("30.01", 30, "SOBRE"),
        ("45", 30, "SOBRE"), ("45.01", 30, "EXCESO"), ("4", 2, "BAJO"), ("9999", 30, "EXCESO"),
        ("0.00", 30, "EXCESO"), ("40", 0, "SOBRE"), (None, 30, "EXCESO"), ("31", None, "SOBRE"),
    ],
)
def test_state_bounds(spark, days, cover, state):
    value = None if days is None else Decimal(days)
    df = spark.createDataFrame([(value, cover)], "d decimal(18,2), c int")
    assert one(df.select(metrics.stock_state(F.col("d"), F.col("c")))) == (state,)


def test_derived_values(spark):
    m = metrics_for(spark, stock=[("P", "W1", 10, 2.5)], sales=[("P", "W1", 1, 15), ("P", "W1", 20, 15)])
    got = one(
        m, "stock_value", "q7", "q30", "q90", "daily", "days_of_stock", "turn",
        "reorder_point", "safety_stock", "stock_max", "stock_state", "needs_transfer", "needs_purchase",
    )
    assert [str(x) for x in got] == [
        "25.00", "15.00000", "30.00000", "30.00000", "1.00000", "10.00", "3.0000",
        "12.00000", "7.00000", "30.00000", "MEDIO", "False", "False",
    ]


def test_look_back_edges(spark):
    m = metrics_for(
        spark,
        stock=[("P", "W1", 10, 1)],
        sales=[("P", "W1", n, 1) for n in (0, 7, 8, 30, 31, 90, 91, -1)],
    )
    assert [int(x) for x in one(m, "q7", "q30", "q90", "sales_rows_30d")] == [2, 4, 6, 4]


def test_no_sales_means_excess(spark):
    m = metrics_for(spark, stock=[("P", "W1", 10, 1)])
    assert one(m, "days_of_stock", "turn", "stock_state") == (Decimal("9999.00"), Decimal("0.0000"), "EXCESO")


def test_days_rounding_to_zero_keep_zero_but_state_excess(spark):
    m = metrics_for(spark, stock=[("P", "W1", 0.001, 1)], sales=[("P", "W1", 1, 30000)])
    assert one(m, "days_of_stock", "stock_state") == (Decimal("0.00"), "EXCESO")


def test_net_negative_sales_have_no_days(spark):
    m = metrics_for(spark, stock=[("P", "W1", 5, 1)], sales=[("P", "W1", 1, -3)])
    assert one(m, "days_of_stock", "daily") == (Decimal("9999.00"), Decimal("-0.10000"))


def test_zero_and_negative_stock_have_no_metrics(spark):
    m = metrics_for(spark, stock=[("P", "W1", 0, 1), ("P", "W2", -2, 1)], sales=[("P", "W1", 1, 3)])
    assert rows(m) == []


def test_brandless_and_unknown_products_use_defaults(spark):
    m = metrics_for(
        spark,
        products=[("P", None)],
        stock=[("P", "W1", 10, 1), ("X", "W1", 10, 1)],
        sales=[("P", "W1", 1, 30), ("X", "W1", 1, 30)],
    )
    assert {r[1:] for r in rows(m, "product_id", "reorder_point", "stock_max")} == {
        (Decimal("18.00000"), Decimal("30.00000"))
    }


def test_reserve_warehouse_sales_do_not_count(spark):
    m = metrics_for(spark, stock=[("P", "R1", 10, 1)], sales=[("P", "R1", 1, 30)])
    assert one(m, "q30") == (Decimal("0.00000"),)


def test_as_of_moves_every_window(spark):
    t = tables(spark, stock=[("P", "W1", 10, 1)], sales=[("P", "W1", 40, 5)])
    m = metrics.metrics_of(daily.position_of(t, TODAY - dt.timedelta(days=20)))
    assert one(m, "q30") == (Decimal("5.00000"),)


def test_params_change_the_thresholds(spark):
    t = tables(spark, stock=[("P", "W1", 10, 1)], sales=[("P", "W1", 1, 30)])
    m = metrics.metrics_of(daily.position_of(t, TODAY, Params(critical_days=11)))
    assert one(m, "stock_state") == ("CRITICO",)


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_abc_classes_match_a_full_sort(spark, parts):
    """Many ties, and one value of a third of all rows that fills several partitions."""
    values = [500] * 100 + [(i * 37) % 91 + i % 7 for i in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with Scratch(spark) as scratch:
            found = metrics.abc_classes(df, "v", "k", scratch)
            plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
            got = {r["k"]: r["abc_class"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = sum(values)
    for k, v in enumerate(values):
        share = sum(x for x in values if x > v) / total
        assert got[k] == ("A" if share < 0.8 else "B" if share < 0.95 else "C")
    assert "SortMergeJoin [v#" not in plan and "ShuffledHashJoin [v#" not in plan


def test_network_metrics_one_row_per_product(spark):
    t = tables(
        spark,
        stock=[("P", "W1", 10, 2), ("P", "W2", 0, 2), ("P", "R1", 20, 2)],
        sales=[("P", "W1", 1, 30, 300)],
    )
    n = metrics.network_metrics(t.sales, t.stock, t.warehouses, TODAY, Scratch(spark))
    got = one(
        n, "stock", "sales_point_stock", "warehouses_with_stock", "sales_points_with_stock",
        "sales_points_without_stock", "days_of_stock", "abc_class",
    )
    assert [str(x) for x in got] == ["30.00000", "10.00000", "2", "1", "1", "30.00", "A"]
