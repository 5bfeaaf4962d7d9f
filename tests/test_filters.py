import pytest
from world import TODAY, days_ago, rows, tables

from shelfwise.functions import filters as Fl
from shelfwise.functions.sizes import broadcast_if_small, is_small


@pytest.mark.parametrize(
    "text, values",
    [(None, []), ("", []), (" , ,", []), ("a", ["a"]), (" a , b ,,c", ["a", "b", "c"]), (["x"], ["x"])],
)
def test_parse_list(text, values):
    assert Fl.parse_list(text) == values


@pytest.mark.parametrize(
    "tags, kept",
    [
        ([], [None, "", "  ", "PROYECTOS", "OUTLET"]),
        (["INVENTARIO"], [None, ""]),
        (["OUTLET"], ["OUTLET"]),
        (["INVENTARIO", "OUTLET"], [None, "", "OUTLET"]),
        (["NONE SUCH"], []),
    ],
)
def test_tag_matches(spark, tags, kept):
    df = spark.createDataFrame([(t,) for t in (None, "", "  ", "PROYECTOS", "OUTLET")], "stock_tag string")
    got = [r[0] for r in df.filter(Fl.tag_matches("stock_tag", tags)).collect()]
    assert got == kept


def test_is_one_of_without_values_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    assert df.filter(Fl.is_one_of("x", [])).count() == 2
    assert df.filter(Fl.is_one_of("x", ["a"])).count() == 1


def test_look_back_includes_both_ends(spark):
    df = spark.createDataFrame([(days_ago(n), n) for n in (-1, 0, 30, 31)], "sale_date date, n int")
    assert [r["n"] for r in Fl.look_back(df, TODAY, 30).collect()] == [0, 30]


def test_project_products_are_dropped_whole(spark):
    t = tables(spark, stock=[("P", "W1", 1, 1, "PROYECTOS"), ("P", "W2", 1, 1), ("Q", "W1", 1, 1)])
    assert rows(Fl.without_projects(t.stock, t.stock), "product_id") == [("Q",)]


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(10)
    assert is_small(df, 10) and not is_small(df, 9)
    hinted = broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(df, 9)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_dimensions_over_the_bound_give_the_same_rows_without_hints(spark):
    from shelfwise.operators import metrics
    from shelfwise.plans import daily

    t = tables(spark, stock=[("P", "W1", 5, 1), ("P", "R1", 5, 1)], sales=[("P", "W1", 1, 3)]).checked()
    assert t.small == {"warehouse_types", "regions", "warehouses", "brands", "products"}
    bare = tables(spark, stock=[("P", "W1", 5, 1), ("P", "R1", 5, 1)], sales=[("P", "W1", 1, 3)])
    large = type(t)(**{**{n: getattr(bare, n) for n in ("sales", "stock", "warehouse_types", "stock_daily")},
                       "products": spark.createDataFrame([("P", "CP", "Name P", "A")], t.products.schema),
                       "brands": spark.createDataFrame([tuple(r) for r in t.brands.collect()], t.brands.schema),
                       "warehouses": spark.createDataFrame([tuple(r) for r in t.warehouses.collect()], t.warehouses.schema),
                       "regions": t.regions}).checked(max_rows=0)
    assert large.small == frozenset()
    a = rows(metrics.metrics_of(daily.position_of(t, TODAY)))
    assert a == rows(metrics.metrics_of(daily.position_of(large, TODAY))) and len(a) == 2
