import datetime as dt
import random
from decimal import Decimal

from world import rows

from shelfwise.functions.sizes import Scratch
from shelfwise.operators import lifecycle, merges
from shelfwise.sources.ledger import SalesKeys

SALES = "doc_prefix string, doc_no string, product_id string, qty int, seq int"


def test_first_sale_wins_and_null_keys_never_conflict(spark):
    batch = spark.createDataFrame(
        [("A", "1", "P", 1, 1), ("A", "1", "P", 2, 2), (None, "1", "P", 3, 3), (None, "1", "P", 4, 4), ("A", "2", "P", 5, 5)],
        SALES,
    )
    old = spark.createDataFrame([("A", "2", "P", 9, 0), (None, "1", "P", 8, 0)], SALES)
    assert rows(merges.new_sales(old, batch, ["seq"]), "qty") == [(1,), (3,), (4,)]
    once = merges.merge_sales(old, batch, ["seq"])
    assert rows(once, "qty") == [(1,), (3,), (4,), (8,), (9,)]
    keyed = batch.filter("doc_prefix IS NOT NULL")
    assert merges.new_sales(once, keyed, ["seq"]).count() == 0


def test_one_key_on_most_rows_is_reduced_to_its_first_row(spark):
    batch = spark.range(5000).selectExpr(
        "'A' AS doc_prefix", "CAST(IF(id % 3 = 0, 0, id) AS string) AS doc_no", "'P' AS product_id",
        "CAST(id AS int) AS qty", "CAST(id AS int) AS seq",
    )
    got = merges.new_sales(None, batch, ["seq"])
    ids = {0} | {i for i in range(5000) if i % 3}
    assert got.count() == len(ids)
    assert rows(got.filter("doc_no = '0'"), "qty") == [(0,)]


STOCK = "warehouse_id string, product_id string, qty decimal(15,5), seq int"


def test_last_stock_row_wins_and_missing_rows_stay_or_go_to_zero(spark):
    old = spark.createDataFrame([("W", "P", Decimal(1)), ("W", "Q", Decimal(2))], "warehouse_id string, product_id string, qty decimal(15,5)")
    batch = spark.createDataFrame([("W", "P", Decimal(7), 1), ("W", "P", Decimal(8), 2), ("V", "P", Decimal(3), 3)], STOCK)
    merged = merges.merge_stock(old, batch, ["seq"])
    value = lambda df: [(r[0], r[1], int(r[2])) for r in rows(df)]
    assert value(merged) == [("V", "P", 3), ("W", "P", 8), ("W", "Q", 2)]
    assert value(merges.merge_stock(merged, batch, ["seq"])) == value(merged)
    assert value(merges.merge_stock(old, batch, ["seq"], zero_missing=True)) == [("V", "P", 3), ("W", "P", 8), ("W", "Q", 0)]


def test_snapshot_key_includes_the_date(spark):
    schema = "snapshot_date date, warehouse_id string, product_id string, qty int"
    old = spark.createDataFrame([(dt.date(2025, 1, 1), "W", "P", 1), (dt.date(2025, 1, 2), "W", "P", 2)], schema)
    batch = spark.createDataFrame([(dt.date(2025, 1, 2), "W", "P", 9, 1)], schema + ", seq int")
    assert rows(merges.merge_snapshot(old, batch, ["seq"]), "qty") == [(1,), (9,)]


def test_product_update_keeps_the_brand(spark):
    cols = "product_id string, code string, name string, uom string, product_class string, product_group string, product_line string, brand_id string"
    old = spark.createDataFrame([("P", "1", "old", "u", None, None, None, "A"), ("N", "2", "n", None, None, None, None, None), ("K", "3", "kept", None, None, None, None, "A")], cols)
    brands = spark.createDataFrame([("B", "Brand B text")], "brand_id string, source_name string")
    batch = spark.createDataFrame(
        [("P", "9", "new", None, "c", None, None, "Brand B text"), ("N", "9", "n2", None, None, None, None, "Brand B text"),
         ("Z", "4", "z", None, None, None, None, "Brand B text"), ("Y", "5", "y", None, None, None, None, "other")],
        cols.replace("brand_id", "source_brand"),
    )
    mapped = merges.map_brands(batch, brands)
    got = merges.merge_products(old, mapped)
    assert rows(got, "product_id", "name", "uom", "product_class", "brand_id") == [
        ("K", "kept", None, None, "A"), ("N", "n2", None, None, None), ("P", "new", None, "c", "A"),
        ("Y", "y", None, None, "other"), ("Z", "z", None, None, "B"),
    ]
    assert rows(merges.merge_products(got, mapped)) == rows(got)


DAY = dt.date(2025, 1, 1)
AT = dt.datetime(2025, 1, 2, 3)


def test_alert_status_takes_the_last_valid_change(spark):
    a = spark.createDataFrame(
        [("T", p, "W", DAY, "PENDIENTE", None, None) for p in "PQR"],
        "alert_type string, product_id string, warehouse_id string, generated_on date, state string, handled_by string, handled_at timestamp",
    )
    c = spark.createDataFrame(
        [("T", "P", "W", DAY, "VISTA", "u1", AT, 1), ("T", "P", "W", DAY, "ATENDIDA", "u2", AT, 2), ("T", "P", "W", DAY, "BORRADA", "u3", AT, 3), ("T", "Q", "W", DAY, None, "u4", AT, 4)],
        "alert_type string, product_id string, warehouse_id string, generated_on date, state string, user string, at timestamp, seq int",
    )
    got = lifecycle.apply_alert_status(a, c)
    assert rows(got, "product_id", "state", "handled_by") == [("P", "ATENDIDA", "u2"), ("Q", "PENDIENTE", None), ("R", "PENDIENTE", None)]
    assert lifecycle.rejected_changes(c, ["VISTA", "ATENDIDA", "IGNORADA"]).count() == 2


def test_transfer_time_is_kept_unless_executed(spark):
    t = spark.createDataFrame(
        [(p, "A", "B", DAY, "PENDIENTE", False, None) for p in "PQ"],
        "product_id string, from_id string, to_id string, generated_on date, state string, executed boolean, executed_at timestamp",
    )
    change = lambda p, s, n: (p, "A", "B", DAY, s, AT, n)
    schema = "product_id string, from_id string, to_id string, generated_on date, state string, at timestamp, seq int"
    once = lifecycle.apply_transfer_status(t, spark.createDataFrame([change("P", "EJECUTADO", 1), change("Q", "APROBADO", 1)], schema))
    assert rows(once, "product_id", "state", "executed", "executed_at") == [("P", "EJECUTADO", True, AT), ("Q", "APROBADO", False, None)]
    twice = lifecycle.apply_transfer_status(once, spark.createDataFrame([change("P", "RECHAZADO", 1)], schema))
    assert rows(twice, "product_id", "state", "executed", "executed_at")[0] == ("P", "RECHAZADO", False, AT)


def test_retag(spark):
    s = spark.createDataFrame([("P", "W", "OLD"), ("Q", "W", None)], "product_id string, warehouse_id string, stock_tag string")
    items = spark.createDataFrame([("P", "W"), ("P", "W"), ("Q", ""), ("Z", "W")], "product_id string, warehouse_id string")
    assert rows(lifecycle.retag_stock(s, items, " NEW ")) == [("P", "W", "NEW", True), ("Q", "W", None, False)]
    assert rows(lifecycle.retag_stock(s, items, "  "))[0] == ("P", "W", None, True)


def test_a_large_batch_is_formed_once_for_its_keys(spark, tmp_path):
    keys = SalesKeys(spark, str(tmp_path), buckets=2)
    row = ["IF(id = 9, NULL, 'A') AS doc_prefix", "CAST(id AS string) AS doc_no", "'P' AS product_id"]
    keys.add(spark.range(0, 4).selectExpr(*row), "old")
    batch = spark.range(2, 10).selectExpr(*row, "id AS seq")
    fresh = merges.new_sales(keys.stored(), batch, ["seq"], large=True)
    assert rows(fresh, "doc_no") == rows(merges.new_sales(keys.stored(), batch, ["seq"]), "doc_no")
    assert rows(fresh, "doc_no") == [(str(i),) for i in range(4, 10)]
    assert fresh._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2  # rows with a whole key, and the others


def test_rows_of_one_order_are_told_apart_and_no_column_is_taken_twice(spark):
    df = spark.createDataFrame([("A", 1, 7), ("A", 1, 5), ("A", 2, 1), ("B", None, 4), ("B", 0, 9)], "k string, o int, v int")
    first, last = (merges.one_per_key(df, ["k"], ["o"], last=way) for way in (False, True))
    assert rows(first, "k", "o", "v") == [("A", 1, 5), ("B", None, 4)]
    assert rows(last, "k", "o", "v") == [("A", 2, 1), ("B", 0, 9)]
    assert "min_by" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_a_row_whose_key_came_once_is_not_shuffled(spark):
    rng = random.Random(5)
    text = lambda n: rng.choice([None, *"abcdef"[:n]])
    data = [(text(2), text(6), text(6), rng.randrange(4), i % 7) for i in range(300)]
    ddl = "doc_prefix string, doc_no string, product_id string, seq int, qty int"
    batch, stored = spark.createDataFrame(data, ddl), spark.createDataFrame(data[:40], ddl).select(*merges.SALES_KEY)
    plain = lambda df: sorted((tuple(r) for r in df.select(*batch.columns).collect()), key=str)
    with Scratch(spark) as scratch:
        kept = scratch.keep(batch)
        got = merges.new_sales(stored, kept, ["seq"], scratch=scratch)
        assert plain(got) == plain(merges.new_sales(stored, batch, ["seq"]))
        got = merges.new_sales(stored.limit(0), scratch.keep(batch.dropDuplicates(merges.SALES_KEY)), ["seq"], scratch=scratch)
        first = got._jdf.queryExecution().optimizedPlan().toString()
        assert first.count("Aggregate") == 1  # of the rows that are contested, here none; the others pass
        assert plain(got) == plain(merges.new_sales(None, batch.dropDuplicates(merges.SALES_KEY), ["seq"]))
