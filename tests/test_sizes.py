"""What a task takes does not grow with the tables."""

import os

from pyspark.sql import functions as F
from world import TODAY, rows, tables

from shelfwise.functions import sizes
from shelfwise.operators import alerts as A
from shelfwise.plans import daily
from shelfwise.sources import storage
from shelfwise.sources.changelog import ChangeLog, tag_stock


def test_tasks_are_bounded_and_what_the_session_was_told_stays(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "7m")
    sizes.bound_tasks(session, 40 * sizes.PARTITION_ROWS)
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "7m"
    found = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.conf.get(found) == "40"
    sizes.bound_tasks(session, sizes.PARTITION_ROWS)
    assert session.conf.get(found) == "40"


def test_alerts_are_raised_without_interpreted_filters(spark):
    t = tables(spark, stock=[("P", "W1", 2, 1)], sales=[("P", "W1", 1, 30)])
    raised = A.alerts(daily.position_of(t, TODAY))
    plan = spark._jvm.PythonSQLUtils.explainString(raised._jdf.queryExecution(), "simple")
    assert "lambda" not in plan


def test_stock_of_many_warehouses_lies_in_few_parts(spark, tmp_path):
    root = str(tmp_path)
    ids = spark.range(1000).select(
        F.concat(F.lit("W"), "id").alias("warehouse_id"), F.lit("P").alias("product_id"), (F.col("id") % 2).alias("qty")
    )
    storage.replace_partitions(ids, root, "stock", spread=True)
    assert len([n for n in os.listdir(f"{root}/stock") if "=" in n]) <= 64
    items = ids.filter("qty = 0").select("product_id", "warehouse_id")
    assert tag_stock(spark, root, items.filter("warehouse_id < 'W2'"), "X", 1, "a") == items.filter("warehouse_id < 'W2'").count()
    log = ChangeLog(spark, root, "stock")
    before = rows(log.current())
    assert log.compact() == 1 and rows(storage.read_table(spark, root, "stock")) == before
    assert len(before) == 1000 and {r[5] for r in before} == {None, "X"}


def test_sums_of_days_are_a_file_a_day(spark, tmp_path):
    from shelfwise.sources.rolling import RollingSales

    root = str(tmp_path)
    t = tables(spark, sales=[(f"P{i}", f"W{i}", n, 1, 1) for i in range(20) for n in (0, 1)])
    storage.append_sales(t.sales, root, "a")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with many rows
    try:
        RollingSales(spark, root).sum_days([TODAY])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = os.listdir(f"{root}/daily_sums/sale_date={TODAY}")
    assert len([f for f in files if f.endswith(".parquet")]) == 1
    assert storage.read_table(spark, root, "daily_sums").count() == 20


def test_a_back_load_with_nothing_to_do_reads_no_records(spark, tmp_path):
    from shelfwise.plans import backload

    root = str(tmp_path)
    noted = spark.range(1).select(
        F.lit(TODAY).alias("start_date"), F.lit(TODAY).alias("end_date"), F.lit("done").alias("status")
    )
    storage.replace_partitions(noted, root, "backload_slices")
    unreadable = spark.range(1).selectExpr("'s' AS seq", "CAST(raise_error('read') AS string) AS FECHA")
    assert backload.back_load(spark, root, unreadable, TODAY, TODAY).count() == 1


def test_landed_pages_hold_more_documents_where_there_are_more():
    from shelfwise.plans.catalog import MOST_PAGE_DOCUMENTS, _landed_documents

    assert [_landed_documents(n) for n in (0, 150_000, 900_000)] == [200, 200, 900]
    assert _landed_documents(54_000_000) == MOST_PAGE_DOCUMENTS
