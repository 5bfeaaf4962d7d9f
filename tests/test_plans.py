"""What the physical plans must and must not contain."""

import os

import pytest
from world import TODAY, days_ago, tables

import __spark_entry__ as entry
from shelfwise import schemas
from shelfwise.functions.filters import look_back
from shelfwise.operators import merges, reports
from shelfwise.operators import transfers as T
from shelfwise.plans import daily
from shelfwise.plans.catalog import CATALOG
from shelfwise.sources import storage
from shelfwise.sources.ledger import SalesKeys

SF_DIR = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def plan_of(df, mode="simple"):
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@data
@pytest.mark.parametrize("name", list(CATALOG))
def test_no_cross_join_no_python_no_collected_group(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "collect_list", "collect_set"):
        assert word not in plan, word


@data
def test_all_alerts_read_each_fact_once(spark):
    plan = plan_of(entry.queries()["alerts_all"](spark, SF_DIR))
    facts = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(facts) == 2  # once as stock, once as sales
    assert plan.count("SortMergeJoin") == 1 and "FullOuter" in plan


@data
def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["sales_lookback"](spark, SF_DIR))
    fact = next(line for line in plan.splitlines() if "lineitem" in line)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in fact


def test_date_filters_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    t = tables(spark, sales=[("P", "W1", n, 1, 1) for n in (1, 50, 200)])
    storage.append_sales(t.sales, root)
    stored = storage.read_table(spark, root, "sales")
    recent = look_back(stored, TODAY, 90).select("product_id", "qty")
    plan = plan_of(recent, "formatted")
    assert "(sale_date#" in plan and f">= {days_ago(90)}" in plan
    assert "PartitionFilters" in plan and "ReadSchema: struct<product_id:string,qty:decimal(15,5)>" in plan
    assert recent.count() == 2


def test_metrics_of_one_day_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    for n in (0, 1):
        empty = spark.createDataFrame([], schemas.METRICS)
        storage.write_day(empty, root, "metrics", days_ago(n))
    stored = storage.read_table(spark, root, "metrics").filter(f"calc_date = DATE '{TODAY}'")
    assert "PartitionFilters: [isnotnull(calc_date" in plan_of(stored, "formatted")


def test_limited_lists_sort_with_top_k(spark):
    # more rows than the limit, or the optimizer drops it
    t = tables(spark, sales=[(f"P{i}", "W1", 1, 1, 1) for i in range(9)])
    top = reports.top_products(t.sales, t.stock, t.products, t.warehouses, TODAY, limit=5)
    assert "TakeOrderedAndProject" in plan_of(top)


def test_match_in_cells_joins_on_the_cell(spark):
    t = tables(spark, stock=[("P", "W1", 1, 1), ("P", "R1", 9, 1)], sales=[("P", "W1", 1, 30)])
    position = daily.position_of(t, TODAY)
    split = plan_of(T.match(T.needs(position), T.surpluses(position), split=True))
    assert "need_cell" in split and "surplus_cell" in split


def test_a_large_batch_meets_the_stored_keys_in_their_buckets(spark, tmp_path):
    """200,000 keys, too many for a broadcast: only the batch is shuffled."""
    keys = SalesKeys(spark, str(tmp_path), buckets=8)
    row = ["IF(id % 2 = 0, 'A', 'B') AS doc_prefix", "CAST(id AS string) AS doc_no", "CAST(id % 7 AS string) AS product_id"]
    keys.add(spark.range(0, 300_000).selectExpr(*row), "old")
    batch = spark.range(200_000, 400_000).selectExpr(*row, "id AS seq")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        fresh = merges.new_sales(keys.stored(without="new"), batch, ["seq"])
        assert fresh.count() == 100_000
        plan = plan_of(fresh)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    scans = [i for i, line in enumerate(lines) if keys.name in line and "Scan" in line]
    assert scans and "Bucketed: true" in lines[scans[0]]
    for at in scans:  # everything above the scan, up to the join it feeds
        depth, above = lines[at].find("FileScan"), []
        for line in reversed(lines[:at]):
            place = len(line) - len(line.lstrip(" :+-*"))
            if place < depth:
                above.append(line)
                depth = place
                if "Join" in line:
                    break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above)


@data
@pytest.mark.parametrize("name", ["kpi_inventory", "brand_breakdown"])
def test_distinct_counts_multiply_no_rows(spark, name):
    assert "Expand" not in plan_of(entry.queries()[name](spark, SF_DIR))


@data
def test_the_alert_list_takes_its_limit_once(spark):
    plan = plan_of(entry.queries()["alert_list"](spark, SF_DIR))
    assert "LocalTableScan" in plan and "alert_type" in plan and plan.count("TakeOrderedAndProject") == 0
