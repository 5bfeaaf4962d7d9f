"""Look-back sums moved on by a day equal those formed of all sales."""

import datetime as dt
import random

from world import TODAY, days_ago, rows, tables

from shelfwise.operators import metrics
from shelfwise.plans import daily
from shelfwise.sources import storage
from shelfwise.sources.rolling import RollingSales

COLUMNS = ["product_id", "warehouse_id", "q7", "q30", "q90", "sales_rows_30d"]


def sold(spark, seed, oldest=110, newest=-3, n=300):
    rng = random.Random(seed)
    return tables(
        spark,
        sales=[(rng.choice("PQR"), rng.choice(["W1", "W2", "R1"]), rng.randrange(newest, oldest), rng.randrange(1, 9), 1) for _ in range(n)],
    )


def plain(spark, root, t, as_of):
    return rows(metrics.sales_lookback(storage.read_table(spark, root, "sales"), t.warehouses, as_of), *COLUMNS)


def test_three_days_in_a_row_equal_all_sales(spark, tmp_path):
    root, t = str(tmp_path), sold(spark, 1)
    storage.append_sales(t.sales, root, "a")
    RollingSales.mark(t.sales, root, "a")
    sums = RollingSales(spark, root, lag=0)
    for n in (0, -1, -2, -3):
        day = days_ago(n)
        if n < 0:  # four days' sums and those of the day before
            plan = spark._jvm.PythonSQLUtils.explainString(sums.sums(day)._jdf.queryExecution(), "formatted")
            read = [line for line in plan.splitlines() if "sale_date#" in line and "PartitionFilters" in line]
            days = {d for line in read for d in line.replace(",", " ").replace("]", " ").replace(")", " ").split() if d.count("-") == 2}
            assert len(days) <= 4
        sums.move_to(day)
        got = rows(sums.lookback(day, t.warehouses), *COLUMNS)
        assert got == plain(spark, root, t, day) != []


def test_late_rows_open_a_closed_day(spark, tmp_path):
    root, t = str(tmp_path), sold(spark, 2)
    storage.append_sales(t.sales, root, "a")
    RollingSales.mark(t.sales, root, "a")
    sums = RollingSales(spark, root, lag=2)
    sums.move_to(TODAY)
    assert sums._marked() == ([], []) and sums._closed(TODAY) == TODAY - dt.timedelta(days=2)
    for name, (oldest, newest) in {"recent": (2, 0), "late": (80, 40)}.items():
        more = sold(spark, 3, oldest, newest, 20).sales
        storage.append_sales(more, root, name)
        RollingSales.mark(more, root, name)
        sums.move_to(TODAY)
        assert rows(sums.lookback(TODAY, t.warehouses), *COLUMNS) == plain(spark, root, t, TODAY)


def test_a_run_with_moved_sums_equals_one_with_all_sales(spark, tmp_path):
    from test_storage import WORLD, read, write_world

    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    RollingSales.mark(read(spark, root, "sales"), root, "first")
    first = daily.run_daily(spark, root, TODAY)
    before = {n: rows(read(spark, root, n)) for n in ("metrics", "alerts", "transfer_needs", "transfer_offers")}
    assert daily.run_daily(spark, root, TODAY, rolling=True) == first
    assert {n: rows(read(spark, root, n)) for n in before} == before
