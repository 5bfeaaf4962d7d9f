"""The daily run's outputs over the benchmark tables: each is written for who reads it."""

import datetime as dt
import os

import pytest

from shelfwise.operators.alerts import alerts
from shelfwise.operators.metrics import metrics_of, stock_position
from shelfwise.operators.offers import open_needs, open_offers
from shelfwise.sources import tpch_model as M

SHIPPED = dt.datetime(2001, 10, 30)


@pytest.fixture
def folder(spark, tmp_path):
    """Three products in two sales points and a reserve; one sells fast, one has returns only."""
    lines = [(1, 1, 1, 1, 900.0), (2, 2, 1, 1, 6.0), (3, 3, 1, 1, -4.0), (4, 3, 2, 2, 2.0), (5, 1, 5, 1, 9.0), (6, 2, 2, 1, 30.0)]
    tables = {
        "lineitem": (
            [(*line, 10.0, 0.1, SHIPPED) for line in lines],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_discount double, l_shipdate timestamp",
        ),
        "part": (
            [(k, f"part {k}", f"Brand#{k}", 10.5 * k) for k in (1, 2, 3)],
            "p_partkey long, p_name string, p_brand string, p_retailprice double",
        ),
        "supplier": ([(k, f"s{k}", 1) for k in (1, 2, 5)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(1, 0)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def written(spark):
    here = spark.conf.get("spark.checkpoint.dir")
    return {f"{d}/{t}" for d in os.listdir(here) if d.startswith("shelfwise-") for t in os.listdir(f"{here}/{d}")}


def test_only_what_is_read_is_written_and_once(spark, folder):
    before = written(spark)
    M.stored(spark, folder).metrics.count()
    assert len(written(spark) - before) == 1
    M.stored(spark, folder).metrics.count()
    assert len(written(spark) - before) == 1
    M.stored(spark, folder).alerts.count()
    assert len(written(spark) - before) == 2


def test_outputs_are_those_of_the_whole_position(spark, folder):
    t, got = M.model(spark, folder), M.stored(spark, folder)
    position = stock_position(t.sales, t.stock, t.product_brand, t.warehouses, M.AS_OF)
    pairs = [
        (got.metrics, metrics_of(position)), (got.alerts, M.with_state(alerts(position))),
        (got.needs, M.with_state(open_needs(position))), (got.offers, open_offers(position)),
    ]
    for stored, formed in pairs:
        assert stored.schema.simpleString() == formed.schema.simpleString()
        assert formed.count() and sorted(map(repr, stored.collect())) == sorted(map(repr, formed.collect()))


def test_landed_pages_are_compressed_and_parsed_alike(spark, folder):
    from shelfwise.plans import catalog, load
    from shelfwise.sources.payloads import read_payloads

    orders = [(n, "O" if n % 2 else "F") for n in range(1, 7)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    landing = catalog._landed_sales(spark, folder)
    files = [f for _, _, names in os.walk(landing.removeprefix("file:")) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
    records = load.sales_records(read_payloads(spark, landing))
    assert sorted((r["NUMDOC"], r["REFER"], r["PREFIJO"]) for r in records.collect()) == [
        (str(n), str(p), state) for (n, state), p in zip(orders, (1, 2, 3, 3, 1, 2), strict=True)
    ]
