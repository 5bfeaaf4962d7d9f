import csv
import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F
from world import TODAY, days_ago, one, rows, tables

from shelfwise import schemas
from shelfwise.functions.sizes import Scratch
from shelfwise.operators import reports
from shelfwise.plans import daily, load
from shelfwise.sources import storage
from shelfwise.sources.changelog import ChangeLog, tag_stock
from shelfwise.sources.calendar import select_load
from shelfwise.streaming import ingest


def write_world(spark, root, **world):
    t = tables(spark, **world)
    for name in ("sales", "stock", "products", "brands", "warehouses", "regions", "warehouse_types"):
        df = storage.conform(getattr(t, name), name)
        writer = df.write.mode("overwrite").partitionBy(*schemas.PARTITIONS.get(name, []))
        writer.parquet(storage.table_path(root, name))


WORLD = dict(
    stock=[("P", "W1", 2, 1), ("P", "W2", 400, 1), ("P", "W3", 0, 1), ("P", "R1", 50, 1)],
    sales=[("P", w, 1, 30, 60) for w in ("W1", "W2", "W3")],
)


def read(spark, root, name):
    return storage.read_table(spark, root, name)


def test_daily_run_writes_every_output_and_can_be_repeated(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    first = daily.run_daily(spark, root, TODAY)
    assert first == {
        "date": TODAY.isoformat(), "metrics": 3,
        "alerts": {"total": 5, "low": 1, "over": 1, "slow": 2, "no_rotation": 0, "stockout": 1},
        "transfers": 2, "purchases": 0,
    }
    outputs = ("metrics", "alerts", "transfer_needs", "transfer_offers", "transfers", "purchases")
    assert daily.write_transfer_pairs(spark, root, TODAY) == 2
    before = {n: rows(read(spark, root, n)) for n in outputs}
    assert daily.run_daily(spark, root, TODAY) == first and daily.write_transfer_pairs(spark, root, TODAY) == 2
    assert {n: rows(read(spark, root, n)) for n in before} == before
    assert first["alerts"]["total"] == sum(v for k, v in first["alerts"].items() if k != "total")


def test_a_rerun_keeps_handled_rows_and_other_days(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    daily.run_daily(spark, root, TODAY - dt.timedelta(days=1))
    daily.run_daily(spark, root, TODAY)
    stored = read(spark, root, "alerts").filter(F.col("generated_on") == F.lit(TODAY))
    n = stored.count()
    handled = stored.withColumn("state", F.when(F.col("alert_type") == "STOCK_CRITICO", "VISTA").otherwise(F.col("state")))
    with Scratch(spark) as scratch:
        storage.replace_partitions(scratch.keep(handled), root, "alerts")
    yesterday = rows(read(spark, root, "alerts").filter(F.col("generated_on") < F.lit(TODAY)))
    daily.run_daily(spark, root, TODAY)
    again = read(spark, root, "alerts").filter(F.col("generated_on") == F.lit(TODAY))
    assert again.count() == n + 1 and again.filter("state = 'VISTA'").count() == 1
    assert rows(read(spark, root, "alerts").filter(F.col("generated_on") < F.lit(TODAY))) == yesterday != []


def test_a_run_never_writes_where_handled_rows_lie(spark, tmp_path, monkeypatch):
    """A driver that is lost in the exchange of the pending partition has handled rows still."""
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    daily.run_daily(spark, root, TODAY)
    log = ChangeLog(spark, root, "alerts")
    stored = read(spark, root, "alerts").filter("alert_type = 'STOCK_CRITICO'")
    at = F.lit("2025-06-30 10:00:00").cast("timestamp")
    change = stored.select(*log.kind.keys, F.lit("VISTA").alias("state"), F.lit("u").alias("user"), at.alias("at"), F.lit(1).alias("seq"))
    wrong = change.withColumn("state", F.lit("?")).withColumn("seq", F.lit(2))
    assert log.append(change.union(wrong), "a") == {"changes": 2, "rejected": 1}
    assert log.append(change.union(wrong), "a") == {"changes": 2, "rejected": 1}  # the same batch again
    assert rows(log.current().filter("state = 'VISTA'"), "alert_type", "handled_by") == [("STOCK_CRITICO", "u")]
    n = log.current().count()
    daily.run_daily(spark, root, TODAY)  # folds the log in first
    assert log.changes().count() == 0
    day = f"{root}/alerts/generated_on={TODAY.isoformat()}"
    files = {f: os.path.getmtime(f"{day}/done=true/{f}") for f in os.listdir(f"{day}/done=true")}
    assert read(spark, root, "alerts").count() == n + 1
    daily.run_daily(spark, root, TODAY)
    assert files == {f: os.path.getmtime(f"{day}/done=true/{f}") for f in os.listdir(f"{day}/done=true")}
    assert read(spark, root, "alerts").count() == n + 1


def test_a_day_of_which_all_was_handled_has_nothing_pending(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    daily.run_daily(spark, root, TODAY)
    log = ChangeLog(spark, root, "alerts")
    every = read(spark, root, "alerts")
    change = every.select(*log.kind.keys, F.lit("ATENDIDA").alias("state"), F.lit("u").alias("user"), F.lit(None).cast("timestamp").alias("at"), F.lit(1).alias("seq"))
    log.append(change, "a")
    before = rows(log.current())
    assert log.compact() == 1 and log.compact() == 0
    assert rows(read(spark, root, "alerts")) == before == rows(log.current())


def test_a_compaction_keeps_no_copy_of_the_table(spark, tmp_path, monkeypatch):
    root, days = str(tmp_path), [TODAY - dt.timedelta(days=n) for n in (0, 1)]
    ddl = "alert_type string, product_id string, warehouse_id string, state string, generated_on date"
    alerts = spark.createDataFrame([("A", p, "W", "PENDIENTE", d) for d in days for p in "pqr"], ddl)
    storage.replace_partitions(alerts, root, "alerts")
    log = ChangeLog(spark, root, "alerts")
    change = alerts.filter((F.col("generated_on") == F.lit(TODAY)) | (F.col("product_id") == "p")).select(
        *log.kind.keys, F.lit("VISTA").alias("state"), F.lit("u").alias("user"), F.lit(None).cast("timestamp").alias("at"), F.lit(1).alias("seq")
    )
    log.append(change, "a")

    def fail(*_a, **_k):
        raise AssertionError("a copy")

    monkeypatch.setattr(Scratch, "keep", fail)
    assert log.compact() == 1
    want = sorted((d, p, "VISTA" if d == TODAY or p == "p" else "PENDIENTE") for d in days for p in "pqr")
    assert rows(read(spark, root, "alerts"), "generated_on", "product_id", "state") == want  # today has none pending


def test_tags_are_logged_and_folded_in(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    items = spark.createDataFrame([("P", "W1"), ("P", "W1"), ("P", "W2"), ("P", ""), ("Z", "W1")], "product_id string, warehouse_id string")
    assert tag_stock(spark, root, items, " NEW ", 1, "a") == 2
    assert tag_stock(spark, root, items.filter("warehouse_id = 'W2'"), " ", 2, "b") == 1
    log = ChangeLog(spark, root, "stock")
    want = [("R1", None), ("W1", "NEW"), ("W2", None), ("W3", None)]
    assert rows(log.current(), "warehouse_id", "stock_tag") == want
    log.compact()
    assert rows(read(spark, root, "stock"), "warehouse_id", "stock_tag") == want


def test_the_rebuild_is_written_for_all_days(spark, tmp_path):
    root = str(tmp_path)
    day = TODAY - dt.timedelta(days=3)
    old = [("SIN_ROTACION", "P", "W1", "PENDIENTE", day), ("SIN_ROTACION", "Q", "W1", "VISTA", day), ("STOCK_BAJO", "P", "W2", "PENDIENTE", TODAY)]
    frame = spark.createDataFrame(old, "alert_type string, product_id string, warehouse_id string, state string, generated_on date")
    storage.replace_partitions(frame, root, "alerts")
    fresh = spark.createDataFrame([("SIN_ROTACION", "R", "W3")], "alert_type string, product_id string, warehouse_id string")
    assert storage.rebuild_no_rotation(fresh, root, TODAY) == {"deleted": 1, "inserted": 1}
    assert rows(read(spark, root, "alerts"), "alert_type", "product_id", "state", "generated_on") == [
        ("SIN_ROTACION", "Q", "VISTA", day), ("SIN_ROTACION", "R", "PENDIENTE", TODAY), ("STOCK_BAJO", "P", "PENDIENTE", TODAY),
    ]


def test_outputs_that_became_empty_are_cleared(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    daily.run_daily(spark, root, TODAY)
    write_world(spark, root, stock=[("P", "W1", 30, 1)], sales=[("P", "W1", 1, 30)])
    got = daily.run_daily(spark, root, TODAY)
    assert (got["transfers"], got["metrics"]) == (0, 1)
    assert read(spark, root, "transfer_needs").count() == 0 and read(spark, root, "alerts").count() == got["alerts"]["total"]


def test_rollups_are_written(spark, tmp_path):
    root = str(tmp_path)
    write_world(spark, root, **WORLD)
    daily.run_daily(spark, root, TODAY)
    daily.write_rollups(spark, root, TODAY)
    assert one(read(spark, root, "network_metrics"), "product_id", "warehouses_with_stock") == ("P", 3)
    assert rows(read(spark, root, "region_metrics"), "region_id", "critical_products") == [("EMPTY", 0), ("NORTH", 1), ("SOUTH", 0)]


def test_total_cover_is_derived_on_read(spark, tmp_path):
    write_world(spark, str(tmp_path))
    assert rows(read(spark, str(tmp_path), "brands"), "brand_id", "total_cover") == [("A", 40), ("D", None), ("S", 7)]


def test_scratch_tables_are_columnar_and_dropped(spark):
    with Scratch(spark) as scratch:
        kept = scratch.keep(spark.range(10).withColumn("x", F.lit(1)))
        plan = kept.select("id").filter("id > 3")._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan and "struct<id:bigint>" in plan
        assert os.path.isdir(scratch.folder)
    assert not os.path.isdir(scratch.folder)


def test_csv_export_quotes_every_value(spark, tmp_path):
    t = tables(spark, warehouses=[("W1", 'The "big" one', "Venta", "NORTH", False, True)])
    listing = reports.warehouse_list(t.warehouses, spark.createDataFrame([], schemas.METRICS))
    path = str(tmp_path / "out")
    storage.export_csv(listing, "warehouses", path)
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    text = open(os.path.join(path, part), encoding="utf-8").read()
    assert '"The ""big"" one"' in text
    found = list(csv.reader(text.splitlines()))
    assert found[0][:3] == ["Código", "Nombre", "Tipo"] and found[1][1] == 'The "big" one' and found[1][-1] == ""


SALE = {"PREFIJO": "A", "FECHA": days_ago(1).isoformat(), "BODEGA": "W1", "CANTID": 2, "VALTOT": 5, "MARCA": "X"}


def sale(no, **kw):
    return {**SALE, "NUMDOC": str(no), "REFER": f"P{no}", **kw}


def land(folder, name, recs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(recs))


def test_batch_load_is_idempotent(spark, tmp_path):
    root, inbox = str(tmp_path / "db"), tmp_path / "in"
    land(inbox, "sales_1.json", [sale(1), sale(1, CANTID=9), sale(2), sale(3, CANTID="?"), sale(4, FECHA="2020-01-01")])
    (inbox / "sales_2.json").write_text("garbage")
    land(tmp_path / "st", "stock_1.json", [{"BODEGA": "W1", "REFERENCIA": "P1", "CANTIDAD": 4, "OBSERV1": " "}])
    plan = select_load(TODAY)
    run = lambda: load.run_load(spark, root, plan, str(inbox), str(tmp_path / "st"))
    got = run()
    assert got["sales"] == {"processed": 5, "outside": 1, "inserted": 4, "products": 4, "quarantined": 1}
    assert got["stock"] == {"processed": 1, "products": 1, "quarantined": 0}
    state = {n: rows(read(spark, root, n).drop("updated_at")) for n in ("sales", "products", "stock", "stock_daily")}
    assert run()["sales"]["inserted"] == 0
    assert {n: rows(read(spark, root, n).drop("updated_at")) for n in state} == state
    assert one(read(spark, root, "sales").filter("doc_no = '1'"), "qty")[0] == 2
    assert spark.read.json(f"{root}/quarantine/sales_payloads").filter("body = 'garbage'").count() == 2


def test_a_replacement_cut_short_loses_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows_of = lambda *ids: spark.createDataFrame([(i,) for i in ids], "product_id string")
    storage.replace_table(rows_of("a"), root, "products")
    bad = rows_of("b").selectExpr("CAST(raise_error('lost') AS string) AS product_id")
    with pytest.raises(Exception, match="lost"):
        storage.replace_table(bad, root, "products")
    assert rows(read(spark, root, "products"), "product_id") == [("a",)]
    # the old table has gone, the new one is not in its place yet
    with monkeypatch.context() as m:
        m.setattr(storage, "finish_replacement", lambda *_: None)
        storage.replace_table(rows_of("b"), root, "products")
    assert not os.path.isdir(f"{root}/products")
    assert rows(read(spark, root, "products"), "product_id") == [("b",)]
    merged = read(spark, root, "products").unionByName(storage.conform(rows_of("c"), "products"))
    storage.replace_table(merged, root, "products")
    assert rows(read(spark, root, "products"), "product_id") == [("b",), ("c",)]


def test_a_repeated_batch_replaces_its_quarantine(spark, tmp_path):
    root = str(tmp_path)
    landed = spark.createDataFrame([("f", 1, "junk")], "source string, page long, body string")
    for _ in range(2):
        load.keep_bad_payloads(landed, root, "sales", "Result", batch="7")
    assert spark.read.json(f"{root}/quarantine/sales_payloads").count() == 1


def test_streaming_in_two_runs_equals_one_batch(spark, tmp_path):
    inbox, cp = tmp_path / "in", str(tmp_path / "cp")
    stream_root, batch_root = str(tmp_path / "s"), str(tmp_path / "b")
    land(inbox, "sales_1.json", [sale(1), sale(2)])
    ingest.ingest_sales(spark, str(inbox), stream_root, cp).awaitTermination()
    assert read(spark, stream_root, "sales").count() == 2
    land(inbox, "sales_2.json", [sale(2, CANTID=7), sale(3)])
    ingest.ingest_sales(spark, str(inbox), stream_root, cp).awaitTermination()
    ingest.ingest_sales(spark, str(inbox), stream_root, cp).awaitTermination()
    from shelfwise.sources.payloads import read_payloads

    load.load_sales(spark, batch_root, load.sales_records(read_payloads(spark, str(inbox))))
    for name in ("sales", "products"):
        assert rows(read(spark, stream_root, name)) == rows(read(spark, batch_root, name)) != []


def test_a_batch_repeated_half_way_stores_its_rows_once(spark, tmp_path, monkeypatch):
    """Also those with a NULL in the key, and also if the rows were stored but not their keys."""
    root = str(tmp_path / "db")
    land(tmp_path / "in", "sales_1.json", [sale(1), sale(1), sale(2), sale(3, PREFIJO=None), sale(3, PREFIJO=None)])
    from shelfwise.sources.ledger import SalesKeys
    from shelfwise.sources.payloads import read_payloads

    recs = load.sales_records(read_payloads(spark, str(tmp_path / "in")))
    SalesKeys(spark, root)
    with monkeypatch.context() as m:
        m.setattr(SalesKeys, "add", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load.load_sales(spark, root, recs, batch="7")
    assert read(spark, root, "sales").count() == 4
    before = None
    for _ in range(2):
        assert load.load_sales(spark, root, recs, batch="7")["inserted"] == 4
        stored = rows(read(spark, root, "sales"))
        assert len(stored) == 4 and stored == (before or stored)
        before = stored
    other = load.load_sales(spark, root, recs, batch="8")
    assert other["inserted"] == 2 and read(spark, root, "sales").count() == 6


def test_a_stream_that_lost_its_last_commit_repeats_the_batch(spark, tmp_path):
    inbox, root, cp = tmp_path / "in", str(tmp_path / "db"), str(tmp_path / "cp")
    land(inbox, "sales_1.json", [sale(1), sale(2, PREFIJO=None)])
    ingest.ingest_sales(spark, str(inbox), root, cp).awaitTermination()
    before = rows(read(spark, root, "sales"))
    ingest.forget_last_batch(spark, cp)
    ingest.ingest_sales(spark, str(inbox), root, cp).awaitTermination()
    assert rows(read(spark, root, "sales")) == before and len(before) == 2


def test_a_feed_with_a_hole_waits(spark, tmp_path):
    root, inbox = str(tmp_path / "db"), tmp_path / "in"
    land(inbox, "a_p1.json", [sale(1), sale(2)])
    land(inbox, "a_p3.json", [sale(5)])
    land(inbox, "b_p1.json", [sale(11), sale(12)])
    land(inbox, "b_p2.json", [sale(13)])
    land(inbox, "c_p1.json", [sale(21)])
    land(inbox, "c_p2.json", [sale(22), sale(23)])
    plan = select_load(TODAY, "sales")
    got = load.run_load(spark, root, plan, str(inbox), None, page_size=2)["sales"]
    gap = lambda feed, kind, page: {"feed": feed, "kind": kind, "first_page": page, "last_page": page}
    assert got["held"] == [gap("a_p.json", "missing", 2), gap("c_p.json", "short", 1), gap("c_p.json", "open", 3)]
    assert [r[0] for r in rows(read(spark, root, "sales"), "doc_no")] == ["11", "12", "13"]
    land(inbox, "a_p2.json", [sale(3), sale(4)])
    got = load.run_load(spark, root, plan, str(inbox), None, page_size=2)["sales"]
    assert {g["feed"] for g in got["held"]} == {"c_p.json"} and got["inserted"] == 5


def test_a_stream_holds_pages_back_over_batches(spark, tmp_path):
    inbox, root, cp = tmp_path / "in", str(tmp_path / "db"), str(tmp_path / "cp")
    run = lambda: ingest.ingest_sales(spark, str(inbox), root, cp, page_size=2).awaitTermination()
    stored = lambda: sorted(int(r[0]) for r in rows(read(spark, root, "sales"), "doc_no"))
    land(inbox, "a_p1.json", [sale(1), sale(2)])
    run()
    assert stored() == []
    land(inbox, "a_p3.json", [sale(5)])
    land(inbox, "b_p1.json", [sale(11)])
    run()
    assert stored() == [11]
    land(inbox, "a_p2.json", [sale(3), sale(4)])
    run()
    ingest.forget_last_batch(spark, cp)
    run()
    assert stored() == [1, 2, 3, 4, 5, 11]


def test_a_back_load_does_failed_slices_again(spark, tmp_path, monkeypatch):
    from shelfwise.plans import backload
    from shelfwise.sources.payloads import read_payloads

    root = str(tmp_path / "db")
    on = lambda no, n, **kw: sale(no, FECHA=days_ago(n).isoformat(), **kw)
    land(tmp_path / "in", "s_1.json", [on(1, 20), on(2, 19), on(3, 12), on(3, 12), on(4, 11, PREFIJO=None), on(5, 3, CANTID="?")])
    recs = load.sales_records(read_payloads(spark, str(tmp_path / "in")))
    args = (spark, root, recs, days_ago(20), days_ago(0))
    plain, calls = load.load_sales, []

    def broken(*a, **kw):
        calls.append(kw["batch"])
        got = plain(*a, **kw)
        if kw["batch"] == f"slice-{days_ago(13).isoformat()}":
            raise RuntimeError("lost after it was stored")
        return got

    with monkeypatch.context() as m:
        m.setattr(load, "load_sales", broken)
        first = rows(backload.back_load(*args), "start_date", "status", "loaded", "errors")
    assert first == [(days_ago(20), "done", 2, 0), (days_ago(13), "failed", 0, 0), (days_ago(6), "done", 1, 1)]
    assert len(calls) == 3
    with monkeypatch.context() as m:
        m.setattr(load, "load_sales", lambda *a, **kw: calls.append(kw["batch"]) or plain(*a, **kw))
        again = rows(backload.back_load(*args), "start_date", "status", "loaded", "message")
    assert calls[3:] == [f"slice-{days_ago(13).isoformat()}"]
    assert [r[:3] for r in again] == [(days_ago(20), "done", 2), (days_ago(13), "done", 2), (days_ago(6), "done", 1)]
    assert read(spark, root, "sales").count() == sum(r[2] for r in again) == 5


def test_stored_keys_survive_a_compaction_and_a_new_session_name(spark, tmp_path):
    from shelfwise.sources.ledger import SalesKeys

    root = str(tmp_path)
    keys = SalesKeys(spark, root, buckets=3)
    frame = lambda *n: spark.createDataFrame([("A", str(i), "P") for i in n], "doc_prefix string, doc_no string, product_id string")
    keys.add(frame(1, 2), "a")
    keys.add(frame(2, 3), "b")
    assert keys.stored().count() == 4 and keys.stored(without="b").count() == 2
    keys.compact(buckets=5)
    assert rows(keys.stored(), "doc_no", "batch_id") == [("1", "a"), ("2", "a"), ("3", "b")]
    spark.sql(f"DROP TABLE {keys.name}")  # another session's catalog does not know it
    again = SalesKeys(spark, root)
    assert again.buckets == 5 and again.stored().count() == 3
    assert len(os.listdir(f"{root}/sales_keys")) == 1


def test_streaming_stock_keeps_rows_missing_from_the_feed(spark, tmp_path):
    inbox, root, cp = tmp_path / "in", str(tmp_path / "db"), str(tmp_path / "cp")
    item = lambda p, q: {"BODEGA": "W1", "REFERENCIA": p, "CANTIDAD": q}
    land(inbox, "stock_1.json", [item("P", 1), item("Q", 2)])
    ingest.ingest_stock(spark, str(inbox), root, cp, TODAY).awaitTermination()
    land(inbox, "stock_2.json", [item("P", 5)])
    ingest.ingest_stock(spark, str(inbox), root, cp, TODAY).awaitTermination()
    assert [(r[0], int(r[1])) for r in rows(read(spark, root, "stock"), "product_id", "qty")] == [("P", 5), ("Q", 2)]
    assert read(spark, root, "stock_daily").count() == 2
