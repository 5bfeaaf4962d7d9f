"""Snapshots rebuilt from their changes equal those that were stored."""

import datetime as dt
import random

from pyspark.sql import functions as F
from world import TODAY, rows

from shelfwise.sources import storage
from shelfwise.sources.intervals import SnapshotHistory

DDL = "warehouse_id string, product_id string, qty decimal(15,5), unit_cost decimal(15,5), unit_price decimal(15,5), stock_tag string"
NAMES = ["warehouse_id", "product_id", "qty", "stock_tag"]


def test_every_day_is_rebuilt_from_changes(spark, tmp_path):
    rng, root = random.Random(1), str(tmp_path)
    history = SnapshotHistory(spark, root, base_days=3)
    state, days, changed = {}, [], 0
    for n in range(8):
        day = TODAY + dt.timedelta(days=n + (n > 4))  # no snapshot on one day
        before = dict(state)
        for _ in range(4):
            key = (f"W{rng.randrange(3)}", f"P{rng.randrange(4)}")
            if rng.random() < 0.3:
                state.pop(key, None)
            else:
                state[key] = (rng.randrange(5), rng.choice([None, "T"]))
        frame = lambda s: spark.createDataFrame([(*k, q, None, None, tag) for k, (q, tag) in s.items()], DDL.replace("decimal(15,5)", "int"))
        snapshot = frame(state).withColumns({c: F.col(c).cast("decimal(15,5)") for c in ("qty", "unit_cost", "unit_price")})
        differ = sum(before.get(k) != state.get(k) for k in before.keys() | state.keys())
        for _ in range(2):  # stored again, a day is replaced
            assert history.store(day, snapshot) == differ
        changed += differ
        days.append((day, {k: v for k, v in state.items()}))
    assert storage.read_table(spark, root, "stock_changes").count() == changed
    assert 1 < len(history._stored("stock_bases", TODAY + dt.timedelta(days=99))) < len(days)
    plain = lambda s: sorted(((*k, q, tag) for k, (q, tag) in s.items()), key=str)
    read = lambda df: sorted(((w, p, int(q), tag) for w, p, q, tag in rows(df, *NAMES)), key=str)
    for day, want in days:
        assert read(history.as_of(day)) == plain(want)
    assert read(history.as_of(TODAY + dt.timedelta(days=5))) == plain(days[4][1])  # the day without one
    some = [days[2][0], days[3][0], days[6][0]]
    got = history.days(some)
    for day in some:
        assert read(got.filter(F.col("snapshot_date") == F.lit(day))) == plain(dict(days)[day])


def test_a_day_without_a_base_keeps_no_copy_of_the_snapshot(spark, tmp_path, monkeypatch):
    from shelfwise.functions.sizes import Scratch

    ddl = "warehouse_id long, product_id long, qty decimal(15,5), unit_cost decimal(15,5), unit_price decimal(15,5), stock_tag string"
    day = lambda n: spark.range(9).selectExpr("id % 2", "id", f"id * {n}", "1", "2", "NULL").toDF(*[c.split()[0] for c in ddl.split(", ")])
    history, kept, plain = SnapshotHistory(spark, str(tmp_path)), [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, by=None: kept.append(1) or plain(self, df, by))
    assert history.store(TODAY, day(1)) == 9 and len(kept) == 1
    tomorrow = TODAY + dt.timedelta(days=1)
    assert history.store(tomorrow, day(2).filter("product_id < 8")) == 8  # 7 changed, one went
    assert len(kept) == 1
    got = rows(history.as_of(tomorrow), "product_id", "qty")
    assert sorted((int(p), int(q)) for p, q in got) == [(n, 2 * n) for n in range(8)]
