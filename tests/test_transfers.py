import collections
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from world import TODAY, one, rows, tables

from shelfwise import Params
from shelfwise.operators import offers
from shelfwise.operators import transfers as T
from shelfwise.plans import daily

SHORT = [("P", w, 1, 30) for w in ("W1", "W2")]


def moves(spark, p=Params(), **world):
    t = tables(spark, **world)
    return T.transfers(daily.position_of(t, TODAY, p), t.warehouses, p)


def test_one_surplus_serves_every_need(spark):
    got = moves(spark, stock=[("P", "W1", 4, 1), ("P", "W2", 4, 1), ("P", "R1", 10, 1)], sales=SHORT)
    assert rows(got, "from_id", "to_id", "to_region", "qty", "priority") == [
        ("R1", "W1", "NORTH", Decimal("8.00000"), "ALTA"),
        ("R1", "W2", "NORTH", Decimal("8.00000"), "ALTA"),
    ]


def test_quantity_is_limited_by_both_sides(spark):
    got = moves(spark, stock=[("P", "W1", 2, 1), ("P", "R1", 3, 1)], sales=SHORT[:1])
    assert one(got, "qty", "priority", "days_to", "days_from") == (
        Decimal("3.00000"), "URGENTE", Decimal("2.00"), Decimal("9999.00"),
    )


def test_no_transfer_within_a_warehouse(spark):
    # cover of 2 days makes 4 days both a surplus and a need
    world = dict(products=[("P", "S")], stock=[("P", "W1", 4, 1)], sales=[("P", "W1", 1, 30)])
    assert rows(moves(spark, **world)) == []
    two = dict(world, stock=[("P", "W1", 4, 1), ("P", "W2", 4, 1)], sales=SHORT)
    assert rows(moves(spark, **two), "from_id", "to_id", "qty") == [
        ("W1", "W2", Decimal("2.00000")), ("W2", "W1", Decimal("2.00000")),
    ]


def test_cells_give_the_same_pairs_for_a_hot_product(spark):
    """A product on most rows, matched whole and in cells of 3 rows, against brute force."""
    need = [("HOT", f"n{i}", 1.0 + i % 5) for i in range(17)] + [("COLD", "n1", 2.0)]
    over = [("HOT", f"n{i}", 1.0 + i % 3) for i in range(8, 19)] + [("COLD", "n9", 1.0)]
    n = spark.createDataFrame(
        [(p, w, "R", Decimal("5.00"), Decimal(str(q)), "OTRAS", "B") for p, w, q in need],
        "product_id string, to_id string, to_region string, days_to decimal(18,2),"
        " needed decimal(15,5), category string, abc_class string",
    )
    s = spark.createDataFrame(
        [(p, w, Decimal("99.00"), Decimal(str(q))) for p, w, q in over],
        "product_id string, from_id string, days_from decimal(18,2), available decimal(15,5)",
    )
    brute = sorted(
        (p, b, a, str(Decimal(str(min(q, r))).quantize(Decimal("0.00001"))))
        for p, a, q in need for o, b, r in over if p == o and a != b
    )
    small = Params(match_cell_rows=3)
    for split in (False, True):
        got = rows(T.match(n, s, split, small), "product_id", "from_id", "to_id", F.col("qty").cast("string"))
        assert sorted(got) == brute


def test_counts_without_pairs_equal_counted_pairs(spark):
    t = tables(
        spark,
        products=[("P", "S"), ("Q", "A")],
        stock=[("P", w, 4, 1) for w in ("W1", "W2", "W3")] + [("P", "R1", 50, 1)]
        + [("Q", "W1", 4, 1), ("Q", "R1", 5, 1), ("Q", "W3", 12, 1)],
        sales=[(p, w, 1, 30) for p in "PQ" for w in ("W1", "W2", "W3")],
    )
    position = daily.position_of(t, TODAY)
    pairs = T.transfers(position, t.warehouses).groupBy("product_id", "to_region").count()
    assert rows(T.transfer_counts(position)) == rows(pairs) != []


def sides(spark, seed):
    """Many needs and surpluses of few products, some with both, in ties of days."""
    rng = random.Random(seed)
    need, offer = [], []
    for product in "PQRS":
        for w in range(14):
            if rng.random() < 0.5:
                state = "VISTA" if rng.random() < 0.2 else "PENDIENTE"
                prio = rng.choice(["URGENTE", "ALTA", "MEDIA"])
                need.append((product, f"W{w}", rng.choice("NS"), rng.randrange(4), rng.randrange(1, 9), "C", "A", prio, state))
            if rng.random() < 0.5 and product != "S":
                offer.append((product, f"W{w}", rng.randrange(9), rng.randrange(1, 9)))
    q = "decimal(15,5)"
    n = spark.createDataFrame(need, "product_id string, to_id string, to_region string, days_to int, needed int, category string, abc_class string, priority string, state string")
    o = spark.createDataFrame(offer, "product_id string, from_id string, days_from int, available int")
    pairs = [
        (p, f, t, region, min(have, lack), state, prio, days)
        for p, t, region, days, lack, _, _, prio, state in need
        for p2, f, _, have in offer if p2 == p and f != t
    ]
    return n.withColumn("needed", F.col("needed").cast(q)), o.withColumn("available", F.col("available").cast(q)), pairs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_pairs_and_counts_equal_those_of_all_pairs(spark, seed):
    need, offer, pairs = sides(spark, seed)
    rng = random.Random(seed)
    picked = rng.sample(pairs, 15)
    log = [(*r[:3], rng.choice(["APROBADO", "RECHAZADO"])) for r in picked] + [("P", "W1", "W1", "APROBADO"), ("Z", "W1", "W2", "APROBADO")]
    handled = spark.createDataFrame(log, "product_id string, from_id string, to_id string, state string")
    done = {r[:3]: r[3] for r in log}
    stated = [(r[7], r[0], r[2], r[1], done.get(r[:3], r[5]), r[4], r[3]) for r in pairs]
    for state in ("PENDIENTE", "VISTA", "APROBADO", None):
        want = sorted(r for r in stated if state in (None, r[4]))
        for limit in (1, 7, 40, 1000):
            got = offers.first_pairs(need, offer, limit, state=state, handled=handled).collect()
            found = [(r["days_to"], r["product_id"], r["to_id"], r["from_id"], r["state"], int(r["qty"]), r["to_region"]) for r in got]
            assert found == want[:limit]
    plain = sorted(((r[7], r[0], r[2], r[1], r[5], r[4], r[3]) for r in pairs if r[5] == "PENDIENTE"))
    got = offers.first_pairs(need, offer, 25).collect()
    assert [(r["days_to"], r["product_id"], r["to_id"], r["from_id"]) for r in got] == [r[:4] for r in plain[:25]]
    by_region = collections.Counter(r[6] for r in stated if r[4] == "PENDIENTE")
    assert dict(rows(offers.region_counts(need, offer, handled))) == by_region


def test_the_list_forms_no_more_pairs_than_its_needs_have(spark):
    need, offer, _ = sides(spark, 4)
    plan = spark._jvm.PythonSQLUtils.explainString(offers.first_pairs(need, offer, 5)._jdf.queryExecution(), "simple")
    joined = plan[plan.index("BroadcastHashJoin [product_id") :]
    assert "TakeOrderedAndProject(limit=5" in joined


def test_order_puts_main_class_a_brands_first(spark):
    got = moves(
        spark,
        products=[("P", "D"), ("Q", "A"), ("S", "S")],
        stock=[(p, w, 1, 1) for p in "PQS" for w in ("W1",)] + [(p, "R1", 90, 1) for p in "PQS"],
        sales=[(p, "W1", 1, 30) for p in "PQS"],
    )
    assert [r["product_id"] for r in T.in_order(got).collect()] == ["Q", "S", "P"]
