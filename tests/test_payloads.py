import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from world import one, rows

from shelfwise.plans import load
from shelfwise.sources import calendar, payloads, records

REC = [{"REFER": "P", "CANTID": 2}, {"REFER": "Q", "CANTID": "3.50"}]
BARE = json.dumps(REC)
SPACED = BARE.replace("[{", "[ {").replace("}]", "} ]")
XML = '<s:Envelope xmlns:s="http://x"><s:Body><GetVentasResult>{}</GetVentasResult></s:Body></s:Envelope>'
LONG = "x" * 5000


def landed(spark, *bodies):
    return spark.createDataFrame(
        [(f"f{i}", i, b) for i, b in enumerate(bodies)], "source string, page long, body string"
    )


def parsed(spark, body, envelope=payloads.SALES_ENVELOPE):
    d = payloads.decode(landed(spark, body), "Result")
    lists = payloads.record_lists(d, envelope)
    found = [(r["REFER"], r["CANTID"]) for r in records.explode_records(lists, records.SALES_RECORD).orderBy("seq").collect()]
    return one(d, "status")[0], found


OK = ("ok", [("P", "2"), ("Q", "3.50")])


@pytest.mark.parametrize(
    "body, expected",
    [
        (BARE, OK),
        (BARE + "<soap><ok/></soap>", OK),
        ("noise " + BARE + " noise", OK),
        (XML.format(SPACED), OK),
        (XML.format(SPACED.replace('"', "&quot;")), OK),
        (XML.format(f"<![CDATA[{SPACED}]]>"), OK),
        (XML.format('{"ventas": ' + SPACED + "}"), OK),
        (XML.format('{"data": ' + SPACED + "}"), OK),
        (XML.format('{"resultado": ' + SPACED + ', "other": 1}'), OK),
        (XML.format('{"data": [], "ventas": ' + SPACED + "}"), OK),
        (XML.format('{"ventas": null, "data": ' + SPACED + "}"), ("ok", [])),
        (XML.format('{"unknown": ' + SPACED + "}"), ("ok", [])),
        (XML.format("[]"), ("ok", [])),
        (XML.format("not json"), ("raw", [])),
        ("<a><Other>1</Other></a>", ("error", [])),
        ("[{broken}]" + XML.format(SPACED), OK),
        ("", ("error", [])),
        (json.dumps([{"REFER": LONG, "CANTID": 1}]), ("ok", [(LONG, "1")])),
        ('[{"REFER":"a","REFER":"P","CANTID":2}]', ("ok", [("P", "2")])),
        (XML.format(SPACED.replace('"', "&#34;")), OK),
        (XML.format(SPACED.replace('"', "&#x22;")), OK),
        (XML.format('[ {&#34;REFER&#34;: &#34;&#x20AC; &#xZ;&#34;} ]'), ("ok", [("€ &#xZ;", None)])),
        ('[{"REFER": NaN}]', ("raw", [])),
    ],
)
def test_envelopes(spark, body, expected):
    assert parsed(spark, body) == expected


def test_a_large_payload_is_no_error(spark):
    one_record = '{"REFER":"P","CANTID":2}'
    many = F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit(one_record), 6_500_000), ","), F.lit("]"))
    large = spark.range(1).select(F.lit("f").alias("source"), F.lit(1).alias("page"), many.alias("body"))
    d = payloads.decode(large, "Result").select("status", F.length("payload"))
    assert d.collect()[0][0] == "ok" and d.collect()[0][1] > 150_000_000


def test_stock_envelope_does_not_know_the_sales_key(spark):
    assert parsed(spark, XML.format('{"ventas": ' + SPACED + "}"), payloads.STOCK_ENVELOPE) == ("ok", [])
    assert parsed(spark, XML.format('{"inventario": ' + SPACED + "}"), payloads.STOCK_ENVELOPE) == OK


def test_undecodable_payloads_are_kept_whole(spark):
    d = payloads.decode(landed(spark, BARE, XML.format(LONG), "junk"), "Result")
    bad = rows(payloads.quarantine(d), "status", "body")
    assert bad == [("error", "junk"), ("raw", XML.format(LONG))]


def test_sales_mapping(spark):
    body = json.dumps([
        {"TIPMOV": "F", "PREFIJO": "A", "NUMDOC": 7, "FECHA": "2025-01-02", "BODEGA": "0012", "REFER": "P",
         "CANTID": "1.5", "VALTOT": 12, "PORIVA": None},
        {"FECHA": "2025-01-02", "REFER": "P", "CANTID": "many"},
        {"REFER": "no date"},
    ])
    lists = payloads.record_lists(payloads.decode(landed(spark, body), "Result"), payloads.SALES_ENVELOPE)
    recs = records.explode_records(lists, records.SALES_RECORD)
    got = records.sales_rows(recs).orderBy("seq").collect()
    assert [(r["doc_no"], r["warehouse_id"], r["qty"], r["amount"], r["tax_pct"], r["unit_price"]) for r in got] == [
        ("7", "0012", Decimal("1.50000"), Decimal("12.00000"), Decimal("0.00"), Decimal("0.00000")),
        (None, None, Decimal("0.00000"), Decimal("0.00000"), Decimal("0.00"), Decimal("0.00000")),
    ]
    assert records.bad_sales(recs).count() == 2


def test_stock_mapping_trims_tags(spark):
    body = json.dumps([
        {"BODEGA": "1", "REFERENCIA": "P", "CANTIDAD": 1, "OBSERV1": "  OUTLET "},
        {"BODEGA": "1", "REFERENCIA": "Q", "OBSERV1": "   "},
        {"REFERENCIA": "no warehouse"},
    ])
    lists = payloads.record_lists(payloads.decode(landed(spark, body), "Result"), payloads.STOCK_ENVELOPE)
    recs = records.explode_records(lists, records.STOCK_RECORD)
    assert rows(records.stock_rows(recs), "product_id", "qty", "stock_tag") == [
        ("P", Decimal("1.00000"), "OUTLET"), ("Q", Decimal("0.00000"), None),
    ]
    assert records.bad_stock(recs).count() == 1


def test_last_record_of_a_product_wins_with_field_fallbacks(spark):
    body = json.dumps([
        {"REFER": "P", "NOMREF": "first", "MARCA": "X"},
        {"REFER": "P", "NOMBRE": "", "NOMREF": "last", "UNIDADMED": "u", "UNDMED": "v"},
        {"REFER": ""}, {"CODIGO": "no key"},
    ])
    lists = payloads.record_lists(payloads.decode(landed(spark, body), "Result"), payloads.SALES_ENVELOPE)
    got = records.product_rows(records.explode_records(lists, records.SALES_RECORD), "REFER")
    assert rows(got, "product_id", "name", "uom", "source_brand") == [("P", "last", "u", None)]


@pytest.mark.parametrize(
    "counts, complete, limit",
    [([1000, 1000, 3], True, False), ([1000, 0], True, False), ([1000, 1000], False, False),
     ([1000, 5, 1000], False, False), ([1000] * 100, False, True)],
)
def test_page_report(spark, counts, complete, limit):
    df = spark.createDataFrame(list(enumerate(counts, 1)), "page long, records long")
    assert one(payloads.page_report(df), "complete", "hit_page_limit", "records") == (complete, limit, sum(counts))


def test_missing_page_is_noticed(spark):
    df = spark.createDataFrame([(1, 1000), (3, 2)], "page long, records long")
    assert one(payloads.page_report(df), "complete") == (False,)


def test_pages_are_ordered_by_number_not_by_name(spark, tmp_path):
    for page in (2, 10):
        (tmp_path / f"stock_{page}.json").write_text(json.dumps([{"BODEGA": "1", "REFERENCIA": "P", "CANTIDAD": page}]))
    recs = load.stock_records(payloads.read_payloads(spark, str(tmp_path)))
    assert [r["CANTIDAD"] for r in recs.orderBy("seq").collect()] == ["2", "10"]


def test_week_ranges(spark):
    d = dt.date
    got = rows(calendar.week_ranges(spark, d(2025, 1, 1), d(2025, 1, 20)))
    assert got == [(d(2025, 1, 1), d(2025, 1, 7)), (d(2025, 1, 8), d(2025, 1, 14)), (d(2025, 1, 15), d(2025, 1, 20))]
    assert rows(calendar.week_ranges(spark, d(2025, 1, 2), d(2025, 1, 2))) == [(d(2025, 1, 2), d(2025, 1, 2))]
    assert rows(calendar.week_ranges(spark, d(2025, 1, 2), d(2025, 1, 1))) == []


def test_history_summary_keeps_empty_weeks(spark):
    body = json.dumps([
        {"FECHA": "2025-01-01", "REFER": "P", "CANTID": 1}, {"FECHA": "2025-01-07", "REFER": "P", "CANTID": "?"},
        {"FECHA": "2025-01-15", "REFER": "Q"}, {"FECHA": "2024-12-31", "REFER": "Q"}, {"REFER": "Q"},
    ])
    recs = load.sales_records(landed(spark, body))
    got = load.history_summary(spark, recs, dt.date(2025, 1, 1), dt.date(2025, 1, 20))
    assert rows(got, "loaded", "products", "errors") == [(0, 0, 0), (1, 1, 0), (2, 1, 1)]


def test_load_selection():
    today = dt.date(2025, 3, 1)
    assert calendar.select_load(today) == calendar.Load(dt.date(2025, 2, 28), dt.date(2025, 2, 28), today)
    assert calendar.select_load(today, "sales", stock_date=today).stock_date is None
    assert calendar.select_load(today, "stock").sales_from is None
    with pytest.raises(ValueError):
        calendar.select_load(today, "other")


def test_every_sales_line_is_judged(spark):
    from shelfwise.plans import catalog

    fields = ("NUMDOC", "REFER")
    feed = spark.createDataFrame([(str(i), "r") for i in range(40)], ", ".join(f"{f} string" for f in fields))
    decoded = payloads.decode(catalog._line_payloads(feed), "Result")
    got = {r["status"]: r["n"] for r in decoded.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert got == {"ok": 32, "raw": 4, "error": 4}


def test_characters_by_number_are_replaced_once_each(spark):
    texts = {
        "&#34;a&#x22;&#34;": '"a"\'"'.replace("'", ""), "&#38;#34;": "&#34;", "&&#35;34;": "&#34;", "&#&#51;4;&#x41;": "&#34;A",
        "&#;&#zz;&#12345678;&#128512;": "&#;&#zz;&#12345678;\U0001f600", "&#38;lt;": "&lt;", "none": "none",
        "".join(f"&#{n};" for n in range(1000, 1100)): "".join(map(chr, range(1000, 1100))),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", payloads._numeric_entities(F.col("t")).alias("r"))
    assert {r["t"]: r["r"] for r in got.collect()} == texts
    # a text's few different ones are replaced in a pass each, not one by one
    assert "aggregate" in str(payloads._numeric_entities(F.col("t")))


def test_the_element_counts_where_the_list_is_no_json(spark):
    found = payloads.decode(landed(spark, "[{bad}] <Result>[1]</Result>", "[{bad}] <Result>z</Result>", "[{bad}]", "none"), "Result")
    assert rows(found, "page", "payload", "status") == [(0, "[1]", "ok"), (1, None, "raw"), (2, None, "raw"), (3, None, "error")]
