"""Queries on records and the catalog against their SQL twins, and expected values of what they are made of."""

import oracle
import pytest
from pyspark.sql import functions as F

from wattlake.functions import amounts, labels
from wattlake.operators import catalog, compare, records, staging
from wattlake.plans import catalog as catalog_plans, landing as landing_plans, records as record_plans


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


TWINS = {m.__name__ + "." + n: (m.QUERIES[n], m.ORACLE[n]) for m in (record_plans, catalog_plans, landing_plans) for n in m.ORACLE}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_sql_twin(spark, sf, con, name):
    q, sql = TWINS[name]
    assert oracle.compare(q(spark, sf), con, sql) == ""


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("$ 500", ("dollar_amount", 500.0, None, None)), ("100 - $500", ("dollar_amount", 500.0, None, None)), ("up to 500", ("narrative", None, None, None)), ("$0 - $500", ("tiered", None, 500.0, None)),
        ("up to $ 1,000", ("dollar_amount", None, 1000.0, None)), ("0%", (None, None, None, None)), (" N/A ", ("narrative", None, None, None)), ("1,500", ("dollar_amount", 1500.0, None, None)),
    ],
)
def test_listed_amounts(spark, text, expected):
    assert tuple(spark.createDataFrame([(text,)], "x string").select(amounts.read_listed_amount(F.col("x")).alias("y")).first()[0]) == expected


def test_long_texts(spark):
    long = "".join(chr(97 + i * 7 % 26) for i in range(500))
    d = spark.createDataFrame([(long, f"about {long[:100]}", "partial"), (long[:480], f"about {long[:100]}", "mismatch"), (long, long[:99], "partial")], "a string, b string, e string")
    assert d.where(compare.compare_texts(F.col("a"), F.col("b")) != F.col("e")).count() == 0


SETS = "array<struct<parameters:array<struct<source:string,qualifier:string,amount:string,units:string>>>>"


@pytest.mark.parametrize(
    ("parameters", "expected"),
    [
        ([("%", None, "10"), ("$/kW", None, "5")], ("per_unit", None, None, 10.0, 5.0, "kilowatt")),
        ([("$/kW", None, "5"), ("%", None, "10")], ("per_unit", None, None, None, 5.0, "kilowatt")),
        ([("$", "max", "9"), ("$", "min", "3"), ("$", "min", "4")], ("dollar_amount", 3.0, 9.0, None, None, None)),
        ([("$", None, "0"), (None, None, "x"), ("%", None, None)], ("narrative", None, None, None, None, None)),
    ],
)
def test_parameters(spark, parameters, expected):
    rows = [([{"parameters": [("Incentive", q, a, u) for u, q, a in parameters]}, {"parameters": None}, None],), (None,)]
    got = spark.createDataFrame([(x[0],) for x in rows], f"s {SETS}").select(records.read_parameters(F.col("s")).alias("r")).select("r.*").collect()
    assert tuple(got[0]) == expected and tuple(got[1]) == ("narrative", None, None, None, None, None)


def test_labels(spark):
    d = spark.createDataFrame([("electric_vehicle_charger", "Acme Power - Rebate", "Solar water heat kit")], "k string, n string, t string")
    got = d.select(labels.titled(F.col("k")), labels.before_dash(F.col("n")), labels.first_rule(F.col("t"), labels.TECHNOLOGIES), labels.groups_of(F.lit("x"), F.col("n")), labels.cut(F.col("n"), 5)).first()
    assert tuple(got) == ("Electric Vehicle Charger", "Acme Power", "Water Heating", None, "Acme…")


def test_states_change_under_guard(spark):
    rows = spark.createDataFrame([(1, "pending", None), (2, "skipped", None), (3, "pending", None), (None, "pending", None)], "id int, state string, live string")
    ids = spark.createDataFrame([(1,), (2,), (1,), (None,)], "id int")
    once = catalog.change_state(rows, ids, "id", "state", F.lit("promoted"), F.col("state") == "pending", {"live": F.lit("L")})
    assert {tuple(r) for r in once.collect()} == {(1, "promoted", "L"), (2, "skipped", None), (3, "pending", None), (None, "pending", None)}
    assert once.exceptAll(catalog.change_state(once, ids, "id", "state", F.lit("promoted"), F.col("state") == "pending")).isEmpty()
    stale = catalog.unseen_to(once, ids, "id", "state", "pending", "stale", F.lit(True))
    assert {tuple(r)[:2] for r in stale.collect()} == {(1, "promoted"), (2, "skipped"), (3, "stale"), (None, "stale")}


def test_limits_and_links(spark):
    d = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), (None, 3)], "g string, i int")
    assert {tuple(r) for r in staging.limited(d, "g", [F.col("i")], {"a": 1}).collect()} == {("a", 1), ("b", 1), ("b", 2), (None, 3)}
    z = spark.createDataFrame([("k", 1, "s1", ["1", "2", "2"], "1"), ("k", 0, "s0", None, ""), ("k", 2, "s2", ["2"], None)], "k string, r int, s string, zip_codes array<string>, zip_code string")
    assert {tuple(r) for r in catalog.links(z, "k", ["r"], "s").collect()} == {("k", "1", "s1"), ("k", "2", "s1")}


def test_page_facts(spark):
    from wattlake.sources import html

    page = (
        "<html><head><title>Pump Rebate | Acme</title><meta property='og:image' content='/a.jpg'></head><body><script>var x = '<p>no</p>'</script><noscript>Turn on scripts</noscript>"
        "<p>You may receive a rebate of $40 for each pump that a licensed contractor puts in place.</p><p>short</p><a href='/apply'>Apply <b>now</b></a> mail Help@Acme.example (555) 010-0199 <p>open"
    )
    d = spark.createDataFrame([(1, page), (2, "<h1>Page not found</h1>"), (3, ""), (4, None), (5, "<h1>A &amp; B pumps</h1>" + "<p>x</p>" * 20_000)], "i int, h string")
    f = html.page_facts(d, "i", "h")
    got = {r["id"]: r for r in f.collect()}
    assert set(got) == {"1", "2", "5"} and got["1"]["title"] == "Pump Rebate" and got["5"]["title"] == "A & B pumps" and got["1"]["image"] == "/a.jpg" and len(got["1"]["paragraphs"]) == 2
    p = {r["id"]: r for r in html.program_pages(f).collect()}
    assert set(p) == {"1", "5"} and p["1"]["incentive_amount"] == 40.0 and p["1"]["application_url"] == "/apply" and p["1"]["contractor_required"] and p["1"]["contact_email"] == "help@acme.example"


def test_markdown():
    from wattlake.sources.html import to_markdown

    assert to_markdown("<h2>How</h2><p>Ask <b>us</b> <a href='/x'>here</a><br>now</p><img src='a'><ol><li>one</li><li>two</li></ol>") == "## How\n\nAsk **us** [here](/x)\nnow\n\n1. one\n2. two"
    assert to_markdown("") == "" and to_markdown("a &amp; b") == "a & b"


def test_settings():
    from wattlake.settings import Settings, load, plain_dsn

    assert load({}) == Settings() and load({"WATTLAKE_LIMIT": "x", "WATTLAKE_DRY_RUN": "yes", "WATTLAKE_SOURCES": "a, b,"}) == Settings(dry_run=True, sources=("a", "b"))
    assert plain_dsn("postgresql://u:p@h:5/d?schema=s&sslmode=require") == "postgresql://u:p@h:5/d?sslmode=require" and plain_dsn("host=h schema=s") == "host=h schema=s"


def test_calculator(spark):
    offers = [
        dict(payment_methods=["tax_credit", "pos_rebate"], authority_type="federal", authority="fed", program="Credit", program_url="", more_info_url="https://m.example", items=["heat_pump", "ebike"], amount=dict(type="percent", number=0.3, maximum=2000.0, representative=None), owner_status=["Homeowner"], start_date="2023", end_date="2032-12"),
        dict(payment_methods=[], authority_type="city", authority="x", program="Cash", program_url="https://p.example", items=None, amount=dict(type="dollar_amount", number=500.0, maximum=0.0, representative=250.0), owner_status=None, start_date=None, end_date="2020-01-01"),
        dict(payment_methods=None, authority_type=None, authority=None, program=None, items=["pool_pump"], amount=None, owner_status=["business", "renter"]),
    ]
    d = spark.createDataFrame([({"fed": {"name": "Government", "url": None}, "x": {"name": "", "url": None}}, offers, "00501"), (None, None, None)], records.CALCULATOR)
    at = F.to_timestamp(F.lit("2025-06-01"))
    by = {r["program_name"]: r for r in records.calculator_rows(d, at=at).collect()}
    a, b, c = by["Government — Credit"], by["x — Cash"], by[" — "]
    assert (a["program_name"], a["incentive_format"], a["percent_value"], a["maximum_amount"], a["status"], a["application_url"], a["category_tag"], a["customer_type"]) == ("Government — Credit", "tax_credit", 30.0, 2000.0, "active", "https://m.example", ["HVAC", "Electric Vehicles"], "Residential")
    assert (b["utility_company"], b["incentive_amount"], b["maximum_amount"], b["status"], b["implementing_sector"], b["service_territory"]) == ("x", 250.0, 500.0, "draft", "Local Government", "x Service Area")
    assert (c["incentive_format"], c["item"], c["customer_type"], c["implementing_sector"]) == ("narrative", "Pool Pump", "Residential, Commercial", "Utility") and a["application_process"].startswith("Discount applied")


def test_reports_and_routes(spark, tmp_path):
    from wattlake.operators import render, routing

    d = spark.createDataFrame([("a|b", 1.5), (None, 2.0)], "x string, y double")
    assert render.markdown_table(d) == "| x | y |\n| --- | --- |\n| a\\|b | 1.50 |\n|  | 2.00 |"
    assert '"x":"a|b"' in render.json_report({"r": d}).replace(": ", ":") and render.wrapped("aa bb cc", 5) == ["aa bb", "cc"] and render.page_ranges([(1, 1), (3, 5)]) == "1, 3-5"
    routing.write_routed(d.withColumn("rule", F.lit("r1")), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    k = staging.fill_keys(d, "x", F.concat(F.lit("k"), F.col("y").cast("string")))
    assert {r["x"] for r in k.collect()} == {"a|b", "k2.0"}


def test_details_fill_what_is_missing(spark):
    from wattlake.sources import landed

    rows = spark.createDataFrame([(1, "a@x.example", "Text."), (2, None, None), (3, "", "T")], "id int, mail string, about string")
    details = spark.createDataFrame([(1, "b@x.example", "Needs a permit."), (2, "c@x.example", None), (2, "c@x.example", None)], "id int, mail string, requirements string")
    got = {tuple(r) for r in landed.with_details(rows, details, "id", "about", "requirements", ["mail"]).collect()}
    assert got == {(1, "a@x.example", "Text.\n\nNeeds a permit."), (2, "c@x.example", None), (3, None, "T")}
