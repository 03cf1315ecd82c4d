"""Each query of the data-processing operators against its SQL twin, and expected values of the functions."""

import oracle
import pytest
from pyspark.sql import functions as F

from wattlake.functions import amounts, arrays, contacts, dates, urls
from wattlake.operators import compare, merge, staging
from wattlake.plans import reference


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(reference.ORACLE))
def test_sql_twin(spark, sf, con, name):
    assert oracle.compare(reference.QUERIES[name](spark, sf), con, reference.ORACLE[name]) == ""


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("$600", ("dollar_amount", 600.0)), ("30% of cost", ("percent", 30.0)), ("up to $2,000", ("dollar_amount", 2000.0)), ("$0.10/kWh", ("per_unit", 0.1)), ("varies", ("narrative", None)), ("$5 now, up to $90", ("dollar_amount", 90.0)), (None, ("narrative", None)), ("", ("narrative", None))],
)
def test_parse_amount(spark, text, expected):
    assert tuple(one(spark, amounts.parse_amount, text)) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("$100 - $500", ("tiered", 100.0, 500.0, None)), ("Up to $1000", ("dollar_amount", None, 1000.0, None)), ("30%", ("percent", None, None, 30.0)), ("1500", ("dollar_amount", 1500.0, None, None)), ("Varies", ("narrative", None, None, None)), ("$0", (None, None, None, None)), (None, ("narrative", None, None, None))],
)
def test_listed_amount(spark, text, expected):
    assert tuple(one(spark, amounts.read_listed_amount, text)) == expected


def test_context_and_counts(spark):
    assert one(spark, amounts.parse_amount_in_context, "costs $40")[0] == "narrative"
    assert one(spark, amounts.parse_amount_in_context, "rebate of $40")[1] == 40.0
    assert one(spark, amounts.distinct_amounts, "$1 $1 5%") == 2
    assert one(spark, amounts.distinct_amounts, "$100 $100.00") == 2


@pytest.mark.parametrize(("text", "expected"), [("03/2024", "2024-03-01"), ("3/7/2024", "2024-03-07"), ("2024-03-07", "2024-03-07"), ("TBD", "TBD"), (None, None)])
def test_iso_date(spark, text, expected):
    assert one(spark, dates.iso_date, text) == expected


@pytest.mark.parametrize(("text", "expected"), [("1735689600000", "2025-01-01"), ("", None), ("0", None), ("-5", None), ("x", None)])
def test_millis(spark, text, expected):
    assert one(spark, dates.millis_date, text) == expected


def test_urls(spark):
    assert one(spark, urls.path_depth, "https://example.com/a/b/c") == 3
    assert one(spark, urls.path_depth, "https://example.com") == 0
    assert one(spark, urls.is_pdf, "/x.PDF?y=1") is True
    assert one(spark, urls.is_pdf, "/x.pdf/") is False
    assert one(spark, urls.last_id, "https://a.example/detail/1036/") == 1036
    assert one(spark, lambda c: urls.parameter(c, "incentive_id"), "https://a.example/?incentive_id=abc&x=1") == "abc"


def test_lists_and_labels(spark):
    assert one(spark, arrays.union_ignoring_case, ["HVAC", "Wind", "hvac", "Solar"], "array<string>") == ["HVAC", "Wind", "Solar"]
    assert one(spark, contacts.slug, "Combined Heat & Power") == "combined-heat-power"
    assert one(spark, lambda c: contacts.infer_labels(c, reference.LABELS), "heat pump water heater") == ["Water Heating", "HVAC"]


def test_comparisons(spark):
    d = spark.createDataFrame([("", "", "empty"), ("", "a", "missing"), ("a", "", "extra"), ("A", "a", "match"), ("ab", "a", "partial"), ("a", "b", "mismatch")], "a string, b string, e string")
    assert d.where(compare.compare_texts(F.col("a"), F.col("b")) != F.col("e")).count() == 0
    n = spark.createDataFrame([(100.0, 104.0, "match"), (100.0, 110.0, "mismatch"), (0.0, None, "empty"), (0.0, 5.0, "missing")], "a double, b double, e string")
    assert n.where(compare.compare_numbers(F.col("a"), F.col("b")) != F.col("e")).count() == 0


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(1, "a", "done"), (2, "b", "done")], "k int, v string, s string")
    new = spark.createDataFrame([(2, None, "new"), (3, "c", "new")], "k int, v string, s string")
    once = staging.upsert(old, new, "k", ["v"], ["s"])
    twice = staging.upsert(once, new, "k", ["v"], ["s"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a", "done"), (2, None, "done"), (3, "c", "new")]


def test_merge_is_blind_to_row_order(spark):
    rows = [(1, "k", "b", " ", 5.0, ["x"]), (2, "k", "a", "T", None, ["X", "y"]), (3, "k", "c", "U", 0.0, None)]
    out = []
    for r in (rows, rows[::-1]):
        d = spark.createDataFrame(r, "id int, k string, source string, t string, v double, l array<string>")
        d = d.withColumn("r", merge.source_rank(F.col("source"), ("a", "b")))
        out.append([tuple(x) for x in merge.merge(d, "k", ["r", "id"], ["t"], ["v"], ["l"]).collect()])
    assert out[0] == out[1] == [("k", 3, "T", 5.0, ["X", "y"])]


def test_stream_equals_batch(spark, sf):
    a = reference.QUERIES["stream_upsert"](spark, sf)
    b = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
