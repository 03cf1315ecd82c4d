"""What the driver holds while it links: plans, and memory that the JVM has freed."""

from __future__ import annotations

import platform

import pytest
from pyspark.sql import functions as F

from wattlake import session
from wattlake.llm import linkage, names, queries
from wattlake.operators import units

SIDE = """id string, program_name string, utility_company string, segment array<string>, state string, start_date string, end_date string, percent_value double, per_unit_amount double,
unit_type string, incentive_description string, source string"""


@pytest.fixture
def joins(monkeypatch):
    """The number of joins in each plan that a query cuts."""
    seen = []

    def cut(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().treeString().count("Join "))
        return session.cut_lineage(df)

    for m in (queries, linkage, names, units):
        monkeypatch.setattr(m, "cut_lineage", cut)
    return seen


def test_linkage_plans_are_small(spark, sf, joins):
    assert queries.p3_links(spark, sf).count() > 0
    assert max(joins) <= 15  # both sides' rates in one plan, each found twice, took 21


def test_edges_are_found_once(spark, joins):
    s = "id string, org string, `group` string, brand string, place string, product string, sure double, state string, start string, end string, rate string, cluster bigint"
    rows = [(i, "o|gas", "", "", "", "pump", 9.0, "OH", day, "2026-12-31", "x 1", 1) for i, day in (("1", "2026-01-01"), ("2", "2026-02-01"))]
    left, right = spark.createDataFrame(rows, s), spark.createDataFrame([(f"r{x[0]}", *x[1:]) for x in rows], s)
    got = {(x["left"], x["right"]) for x in linkage.link(left, right).collect()}
    assert got == {("1", "r1"), ("2", "r2")}
    assert max(joins) <= 7  # those of the nodes with their rarities; edges joined with their own best took 9


def test_sides_keep_their_own_rates(spark, joins):
    row = lambda id_, share, per, unit: (id_, "Pump rebate", "Ohio Gas", ["Residential"], "ohio", "2026-01-01", None, share, per, unit, "", "a")
    s = spark.createDataFrame([row("1", 0.3, None, "percent"), row("2", None, 5.0, "each"), row(None, 0.2, None, "percent")], SIDE).withColumn("product_category", F.lit("Pump"))
    c = spark.createDataFrame([row("1", 0.5, None, "percent"), row("2", None, None, "")], SIDE).drop("source")
    org = spark.createDataFrame([("ohio gas", "ohio|gas")], "u string, org string")
    alone = {k: {x["id"]: x["rate"] for x in queries._linkable({k: d}, org).collect()} for k, d in (("s", s), ("c", c))}
    rows = queries._linkable({"s": s, "c": c}, org).collect()
    assert len(rows) == 5 and {k: {x["id"]: x["rate"] for x in rows if x["side"] == k} for k in "sc"} == alone
    assert alone["s"]["1"] != alone["c"]["1"] and alone["s"]["2"] and alone["s"][None] is None and alone["c"]["2"] is None
    assert {(x["side"], x["label"]) for x in rows} == {("s", "Pump"), ("c", None)}


def test_freed_memory_is_given_back(spark):
    if platform.libc_ver()[0] != "glibc":
        pytest.skip("another C library")
    assert session.give_back(spark).startswith("Trim native heap")
