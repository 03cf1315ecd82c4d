"""Nested records and units against brute force, and their edge cases."""

import json

import pytest

from wattlake.operators import nested, units
from wattlake.plans import problems


def _whole(text):
    t = text.lstrip("﻿ \n\r\t")
    if t.startswith(")]}'"):
        t = t[4:].lstrip(",; \n")
    for a, b in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        if t.startswith("{&quot;") or t.startswith("{\n") and "&quot;" in t[:20] or a != "&quot;" and "&" in t:
            t = t.replace(a, b)
    try:
        o = json.loads(t)
        return json.loads(o) if isinstance(o, str) else o
    except ValueError:
        return None


def _filled(x):
    if isinstance(x, dict):
        return any(_filled(v) for v in x.values())
    if isinstance(x, list):
        return any(_filled(v) for v in x)
    return x is not None and str(x).strip() != ""


def _items(x):
    return x if isinstance(x, list) else [] if x is None else [x]


def test_children_against_brute_force(spark, sf):
    expected = set()
    for r in spark.read.parquet(f"{sf}/energy_star_raw.parquet").select("incentive_id", "incentivedata").collect():
        o = _whole(r[1]) if r[1] else None
        if not isinstance(o, dict):
            continue
        for i, x in enumerate(_items(o.get("incentivedeliverymechanics")), 1):
            expected |= {("mechanic", r[0], 0, i)} if _filled(x) else set()
        for i, x in enumerate(_items(o.get("incentivecomments")), 1):
            expected |= {("comment", r[0], 0, i)} if _filled(x) else set()
            for j, y in enumerate(_items(x.get("replies")) if isinstance(x, dict) else [], 1):
                expected |= {("reply", r[0], i, j)} if _filled(y) else set()
    for r in spark.read.parquet(f"{sf}/dsire_program.parquet").select("id", "parametersets").collect():
        for i, s in enumerate(r[1] or [], 1):
            for f, tag in (("parameters", "parameter"), ("technologies", "technology"), ("sectors", "sector")):
                for j, x in enumerate((s[f] if s else None) or [], 1):
                    if x and any(v is not None for v in x):
                        expected.add((tag, str(r[0]), i, j))
    got = [tuple(r) for r in problems.p7_found(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_nested_edges(spark, tmp_path):
    c = (nested.JsonChild("m", "m", (("r", "r"),)),)
    rows = [("a", '{"m": [null, {}, {"x": 1, "r": [null, {"t": "y"}]}]}'), ("b", '{"m": "text"}'), ("c", '{"m": {"x": " "}}'), ("d", '{"m": ['), ("e", None), ("f", ""), (None, '{"m": [1]}'), ("g", "﻿{&quot;m&quot;: [&quot;z&quot;]}"), ("h", json.dumps('{"m": [2]}')), ("a", '{"m": [null, {}, {"x": 2}]}')]
    d = nested.json_children(spark.createDataFrame(rows, "k string, j string"), "k", "j", c)
    m = nested.merge_repeats(d)
    assert sorted(tuple(r)[:4] for r in m.collect()) == [("m", "a", 0, 3), ("m", "b", 0, 1), ("m", "g", 0, 1), ("m", "h", 0, 1), ("r", "a", 3, 2)]
    nested.write_tagged(m, str(tmp_path / "t"))
    assert [tuple(r) for r in nested.read_tag(spark, str(tmp_path / "t"), "r", "t string").collect()] == [("a", 3, 2, "y")]
    assert nested.json_children(spark.createDataFrame([], "k string, j string"), "k", "j", c).count() == 0


SCHEMA = "id long, program_name string, utility_company string, percent_value double, per_unit_amount double, unit_type string, incentive_description string"


@pytest.mark.parametrize(
    ("percent", "per_unit", "unit", "text", "expected"),
    [
        (30.0, None, None, None, ("percent", 30.0)),
        (0.3, None, None, "Customers get back 30 % of eligible cost.", ("percent", 30.0)),
        (0.3, None, "other", "It covers thirty percent of the installed price.", ("percent", 30.0)),
        (0.5, None, None, "The payment equals 0.5 percent of the invoice.", ("percent", 0.5)),
        (0.5, None, None, None, None),
        (2500.0, None, "bps", None, ("percent", 25.0)),
        (None, 50.0, "‰", None, ("percent", 5.0)),
        (None, 59.0, "other", "The program pays 59 cents per kWh.", ("kwh", 0.59)),
        (None, 0.59, None, "The program pays 59 cents per kWh.", ("kwh", 0.59)),
        (None, 240.0, None, "The program pays $240 per dozen.", ("unit", 20.0)),
        (None, 335.0, None, "Payment is $335 for every 100 square feet installed.", ("sqft", 3.35)),
        (None, 19.913215, None, "The program pays $19.913215 per m².", ("sqft", 1.85)),
        (None, 2.35, "$/therm", None, ("mmbtu", 23.5)),
        (None, 52.083333, "kBtu/h", None, ("ton", 624.999996)),
        (None, 15.0, None, "Participants receive $15 each quarter, up to the cap.", ("year", 60.0)),
        (None, 5.0, "furlong", None, None),
        (None, float("nan"), "kW", None, None),
        (None, None, "kW", "x", None),
    ],
)
def test_units(spark, percent, per_unit, unit, text, expected):
    d = spark.createDataFrame([(1, "p", None, percent, per_unit, unit, text)], SCHEMA)
    got = units.harmonise(d).collect()
    if expected is None:
        assert got == []
    else:
        assert (got[0][1], round(got[0][2], 5)) == (expected[0], round(expected[1], 5)) and len(got) == 1


def test_unknown_label_is_learned_from_linked_entities(spark):
    rows = []
    for i in range(8):
        rows += [(2 * i, f"p{i}", "u", None, 100.0 + i, "kW", None), (2 * i + 1, f"p{i}", "u", None, (100.0 + i) / 1000, "kilo-watt-ish/1000", None)]
    got = {r[0]: (r[1], round(r[2], 3)) for r in units.harmonise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == ("kilowatt", 100.0) and len(got) == 16


def test_units_of_an_empty_table(spark):
    assert units.harmonise(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", sorted(problems.ORACLE))
def test_sql_twin(spark, sf, name):
    import oracle

    assert oracle.compare(problems.QUERIES[name](spark, sf), oracle.connect(sf), problems.ORACLE[name]) == ""


def test_graph_without_the_vocabulary(spark):
    """Labels that only links to three anchors tell come out as the vocabulary has them."""
    rows = []
    for i in range(6):
        v = 10.0 + i
        rows += [(f"a{i}", "s1", v, "kwh"), (f"a{i}", "s2", v * 1000, "mwh"), (f"b{i}", "s1", v, "sqft"), (f"b{i}", "s3", v * 10.7639, "square metre"), (f"c{i}", "s2", v, "ton"), (f"c{i}", "s3", v / 12, "kbtuh")]
    g = {r["label"]: (r["common_unit"], round(r["scale"], 6), r["round"]) for r in units.label_graph(spark.createDataFrame(rows, "entity string, source string, amount double, label string")).collect()}
    assert g["mwh"] == ("kwh", 0.001, 1) and g["square metre"] == ("sqft", round(1 / 10.7639, 6), 1) and g["kbtuh"] == ("ton", 12.0, 1)
    e = units.source_edges(spark.createDataFrame(rows, "entity string, source string, amount double, label string")).collect()
    assert {(r["label_a"], r["label_b"], round(r["scale"], 6)) for r in e} == {("kwh", "mwh", 1000.0), ("sqft", "square metre", 10.7639), ("ton", "kbtuh", round(1 / 12, 6))}
