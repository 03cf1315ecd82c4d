"""Chains of unit labels and of spellings are followed to their end."""

from wattlake.llm import names
from wattlake.operators import units


def test_labels_four_links_from_the_vocabulary(spark):
    chain = ["kwh", "blorps", "frumps", "quonks", "zindles"]
    rows = [(f"{i}{k}", x, 5.0 + k) for i in range(4) for k in range(5) for x in chain[i : i + 2]]
    got = {(r["label"], r["common_unit"], r["scale"], r["round"]) for r in units.label_graph(spark.createDataFrame(rows, "entity string, label string, amount double")).collect()}
    assert got == {(x, "kwh", 1.0, i) for i, x in enumerate(chain)}


def test_long_chain_of_spellings(spark):
    raw = [("a" * 2 * k + "z" * (16 - 2 * k)) + " gas company" for k in range(9)]
    d = spark.createDataFrame([(x,) for x in raw], "x string")
    assert names.pairs(names.organisations(names.distinct_names([d]))).count() == 36
