"""The natural model of residue is counted over all texts."""

import numpy as np
from pyspark.sql import functions as F

from wattlake.llm import lm, residue


def test_corpus_tables_equal_those_in_memory(spark):
    plain = [("heat pump rebate ", 3), ("attic insulation, 😀 ", 1), ("pump ", 2), ("x", 1)]
    d = spark.createDataFrame(plain, "t string, n bigint")
    for order, own in ((6, 2), (4, 3), (5, 4)):
        other = ["lorem ipsum ", "error "]
        got = lm.KneserNey(["a", "b"], order, own, 16).fit({"a": other, "b": []}, d, "b")
        exp = lm.KneserNey(["a", "b"], order, own, 16).fit({"a": other, "b": [t for t, n in plain for _ in range(n)]})
        assert got.types == exp.types
        for y in "ab":
            for g, e in zip(got.tables[y], exp.tables[y], strict=True):
                assert all(np.array_equal(p, q) for p, q in zip(g, e, strict=True))
    assert lm.corpus_tables(d.where("n > 9"), ["a"], 6, 2, 16) is None


def test_every_text_counts(spark):
    long = " ".join(f"Zorblax quimby {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} vexatious." for i in range(700))
    assert len(long) > 14_000
    d = spark.createDataFrame([(long,), ("Heat pump rebate 100",), ("heat  pump rebate 200",), (None,), (" ",)], "t string")
    assert {(r["t"][:16], r["n"]) for r in residue.wordings(d, F.col("t")).collect()} == {("zorblax quimby a", 1), ("heat pump rebate", 2)}
    m = residue.fit_all(d, F.col("t"))
    c, owner = lm.coded(["zorblax quimby "], m.order)
    p = m.log_probs(c)
    assert (p["plain"] - p["filler"])[owner >= 0].mean() > 2
    assert residue.fit_all(d.where("false"), F.col("t")).classes == residue.CLASSES
