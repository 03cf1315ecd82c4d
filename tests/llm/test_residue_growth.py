"""What is residue stays the same as the corpus grows: shares instead of counts, and no case by one character."""

from pyspark.sql import functions as F

from wattlake.llm import residue

LINES = [("Requirements", 12), ("How to apply", 3), ("Rebate levels", 9), ("The county tests the heat pump", 2), ("A second inspector signs the form", 1)]


def test_copies_of_a_corpus_give_its_model(spark, monkeypatch):
    monkeypatch.setattr(residue, "CORPUS", sum(n for _, n in LINES), raising=False)
    once = spark.createDataFrame([(t,) for t, n in LINES for _ in range(n)], "t string")
    a = residue.fit_all(once, F.col("t"))
    b = residue.fit_all(once.crossJoin(spark.range(8)).select("t"), F.col("t"))
    for x, y in zip(a.filled["plain"], b.filled["plain"], strict=True):
        for (places, n), (others, m) in zip(x, y, strict=True):
            assert dict(zip(places.tolist(), n.tolist(), strict=True)) == dict(zip(others.tolist(), m.tolist(), strict=True))


def test_one_character_makes_no_case():
    letters = "abcdefghijklmnopqrstuvwxyz"
    natural = [(f"rebate {a}{b}{c}", 10) for a in letters for b in letters for c in letters[::2]] + [(f"{x} requirements", 10) for x in ("our", "all", "the", "of", "to")]
    model = residue.fit(natural)
    assert residue.stretches(model, ["requirements "])[0][0] < residue.THRESHOLD
    assert residue.stretches(model, ["4 ", "page not found "])[0].min() >= residue.THRESHOLD
