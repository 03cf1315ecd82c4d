"""Recurring subtrees of a host's pages, with headings in the masthead and containers nested beside them."""

from pyspark.sql import functions as F

from wattlake.llm import pages


def _lines(spark, bodies, host="a.example"):
    d = spark.createDataFrame([(f"p{i}", f"<html><body>\n{b}\n</body></html>", f"https://{host}/{i}") for i, b in enumerate(bodies)], "id string, raw string, url string")
    got: dict[str, list] = {}
    for r in pages.main_lines(d.withColumn("org", F.lit("Acme")), "id", "raw", pages.host_of(F.col("url"), F.lit(None)), "org").orderBy("id", "line_no").collect():
        got.setdefault(r["id"], []).append(r["text"])
    return got


WORDS = ["pump", "boiler", "solar", "lamp", "attic"]


def test_heading_in_the_masthead(spark):
    got = _lines(spark, [f"<header>\n<h1>Acme Power</h1>\n<p>We serve you.</p>\n</header>\n<div>\n<h2>The {w}</h2>\n<p>Text of the {w} for homes.</p>\n</div>" for w in WORDS])
    assert got == {f"p{i}": [f"The {w}", f"Text of the {w} for homes."] for i, w in enumerate(WORDS)}


def test_containers_beside_the_heading(spark):
    page = "<div>\n<h1>The {0}</h1>\n<section>\n<p>Text of the {0}.</p>\n</section>\n<div>\n<p>Share this page with a friend.</p>\n</div>\n<aside>\n<p>About {0} vendors.</p>\n</aside>\n</div>"
    got = _lines(spark, [page.format(w) for w in WORDS])
    assert got == {f"p{i}": [f"The {w}", f"Text of the {w}."] for i, w in enumerate(WORDS)}


def test_heading_apart_from_its_text(spark):
    got = _lines(spark, [f"<header>\n<h1>The {w}</h1>\n</header>\n<div>\n<p>Text of the {w}.</p>\n</div>\n<footer>\n<p>Acme serves homes.</p>\n</footer>" for w in WORDS])
    assert got == {f"p{i}": [f"The {w}", f"Text of the {w}."] for i, w in enumerate(WORDS)}


def test_pages_served_twice_keep_their_body(spark):
    got = _lines(spark, ["<main>\n<h1>The pump</h1>\n<p>Text of the pump.</p>\n</main>"] * 2)
    assert got == {"p0": ["The pump", "Text of the pump."], "p1": ["The pump", "Text of the pump."]}
