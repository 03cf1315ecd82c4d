"""The text operators against brute force, round trips and small planted cases, with their edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import abuse, linkage, lm, names, packing, pages, queries, residue, survivor, tokens


# problem 8


def test_ids_and_round_trip(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_file())
    t.encode_special_tokens = True
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: r[1] for r in queries.p8_ids(spark, sf).collect()}
    assert got == {r[0]: (t.encode(r[1], add_special_tokens=False).ids if r[1] else []) for r in rows}
    assert queries.p8_roundtrip(spark, sf).where("not whole").isEmpty()


def test_encoding_edges(spark):
    texts = [None, "", " ", "<|endoftext|>", "näïve 🙂 ｆｕｌｌ", "x" * 300_000, "x" * 300_000]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    e = tokens.encode_with_offsets(d, "i", "t").collect()
    for r in e:
        assert tokens.decode_ids(r["ids"], tokens.tokenizer_file()) == (texts[r["i"]] or "")
        assert all(0 <= a <= b <= len(texts[r["i"]] or "") for a, b in zip(r["starts"], r["ends"]))
    assert 50256 not in next(r["ids"] for r in e if r["i"] == 3)
    assert tokens.encode(d.where("i < 0"), "i", "t").count() == 0


# problem 9


def test_packing(spark):
    rng = random.Random(1)
    sizes = [rng.randint(1, 130) for _ in range(3000)] + [0, None, -3, 1000, 100, 100]
    items = spark.createDataFrame(list(enumerate(sizes)), "i long, n long")
    kinds = spark.createDataFrame([("a", 100), ("b", 400), (None, 5), ("c", None)], "container string, capacity int")
    p = packing.pack(items, "i", "n", kinds, shard_items=1000).toPandas()
    for kind, cap in (("a", 100), ("b", 400)):
        x = p[p["container"] == kind]
        assert x.groupby("bin")["size"].sum().max() <= cap
        whole = x.groupby("id")["size"].sum()
        assert {i: int(n) for i, n in whole.items()} == {i: n for i, n in enumerate(sizes) if n and n > 0}
        assert (x.groupby("id").size() == [-(-sizes[i] // cap) for i in sorted(whole.index)]).all()
    fill = {r["container"]: r["filled"] for r in packing.fill_report(packing.pack(items, "i", "n", kinds), kinds).collect()}
    assert fill["b"] > 0.97
    assert packing.pack(items.where("i < 0"), "i", "n", kinds).count() == 0


def test_sum_of_squares_minimises():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 20, 300)
    level: dict[int, int] = {}
    for i, c in enumerate(packing.sum_of_squares(sizes, 20)):
        counts = np.bincount([v for v in level.values() if v < 20], minlength=21)
        costs = {}
        for k, v in [(-1, 0), *level.items()]:
            if v + sizes[i] <= 20:
                n = counts.copy()
                n[v] -= v > 0
                n[v + sizes[i]] += v + sizes[i] < 20
                costs[k] = int((n[1:20] ** 2).sum())
        assert costs[c if c in level else -1] == min(costs.values())
        level[c] = level.get(c, 0) + int(sizes[i])


# problem 4


def test_survivors_against_brute_force(spark, sf):
    bad = {r[0] for r in queries.staged_residue(spark, sf).collect()}
    groups: dict[str, list] = {}
    n = lambda x: re.sub(r"\s+", " ", (x or "").lower()).strip()
    for r in spark.read.parquet(f"{sf}/rebates_staging.parquet").where("deleted_at is null").collect():
        if r["id"] not in bad:
            groups.setdefault(hashlib.sha256(f"{n(r['program_name'])}|{n(r['utility_company'])}".encode()).hexdigest(), []).append(r)
    rank = {r["source"]: r["trust_rank"] for r in spark.read.parquet(f"{sf}/source_rank.parquet").collect()}
    stand_in = {"see website", "${summary}", "[description]", "n/a", "{{description}}", "-", "tbd", "description", "see program site for details", "no description available", "", "coming soon.", "null", "lorem ipsum dolor sit amet"}
    expected = set()
    for h, g in groups.items():
        if len(g) < 2:
            continue
        texts = [(r["incentive_description"] or "").strip() for r in g]
        key = lambda r: (-rank.get(r["source"], 99), r["updated_at"], -r["id"])
        a = [key(r) for r, t in zip(g, texts) if n(t) not in stand_in and not any(o != t and o.startswith(t) for o in texts)]
        b = [key(r) for r in g if r["maximum_amount"] and r["maximum_amount"] > 0 and r["maximum_amount"] not in (999999.99, 9999999.0, 99999999.0)]
        expected.add((h, -max(a)[2] if a else 0, -max(b)[2] if b else 0))
    assert {tuple(r) for r in queries.p4_found(spark, sf).collect()} == expected


def test_survivor_edges(spark):
    rows = [(1, "g", "Full text here.", "s", None), (2, "g", "Full te…", "s", "2024-01-02"), (3, "g", None, None, "2024-01-03"), (4, "g", "TBD", "s", "2024-01-04"), (5, "h", "x y", "s", None)]
    d = spark.createDataFrame(rows, "id long, g string, t string, source string, at string").withColumn("at", F.to_timestamp("at"))
    d = survivor.mark_beginnings(d, "g", "t", "cut")
    got = survivor.survive(d, "g", "id", F.lit(1), "at", {"t": survivor.is_text(F.col("t")) & ~F.col("cut")}).collect()
    assert [tuple(r) for r in got] == [("g", 4, 1, "Full text here.")]
    assert survivor.survive(d.where("id < 0"), "g", "id", F.lit(1), "at", {"t": survivor.is_text(F.col("t"))}).count() == 0


# problem 2


@pytest.fixture(scope="module")
def residue_model():
    kinds = ["heat pump", "attic insulation", "smart thermostat", "pool pump", "rooftop solar", "boiler tune-up", "led lighting", "clothes washer"]
    groups = ["residential", "commercial", "template house", "sample creek", "error-free", "building 404", "[re]start"]
    natural = [(f"{g} {k} {p}", 3) for g in groups for k in kinds for p in ("rebate", "loan", "incentive program", "discount")]
    return residue.fit([*natural, ("javascript is required", 2), ("{{title}}", 1), ("lorem ipsum dolor", 1)])


@pytest.mark.parametrize(
    ("text", "found"),
    [("Please enable JavaScript to continue", True), ("Smart Thermostat Rebate for [utility] members in [state]", True), ("{{ offer.title }} - Pool Pump Loan", True), ("Lorem ipsum consectetur elit", True), ("503 - Page not found", True), ("Template House Pool Pump Loan", False), ("Building 404 Rooftop Solar Discount", False), ("[Re]Start LED Lighting Rebate", False), ("Residential Heat Pump Rebate", False)],
)
def test_residue(residue_model, text, found):
    r, _, n = residue.stretches(residue_model, [f"{residue.fold(text)} "])
    assert (r[0] >= residue.THRESHOLD or (r[0] >= residue.WHOLE and n[0] >= residue.COVERAGE * len(text))) == found


def test_residue_edges(spark, residue_model):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "x" * 200_000), (5, "Access denied"), (5, "Access denied")], "id int, t string")
    got = {(r["id"], r["found"]) for r in residue.score(d, ("id",), "t", residue_model).collect()}
    assert (5, True) in got and (2, False) in got and (1, True) not in got
    assert residue.fit([]).classes and residue.score(d.where("id < 0"), ("id",), "t", residue_model).count() == 0


# problem 1


def _page(title, body, crumb=""):
    nav = "".join(f'<li><a href="/x/{i}">{w}</a></li>\n' for i, w in enumerate(["Home", "Outages", "Pay Bill"]))
    return f"<html><body>\n<header>\n<div>We use cookies.</div>\n{nav}</header>\n<main>\n{crumb}<h1>{title}</h1>\n{body}</main>\n<footer>\n<p>Privacy Policy</p>\n<p>About Acme: we serve.</p>\n</footer>\n</body></html>"


def test_main_body(spark):
    rows = [(f"h{i}", _page(f"Program {w}", f"<p>Text of {w} with <a href='/q'>a link</a>.</p>\n<h3>Related programs</h3>\n<li><a href='/r'>Other Rebate Program</a></li>\n<li>Copy of the {w}</li>\n"), "https://a.example/p") for i, w in enumerate(["pump", "boiler", "solar", "lamp"])]
    rows.append(("t", "We use cookies.\nHome\n\nOutages\nPay Bill\nProgram fridge\nText of fridge with more.\nRelated programs\nOther Rebate Program\n• Copy of the lease\nPrivacy Policy\nAbout Acme: we serve.", "https://a.example/p"))
    rows += [("j", '{"a": 1}', "https://a.example/p"), ("n", None, None), ("e", "", None), ("h0", rows[0][1], "https://a.example/p"), ("p", "<html><body><div><p>Get {{x}} and <%= y %> of <Product goes here></p></div></body></html>", None)]
    d = spark.createDataFrame(rows, "id string, raw string, url string").withColumn("org", F.lit("Acme"))
    got: dict[str, list] = {}
    for r in pages.main_lines(d, "id", "raw", pages.host_of(F.col("url"), F.lit(None)), "org").orderBy("id", "line_no").collect():
        got.setdefault(r["id"], []).append(r["text"])
    assert got["h0"] == ["Program pump", "Text of pump with a link.", "Copy of the pump"]
    assert got["t"] == ["Program fridge", "Text of fridge with more.", "• Copy of the lease"]
    assert set(got) == {"h0", "h1", "h2", "h3", "t", "p"} and "{{x}}" in got["p"][0] and "goes here" in got["p"][0]


# problem 6


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("dpl (dranimundpark power and light)", ("dranimundpark", ("light", "power"), "")),
        ("power & light of dranimundpark", ("dranimundpark", ("light", "power"), "")),
        ("dranimundpark p&l", ("dranimundpark", ("light", "power"), "")),
        ("gorudopwell p.u.d. (al)", ("gorudopwell", ("district", "public", "utility"), "")),
        ("lolefotfell water and power d/b/a bonitargate", ("lolefotfell", ("power", "water"), "bonitargate")),
        ("the rasivenbook gas comp. - rebate dept", ("rasivenbook", ("gas",), "")),
        ("various utilities", ("", ("utility",), "")),
    ],
)
def test_read_name(name, expected):
    assert names.read_name(name) == expected


def test_name_pairs(spark):
    raw = ["Brenavale Gas Company", "brenavale  gas co.", "Gas Company of Brenavlae", "Brenavale Electric Cooperative", "North Brenavale Gas Company", "N/A", None, "", "unknown", "Brenavale Gas Company"]
    d = spark.createDataFrame([(x,) for x in raw], "x string")
    p = {tuple(r) for r in names.pairs(names.organisations(names.distinct_names([d, d]))).collect()}
    assert p == {("brenavale gas co.", "brenavale gas company"), ("brenavale gas co.", "gas company of brenavlae"), ("brenavale gas company", "gas company of brenavlae")}
    assert names.pairs(names.organisations(names.distinct_names([d.where("x = '?'")]))).count() == 0


def test_deletions_find_all_small_edits():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(8, 11))) for _ in range(150)]
    for a in words:
        for b in words:
            if names.edit_distance(a, b) <= 2:
                assert names.deletions(a) & names.deletions(b)


# problem 3


def test_linkage(spark):
    def row(side, id_, name, org="acme|gas", group="", start=None):
        return (side, id_, name, org, group, None, start, None, None)

    rows = [
        row("s", "1", "residential heat pump rebate", group="residential"), row("s", "2", "residential heat pump loan", group="residential"), row("s", "3", "commercial heat pump rebate", group="commercial"),
        row("s", "4", "attic insulation rebate", start="2024-01-01"), row("s", "5", "attic insulation rebate", org="other|gas"), row("s", "5b", "", org="acme|gas"),
        row("c", "A", "heat pump incentive, residential", group="residential"), row("c", "B", "rebate for attic insulation", start="2024-01-01"),
    ]
    d = spark.createDataFrame(rows, "side string, id string, name string, org string, segment string, label string, start string, end string, rate string")
    m = linkage.ProductModel([("heat pump rebate", "Heat Pump"), ("attic insulation rebate", "Attic Insulation")] * 3)
    r = linkage.settle_places(linkage.marks(linkage.read(d.where("name <> ''"), m), {}))
    r = r.withColumn("cluster", F.xxhash64("org", "name", "group"))
    got = {(x["left"], x["right"]) for x in linkage.link(r.where("side = 's'"), r.where("side = 'c'")).collect()}
    assert got == {("1", "A"), ("2", "A"), ("4", "B")}


def test_links_hold_to_dates(spark, sf):
    p = queries.p3_links(spark, sf)
    s = spark.read.parquet(f"{sf}/rebates_staging.parquet").select(F.col("id").alias("staging_id"), F.col("start_date").alias("a"))
    c = spark.read.parquet(f"{sf}/rebates.parquet").select(F.col("id").alias("rebate_id"), F.col("start_date").alias("b"))
    x = p.join(s, "staging_id").join(c, "rebate_id").where("a rlike '^....-..-..$' and b rlike '^....-..-..$'")
    assert p.count() == p.select("staging_id").distinct().count()
    assert x.where("a = b").count() >= 0.9 * x.count()


# problem 10


def test_abuse(spark):
    plain = ["The grower checks the load sheet.", "Keep the paid invoice.", "A licensed contractor has to complete the work.", "The damn thing finally works.", "Rats had chewed the cable.", "The board approves the permit copy."]
    bad = ["you are a stupid idiot", "Refugees are vermin, send them back!", "send me nudes baby", "go to hell you worthless scumbag", "someone should break your jaw"]
    rng = random.Random(4)
    docs = [(i, " ".join(rng.sample(plain, 4)), 0) for i in range(60)] + [(100 + i, f"{rng.choice(plain)} {rng.choice(bad)}. {rng.choice(plain)}", 1) for i in range(20)]
    d = spark.createDataFrame([(i, t) for i, t, _ in docs] + [(900, None), (901, ""), (902, " "), (903, "the " * 60_000), (904, "You are a 1d10t, you s c u m b a g!"), (905, "Rats had chewed the cable.")], "id long, text string")
    reviews = spark.createDataFrame([(i, y) for i, _, y in docs if i % 2 == 0] + [(2, None)], "id long, flagged int")
    m = abuse.train(d, "id", "text", reviews)
    got = {r["id"]: r for r in abuse.score(d, "id", "text", m).collect()}
    assert all(got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[904]["flagged"] and not got[905]["flagged"] and not got[903]["flagged"]
    right = [got[i]["flagged"] == bool(y) for i, _, y in docs]
    assert sum(right) >= 0.95 * len(right)
    assert abuse.score(d.where("id < 0"), "id", "text", m).count() == 0


def test_kneser_ney_sums_to_one():
    m = lm.KneserNey(["a", "b"], order=3, own=2, bits=16).fit({"a": ["abab", "abba"], "b": ["bbbb"]})
    for context in ("a", "ab", "b"):
        c, owner = lm.coded([context + x for x in "ab"], m.order)
        p = np.exp(m.log_probs(c)["a"])
        last = [np.flatnonzero(owner == i)[-1] for i in range(2)]
        assert 0.5 < p[last].sum() <= 1.001


def test_windows_against_brute_force():
    rng = np.random.default_rng(5)
    texts = ["x" * int(n) for n in rng.integers(1, 30, 20)]
    c, owner = lm.coded(texts, 4)
    g = rng.normal(size=len(c))
    best, frm, at = lm.best_windows(g, owner, len(texts))
    for i in range(len(texts)):
        x = g[owner == i]
        assert abs(best[i] - max(max(x[a:b].sum() for a in range(len(x)) for b in range(a + 1, len(x) + 1)), 0)) < 1e-6 or best[i] < 0
