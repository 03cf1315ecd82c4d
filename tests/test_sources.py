"""Landed sources, snapshots, routing and identity."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from wattlake.functions.identity import source_uuid
from wattlake.operators import routing, staging
from wattlake.sources import landed


def test_json_pages_keep_order(spark, tmp_path):
    for i, ids in enumerate(([3, 1], [2])):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"data": [{"id": x, "name": f"n{x}"} for x in ids], "total": 3}))
    d = landed.json_pages(spark, str(tmp_path), "data array<struct<id:int,name:string>>, total int", "data")
    assert [tuple(r) for r in d.orderBy("page", "pos").collect()] == [("p0.json", 1, 3, "n3"), ("p0.json", 2, 1, "n1"), ("p1.json", 1, 2, "n2")]


def test_postal_codes(spark, tmp_path):
    (tmp_path / "z.csv").write_text('"ZIP","state_id","zcta","military","population"\n"01001","MA","TRUE","FALSE","100"\n"01002","MA","TRUE","FALSE","x"\n"09001","AE","TRUE","TRUE","5"\n"90001","PR","TRUE","FALSE","5"\n"01003","MA","FALSE","FALSE","1"\n')
    states = spark.createDataFrame([("MA", "Massachusetts")], "abbr string, name string")
    got = sorted(tuple(r) for r in landed.postal_codes(spark, str(tmp_path / "z.csv"), states).collect())
    assert got == [("MA", "01001", 100), ("MA", "01002", 0)]


def test_sitemap_and_seeds(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a.example/save/rebates/pump </loc></url><url><loc>https://a.example/news/x.pdf</loc></url></urlset>')
    u = landed.sitemap_urls(spark, str(tmp_path / "s.xml"))
    seeds = spark.createDataFrame([("https://a.example/seed.pdf",)], "loc string")
    assert [tuple(r) for r in landed.pick_urls(u, seeds, ["news"], ["rebates"], 2).collect()] == [("https://a.example/save/rebates/pump", False)]
    assert [tuple(r) for r in landed.pick_urls(u, seeds, [], ["nothing"], 0).collect()] == [("https://a.example/seed.pdf", True)]


def test_pages_join_in_order(spark):
    d = spark.createDataFrame([("f", 3, "c"), ("f", 1, "a"), ("f", 2, None), ("g", 1, "x")], "f string, p int, t string")
    assert {r[0]: r[1] for r in landed.join_pages(d, "f", "p", "t", mark="|").collect()} == {"f": "a|c", "g": "x"}
    assert {r[0]: r[1] for r in landed.join_pages(d, "f", "p", "t", [(2, 9)], "|").collect()} == {"f": "c"}


def test_a_failing_source_does_not_stop_the_others(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "ok"))
    r = landed.Registry()
    r.add(landed.Source("ok", lambda s, p: s.read.parquet(p)))
    r.add(landed.Source("bad", lambda s, p: s.read.parquet(p)))
    d, failed = r.union(spark, {"ok": str(tmp_path / "ok"), "bad": str(tmp_path / "none")})
    assert [tuple(x) for x in d.collect()] == [(1, "ok")] and list(failed) == ["bad"]
    with pytest.raises(ValueError):
        r.union(spark, {"bad": str(tmp_path / "none")})


def test_snapshots(spark, tmp_path):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    staging.write_snapshot(a, str(tmp_path), "t")
    old = staging.read_snapshot(spark, str(tmp_path), "t")
    staging.write_snapshot(staging.insert_absent(old, spark.createDataFrame([(1, "z"), (2, "b"), (2, "a")], "k int, v string"), ["k"], ["v"]), str(tmp_path), "t")
    assert sorted(map(tuple, staging.read_snapshot(spark, str(tmp_path), "t").collect())) == [(1, "a"), (2, "a")]
    assert old.count() == 1


def test_routing_edges(spark):
    rows = [(1, " ca ", None, None, None), (2, None, "Acme Gas", None, None), (3, None, "", None, None), (4, None, None, True, None), (5, None, None, None, ["94105"])]
    d = spark.createDataFrame(rows, "id int, state string, utility string, nationwide boolean, codes array<string>").withColumn("area", F.lit(None).cast("string"))
    rules = [routing.Rule("s", states=("CA",)), routing.Rule("u", organisations=("gas",)), routing.Rule("z", codes=("94105",)), routing.Rule("all")]
    got = {(r["id"], r["rule"]) for r in routing.route(d, rules, "state", "utility", "area", "nationwide", F.col("codes")).collect()}
    assert got == {(1, "s"), (2, "u"), (4, "s"), (4, "u"), (4, "z"), (5, "z"), *((i, "all") for i in range(1, 6))}
    with pytest.raises(ValueError):
        routing.route(d, rules, "state", "utility", "area", "nationwide", F.col("codes"), most=1)


def test_uuid_matches_the_library(spark):
    ns = uuid.uuid5(uuid.NAMESPACE_URL, "https://wattlake.example/src")
    for k in ("1", "schlüssel", ""):
        assert spark.range(1).select(source_uuid("src", F.lit(k))).first()[0] == str(uuid.uuid5(ns, k))
