"""Queries that land rows as a source would and read them back through the sources, each with its SQL twin."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.functions import urls
from wattlake.operators import catalog, staging
from wattlake.session import shared_folder, table
from wattlake.sources import html, landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"


@query("SELECT event_id, event_type, page, pos FROM (SELECT event_id, event_type, event_id // 500 AS page, (row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id))::INTEGER AS pos FROM events)")
def paged_events(spark, d):
    """Pages of an API, landed as documents in any order and each twice, merged in the order of their numbers."""
    e = table(spark, d, "events").withColumn("page", F.floor(F.col("event_id") / 500))
    docs = e.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("results")).select(F.to_json(F.struct(F.col("page").alias("number"), "results")).alias("value"))
    folder = _folder(spark)
    docs.unionByName(docs).write.text(folder)
    rows = landed.paged_rows(spark, folder, "number bigint, results array<struct<event_id:bigint,event_type:string>>", "results", "number")
    return landed.merge_pages(rows, "event_id").select("event_id", "event_type", "page", "pos")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_customers(spark, d):
    """A CSV file with a header in another case, as text."""
    folder = _folder(spark)
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("C_CustKey"), F.col("c_name").alias("C_NAME"), F.col("c_mktsegment").alias("c_mktsegment"))
    c.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)
    return landed.csv_rows(spark, folder, ["c_custkey", "c_name", "c_mktsegment"])


@query("SELECT n_nationkey, n_name FROM nation")
def array_file(spark, d):
    """A file that is one JSON array: a dimension of a few rows."""
    folder = _folder(spark)
    text = json.dumps([{"n_nationkey": r[0], "n_name": r[1]} for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect()], indent=1)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return landed.json_array(spark, folder, "n_nationkey int, n_name string")


@query("SELECT DISTINCT 'https://' || site || '/p' || (doc_id % 100) AS loc FROM documents WHERE site <> ''")
def sitemap_addresses(spark, d):
    """The addresses of a site's map, found through an index of maps."""
    folder = _folder(spark)
    loc = table(spark, d, "documents").where("site <> ''").select(F.concat(F.lit("https://"), "site", F.lit("/p"), (F.col("doc_id") % 100).cast("string")).alias("loc")).distinct()
    loc.write.format("xml").option("rootTag", "urlset").option("rowTag", "url").save(f"{folder}/maps")
    index = spark.createDataFrame([(f"{folder}/maps",), (f"{folder}/gone",)], "loc string")
    index.write.format("xml").option("rootTag", "sitemapindex").option("rowTag", "sitemap").save(f"{folder}/index")
    return landed.sitemap_urls(spark, f"{folder}/index")


@query("SELECT DISTINCT program_url AS loc, ends_with(string_split(lower(program_url), '?')[1], '.pdf') AS is_pdf FROM rebates_staging WHERE program_url IS NOT NULL AND regexp_matches(lower(program_url), 'rebates')")
def picked_addresses(spark, d):
    """The addresses worth a visit; seeds only if none is."""
    loc = table(spark, d, "rebates_staging").select(F.col("program_url").alias("loc")).where("loc is not null")
    seeds = spark.createDataFrame([("https://portal.example/start",)], "loc string")
    return landed.pick_urls(loc, seeds, [], ["rebates"], 0)


@query("SELECT 'https://portal.example/start' AS loc, false AS is_pdf")
def seed_addresses(spark, d):
    """The seeds, where no address passes."""
    loc = table(spark, d, "rebates_staging").select(F.col("program_url").alias("loc")).where("loc is not null")
    seeds = spark.createDataFrame([("https://portal.example/start",)], "loc string")
    return landed.pick_urls(loc, seeds, ["://"], [], 0)


@query(
    """WITH a AS (SELECT id, updated_at, unnest(list_distinct([nullif(program_url, ''), nullif(application_url, '')])) AS address FROM rebates_staging),
b AS (SELECT address, id, row_number() OVER (PARTITION BY address ORDER BY updated_at DESC NULLS LAST, id) AS n FROM a WHERE address IS NOT NULL) SELECT address, id FROM b WHERE n = 1"""
)
def newest_by_address(spark, d):
    """The newest row of each address, be it that of the program or of the application."""
    s = table(spark, d, "rebates_staging").select("id", "program_url", "application_url", "updated_at")
    return landed.newest(s, ["program_url", "application_url"], "updated_at", "id").select("address", "id")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 200 ELSE 100 END AS status FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 200 FROM orders WHERE o_orderstatus = 'P'")
def retried_rows(spark, d):
    """Rows that were refused, fetched again another way."""
    o = table(spark, d, "orders")
    first = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", 403).otherwise(100).alias("status"))
    return landed.retry_blocked(first, o.select("o_orderkey", F.lit(200).alias("status")), "o_orderkey", "status")


@query(
    """WITH t AS (SELECT DISTINCT stg_source_id, unnest(stg_tenant_ids) AS subscriber FROM rebates_staging)
SELECT DISTINCT s.id, t.subscriber FROM t JOIN rebates_staging s ON s.stg_source_id = t.stg_source_id WHERE t.subscriber IS NOT NULL"""
)
def tagged_rows(spark, d):
    """The subscribers that rows of a source are tagged with, for every staged row of that source id."""
    t = catalog.subscriptions(table(spark, d, "rebates_staging"), "stg_source_id", "stg_tenant_ids").distinct()
    return table(spark, d, "rebates_staging").select("id", "stg_source_id").join(t, "stg_source_id").select("id", "subscriber").distinct()


SUBSCRIBERS = [("a", True, ["dsireusa", "energy_star"]), ("b", True, ["energy_star", "pdf_catalog"]), ("c", False, [])]


@query("SELECT * FROM (VALUES ('dsireusa'), ('energy_star'), ('pdf_catalog')) v(source)")
def active_sources(spark, d):
    """The sources that active subscribers want; all of the table's if one of them names none."""
    t = spark.createDataFrame(SUBSCRIBERS, "id string, active boolean, sources array<string>")
    return landed.wanted_sources(t, table(spark, d, "rebates_staging").select("source"))


@query("SELECT DISTINCT source FROM rebates_staging WHERE source IS NOT NULL")
def all_sources(spark, d):
    t = spark.createDataFrame([*SUBSCRIBERS, ("d", True, [])], "id string, active boolean, sources array<string>")
    return landed.wanted_sources(t, table(spark, d, "rebates_staging").select("source"))


@query("SELECT event_id, event_type, value + 1 AS value, user_id FROM events")
def upsert_by_several(spark, d):
    """An upsert keyed on two columns."""
    old = table(spark, d, "events").select("event_id", "event_type", "value", "user_id")
    return staging.upsert(old, old.withColumns({"value": F.col("value") + 1, "user_id": F.lit(-1).cast("bigint")}), ["event_id", "event_type"], ["value"])


@query("SELECT id, len(list_filter([program_name, utility_company, state, administrator, start_date, end_date, program_url], lambda x: x <> ''))::INTEGER AS filled FROM rebates_staging")
def filled_fields(spark, d):
    """The filled fields of a row as a map, and how many they are."""
    names = ("program_name", "utility_company", "state", "administrator", "start_date", "end_date", "program_url")
    by = F.map_filter(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))]), lambda k, v: F.coalesce(v != "", F.lit(False)))
    return table(spark, d, "rebates_staging").select("id", by.alias("m")).select("id", F.size("m").alias("filled"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def loose_json(spark, d):
    """A field that may be a number or text, always as text."""
    return table(spark, d, "events").select("event_id", F.from_json("props", "k string")["k"].alias("k"))


@query("SELECT DISTINCT program_url AS url, coalesce(nullif(regexp_extract(program_url || '?incentive_id=' || id::VARCHAR || '&x=1', 'incentive_id=([^&]*)', 1), ''), '') AS parameter, coalesce(try_cast(regexp_extract(program_url, '([^/-]*)$', 1) AS INTEGER), 0) AS number, id FROM rebates_staging WHERE program_url IS NOT NULL")
def ids_in_addresses(spark, d):
    u = F.col("program_url")
    full = F.concat(u, F.lit("?incentive_id="), F.col("id").cast("string"), F.lit("&x=1"))
    return table(spark, d, "rebates_staging").where(u.isNotNull()).select(u.alias("url"), urls.parameter(full, "incentive_id").alias("parameter"), urls.last_id(F.regexp_replace(u, "-", "/")).alias("number"), "id").distinct()


@query("SELECT id, CASE length(d) WHEN 4 THEN d || '-01-01' WHEN 7 THEN d || '-01' ELSE d END AS day FROM (SELECT id, CASE WHEN id % 3 = 0 THEN substr(start_date, 1, 4) WHEN id % 3 = 1 THEN substr(start_date, 1, 7) ELSE start_date END AS d FROM rebates_staging WHERE regexp_matches(start_date, '^\\d{4}-\\d\\d-\\d\\d$'))")
def whole_dates(spark, d):
    """Dates given to the year or month only, as days."""
    from wattlake.functions import dates

    s = F.col("start_date")
    short = F.when(F.col("id") % 3 == 0, F.substring(s, 1, 4)).when(F.col("id") % 3 == 1, F.substring(s, 1, 7)).otherwise(s)
    return table(spark, d, "rebates_staging").where(s.rlike(r"^\d{4}-\d\d-\d\d$")).select("id", dates.whole_date(short).alias("day"))


@query(
    r"""WITH p AS (SELECT id, replace(replace(raw_response, '&amp;', '&'), '&nbsp;', ' ') AS r FROM incentive WHERE regexp_matches(raw_response, '(?i)<html') AND regexp_matches(raw_response, '(?i)<h1[^>]*>[^<]*\S[^<]*</h1>'))
SELECT DISTINCT id, trim(regexp_replace(regexp_extract(r, '(?i)<h1[^>]*>([^<]*\S[^<]*)</h1>', 1), '\s+', ' ', 'g')) AS title FROM p"""
)
def page_titles(spark, d):
    """The headings of whole HTML pages."""
    i = table(spark, d, "incentive").where(r"raw_response rlike '(?i)<html' and raw_response rlike '(?i)<h1[^>]*>[^<]*\\S[^<]*</h1>'")
    return html.page_facts(i, "id", "raw_response").select("id", "title").distinct()


_JSON_ROW = r"^\s*\{"


@query(
    r"""WITH j AS (SELECT id, try_cast(raw_response AS JSON) AS j FROM incentive WHERE regexp_matches(raw_response, '^\s*\{')),
t AS (SELECT id, try_cast(substr(raw_response, 1, 0) AS VARCHAR) AS x, raw_response AS r FROM incentive WHERE raw_response <> '' AND NOT regexp_matches(raw_response, '^\s*\{') AND NOT regexp_matches(raw_response, '(?i)<(html|body|div|p|h1)[ >]'))
SELECT id, nullif(json_extract_string(j, '$.name'), '') AS title, 'record' AS kind FROM j WHERE j IS NOT NULL UNION ALL SELECT id, string_split(r, chr(10))[1] AS title, 'text' AS kind FROM t"""
)
def extracted_again(spark, d):
    """Stored payloads read again, each by its kind: records by their fields, texts by their first line; pages have a query of their own."""
    raw = F.col("raw_response")
    i = table(spark, d, "incentive").where(raw != "").select("id", "raw_response")
    v = F.try_parse_json(raw)
    name = F.try_variant_get(v, "$.name", "string")
    record = lambda x: x.where(v.isNotNull()).select("id", F.when(name != "", name).alias("title"), F.lit("record").alias("kind"))
    text = lambda x: x.select("id", F.get(F.split(raw, "\n"), F.lit(0)).alias("title"), F.lit("text").alias("kind"))
    none = lambda x: x.where("false").select("id", F.lit("").alias("title"), F.lit("page").alias("kind"))
    return landed.dispatch(i, [(raw.rlike(_JSON_ROW), record), (raw.rlike("(?i)<(html|body|div|p|h1)[ >]"), none), (F.lit(True), text)])


@query("SELECT id, name, administrator FROM dsire_program")
def raw_round_trip(spark, d):
    """Rows kept as JSON text and read back."""
    p = table(spark, d, "dsire_program").select("id", "name", "administrator")
    kept = p.select(F.to_json(F.struct("id", "name", "administrator")).alias("raw"))
    return kept.select(F.from_json("raw", "id int, name string, administrator string").alias("r")).select("r.*")


@query("SELECT count(*)::BIGINT AS n FROM (SELECT DISTINCT source, stg_source_id, unnest(list_append(coalesce(zip_codes, []), zip_code)) AS z FROM rebates_staging) WHERE z <> ''")
def count_links(spark, d):
    z = F.concat(F.coalesce("zip_codes", F.array().cast("array<string>")), F.array("zip_code"))
    return table(spark, d, "rebates_staging").select("source", "stg_source_id", F.explode(z).alias("z")).where("z <> ''").distinct().agg(F.count("*").alias("n"))


def page_programs(spark, d):
    """Programs told from HTML pages."""
    return html.program_pages(html.page_facts(table(spark, d, "incentive").where("raw_response rlike '(?i)<(html|body|div|p|h1)[ >]'"), "id", "raw_response"))


def summary_markdown(spark, d):
    """HTML summaries as Markdown."""
    return html.markdown(table(spark, d, "dsire_program"), "id", "summary")


QUERIES |= {"page_programs": page_programs, "summary_markdown": summary_markdown}
