"""Queries of the data-processing operators on the driver's tables, each with its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.functions import amounts, arrays, contacts, dates, urls
from wattlake.functions.identity import source_uuid
from wattlake.functions.text import norm, program_hash
from wattlake.operators import compare, merge, report, routing, staging
from wattlake.session import cut_lineage, shared_folder, table
from wattlake.sources.landed import join_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PRIORITY = ("rewiring_america", "dsireusa", "energy_star")
# Formats and units that a catalog takes.
FORMATS = ("dollar_amount", "percent", "per_unit", "tiered", "tax_credit", "tax_deduction", "tax_exemption", "financing", "bill_credit", "free_product", "performance", "narrative")
UNITS = ("watt", "kilowatt", "kwh", "mmbtu", "sqft", "linear_ft", "ton", "unit", "port", "month", "year", "percent_saved", "other")
WS_SQL = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NORM_SQL = "trim(regexp_replace(lower({0}), '" + WS_SQL.replace("{", "{{").replace("}", "}}") + "', ' ', 'g'))"
STRIP_SQL = "regexp_replace({0}, '^" + (WS_SQL + "|" + WS_SQL).replace("{", "{{").replace("}", "}}") + "$', '', 'g')"
HASH_SQL = f"sha256(coalesce({NORM_SQL.format('program_name')},'') || '|' || coalesce({NORM_SQL.format('utility_company')},''))"
RANK_SQL = "CASE source WHEN 'rewiring_america' THEN 0 WHEN 'dsireusa' THEN 1 WHEN 'energy_star' THEN 2 ELSE 3 END"
LIVE_SQL = f"WITH s AS (SELECT *, coalesce(nullif(stg_program_hash,''), {HASH_SQL}) AS k, {RANK_SQL} AS r FROM rebates_staging WHERE deleted_at IS NULL)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _staged(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "rebates_staging").where("deleted_at is null")
    return s.withColumn("k", merge.group_key(F.col("stg_program_hash"), F.col("program_name"), F.col("utility_company"))).withColumn("r", merge.source_rank(F.col("source"), PRIORITY))


@query(
    LIVE_SQL
    + r"""
SELECT k AS program_hash, count(*)::BIGINT AS "rows", arg_min(program_name, row(r,id)) FILTER (WHERE trim(program_name) <> '') AS program_name,
 arg_min(administrator, row(r,id)) FILTER (WHERE trim(administrator) <> '') AS administrator, arg_min(maximum_amount, row(r,id)) FILTER (WHERE maximum_amount IS NOT NULL) AS maximum_amount,
 arg_min(contractor_required, row(r,id)) FILTER (WHERE contractor_required IS NOT NULL) AS contractor_required FROM s GROUP BY k"""
)
def merge_programs(spark, d):
    m = merge.merge(_staged(spark, d), "k", ["r", "id"], texts=["program_name", "administrator"], values=["maximum_amount", "contractor_required"])
    return m.withColumnRenamed("k", "program_hash")


@query(
    LIVE_SQL
    + """, e AS (SELECT k, r, id, i, c FROM (SELECT k, r, id, unnest(category_tag) AS c, generate_subscripts(category_tag, 1) AS i FROM s) WHERE c IS NOT NULL),
 f AS (SELECT k, c, row_number() OVER (PARTITION BY k, lower(c) ORDER BY r, id, i) AS n, r, id, i FROM e)
SELECT s.k AS program_hash, coalesce((SELECT string_agg(c, '|' ORDER BY f.r, f.id, f.i) FROM f WHERE f.k = s.k AND n = 1), '') AS categories FROM s GROUP BY s.k"""
)
def merge_list_union(spark, d):
    """Ordered union of lists, letter case ignored."""
    m = merge.merge(_staged(spark, d), "k", ["r", "id"], unions=["category_tag"])
    return m.select(F.col("k").alias("program_hash"), F.array_join("category_tag", "|").alias("categories"))


@query(LIVE_SQL + """ SELECT k AS program_hash, string_agg(DISTINCT z, ',' ORDER BY z) AS codes FROM (SELECT k, unnest(list_append(coalesce(zip_codes, []), zip_code)) AS z FROM s) WHERE z <> '' GROUP BY k""")
def merge_codes(spark, d):
    """Sorted distinct postal codes of a program, from the scalar and the list."""
    z = F.concat(F.coalesce("zip_codes", F.array().cast("array<string>")), F.array("zip_code"))
    e = _staged(spark, d).select("k", F.explode(z).alias("z")).where("z <> ''").distinct()
    return e.groupBy(F.col("k").alias("program_hash")).agg(F.array_join(F.array_sort(F.collect_list("z")), ",").alias("codes"))


@query(LIVE_SQL + """ SELECT count(*)::BIGINT AS programs, sum(n)::BIGINT AS "rows", count(*) FILTER (WHERE n > 1)::BIGINT AS merged, count(*) FILTER (WHERE m > 1)::BIGINT AS of_several_sources FROM (SELECT k, count(*) AS n, count(DISTINCT source) AS m FROM s GROUP BY k)""")
def group_counters(spark, d):
    g = _staged(spark, d).groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("source").alias("m"))
    return g.agg(F.count("*").alias("programs"), F.sum("n").alias("rows"), F.count_if(F.expr("n > 1")).alias("merged"), F.count_if(F.expr("m > 1")).alias("of_several_sources"))


@query(LIVE_SQL + """ SELECT k AS program_hash, count(*)::BIGINT AS n, min(id) AS first_id FROM s GROUP BY k HAVING count(*) > 1""")
def merge_preview(spark, d):
    """The groups a merge would make, without writing."""
    return _staged(spark, d).groupBy(F.col("k").alias("program_hash")).agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


@query(LIVE_SQL + """, f AS (SELECT k, source, min(row(r,id)) AS o FROM s WHERE source IS NOT NULL GROUP BY k, source) SELECT k AS program_hash, string_agg(source, '|' ORDER BY o) AS sources FROM f GROUP BY k""")
def sources_list(spark, d):
    f = _staged(spark, d).where("source is not null").groupBy("k", "source").agg(F.min(F.struct("r", "id")).alias("o"))
    return f.groupBy(F.col("k").alias("program_hash")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "source"))), lambda x: x["source"]), "|").alias("sources"))


@query(f"SELECT id, {HASH_SQL} AS program_hash FROM rebates_staging")
def program_hashes(spark, d):
    return table(spark, d, "rebates_staging").select("id", program_hash("program_name", "utility_company").alias("program_hash"))


_NS = uuid.uuid5(uuid.NAMESPACE_URL, "https://wattlake.example/documents").hex


@query(
    f"WITH h AS (SELECT doc_id, sha1(unhex('{_NS}') || encode(coalesce(title, '') || doc_id::VARCHAR)) AS h FROM documents) SELECT doc_id, substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab', (instr('0123456789abcdef', substr(h,17,1)) - 1) % 4 + 1, 1)||substr(h,18,3)||'-'||substr(h,21,12) AS uuid FROM h"
)
def deterministic_ids(spark, d):
    x = table(spark, d, "documents")
    return x.select("doc_id", source_uuid("documents", F.concat(F.coalesce("title", F.lit("")), F.col("doc_id").cast("string"))).alias("uuid"))


@query("SELECT stg_promotion_status AS status, count(*)::BIGINT AS n FROM rebates_staging WHERE deleted_at IS NULL GROUP BY 1")
def stats_by_status(spark, d):
    return report.by_status(table(spark, d, "rebates_staging").where("deleted_at is null"), "stg_promotion_status").withColumnRenamed("stg_promotion_status", "status")


@query(
    "SELECT source, count(*)::BIGINT AS total, count(*) FILTER (WHERE stg_promotion_status='promoted')::BIGINT AS promoted, count(*) FILTER (WHERE stg_promotion_status='pending')::BIGINT AS pending, count(*) FILTER (WHERE stg_promotion_status='skipped')::BIGINT AS skipped, count(*) FILTER (WHERE stg_promotion_status='stale')::BIGINT AS stale, round(100.0*count(*) FILTER (WHERE stg_promotion_status='promoted')/nullif(count(*),0),1)::DOUBLE AS rate FROM rebates_staging WHERE deleted_at IS NULL GROUP BY 1"
)
def stats_by_source(spark, d):
    return report.by_source(table(spark, d, "rebates_staging").where("deleted_at is null"), "source", "stg_promotion_status", ("promoted", "pending", "skipped", "stale"))


@query("SELECT coalesce(f, 'unknown') AS value, n FROM (SELECT incentive_format AS f, count(*)::BIGINT AS n FROM rebates_staging WHERE deleted_at IS NULL GROUP BY 1)")
def stats_by_format(spark, d):
    return report.by_value(table(spark, d, "rebates_staging").where("deleted_at is null"), "incentive_format")


@query("WITH c AS (SELECT upper(trim(state)) AS s, count(*) AS n FROM rebates_staging WHERE state IS NOT NULL GROUP BY 1), dim AS (SELECT DISTINCT stateobj.abbreviation AS state FROM dsire_program WHERE stateobj.abbreviation IS NOT NULL) SELECT state, coalesce(n,0)::BIGINT AS n FROM dim LEFT JOIN c ON s = state")
def stats_states(spark, d):
    dim = table(spark, d, "dsire_program").select(F.col("stateobj.abbreviation").alias("state")).where("state is not null").distinct()
    return report.over_dimension(dim, "state", table(spark, d, "rebates_staging"), F.col("state"))


@query(
    "SELECT count(*) FILTER (WHERE coalesce(incentive_description,'') = '')::BIGINT AS no_description, count(*) FILTER (WHERE incentive_amount IS NULL AND maximum_amount IS NULL AND percent_value IS NULL AND per_unit_amount IS NULL)::BIGINT AS no_amount, count(*) FILTER (WHERE state IS NULL)::BIGINT AS no_state, count(*) FILTER (WHERE coalesce(application_url, program_url) IS NULL)::BIGINT AS no_url, count(*) FILTER (WHERE service_territory IS NULL)::BIGINT AS no_territory FROM rebates_staging WHERE deleted_at IS NULL"
)
def stats_quality(spark, d):
    s = table(spark, d, "rebates_staging").where("deleted_at is null")
    c = F.col
    return report.quality(
        s,
        {
            "no_description": F.coalesce(c("incentive_description"), F.lit("")) == "",
            "no_amount": c("incentive_amount").isNull() & c("maximum_amount").isNull() & c("percent_value").isNull() & c("per_unit_amount").isNull(),
            "no_state": c("state").isNull(),
            "no_url": F.coalesce("application_url", "program_url").isNull(),
            "no_territory": c("service_territory").isNull(),
        },
    )


AT = datetime(2025, 6, 1, tzinfo=timezone.utc)


@query(
    "WITH s AS (SELECT created_at AS c, updated_at AS u FROM rebates_staging) SELECT count(*) FILTER (WHERE c >= TIMESTAMPTZ '2025-05-31 00:00:00+00')::BIGINT AS added_day, count(*) FILTER (WHERE u >= TIMESTAMPTZ '2025-05-31 00:00:00+00' AND c < TIMESTAMPTZ '2025-05-31 00:00:00+00')::BIGINT AS changed_day, count(*) FILTER (WHERE c >= TIMESTAMPTZ '2025-05-25 00:00:00+00')::BIGINT AS added_week, count(*) FILTER (WHERE u >= TIMESTAMPTZ '2025-05-25 00:00:00+00' AND c < TIMESTAMPTZ '2025-05-25 00:00:00+00')::BIGINT AS changed_week FROM s"
)
def stats_activity(spark, d):
    return report.activity(table(spark, d, "rebates_staging"), "created_at", "updated_at", AT, {"day": "24 hours", "week": "7 days"})


SHIFT = 500


def _sides(spark, d):
    """All events as a table, and all of them again as arrivals, other values under keys that are shifted: some keys are new, some are known, some aren't seen."""
    e = table(spark, d, "events")
    old = e.select("event_id", "event_type", "value", F.lit("done").alias("state"))
    new = e.select(
        (F.col("event_id") + SHIFT).alias("event_id"), F.concat("event_type", F.lit("2")).alias("event_type"), F.when(F.col("event_type") != "click", F.col("value") + 1).alias("value"), F.lit("new").alias("state")
    )
    return old, new


UPSERT_SQL = f"""WITH e AS (SELECT event_id, event_type, value, 'done' AS state FROM events),
i AS (SELECT event_id + {SHIFT} AS event_id, event_type || '2' AS event_type, CASE WHEN event_type <> 'click' THEN value + 1 END AS value, 'new' AS state FROM events) """


@query(UPSERT_SQL + "SELECT coalesce(e.event_id, i.event_id) AS event_id, CASE WHEN i.event_id IS NOT NULL THEN i.event_type ELSE e.event_type END AS event_type, CASE WHEN i.event_id IS NOT NULL THEN i.value ELSE e.value END AS value, coalesce(e.state, i.state) AS state FROM e FULL JOIN i ON e.event_id = i.event_id")
def upsert_keyed(spark, d):
    return staging.upsert(*_sides(spark, d), "event_id", ["event_type", "value"], ["state"])


@query(UPSERT_SQL + "SELECT coalesce(e.event_id, i.event_id) AS event_id, CASE WHEN i.event_id IS NOT NULL THEN i.event_type ELSE e.event_type END AS event_type, CASE WHEN i.event_id IS NOT NULL THEN i.value ELSE e.value END AS value, coalesce(i.state, e.state) AS state FROM e FULL JOIN i ON e.event_id = i.event_id")
def upsert_refresh(spark, d):
    return staging.upsert(*_sides(spark, d), "event_id", ["event_type", "value"], ["state"], refresh=True)


@query(UPSERT_SQL + "SELECT * FROM e UNION ALL SELECT * FROM i WHERE event_id NOT IN (SELECT event_id FROM e)")
def insert_absent(spark, d):
    old, new = _sides(spark, d)
    return staging.insert_absent(old, new, ["event_id"], ["event_type"])


@query(UPSERT_SQL + "SELECT event_id FROM e WHERE event_id NOT IN (SELECT event_id FROM i)")
def unseen_rows(spark, d):
    old, new = _sides(spark, d)
    return staging.unseen(old, new, "event_id").select("event_id")


@query(
    """WITH n AS (SELECT DISTINCT o_orderkey + 1000 AS l_orderkey, o_custkey AS l_suppkey FROM orders)
SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM n) UNION ALL SELECT * FROM n"""
)
def replace_links(spark, d):
    """The links of lineitem, those of every order that another table has links for replaced by these."""
    new = table(spark, d, "orders").select((F.col("o_orderkey") + 1000).alias("l_orderkey"), F.col("o_custkey").alias("l_suppkey"))
    return staging.replace_links(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), new, "l_orderkey")


@query(LIVE_SQL + """, g AS (SELECT k, arg_min(stg_source_id, row(r,id)) AS first FROM s GROUP BY k), l AS (SELECT program_hash, min(id) AS id FROM rebates WHERE program_hash IS NOT NULL GROUP BY 1) SELECT g.k AS program_hash, coalesce(l.id, g.first) AS id FROM g LEFT JOIN l ON l.program_hash = g.k""")
def reuse_ids(spark, d):
    g = _staged(spark, d).groupBy(F.col("k").alias("program_hash")).agg(F.min_by("stg_source_id", F.struct("r", "id")).alias("first"))
    return staging.reuse_ids(g, table(spark, d, "rebates"), "program_hash", "id", F.col("first")).select("program_hash", "id")


@query("SELECT c AS name, replace(replace(replace(lower(c),' & ','-'),' ','-'),'/','-') AS slug, count(*)::BIGINT AS \"rows\" FROM (SELECT unnest(category_tag) AS c FROM rebates_staging) WHERE c <> '' GROUP BY c")
def category_dimension(spark, d):
    """Members of a dimension made from the tags of rows."""
    t = table(spark, d, "rebates_staging").select(F.explode("category_tag").alias("name")).where("name <> ''")
    return t.groupBy("name").agg(F.count("*").alias("rows")).select("name", contacts.slug(F.col("name")).alias("slug"), "rows")


@query("SELECT id, CASE WHEN incentive_format IN " + str(FORMATS) + " THEN incentive_format END AS format, CASE WHEN unit_type IN " + str(UNITS) + " THEN unit_type END AS unit FROM rebates_staging")
def enum_guard(spark, d):
    return table(spark, d, "rebates_staging").select("id", contacts.keep_listed(F.col("incentive_format"), FORMATS).alias("format"), contacts.keep_listed(F.col("unit_type"), UNITS).alias("unit"))


RULES = [routing.Rule("west", states=("CA", "or", "WA")), routing.Rule("gas", organisations=("Gas Company",)), routing.Rule("codes", codes=("72212", "72213", "10001")), routing.Rule("all")]
ROUTE_SQL = """SELECT id, r AS rule FROM rebates_staging, (VALUES ('west'), ('gas'), ('codes'), ('all')) v(r) WHERE r = 'all' OR coalesce(available_nationwide, false) OR (r = 'west' AND upper(trim(state)) IN ('CA','OR','WA'))
 OR (r = 'gas' AND trim(coalesce(utility_company,'')) <> '' AND (contains(lower(trim(utility_company)), 'gas company') OR contains('gas company', lower(trim(utility_company))))) OR (r = 'codes' AND list_has_any(coalesce(zip_codes, []), ['72212','72213','10001']))"""


def _routed(spark, d):
    return routing.route(table(spark, d, "rebates_staging"), RULES, "state", "utility_company", "service_territory", "available_nationwide", F.col("zip_codes"))


@query(ROUTE_SQL)
def route_rows(spark, d):
    return _routed(spark, d).select("id", "rule")


@query(f"SELECT id, rule FROM (SELECT id, rule, row_number() OVER (PARTITION BY rule ORDER BY id) AS n FROM ({ROUTE_SQL})) WHERE n <= 50")
def route_capped(spark, d):
    """At most 50 rows a rule, a limit that is the feature."""
    return staging.top_n(_routed(spark, d).select("id", "rule"), ["rule"], [F.col("id")], 50).select("id", "rule")


@query(f"SELECT rule, count(*)::BIGINT AS n FROM ({ROUTE_SQL}) GROUP BY rule")
def route_counts(spark, d):
    return _routed(spark, d).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT c_nationkey, c_custkey, n AS rank FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::INTEGER AS n FROM customer) WHERE n <= 5")
def top_per_group(spark, d):
    return staging.top_n(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 5).select("c_nationkey", "c_custkey", "rank")


@query(
    "WITH a AS (SELECT source, id, program_name, row_number() OVER (PARTITION BY source ORDER BY updated_at DESC NULLS LAST, id) AS n FROM rebates_staging WHERE program_url <> ''), b AS (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY n) AS m FROM a WHERE n <= 50 AND NOT (octet_length(encode(trim(coalesce(program_name,'')))) < 10 OR contains(lower(coalesce(program_name,'')), 'log in'))) SELECT source, id FROM b WHERE m <= 10"
)
def sample_in_two_stages(spark, d):
    """A sample a source: the newest 5 n candidates, junk out, the first n of the rest."""
    s = table(spark, d, "rebates_staging").where("program_url <> ''")
    a = staging.top_n(s, ["source"], [F.desc_nulls_last("updated_at"), F.col("id")], 50).withColumnRenamed("rank", "n")
    name = F.coalesce("program_name", F.lit(""))
    a = a.where(~((F.octet_length(F.trim(name)) < 10) | F.lower(name).contains("log in")))
    return staging.top_n(a, ["source"], [F.col("n")], 10).select("source", "id")


@query(f"SELECT t AS text, min(doc_id) AS doc_id FROM (SELECT {NORM_SQL.format('text')} AS t, doc_id FROM documents WHERE text IS NOT NULL) GROUP BY t")
def keep_first_text(spark, d):
    x = table(spark, d, "documents").where("text is not null").select(norm("text").alias("text"), "doc_id")
    return x.groupBy("text").agg(F.min("doc_id").alias("doc_id"))


@query("WITH u AS (SELECT DISTINCT program_url AS u FROM rebates_staging WHERE program_url IS NOT NULL), x AS (SELECT u, regexp_replace(u, '^.*?://', '') AS r FROM u) SELECT u AS url, CASE WHEN contains(r, '/') THEN len(list_filter(string_split(regexp_replace(r, '^[^/]*/', ''), '/'), lambda x: x <> '')) ELSE 0 END::INTEGER AS depth, ends_with(string_split(lower(u), '?')[1], '.pdf') AS is_pdf, coalesce(try_cast(regexp_extract(regexp_replace(u, '/+$', ''), '([^/-]*)$', 1) AS INTEGER), 0) AS number FROM x")
def url_parts(spark, d):
    u = F.col("url")
    x = table(spark, d, "rebates_staging").select(F.col("program_url").alias("url")).where("url is not null").distinct()
    return x.select("url", urls.path_depth(u).cast("int").alias("depth"), urls.is_pdf(u).alias("is_pdf"), urls.last_id(F.regexp_replace(u, "-", "/")).alias("number"))


@query("SELECT DISTINCT program_url AS url FROM rebates_staging WHERE program_url IS NOT NULL AND NOT regexp_matches(lower(program_url), 'county|login') AND regexp_matches(lower(program_url), 'rebates|offers') AND len(list_filter(string_split(regexp_replace(regexp_replace(program_url, '^.*?://', ''), '^[^/]*/', ''), '/'), lambda x: x <> '')) >= 2")
def url_filter(spark, d):
    return table(spark, d, "rebates_staging").select(F.col("program_url").alias("url")).where(urls.keep_url(F.col("program_url"), ["county", "login"], ["rebates", "offers"], 2)).distinct()


PARSE_SQL = r"""x AS (SELECT doc_id, t, coalesce(try_cast(replace(regexp_extract(t, '\$([0-9]+(?:\.[0-9]+)?)\s*/\s*(?:k[Ww][Hh])', 1), ',', '') AS DOUBLE),0) AS a, coalesce(try_cast(replace(regexp_extract(t, '(?i)up\s+to\s+\$([0-9,]+(?:\.[0-9]+)?)', 1), ',', '') AS DOUBLE),0) AS b,
 coalesce(try_cast(replace(regexp_extract(t, '\$([0-9,]+(?:\.[0-9]+)?)', 1), ',', '') AS DOUBLE),0) AS c, coalesce(try_cast(regexp_extract(t, '([0-9]+(?:\.[0-9]+)?)\s*%', 1) AS DOUBLE),0) AS p FROM d)"""


@query("WITH d AS (SELECT doc_id, coalesce(text,'') AS t FROM documents), " + PARSE_SQL + " SELECT doc_id, CASE WHEN a<>0 THEN 'per_unit' WHEN b<>0 OR c<>0 THEN 'dollar_amount' WHEN p<>0 THEN 'percent' ELSE 'narrative' END AS format, CASE WHEN a<>0 THEN a WHEN b<>0 THEN b WHEN c<>0 THEN c WHEN p<>0 THEN p END AS amount FROM x")
def parse_amount(spark, d):
    return table(spark, d, "documents").select("doc_id", amounts.parse_amount(F.col("text")).alias("x")).select("doc_id", "x.*")


_CTX = " OR ".join(f"contains(lower(t), '{w}')" for w in amounts.CONTEXT)


@query("WITH d AS (SELECT doc_id, coalesce(text,'') AS t FROM documents), " + PARSE_SQL + f", y AS (SELECT *, ({_CTX}) AS k FROM x) SELECT doc_id, CASE WHEN NOT k THEN 'narrative' WHEN a<>0 THEN 'per_unit' WHEN b<>0 OR c<>0 THEN 'dollar_amount' WHEN p<>0 THEN 'percent' ELSE 'narrative' END AS format, CASE WHEN NOT k THEN NULL WHEN a<>0 THEN a WHEN b<>0 THEN b WHEN c<>0 THEN c WHEN p<>0 THEN p END AS amount FROM y")
def parse_amount_in_context(spark, d):
    return table(spark, d, "documents").select("doc_id", amounts.parse_amount_in_context(F.col("text")).alias("x")).select("doc_id", "x.*")


@query(r"SELECT doc_id, (len(list_distinct(list_concat(list_transform(regexp_extract_all(coalesce(text,''), '\$([0-9,]+(?:\.[0-9]+)?)', 1), lambda x: '$' || x), list_transform(regexp_extract_all(coalesce(text,''), '([0-9]+(?:\.[0-9]+)?)\s*%', 1), lambda x: x || '%')))))::INTEGER AS n FROM documents")
def distinct_amounts(spark, d):
    return table(spark, d, "documents").select("doc_id", amounts.distinct_amounts(F.col("text")).alias("n"))


_NUM = r"([0-9,]+(?:\.[0-9]+)?)"
_VALUE = "nullif(coalesce(try_cast(replace(regexp_extract(t, '{0}', {1}), ',', '') AS DOUBLE), 0), 0)"


@query(
    rf"""
WITH d AS (SELECT DISTINCT incentiveamount AS a FROM energy_star_raw),
t AS (SELECT a, regexp_replace(coalesce(a, ''), '^{WS_SQL}|{WS_SQL}$', '', 'g') AS t FROM d),
x AS (SELECT a, t = '' OR lower(t) IN ('varies', 'n/a') AS bare,
    regexp_matches(t, '\$\s*{_NUM}\s*-\s*\$\s*{_NUM}') AS rng, regexp_matches(t, '(?i)up\s+to\s+\$\s*{_NUM}') AS up,
    regexp_matches(t, '([0-9]+(?:\.[0-9]+)?)\s*%') AS pc, regexp_matches(t, '\$\s*{_NUM}') AS dl, regexp_matches(t, '^{_NUM}$') AS pl,
    {_VALUE.format(rf"\$\s*{_NUM}\s*-\s*\$\s*{_NUM}", 1)} AS lo, {_VALUE.format(rf"\$\s*{_NUM}\s*-\s*\$\s*{_NUM}", 2)} AS hi,
    {_VALUE.format(rf"(?i)up\s+to\s+\$\s*{_NUM}", 1)} AS vu, {_VALUE.format(r"([0-9]+(?:\.[0-9]+)?)\s*%", 1)} AS vp,
    {_VALUE.format(rf"\$\s*{_NUM}", 1)} AS vd, {_VALUE.format(rf"^{_NUM}$", 1)} AS vl FROM t)
SELECT a AS written,
    CASE WHEN bare THEN 'narrative' WHEN rng THEN 'tiered' WHEN up THEN CASE WHEN vu > 0 THEN 'dollar_amount' END WHEN pc THEN CASE WHEN vp > 0 THEN 'percent' END
    WHEN dl THEN CASE WHEN vd > 0 THEN 'dollar_amount' END WHEN pl THEN CASE WHEN vl > 0 THEN 'dollar_amount' END ELSE 'narrative' END AS format,
    CASE WHEN bare THEN NULL WHEN rng THEN lo WHEN up OR pc THEN NULL WHEN dl THEN vd WHEN pl THEN vl END AS amount,
    CASE WHEN bare THEN NULL WHEN rng THEN hi WHEN up THEN vu END AS maximum,
    CASE WHEN bare OR rng OR up THEN NULL WHEN pc THEN vp END AS percent FROM x"""
)
def listed_amounts(spark, d):
    x = table(spark, d, "energy_star_raw").select(F.col("incentiveamount").alias("written")).distinct()
    return x.select("written", amounts.read_listed_amount(F.col("written")).alias("x")).select("written", "x.*")


@query(r"SELECT doc_id, try_cast(regexp_extract(coalesce(text,''), '\b([1-9][0-9]?|100)\s*%', 1) AS DOUBLE) AS percent FROM documents")
def share_in_text(spark, d):
    return table(spark, d, "documents").select("doc_id", amounts.share_in_text(F.col("text")).alias("percent"))


@query(
    "WITH x AS (SELECT id, trim(start_date) AS t, string_split(trim(start_date), '/') AS p FROM rebates_staging) SELECT id, CASE WHEN len(p)=2 THEN p[2] || '-' || lpad(p[1],2,'0') || '-01' WHEN len(p)=3 THEN p[3] || '-' || lpad(p[1],2,'0') || '-' || lpad(p[2],2,'0') ELSE t END AS day FROM x"
)
def iso_dates(spark, d):
    return table(spark, d, "rebates_staging").select("id", dates.iso_date(F.col("start_date")).alias("day"))


@query("SELECT DISTINCT incentive_start_date AS written, CASE WHEN try_cast(trim(incentive_start_date) AS BIGINT) > 0 THEN strftime(make_timestamp(try_cast(trim(incentive_start_date) AS BIGINT) * 1000), '%Y-%m-%d') END AS day FROM energy_star_raw")
def millis_dates(spark, d):
    x = table(spark, d, "energy_star_raw").select(F.col("incentive_start_date").alias("written")).distinct()
    return x.select("written", dates.millis_date(F.col("written")).alias("day"))


@query("SELECT id, NOT (coalesce(try_strptime(end_date, '%Y-%m-%d') < TIMESTAMP '2025-06-01', false) OR coalesce(try_strptime(start_date, '%Y-%m-%d') > TIMESTAMP '2025-06-01', false)) AS current FROM rebates_staging")
def current_rows(spark, d):
    return table(spark, d, "rebates_staging").select("id", dates.is_current(F.col("start_date"), F.col("end_date"), F.lit(AT)).alias("current"))


@query(
    r"SELECT doc_id, nullif(lower(regexp_extract(coalesce(text,''), '([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})', 1)), '') AS email, CASE WHEN regexp_matches(coalesce(text,''), '(?i)(?:must be (?:installed|completed) by|licensed contractor|approved contractor|trade ally|contractor required|participating contractor)') THEN true END AS contractor, nullif(regexp_extract(coalesce(text,''), '(?i)(?:effective|start(?:s|ing)?|begin(?:s|ning)?|as of|from)\s+(\d{4}-\d{2}-\d{2}|\w+ \d{1,2},?\s*\d{4})', 1), '') AS starts FROM documents"
)
def facts_in_text(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", contacts.email(t).alias("email"), contacts.says(t, contacts.CONTRACTOR).alias("contractor"), dates.date_in_text(t, dates.START).alias("starts"))


LABELS = [("heat pump water heater", "Water Heating"), ("water heater", "Water Heating"), ("geothermal", "Geothermal"), ("heat pump", "HVAC"), ("boiler", "HVAC"), ("rooftop solar", "Solar"), ("solar array", "Solar"), ("insulation", "Insulation"), ("battery", "Energy Storage"), ("charger", "Electric Vehicles")]


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(coalesce(text,'')), '{w}')" for w, x in LABELS if x == lab) + f" THEN '{lab}' END" for lab in dict.fromkeys(x for _, x in LABELS)) + "], lambda x: x IS NOT NULL), '|') AS labels FROM documents")
def infer_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(contacts.infer_labels(F.col("text"), LABELS), "|").alias("labels"))


@query(r"SELECT id, trim(regexp_replace(regexp_replace(coalesce(summary,''), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM dsire_program")
def strip_markup(spark, d):
    return table(spark, d, "dsire_program").select("id", contacts.strip_markup(F.col("summary")).alias("text"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT id, t.id AS tier, t.amount AS amount, t.unit AS unit FROM (SELECT id, unnest(rate_tiers) AS t FROM rebates_staging)")
def explode_tiers(spark, d):
    return table(spark, d, "rebates_staging").select("id", F.explode("rate_tiers").alias("t")).select("id", F.col("t.id").alias("tier"), "t.amount", "t.unit")


@query("SELECT DISTINCT source, z AS zip FROM (SELECT source, unnest(list_append(coalesce(zip_codes, []), zip_code)) AS z FROM rebates_staging WHERE deleted_at IS NULL) WHERE z <> ''")
def backfill_links(spark, d):
    s = table(spark, d, "rebates_staging").where("deleted_at is null")
    return s.select("source", F.explode(F.concat(F.coalesce("zip_codes", F.array().cast("array<string>")), F.array("zip_code"))).alias("zip")).where("zip <> ''").distinct()


DIFF_SQL = LIVE_SQL + f""", i AS (SELECT program_hash AS h, administrator AS a1, maximum_amount AS m1, contractor_required AS c1, category_tag AS t1, row_number() OVER (PARTITION BY program_hash ORDER BY updated_at DESC, id) AS n FROM incentive WHERE program_hash IS NOT NULL),
 g AS (SELECT {HASH_SQL} AS h, administrator AS a2, maximum_amount AS m2, contractor_required AS c2, category_tag AS t2, row_number() OVER (PARTITION BY {HASH_SQL} ORDER BY r, id) AS n FROM s),
 p AS (SELECT i.h, lower({STRIP_SQL.format("coalesce(a1,'')")}) AS x, lower({STRIP_SQL.format("coalesce(a2,'')")}) AS y, coalesce(m1,0) AS m1, coalesce(m2,0) AS m2, c1, c2, list_distinct(list_transform(coalesce(t1,[]), lambda x: lower(trim(x)))) AS l1, list_distinct(list_transform(coalesce(t2,[]), lambda x: lower(trim(x)))) AS l2 FROM i JOIN g ON i.h = g.h AND i.n = 1 AND g.n = 1),
 q AS (SELECT *, CASE WHEN len(list_distinct(list_concat(l1,l2))) > 0 THEN len(list_intersect(l1,l2))::DOUBLE / len(list_distinct(list_concat(l1,l2))) END AS j FROM p),
 d AS (SELECT h, 'administrator' AS field, CASE WHEN x='' AND y='' THEN 'empty' WHEN x='' THEN 'missing' WHEN y='' THEN 'extra' WHEN x=y THEN 'match' WHEN contains(x,y) OR contains(y,x) THEN 'partial' ELSE 'mismatch' END AS status, 1.0::DOUBLE AS weight FROM q
 UNION ALL SELECT h, 'maximum', CASE WHEN m1=0 AND m2=0 THEN 'empty' WHEN m1=0 THEN 'missing' WHEN m2=0 THEN 'extra' WHEN abs(m1-m2)/greatest(abs(m2),0.01) < 0.05 THEN 'match' ELSE 'mismatch' END, 2.0 FROM q
 UNION ALL SELECT h, 'contractor', CASE WHEN c1 IS NULL AND c2 IS NULL THEN 'empty' WHEN c1 IS NULL THEN 'missing' WHEN c2 IS NULL THEN 'extra' WHEN c1=c2 THEN 'match' ELSE 'mismatch' END, 0.5 FROM q
 UNION ALL SELECT h, 'tags', CASE WHEN len(l1)=0 AND len(l2)=0 THEN 'empty' WHEN len(l1)=0 THEN 'missing' WHEN len(l2)=0 THEN 'extra' WHEN j>=0.8 THEN 'match' WHEN j>=0.3 THEN 'partial' ELSE 'missing' END, 1.5 FROM q)"""


def _diff(spark, d):
    inc = staging.keep_first(table(spark, d, "incentive").where("program_hash is not null").withColumn("u", -F.unix_micros("updated_at")), ["program_hash"], ["u", "id"])
    stg = staging.keep_first(_staged(spark, d).withColumn("h", program_hash("program_name", "utility_company")), ["h"], ["r", "id"])
    p = inc.select(F.col("program_hash").alias("h"), F.col("administrator").alias("a1"), F.col("maximum_amount").alias("m1"), F.col("contractor_required").alias("c1"), F.col("category_tag").alias("t1")).join(
        stg.select("h", F.col("administrator").alias("a2"), F.col("maximum_amount").alias("m2"), F.col("contractor_required").alias("c2"), F.col("category_tag").alias("t2")), "h"
    )
    c = F.col
    return compare.melt(p, "h", {"administrator": (compare.compare_texts(c("a1"), c("a2")), 1.0), "maximum": (compare.compare_numbers(c("m1"), c("m2")), 2.0), "contractor": (compare.compare_flags(c("c1"), c("c2")), 0.5), "tags": (compare.compare_lists(c("t1"), c("t2")), 1.5)})


@query(DIFF_SQL + " SELECT * FROM d")
def field_status(spark, d):
    return _diff(spark, d)


@query(DIFF_SQL + " SELECT h, CASE WHEN sum(CASE WHEN status<>'empty' THEN weight ELSE 0 END) > 0 THEN sum(CASE status WHEN 'match' THEN weight WHEN 'partial' THEN weight/2 ELSE 0 END) / sum(CASE WHEN status<>'empty' THEN weight ELSE 0 END) ELSE 0 END AS score FROM d GROUP BY h")
def overall_score(spark, d):
    return compare.overall(_diff(spark, d), "h")


@query(DIFF_SQL + " SELECT field, count(*)::BIGINT AS n FROM d WHERE status IN ('missing','mismatch') GROUP BY field")
def gap_counts(spark, d):
    return compare.gaps(_diff(spark, d))


@query("WITH x AS (SELECT id, list_distinct(list_transform(coalesce(category_tag, []), lambda x: lower(trim(x)))) AS a, list_distinct(list_transform(coalesce(segment, []), lambda x: lower(trim(x)))) AS b FROM rebates_staging) SELECT id, CASE WHEN len(list_distinct(list_concat(a,b))) > 0 THEN len(list_intersect(a,b))::DOUBLE / len(list_distinct(list_concat(a,b))) END AS jaccard FROM x")
def set_similarity(spark, d):
    return table(spark, d, "rebates_staging").select("id", arrays.jaccard(F.col("category_tag"), F.col("segment")).cast("double").alias("jaccard"))


@query("SELECT n_regionkey AS region, string_agg(n_name, '/' ORDER BY n_nationkey) AS text FROM nation GROUP BY 1")
def ordered_pages(spark, d):
    return join_pages(table(spark, d, "nation"), "n_regionkey", "n_nationkey", "n_name", mark="/").select(F.col("n_regionkey").alias("region"), "text")


@query("SELECT c_custkey, p AS profile, (floor((row_number() OVER (ORDER BY c_custkey, p) - 1) / 500))::BIGINT AS batch FROM customer, (VALUES (0),(1),(2)) v(p) ")
def sweep_batches(spark, d):
    """A sweep over keys and three profiles in batches of 500; the number is counted from keys sorted by range, without one task for all."""
    c = table(spark, d, "customer").select("c_custkey").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").withColumn("part", F.spark_partition_id())
    c = cut_lineage(c)
    from pyspark.sql import Window

    sizes = c.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    pos = c.withColumn("pos", F.row_number().over(Window.partitionBy("part").orderBy("c_custkey")) - 1).join(F.broadcast(before), "part").withColumn("pos", F.col("pos") + F.col("before"))
    return pos.select("c_custkey", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("profile"), "pos").select("c_custkey", "profile", F.floor((F.col("pos") * 3 + F.col("profile")) / 500).alias("batch"))


def _landed_twice(spark, d, folder: str) -> DataFrame:
    """A stream of all events, landed in files, each event in two of them."""
    from wattlake.streaming import ingest

    src = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    src.unionByName(src).repartition(4).write.parquet(f"{folder}/in")
    return ingest.landed(spark, f"{folder}/in", src.schema, 2)


@query("SELECT event_id, event_type, value FROM events")
def stream_upsert(spark, d):
    """Events streamed in batches into a snapshot; equals the batch upsert."""
    from wattlake.streaming import ingest

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    ingest.run_available(_landed_twice(spark, d, folder), ingest.upsert_sink(folder, "events", "event_id", ["ts", "event_type", "value"], ["ts", "event_type"]), f"{folder}/ck")
    return staging.read_snapshot(spark, folder, "events").select("event_id", "event_type", "value")


@query("SELECT event_id, event_type FROM events")
def stream_first(spark, d):
    """The first arrival of each event within the watermark."""
    from wattlake.streaming import ingest

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    kept = ingest.first_of_key(_landed_twice(spark, d, folder), "event_id", "ts", "1000 days").select("event_id", "event_type")
    ingest.run_available(kept, lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{folder}/out/{epoch}"), f"{folder}/ck")
    return spark.read.parquet(f"{folder}/out/*")


@query("SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, (2 * count(*))::BIGINT AS n FROM events GROUP BY 1, 2")
def stream_counts(spark, d):
    """Counts by event time as they stand after the last batch: each batch upserts the windows it changes."""
    from wattlake.streaming import ingest

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    counts = ingest.counts_by_window(_landed_twice(spark, d, folder), "ts", ["event_type"], "1 day", "1000 days")
    counts = counts.select(F.concat_ws(" ", "event_type", F.col("window.start").cast("string")).alias("key"), "event_type", F.col("window.start").cast("timestamp_ntz").alias("day"), F.col("count").alias("n"))
    ingest.run_available(counts, ingest.upsert_sink(folder, "counts", "key", ["n"], [-F.col("n")]), f"{folder}/ck", "update")
    return staging.read_snapshot(spark, folder, "counts").select("event_type", "day", "n")
