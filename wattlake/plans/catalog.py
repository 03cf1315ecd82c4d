"""Queries from staged rows to the catalog and of the evaluation of records, each with its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.functions import labels, urls
from wattlake.functions.identity import source_uuid
from wattlake.functions.text import program_hash
from wattlake.operators import catalog, compare, staging
from wattlake.plans.records import any_sql, map_sql
from wattlake.plans.reference import FORMATS, HASH_SQL, LIVE_SQL, PRIORITY, STRIP_SQL, UNITS, _staged
from wattlake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def _first_sql(c: str, keep: str) -> str:
    return f"arg_min({c}, row(r, id)) FILTER (WHERE {keep})"


def _union_sql(c: str) -> str:
    return f"""(SELECT string_agg(v, '|' ORDER BY r, id, i) FROM (SELECT v, r, id, i, row_number() OVER (PARTITION BY lower(v) ORDER BY r, id, i) AS n
        FROM (SELECT r, id, unnest({c}) AS v, generate_subscripts({c}, 1) AS i FROM s AS z WHERE z.k = s.k) WHERE v IS NOT NULL) WHERE n = 1)"""


_BLANK = "trim(regexp_replace({0}, '\\s+', ' ', 'g')) <> ''"
_PICKED = ", ".join([
    *[f"{_first_sql(c, _BLANK.format(c))} AS {c}" for c in catalog.TEXTS if c not in ("incentive_format", "unit_type")],
    *[f"{_first_sql(c, f'{c} IS NOT NULL')} AS {c}" for c in catalog.VALUES],
    *[f"{_first_sql(c, _BLANK.format(c))} AS {c}__" for c in ("incentive_format", "unit_type")],
])


@query(
    LIVE_SQL
    + f""", m AS (SELECT k, count(*)::BIGINT AS "rows", arg_min(row(program_name, utility_company, source), row(r, id)) AS f, {_PICKED}, {_first_sql('len(rate_tiers)::INTEGER', 'len(rate_tiers) > 0')} AS tiers FROM s GROUP BY k),
o AS (SELECT k, string_agg(source, '|' ORDER BY o) AS sources FROM (SELECT k, source, min(row(r, id)) AS o FROM s WHERE source IS NOT NULL GROUP BY k, source) GROUP BY k),
e AS (SELECT k, r, id, c, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM (SELECT k, r, id, 'category_tag' AS c, category_tag AS l FROM s UNION ALL SELECT k, r, id, 'segment', segment FROM s UNION ALL SELECT k, r, id, 'image_urls', image_urls FROM s)),
n AS (SELECT *, row_number() OVER (PARTITION BY k, c, lower(v) ORDER BY r, id, i) AS n FROM e WHERE v IS NOT NULL),
u AS (SELECT k, string_agg(v, '|' ORDER BY r, id, i) FILTER (WHERE c = 'category_tag') AS category_tag, string_agg(v, '|' ORDER BY r, id, i) FILTER (WHERE c = 'segment') AS segment,
    string_agg(v, '|' ORDER BY r, id, i) FILTER (WHERE c = 'image_urls') AS image_urls FROM n WHERE n = 1 GROUP BY k)
SELECT m.* EXCLUDE (k, f, incentive_format__, unit_type__), m.k AS program_hash, f[1] AS program_name, f[2] AS utility_company, f[3] AS source, coalesce(sources, '') AS sources,
    CASE WHEN incentive_format__ IN {FORMATS} THEN incentive_format__ END AS incentive_format, CASE WHEN unit_type__ IN {UNITS} THEN unit_type__ END AS unit_type,
    coalesce(category_tag, '') AS category_tag, coalesce(segment, '') AS segment, coalesce(image_urls, '') AS image_urls FROM m LEFT JOIN o USING (k) LEFT JOIN u USING (k)""".replace("arg_min(row(program_name, utility_company, source), row(r, id)) AS f", "arg_min([program_name, utility_company, source], row(r, id)) AS f")
)
def merge_whole(spark, d):
    """Every column of the catalog of each program, merged from its staged rows."""
    m = catalog.whole_rows(_staged(spark, d), "k", ["r", "id"], FORMATS, UNITS)
    lists = {c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), "|") for c in ("sources", *catalog.UNIONS)}
    return m.withColumns(lists).withColumn("tiers", F.when(F.size("rate_tiers") > 0, F.size("rate_tiers"))).drop("rate_tiers").withColumnRenamed("k", "program_hash")


_CODES = LIVE_SQL + ", z AS (SELECT DISTINCT k, r, id, source, stg_source_id, zip FROM (SELECT *, unnest(list_concat(coalesce(zip_codes, []), CASE WHEN zip_code <> '' THEN [zip_code] ELSE [] END)) AS zip FROM s)) "


@query(_CODES + "SELECT k AS program_hash, zip, arg_min(stg_source_id, row(r, id)) AS stg_source_id FROM z GROUP BY k, zip")
def code_links(spark, d):
    return catalog.links(_staged(spark, d), "k", ["r", "id"], "stg_source_id").withColumnRenamed("k", "program_hash")


@query(_CODES + "SELECT k AS program_hash, zip, source, arg_min(stg_source_id, row(r, id)) AS stg_source_id FROM z GROUP BY k, zip, source")
def code_links_by_source(spark, d):
    return catalog.links_by_source(_staged(spark, d), "k", ["r", "id"], "source", "stg_source_id").withColumnRenamed("k", "program_hash")


@query(
    _CODES
    + """, w AS (SELECT DISTINCT k, zip FROM z WHERE source = 'dsireusa')
SELECT DISTINCT z.k AS program_hash, z.zip, z.source, z.stg_source_id FROM z JOIN w ON w.k = z.k AND w.zip = z.zip WHERE z.zip <> ''"""
)
def backfill_sources(spark, d):
    """The sources of links that one source made, from all staged rows."""
    s = _staged(spark, d)
    known = catalog.codes_of(s.where("source = 'dsireusa'"), ["k"]).distinct()
    return catalog.backfill(s, known, "k", "source", "stg_source_id").withColumnRenamed("k", "program_hash")


@query(
    LIVE_SQL
    + f""", e AS (SELECT k, r, id, unnest(category_tag) AS c, generate_subscripts(category_tag, 1) AS i FROM s), f AS (SELECT k, c, r, id, i, row_number() OVER (PARTITION BY k, lower(c) ORDER BY r, id, i) AS n FROM e WHERE c IS NOT NULL),
p AS (SELECT k, CASE c {' '.join(f"WHEN '{c}' THEN '{ps[0]}'" for c, ps in labels.PORTFOLIOS.items())} END AS p, r, id, i FROM f WHERE n = 1),
g AS (SELECT k, p, min(row(r, id, i)) AS o FROM p WHERE p IS NOT NULL GROUP BY k, p) SELECT k AS program_hash, string_agg(p, '|' ORDER BY o) AS portfolios FROM g GROUP BY k"""
)
def program_portfolios(spark, d):
    from wattlake.operators.merge import merge

    m = merge(_staged(spark, d), "k", ["r", "id"], unions=["category_tag"])
    return catalog.portfolios(m, "k", "category_tag").select(F.col("k").alias("program_hash"), F.array_join("portfolios", "|").alias("portfolios"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{n.lower().replace(' & ', '-').replace(' ', '-').replace('/', '-')}', '{c}')" for n, c in labels.PORTFOLIO_CODES.items()) + ") v(name, slug, code)")
def portfolio_dimension(spark, d):
    return catalog.seeded(spark)


_NS = uuid.uuid5(uuid.NAMESPACE_URL, "https://wattlake.example/category").hex


@query(
    f"""WITH n AS (SELECT DISTINCT c AS name FROM (SELECT unnest(category_tag) AS c FROM rebates_staging) WHERE c <> ''), h AS (SELECT name, sha1(unhex('{_NS}') || encode(name)) AS h FROM n)
SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab', (instr('0123456789abcdef', substr(h,17,1)) - 1) % 4 + 1, 1)||substr(h,18,3)||'-'||substr(h,21,12) AS id, name,
    replace(replace(replace(lower(name),' & ','-'),' ','-'),'/','-') AS slug, CASE name {' '.join(f"WHEN '{c}' THEN '{ps[0]}'" for c, ps in labels.PORTFOLIOS.items())} END AS portfolio FROM h"""
)
def category_members(spark, d):
    n = table(spark, d, "rebates_staging").select(F.explode("category_tag").alias("name"))
    return catalog.category_rows(n, "name", lambda c: source_uuid("category", c))


@query("SELECT id, t AS subscriber FROM (SELECT DISTINCT id, unnest(stg_tenant_ids) AS t FROM rebates_staging) WHERE t IS NOT NULL")
def subscriber_status(spark, d):
    return catalog.subscriptions(table(spark, d, "rebates_staging"), "id", "stg_tenant_ids")


@query("SELECT DISTINCT s.id, s.program_name, s.source FROM rebates_staging s, (SELECT DISTINCT id, unnest(stg_tenant_ids) AS t FROM rebates_staging) x WHERE x.id = s.id AND x.t = 't-alder' AND s.stg_promotion_status = 'pending' AND s.deleted_at IS NULL")
def pending_of_subscriber(spark, d):
    """The rows that wait for one subscriber: staged rows joined to its status rows."""
    s = table(spark, d, "rebates_staging")
    mine = catalog.subscriptions(s, "id", "stg_tenant_ids").where("subscriber = 't-alder'")
    return s.where("stg_promotion_status = 'pending' and deleted_at is null").join(mine.select("id"), "id").select("id", "program_name", "source")


@query(
    f"""WITH l AS (SELECT program_hash AS h, min(id) AS live FROM rebates WHERE program_hash IS NOT NULL GROUP BY 1)
SELECT s.id, CASE WHEN s.stg_promotion_status = 'pending' AND live IS NOT NULL THEN 'promoted' ELSE s.stg_promotion_status END AS stg_promotion_status,
    CASE WHEN s.stg_promotion_status = 'pending' AND live IS NOT NULL THEN live ELSE s.stg_rebate_id END AS stg_rebate_id FROM (SELECT *, {HASH_SQL} AS h FROM rebates_staging) s LEFT JOIN l USING (h)"""
)
def promote_known(spark, d):
    """Pending rows whose program is in the catalog are promoted with its id; rows in another state stay."""
    live = table(spark, d, "rebates").where("program_hash is not null").groupBy(F.col("program_hash").alias("h")).agg(F.min("id").alias("live"))
    s = table(spark, d, "rebates_staging").select("id", "stg_promotion_status", "stg_rebate_id", program_hash("program_name", "utility_company").alias("h")).join(live, "h", "left")
    out = catalog.change_state(s, s.where("live is not null"), "id", "stg_promotion_status", F.lit("promoted"), F.col("stg_promotion_status") == "pending", {"stg_rebate_id": F.col("live")})
    return out.select("id", "stg_promotion_status", "stg_rebate_id")


@query(
    """SELECT id, CASE WHEN source = 'energy_star' AND stg_promotion_status = 'promoted' AND stg_source_id NOT IN (SELECT stg_source_id FROM rebates_staging WHERE updated_at >= TIMESTAMPTZ '2025-03-01 00:00:00+00' AND stg_source_id IS NOT NULL) THEN 'stale' ELSE stg_promotion_status END AS stg_promotion_status FROM rebates_staging"""
)
def mark_stale(spark, d):
    """Promoted rows of one source that its last run didn't bring go stale."""
    s = table(spark, d, "rebates_staging").select("id", "stg_source_id", "source", "stg_promotion_status")
    seen = table(spark, d, "rebates_staging").where(F.col("updated_at") >= F.lit(datetime(2025, 3, 1, tzinfo=timezone.utc))).select("stg_source_id")
    return catalog.unseen_to(s, seen, "stg_source_id", "stg_promotion_status", "promoted", "stale", F.col("source") == "energy_star").select("id", "stg_promotion_status")


@query(f"SELECT r.id AS rebate_id, s.id AS staging_id, s.source FROM (SELECT *, {HASH_SQL} AS h FROM rebates_staging WHERE deleted_at IS NULL) s JOIN rebates r ON r.program_hash = s.h")
def provenance(spark, d):
    """The staged rows behind each row of the catalog."""
    s = table(spark, d, "rebates_staging").where("deleted_at is null").select(F.col("id").alias("staging_id"), "source", program_hash("program_name", "utility_company").alias("program_hash"))
    return table(spark, d, "rebates").select(F.col("id").alias("rebate_id"), "program_hash").join(s, "program_hash").select("rebate_id", "staging_id", "source")


@query("SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM review_labels)")
def known_ids(spark, d):
    """The rows whose id is known elsewhere: a semi-join."""
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "review_labels").select("doc_id"), "doc_id", "left_semi")


@query("SELECT doc_id, coalesce(v, -1)::DOUBLE AS flagged FROM documents LEFT JOIN (SELECT doc_id, avg(flagged::DOUBLE) AS v FROM review_labels GROUP BY doc_id) USING (doc_id)")
def second_opinion(spark, d):
    """Every row with the second opinion on it, or -1 where there is none."""
    v = table(spark, d, "review_labels").groupBy("doc_id").agg(F.avg(F.col("flagged").cast("double")).alias("v"))
    return table(spark, d, "documents").select("doc_id").join(v, "doc_id", "left").select("doc_id", F.coalesce("v", F.lit(-1.0)).alias("flagged"))


_STAGED_COLS = (
    "program_name", "utility_company", "incentive_description", "incentive_amount", "maximum_amount", "percent_value", "per_unit_amount", "incentive_format", "unit_type", "state", "zip_code", "service_territory",
    "available_nationwide", "customer_type", "product_category", "administrator", "source", "start_date", "end_date", "application_url", "program_url", "contact_email", "contact_phone", "contractor_required", "source_url",
)


@query(f"SELECT id AS stg_source_id, {', '.join(_STAGED_COLS)}, {HASH_SQL} AS stg_program_hash, 'pending' AS stg_promotion_status, nullif(raw_response, '') AS stg_raw_response, nullif(raw_content_type, '') AS stg_raw_content_type FROM incentive")
def staged_rows(spark, d):
    """Extracted rows as rows of the staging table: identity computed anew, empty payloads null, a first state."""
    i = table(spark, d, "incentive")
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    return i.select(
        F.col("id").alias("stg_source_id"), *_STAGED_COLS, program_hash("program_name", "utility_company").alias("stg_program_hash"), F.lit("pending").alias("stg_promotion_status"),
        blank("raw_response").alias("stg_raw_response"), blank("raw_content_type").alias("stg_raw_content_type"),
    )


_IMAGE = "CASE WHEN {0} LIKE 'http://%' OR {0} LIKE 'https://%' THEN {0} WHEN {0} LIKE '//%' THEN 'https:' || {0} WHEN {0} LIKE '/%' THEN 'https://portal.example' || {0} ELSE '' END"


@query(
    f"""WITH x AS (SELECT DISTINCT u FROM (SELECT unnest([image_url, program_url, regexp_replace(program_url, '^https?:', ''), regexp_replace(program_url, '^https?://[^/]*', '')]) AS u FROM rebates_staging) WHERE u IS NOT NULL)
SELECT u AS written, {_IMAGE.format('u')} AS image, u <> '' AND NOT {any_sql('u', labels.NO_IMAGE)} AS is_picture FROM x"""
)
def image_addresses(spark, d):
    """Addresses as absolute ones, and whether they may be those of a picture."""
    p, u = F.col("program_url"), F.col("written")
    forms = F.array("image_url", p, F.regexp_replace(p, "^https?:", ""), F.regexp_replace(p, "^https?://[^/]*", ""))
    x = table(spark, d, "rebates_staging").select(F.explode(forms).alias("written")).where("written is not null").distinct()
    return x.select("written", urls.absolute(u, "https://portal.example/").alias("image"), ((u != "") & ~labels.any_word(u, labels.NO_IMAGE)).alias("is_picture"))


@query("SELECT id, coalesce(nullif(source_url, ''), nullif(program_url, ''), '') AS url FROM rebates_staging")
def source_addresses(spark, d):
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    return table(spark, d, "rebates_staging").select("id", F.coalesce(blank("source_url"), blank("program_url"), F.lit("")).alias("url"))


@query(
    f"""SELECT id, CASE WHEN length(program_name) > 46 THEN substr(program_name, 1, 43) || '...' ELSE program_name END AS program, coalesce(nullif(state, ''), '-') AS state, coalesce(incentive_format, '-') AS format,
    CASE WHEN incentive_amount IS NOT NULL THEN printf('$%.0f', incentive_amount) WHEN percent_value IS NOT NULL THEN printf('%.0f%%', percent_value)
    WHEN per_unit_amount IS NOT NULL AND unit_type IS NOT NULL THEN printf('$%.4f', per_unit_amount) || '/' || unit_type ELSE '-' END AS amount FROM rebates_staging"""
)
def item_list(spark, d):
    """A list of rows to look at: a short name and the amount that speaks first."""
    a, p, u = F.col("incentive_amount"), F.col("percent_value"), F.col("per_unit_amount")
    amount = F.when(a.isNotNull(), F.format_string("$%.0f", F.bround(a, 0))).when(p.isNotNull(), F.format_string("%.0f%%", F.bround(p, 0))).when(u.isNotNull() & F.col("unit_type").isNotNull(), F.concat(F.format_string("$%.4f", u), F.lit("/"), F.col("unit_type"))).otherwise("-")
    n = F.col("program_name")
    return table(spark, d, "rebates_staging").select("id", F.when(F.length(n) > 46, F.concat(F.substring(n, 1, 43), F.lit("..."))).otherwise(n).alias("program"), F.coalesce(F.when(F.col("state") != "", F.col("state")), F.lit("-")).alias("state"), F.coalesce("incentive_format", F.lit("-")).alias("format"), amount.alias("amount"))


@query(
    r"""WITH x AS (SELECT id, raw_response AS r, contains(coalesce(raw_content_type, ''), 'html') OR starts_with(trim(raw_response), '<') AS html FROM incentive WHERE raw_response IS NOT NULL),
y AS (SELECT id, CASE WHEN html THEN trim(regexp_replace(regexp_replace(regexp_replace(r, '<[^>]+>', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')) ELSE r END AS s FROM x)
SELECT id, CASE WHEN length(s) > 7000 THEN substr(s, 1, 7000) || chr(10) || '[content truncated]' ELSE s END AS content FROM y"""
)
def prepared_content(spark, d):
    """Payloads as plain text of bounded length, a limit that is the feature."""
    r = F.col("raw_response")
    html = F.coalesce(F.col("raw_content_type"), F.lit("")).contains("html") | F.trim(r).startswith("<")
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(r, "<[^>]+>", " "), r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))
    s = F.when(html, plain).otherwise(r)
    return table(spark, d, "incentive").where("raw_response is not null").select("id", F.when(F.length(s) > 7000, F.concat(F.substring(s, 1, 7000), F.lit("\n[content truncated]"))).otherwise(s).alias("content"))


# the fields of a record that are compared, with their kinds and weights
FIELDS = {
    "program_name": ("text", 2.0), "utility_company": ("text", 1.5), "incentive_description": ("text", 1.0), "incentive_amount": ("number", 2.0), "maximum_amount": ("number", 1.5), "percent_value": ("number", 1.5),
    "per_unit_amount": ("number", 1.5), "incentive_format": ("text", 1.0), "state": ("text", 1.0), "category_tag": ("list", 1.5), "customer_type": ("text", 1.0), "start_date": ("text", 1.0), "end_date": ("text", 1.0),
    "application_url": ("text", 1.0), "contact_email": ("text", 0.5), "contact_phone": ("text", 0.5), "contractor_required": ("flag", 0.5), "energy_audit_required": ("flag", 0.5),
}


def _status_sql(f: str, kind: str) -> str:
    if kind == "text":
        x, y = (STRIP_SQL.format(f"coalesce({t}.{f}, '')") for t in "ab")
        lx, ly = f"lower({x})", f"lower({y})"
        return (
            f"CASE WHEN {x} = '' AND {y} = '' THEN 'empty' WHEN {x} = '' THEN 'missing' WHEN {y} = '' THEN 'extra' WHEN {lx} = {ly} THEN 'match' "
            f"WHEN (octet_length(encode({x})) >= 490 AND contains({ly}, substr({lx}, 1, 100))) OR contains({lx}, {ly}) OR contains({ly}, {lx}) THEN 'partial' ELSE 'mismatch' END"
        )
    if kind == "number":
        x, y = (f"coalesce(CASE WHEN NOT isnan({t}.{f}) THEN {t}.{f} END, 0)" for t in "ab")
        return f"CASE WHEN {x} = 0 AND {y} = 0 THEN 'empty' WHEN {x} = 0 THEN 'missing' WHEN {y} = 0 THEN 'extra' WHEN abs({x} - {y}) / greatest(abs({y}), 0.01) < 0.05 THEN 'match' ELSE 'mismatch' END"
    if kind == "flag":
        return f"CASE WHEN a.{f} IS NULL AND b.{f} IS NULL THEN 'empty' WHEN a.{f} IS NULL THEN 'missing' WHEN b.{f} IS NULL THEN 'extra' WHEN a.{f} = b.{f} THEN 'match' ELSE 'mismatch' END"
    x, y = (f"list_distinct(list_transform(coalesce({t}.{f}, []), lambda x: lower(trim(x))))" for t in "ab")
    j = f"len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y})))"
    return f"CASE WHEN len(coalesce(a.{f}, [])) = 0 AND len(coalesce(b.{f}, [])) = 0 THEN 'empty' WHEN len(coalesce(a.{f}, [])) = 0 THEN 'missing' WHEN len(coalesce(b.{f}, [])) = 0 THEN 'extra' WHEN {j} >= 0.8 THEN 'match' WHEN {j} >= 0.3 THEN 'partial' ELSE 'missing' END"


_PAIRS = (
    LIVE_SQL
    + f""", a AS (SELECT *, {HASH_SQL} AS h, row_number() OVER (PARTITION BY {HASH_SQL} ORDER BY r, id) AS n FROM s), b AS (SELECT *, row_number() OVER (PARTITION BY program_hash ORDER BY updated_at DESC, id) AS n FROM incentive WHERE program_hash IS NOT NULL),
m AS ("""
    + " UNION ALL ".join(f"SELECT h, a.source, '{f}' AS field, {_status_sql(f, k)} AS status, {w}::DOUBLE AS weight FROM a JOIN b ON a.h = b.program_hash AND a.n = 1 AND b.n = 1" for f, (k, w) in FIELDS.items())
    + ")"
)


def _melted(spark, d) -> DataFrame:
    a = staging.keep_first(_staged(spark, d).select("r", "id", "source", *FIELDS, program_hash("program_name", "utility_company").alias("h")), ["h"], ["r", "id"])
    b = staging.keep_first(table(spark, d, "incentive").where("program_hash is not null").select("id", F.col("program_hash").alias("h"), *FIELDS, (-F.unix_micros("updated_at")).alias("u")), ["h"], ["u", "id"])
    p = a.select("h", "source", *[F.col(f).alias(f"a_{f}") for f in FIELDS]).join(b.select("h", *[F.col(f).alias(f"b_{f}") for f in FIELDS]), "h")
    by = {"text": compare.compare_texts, "number": compare.compare_numbers, "flag": compare.compare_flags, "list": compare.compare_lists}
    parts = F.array(*[F.struct(F.lit(f).alias("field"), by[k](F.col(f"a_{f}"), F.col(f"b_{f}")).alias("status"), F.lit(w).alias("weight")) for f, (k, w) in FIELDS.items()])
    return p.select("h", "source", F.explode(parts).alias("x")).select("h", "source", "x.*")


@query(_PAIRS + " SELECT h, field, status, weight FROM m")
def whole_status(spark, d):
    """All compared fields of staged records against a second reading of them."""
    return _melted(spark, d).drop("source")


_SCORES = _PAIRS + ", g AS (SELECT h, source, CASE WHEN sum(CASE WHEN status <> 'empty' THEN weight ELSE 0 END) > 0 THEN sum(CASE status WHEN 'match' THEN weight WHEN 'partial' THEN weight / 2 ELSE 0 END) / sum(CASE WHEN status <> 'empty' THEN weight ELSE 0 END) ELSE 0 END AS score FROM m GROUP BY h, source)"


def _scored(spark, d) -> DataFrame:
    m = _melted(spark, d)
    return compare.overall(m, "h").join(m.select("h", "source").distinct(), "h")


@query(_SCORES + ", f AS (SELECT *, score = 0 AS failed FROM g) SELECT source, count(*)::BIGINT AS n, avg(score) AS mean, avg(score) FILTER (WHERE NOT failed) AS mean_of_read FROM f GROUP BY source")
def source_scores(spark, d):
    """Mean score a source, with and without the records of which nothing could be read."""
    return compare.means(_scored(spark, d).withColumn("failed", F.col("score") == 0), "source", "score", "failed")


@query(_SCORES + " SELECT h, score, CASE WHEN score >= 0.85 THEN 'good' WHEN score >= 0.65 THEN 'fair' WHEN score >= 0.4 THEN 'weak' ELSE 'poor' END AS grade, repeat('#', floor(score * 10)::INTEGER) || repeat('.', 10 - floor(score * 10)::INTEGER) AS bar FROM g")
def score_grades(spark, d):
    s = F.col("score")
    return _scored(spark, d).select("h", "score", compare.grade(s).alias("grade"), compare.bar(s).alias("bar"))


@query(_PAIRS + " SELECT h, string_agg(field, '|' ORDER BY field) AS fields FROM m WHERE status IN ('missing', 'mismatch') GROUP BY h")
def missing_fields(spark, d):
    m = _melted(spark, d).where(F.col("status").isin("missing", "mismatch"))
    return m.groupBy("h").agg(F.array_join(F.array_sort(F.collect_list("field")), "|").alias("fields"))


@query(f"SELECT c_custkey, coalesce({map_sql('c_mktsegment', {'building': 'Buildings', 'machinery': 'Machines'})}, c_mktsegment) AS label FROM customer")
def mapped_labels(spark, d):
    """Labels by an exact map, the value itself where it has none."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.coalesce(labels.mapped(F.col("c_mktsegment"), {"building": "Buildings", "machinery": "Machines"}), F.col("c_mktsegment")).alias("label"))


@query("SELECT (count(*) / 500 + CASE WHEN count(*) % 500 > 0 THEN 1 ELSE 0 END)::BIGINT AS pages, count(*)::BIGINT AS n FROM orders".replace("count(*) / 500", "count(*) // 500"))
def page_math(spark, d):
    return table(spark, d, "orders").agg(F.ceil(F.count("*") / 500).alias("pages"), F.count("*").alias("n"))


@query("SELECT source, id FROM (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY id) AS n FROM rebates_staging WHERE deleted_at IS NULL) WHERE n <= CASE source " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in zip(PRIORITY, (20, 30, 5))) + " ELSE 1000000000 END")
def limited_sources(spark, d):
    """The first rows of each source up to its own limit, a limit that is the feature; sources without one are whole."""
    return staging.limited(table(spark, d, "rebates_staging").where("deleted_at is null").select("source", "id"), "source", [F.col("id")], dict(zip(PRIORITY, (20, 30, 5), strict=True)))


@query("SELECT id, list_transform(list_filter(coalesce(rate_tiers, []), lambda t: t.amount IS NOT NULL), lambda t: t.id || '=' || printf('%.2f', t.amount) || coalesce(' ' || t.unit, ''))::VARCHAR AS tiers FROM rebates_staging".replace("list_transform(list_filter", "array_to_string(list_transform(list_filter").replace(")::VARCHAR AS tiers", "), '|') AS tiers"))
def tier_texts(spark, d):
    """Tiers of a rate as text."""
    t = F.filter(F.coalesce("rate_tiers", F.array().cast("array<struct<id:string,description:string,amount:double,unit:string>>")), lambda t: t["amount"].isNotNull())
    one = lambda t: F.concat(t["id"], F.lit("="), F.format_string("%.2f", t["amount"]), F.coalesce(F.concat(F.lit(" "), t["unit"]), F.lit("")))
    return table(spark, d, "rebates_staging").select("id", F.array_join(F.transform(t, one), "|").alias("tiers"))
