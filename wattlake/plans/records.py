"""Queries that map landed records to canonical program rows, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.functions import amounts, contacts, labels
from wattlake.operators import records
from wattlake.plans.reference import NORM_SQL, ORACLE as _TWINS, STRIP_SQL
from wattlake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def any_sql(text: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), '{w}')" for w in words) + ")"


def rules_sql(text: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN {any_sql(text, ws)} THEN '{label}'" for label, ws in rules) + " END"


def map_sql(text: str, by) -> str:
    return f"CASE lower({text}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in by.items()) + " END"


def _inner_sql(field: str) -> str:
    return f"list_filter(flatten(list_filter(list_transform(parametersets, lambda s: s.{field}), lambda x: x IS NOT NULL)), lambda x: x IS NOT NULL)"


_AMOUNT = f"try_cast({STRIP_SQL.format('x.amount')} AS DOUBLE)"
_RATES = "(" + ", ".join(f"'{u}'" for u in records.RATE_UNITS) + ")"
#: (id, fmt, amt, most, pct, per, unit) of every row, from its parameters alone
PARAMETERS_SQL = f"""
p AS (SELECT row_number() OVER () AS rid, * FROM dsire_program),
q AS (SELECT *, list_transform(list_filter({_inner_sql('parameters')}, lambda x: x.source = 'Incentive' AND {_AMOUNT} <> 0),
    lambda x: {{'a': {_AMOUNT}, 'u': lower({STRIP_SQL.format("coalesce(x.units, '')")}), 'm': lower(coalesce(x.qualifier, '')) = 'max'}}) AS v FROM p),
e AS (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM q),
b AS (SELECT rid, min(i) FILTER (WHERE x.u IN {_RATES}) AS began FROM e GROUP BY rid),
g AS (SELECT e.rid, arg_max(x.a, i) FILTER (WHERE x.u IN {_RATES}) AS per, arg_max(x.u, i) FILTER (WHERE x.u IN {_RATES}) AS per_u,
    arg_max(x.a, i) FILTER (WHERE x.u = '%' AND (began IS NULL OR i < began)) AS pct, arg_min(x.a, i) FILTER (WHERE x.u = '$' AND NOT x.m) AS amt,
    arg_max(x.a, i) FILTER (WHERE x.u = '$' AND x.m) AS most, count(*) FILTER (WHERE x.u = '$') AS sums FROM e JOIN b USING (rid) GROUP BY e.rid),
r AS (SELECT q.*, CASE WHEN per IS NOT NULL THEN 'per_unit' WHEN pct IS NOT NULL THEN 'percent' WHEN sums > 0 THEN 'dollar_amount' ELSE 'narrative' END AS fmt, amt, most, pct, per,
    {map_sql('per_u', records.RATE_UNITS)} AS unit, {rules_sql('typeobj.name', labels.TYPE_FORMATS)} AS told FROM q LEFT JOIN g USING (rid)),
t AS (SELECT *, told IS NOT NULL AND fmt IN ('narrative', 'dollar_amount') AS narrowed, coalesce(told = 'financing', false) AND fmt IN ('narrative', 'dollar_amount') AS financed FROM r)"""


@query(
    f"WITH {PARAMETERS_SQL} SELECT id, fmt AS format, amt AS amount, most AS maximum, pct AS percent, per AS per_unit, unit FROM t"
)
def parameter_amounts(spark, d):
    """The amounts that nested parameters state."""
    return table(spark, d, "dsire_program").select("id", records.read_parameters(F.col("parametersets")).alias("r")).select("id", "r.*")


_TECH = f"""
u AS (SELECT rid, unnest({_inner_sql('technologies')}) AS x, generate_subscripts({_inner_sql('technologies')}, 1) AS i FROM t),
w AS (SELECT rid, l, min(i * 2 + k) AS o FROM (SELECT rid, i, 0 AS k, {rules_sql('x.name', labels.TECHNOLOGIES)} AS l FROM u UNION ALL SELECT rid, i, 1, {map_sql('x.category', labels.CATEGORIES)} FROM u) WHERE l IS NOT NULL GROUP BY rid, l),
c AS (SELECT rid, string_agg(l, '|' ORDER BY o) AS categories FROM w GROUP BY rid),
v AS (SELECT rid, unnest({_inner_sql('sectors')}).name AS n, generate_subscripts({_inner_sql('sectors')}, 1) AS i FROM t),
s AS (SELECT rid, string_agg(n, ', ' ORDER BY o) AS customer_type FROM (SELECT rid, n, min(i) AS o FROM v WHERE n <> '' GROUP BY rid, n) GROUP BY rid)"""
_DAY = """CASE WHEN len({p}) = 2 THEN {p}[2] || '-' || lpad({p}[1], 2, '0') || '-01' WHEN len({p}) = 3 THEN {p}[3] || '-' || lpad({p}[1], 2, '0') || '-' || lpad({p}[2], 2, '0') ELSE {t} END"""


def _day_sql(c: str) -> str:
    t = STRIP_SQL.format(c)
    return f"nullif({_DAY.format(p=f'string_split({t}, chr(47))', t=t)}, '')"


def _hash_sql(name: str, organisation: str) -> str:
    return f"sha256(coalesce({NORM_SQL.format(name)},'') || '|' || coalesce({NORM_SQL.format(organisation)},''))"


@query(
    rf"""
WITH {PARAMETERS_SQL}, {_TECH},
f AS (SELECT *, coalesce(name, '') AS nm, coalesce(administrator, '') AS ad, coalesce(stateobj.name, '') AS st, coalesce(sectorobj.name, '') AS se, coalesce(stateobj.abbreviation, '') AS ab,
    coalesce(entirestate, false) AS whole, nullif(trim(regexp_replace(regexp_replace(coalesce(summary, ''), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')), '') AS txt FROM t),
h AS (SELECT *, CASE WHEN instr(nm, ' — ') > 1 THEN trim(string_split(nm, ' — ')[1]) WHEN instr(nm, ' - ') > 1 THEN trim(string_split(nm, ' - ')[1]) WHEN st <> '' THEN st || ' State Programs' ELSE 'DSIRE USA' END AS fb,
    try_cast(regexp_extract(coalesce(txt, ''), '\b([1-9][0-9]?|100)\s*%', 1) AS DOUBLE) AS share FROM f),
k AS (SELECT *, CASE WHEN ad <> '' THEN ad WHEN se = 'State' THEN st || ' State Programs' WHEN se = 'Local Government' THEN st || ' Local Government' ELSE fb END AS org FROM h)
SELECT id, name AS program_name, org AS utility_company, nullif(ad, '') AS administrator, nullif(ab, '') AS state,
    CASE WHEN se = 'State' OR whole THEN st || ' Statewide' WHEN ad <> '' THEN ad || ' Service Area' ELSE fb || ' Service Territory' END AS service_territory,
    ab = '' OR (whole AND se = 'Federal') AS available_nationwide, {_day_sql('startdate')} AS start_date, {_day_sql('enddate')} AS end_date, txt AS incentive_description, nullif(websiteurl, '') AS program_url,
    CASE WHEN pct IS NULL AND share IS NOT NULL AND (CASE WHEN narrowed THEN told ELSE fmt END) = 'narrative' THEN 'percent' WHEN narrowed THEN told ELSE fmt END AS incentive_format,
    coalesce(CASE WHEN NOT financed THEN amt END, CASE WHEN unit IN ('unit', 'port') THEN per END) AS incentive_amount, CASE WHEN financed THEN coalesce(most, amt) ELSE most END AS maximum_amount,
    coalesce(pct, share) AS percent_value, per AS per_unit_amount, unit AS unit_type, coalesce(categories, '') AS categories, customer_type,
    nullif(CASE WHEN se = 'Local' THEN 'Local Government' ELSE se END, '') AS implementing_sector,
    CASE WHEN {any_sql('txt', records.AUDIT_PHRASES)} THEN true END AS energy_audit_required, CASE WHEN {any_sql('txt', records.CONTRACTOR_PHRASES)} THEN true END AS contractor_required,
    {_hash_sql('name', 'org')} AS program_hash
FROM k LEFT JOIN c USING (rid) LEFT JOIN s USING (rid)"""
)
def program_records(spark, d):
    """Programs with nested parameter sets as canonical rows."""
    return records.program_rows(table(spark, d, "dsire_program"), unnamed="DSIRE USA")


@query(
    f"""
WITH t AS (SELECT row_number() OVER () AS rid, * FROM dsire_program), u AS (SELECT id, unnest({_inner_sql('technologies')}) AS x FROM t),
n AS (SELECT id, coalesce({map_sql('x.category', labels.CATEGORIES)}, '') AS l, count(*) AS n FROM u WHERE x.category <> '' GROUP BY 1, 2)
SELECT id, l AS category FROM (SELECT id, l, row_number() OVER (PARTITION BY id ORDER BY n DESC, l) AS r FROM n) WHERE r = 1 AND l <> ''"""
)
def top_categories(spark, d):
    return records.top_category(table(spark, d, "dsire_program"), "id", "parametersets")


def _json(path: str) -> str:
    return f"nullif(json_extract_string(j, '$.{path}'), '')"


def _entity(path: str) -> str:
    return "coalesce(" + ", ".join(_json(f"{path}.{n}") for n in records.ENTITY_NAMES) + ")"


_LISTED = _TWINS["listed_amounts"].replace("SELECT DISTINCT incentiveamount AS a FROM energy_star_raw", "SELECT DISTINCT written AS a FROM y")
_MILLIS = "CASE WHEN try_cast(trim({0}) AS BIGINT) > 0 THEN strftime(make_timestamp(try_cast(trim({0}) AS BIGINT) * 1000), '%Y-%m-%d') END"
_START = _MILLIS.format(f"coalesce(nullif(incentive_start_date, ''), {_json('incentivestartedate')})")
_END = _MILLIS.format(f"coalesce(nullif(incentive_end_date, ''), {_json('incentiveenddate')})")


@query(
    f"""
WITH j AS (SELECT *, try_cast(incentivedata AS JSON) AS j FROM energy_star_raw),
y AS (SELECT *, coalesce(nullif(utility, ''), 'Energy Star') AS org, lower(coalesce(available_nationwide, '')) = 'yes' AS nation,
    coalesce({_json('incentiveproductsubcategory.incentiveproductgeneral.incentiveproductgeneralname')}, nullif(product_general, '')) AS prod, coalesce(nullif(incentiveamount, ''), {_json('incentiveamount')}) AS written,
    lower(coalesce(CASE WHEN json_type(j, '$.incentivedeliverymechanics') = 'ARRAY' THEN json_extract_string(j, '$.incentivedeliverymechanics[0].incentivedeliverymechanicsname')
        ELSE json_extract_string(j, '$.incentivedeliverymechanics.incentivedeliverymechanicsname') END, '')) AS mech,
    coalesce({_json('incentiveproductsubcategory.incentiveproductsubcategoryoverride')}, {_json('incentiveproductsubcategory.incentiveproductsubcategoryname')}) AS sub FROM j),
a AS ({_LISTED}),
z AS (SELECT y.*, a.format, a.amount, a.maximum, a.percent, contains(mech, 'retailer') OR contains(mech, 'instant') AS instant, org || ' ' || coalesce(prod || ' Rebate', 'Rebate Program') AS nm,
    coalesce({_entity('incentivetype')}, 'Rebate') || ': ' || coalesce(y.written, '') || ' on ' || coalesce(prod, '') AS about FROM y JOIN a ON a.written IS NOT DISTINCT FROM y.written)
SELECT incentive_id AS id, nm AS program_name, org AS utility_company, upper({_json('serviceterritory.serviceterritorystatecode')}) AS state,
    coalesce({_json('serviceterritory.serviceterritoryname')}, {_json('serviceterritory.serviceterritorydesc')}) AS service_territory, nation AS available_nationwide, product_category,
    CASE WHEN trim({_entity('incomequalification')}) IN {records.RESTRICTED_INCOMES} THEN 'Income Qualified' END AS restriction, {_entity('incentivemarketsector')} AS customer_type,
    CASE WHEN nation OR trim(coalesce(utility, '')) = '' THEN 'Federal' WHEN {any_sql('utility', labels.AGENCIES)} THEN 'State' ELSE 'Utility' END AS implementing_sector,
    coalesce(CASE WHEN lower(nullif(product, '')) <> 'all' THEN product END, CASE WHEN lower(sub) <> 'all' THEN sub END) AS unit_type,
    format AS incentive_format, amount AS incentive_amount, maximum AS maximum_amount, percent AS percent_value, CASE WHEN instant THEN '[Instant Rebate Available] ' || about ELSE about END AS incentive_description,
    lower(coalesce({_json('energyauditrequired')}, '')) = 'y' AS energy_audit_required,
    CASE WHEN instant THEN '{records.APPLY_RETAILER}' WHEN contains(mech, 'rebate application') THEN '{records.APPLY_FORM}' ELSE '{records.APPLY_DEFAULT}' END AS application_process,
    {_json('programwebaddress')} AS program_url, {_json('contactemail')} AS contact_email, {_json('contactphonenumber')} AS contact_phone, {_START} AS start_date, {_END} AS end_date,
    CASE WHEN lower({_entity('incentivestatus.incentiveactivestatus')}) = 'active' THEN 'active' ELSE 'draft' END AS status, {_hash_sql('nm', 'org')} AS program_hash FROM z"""
)
def listing_records(spark, d):
    """Listings with JSON details as canonical rows."""
    return records.listing_rows(table(spark, d, "energy_star_raw"), unnamed="Energy Star")


@query(
    f"""SELECT DISTINCT program_name AS name, {rules_sql('program_name', labels.TECHNOLOGIES)} AS technology, {rules_sql('program_name', labels.TYPE_FORMATS)} AS format,
    {rules_sql('program_name', labels.RECIPIENTS)} AS recipient FROM rebates_staging WHERE program_name IS NOT NULL"""
)
def keyword_labels(spark, d):
    """Labels by ordered keyword rules."""
    n = F.col("name")
    x = table(spark, d, "rebates_staging").select(F.col("program_name").alias("name")).where("name is not null").distinct()
    return x.select("name", labels.first_rule(n, labels.TECHNOLOGIES).alias("technology"), labels.first_rule(n, labels.TYPE_FORMATS).alias("format"), labels.first_rule(n, labels.RECIPIENTS).alias("recipient"))


_PLACE = "coalesce(title, '') || ' ' || coalesce(site, '')"


def _told(home: str, business: str) -> str:
    return f"CASE WHEN {home} AND {business} THEN 'Residential, Commercial' WHEN {business} THEN 'Commercial' WHEN {home} THEN 'Residential' END"


@query(
    f"""WITH x AS (SELECT doc_id, {_PLACE} AS place, substr(coalesce(text, ''), 1, 2000) AS head FROM documents)
SELECT doc_id, coalesce({_told(any_sql('place', labels.HOME_WORDS), any_sql('place', labels.BUSINESS_WORDS))}, {_told(any_sql('head', labels.HOME_PHRASES), any_sql('head', labels.BUSINESS_PHRASES))}) AS customers FROM x"""
)
def customer_groups(spark, d):
    place = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("site", F.lit("")))
    return table(spark, d, "documents").select("doc_id", labels.groups_of(place, F.col("text")).alias("customers"))


@query("SELECT DISTINCT source AS key, list_reduce(list_transform(string_split(source, '_'), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), lambda a, b: a || ' ' || b) AS title FROM rebates_staging WHERE source IS NOT NULL")
def titled_keys(spark, d):
    return table(spark, d, "rebates_staging").select(F.col("source").alias("key")).where("key is not null").distinct().select("key", labels.titled(F.col("key")).alias("title"))


@query(f"""SELECT doc_id, {any_sql('title', labels.NO_TITLE)} AS no_title, {any_sql('text', labels.NO_PARAGRAPH)} AS no_paragraph, {any_sql('text', labels.CHALLENGE)} AS challenge FROM documents""")
def junk_pages(spark, d):
    """Pages that are no program by their title, by a phrase of their text, or because they ask for a check of the browser."""
    return table(spark, d, "documents").select("doc_id", labels.any_word(F.col("title"), labels.NO_TITLE).alias("no_title"), labels.any_word(F.col("text"), labels.NO_PARAGRAPH).alias("no_paragraph"), labels.any_word(F.col("text"), labels.CHALLENGE).alias("challenge"))


@query(
    r"""WITH x AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
y AS (SELECT doc_id, t, nullif(regexp_extract(t, '(?:^|[^\d])((?:\+1[\s.\-]?)?(?:\(\d{3}\)|\d{3})[\s.\-]\d{3}[\s.\-]\d{4})(?:[^\d]|$)', 1), '') AS phone FROM x)
SELECT doc_id, phone, CASE WHEN regexp_matches(t, '(?i)(?:energy audit required|home assessment required|home energy assessment|home energy checkup required|pre-inspection required)') THEN true END AS audit,
    NOT regexp_matches(t, '(?i)(?:expired|program ended|no longer available|program closed|funding exhausted|wait ?list)') AS open,
    CASE WHEN regexp_matches(t, '(?i)(?:low.income|income.qualified|income.eligible|CARE|FERA|LIHEAP|Good Neighbor|affordable|<\s*\d+%\s*AMI|\d+%\s*(?:of\s+)?(?:area\s+median|AMI))') THEN true END AS low_income,
    nullif(regexp_extract(t, '(?i)(?:end(?:s|ing)?|expires?|through|until|deadline|valid\s+through|offer\s+ends?)\s+(\d{4}-\d{2}-\d{2}|\w+ \d{1,2},?\s*\d{4}|\w+ \d{4})', 1), '') AS ends FROM y"""
)
def statements_in_text(spark, d):
    from wattlake.functions import dates

    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", contacts.phone(t).alias("phone"), contacts.says(t, contacts.AUDIT).alias("audit"), F.coalesce(~t.rlike(contacts.ENDED), F.lit(True)).alias("open"), contacts.says(t, contacts.LOW_INCOME).alias("low_income"), dates.date_in_text(t, dates.END).alias("ends")
    )


@query(
    _TWINS["parse_amount_in_context"].replace("SELECT doc_id, CASE WHEN NOT k", "SELECT doc_id, CASE WHEN hub OR NOT k").replace("CASE WHEN NOT k THEN NULL", "CASE WHEN hub OR NOT k THEN NULL").replace(
        "AS k FROM x)", r"AS k, len(list_distinct(list_concat(list_transform(regexp_extract_all(t, '\$([0-9,]+(?:\.[0-9]+)?)', 1), lambda x: '$' || x), list_transform(regexp_extract_all(t, '([0-9]+(?:\.[0-9]+)?)\s*%', 1), lambda x: x || '%')))) >= 3 AS hub FROM x)"
    )
)
def amount_of_page(spark, d):
    """The amount of a page in context; a page that lists several offers has none of its own."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", amounts.settle_hub(amounts.parse_amount_in_context(t), t).alias("x")).select("doc_id", "x.*")


@query(
    rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE trim(text) <> ''),
x AS (SELECT doc_id, i, {STRIP_SQL.format('raw')} AS t FROM l),
y AS (SELECT doc_id, arg_min(t, i) FILTER (WHERE octet_length(encode(t)) BETWEEN 5 AND 200) AS title, arg_min(t, i) FILTER (WHERE octet_length(encode(t)) > 40) AS para FROM x GROUP BY doc_id)
SELECT doc_id, title, CASE WHEN length(coalesce(para, title)) > 500 THEN substr(coalesce(para, title), 1, 497) || '...' ELSE coalesce(para, title) END AS description FROM y
WHERE title IS NOT NULL AND NOT {any_sql('title', ('page not found', '404', 'error', 'access denied'))}"""
)
def plain_text_programs(spark, d):
    """Title and description of a program from plain text: the first line of 5 to 200 bytes, and the first longer than 40."""
    return records.from_plain_text(table(spark, d, "documents"), "doc_id", "text")
