"""Records of landed sources to canonical program rows, as native columns.

Nested parameters, technologies and sectors are read where they stand: each rule is a filter over the
ordered list and its first or last element, so a record is mapped in one projection without a shuffle.
Empty texts and zero amounts count as missing. Null lists, elements and fields are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions import amounts, contacts, dates, labels
from wattlake.functions.identity import source_uuid
from wattlake.functions.text import program_hash, strip

# Units of rates per unit, as a source writes them.
RATE_UNITS = {"$/kw": "kilowatt", "$/kilowatt": "kilowatt", "$/kwh": "kwh", "$/w": "watt", "$/watt": "watt", "$/unit": "unit", "$/port": "port"}
# Phrases of a description that tell of requirements.
AUDIT_PHRASES, CONTRACTOR_PHRASES = ("energy audit",), ("certified contractor", "licensed contractor", "qualified contractor", "certified installer", "licensed installer")
# Names that named entities go by, the first that is filled counts.
ENTITY_NAMES = (
    "incentivetypename", "incomequalificationname", "incentivemarketsectorname", "incentivebuildingsectorname", "incentiverecipientname", "incentiveactivestatusname", "websitevisibilityname",
    "serviceterritorytypename",
)
# Incomes that restrict a program.
RESTRICTED_INCOMES = ("Low-Income", "Moderate-Income", "Low-to-Moderate Income")
# How to apply, by the first mechanic of delivery.
APPLY_DEFAULT = "Visit the program website for application details and requirements."
APPLY_RETAILER = "Purchase through participating retailers to receive instant rebate at point of sale. Visit program website for list of participating retailers."
APPLY_FORM = "Submit rebate application after purchase. Visit program website for application form and requirements."


def filled(c: Column) -> Column:
    """A text, or null if it is empty."""
    return F.when(c != "", c)


def _inner(sets: Column, field: str) -> Column:
    """The elements of ``field`` of all sets in order, without nulls."""
    return F.filter(F.flatten(F.filter(F.transform(sets, lambda s: s[field]), lambda x: x.isNotNull())), lambda x: x.isNotNull())


def _last(a: Column) -> Column:
    return F.try_element_at(a, F.lit(-1))


def read_parameters(sets: Column) -> Column:
    """Struct (format, amount, maximum, percent, per_unit, unit) of the amounts in nested parameters.

    Rates per unit go before shares, shares before sums. The last rate counts, the last share before any
    rate, the first sum that isn't a maximum and the last one that is.
    """

    def amount(p: Column) -> Column:
        return strip(p["amount"]).try_cast("double")

    none = F.lit(None).cast("double")
    p = F.filter(_inner(sets, "parameters"), lambda x: (x["source"] == "Incentive") & F.coalesce(amount(x) != 0, F.lit(False)))
    p = F.transform(p, lambda x: F.struct(amount(x).alias("amount"), F.lower(strip(F.coalesce(x["units"], F.lit("")))).alias("unit"), (F.lower(F.coalesce(x["qualifier"], F.lit(""))) == "max").alias("most")))
    rate = lambda x: x["unit"].isin(*RATE_UNITS)
    rates = F.filter(p, rate)
    began = F.array_position(F.transform(p, rate), F.lit(True))
    shares = F.filter(p, lambda x, i: (x["unit"] == "%") & ((began == 0) | (i + 1 < began)))
    sums = F.filter(p, lambda x: x["unit"] == "$")
    units = F.create_map(*[F.lit(x) for kv in RATE_UNITS.items() for x in kv])
    fmt = F.when(F.size(rates) > 0, "per_unit").when(F.size(shares) > 0, "percent").when(F.size(sums) > 0, "dollar_amount").otherwise("narrative")
    return F.when(
        sets.isNotNull(),
        F.struct(
            fmt.alias("format"),
            F.get(F.filter(sums, lambda x: ~x["most"]), F.lit(0))["amount"].alias("amount"),
            _last(F.filter(sums, lambda x: x["most"]))["amount"].alias("maximum"),
            _last(shares)["amount"].alias("percent"),
            _last(rates)["amount"].alias("per_unit"),
            F.try_element_at(units, _last(rates)["unit"]).alias("unit"),
        ),
    ).otherwise(F.struct(F.lit("narrative").alias("format"), none.alias("amount"), none.alias("maximum"), none.alias("percent"), none.alias("per_unit"), F.lit(None).cast("string").alias("unit")))


def settle_format(read: Column, type_name: Column) -> Column:
    """``read`` with its format narrowed by the type of the program, where the parameters leave it open; a sum that is financed is a maximum, a rate per unit or port an amount too."""
    told = labels.first_rule(type_name, labels.TYPE_FORMATS)
    fmt = F.when(told.isNotNull() & read["format"].isin("narrative", "dollar_amount"), told).otherwise(read["format"])
    financed = (fmt == "financing") & read["format"].isin("narrative", "dollar_amount")
    amount = F.when(~financed, read["amount"])
    return F.struct(
        fmt.alias("format"),
        F.coalesce(amount, F.when(read["unit"].isin("unit", "port"), read["per_unit"])).alias("amount"),
        F.when(financed, F.coalesce(read["maximum"], read["amount"])).otherwise(read["maximum"]).alias("maximum"),
        read["percent"].alias("percent"),
        read["per_unit"].alias("per_unit"),
        read["unit"].alias("unit"),
    )


def technology_labels(sets: Column) -> Column:
    """Labels of all technologies, each by its name and then by its category, in order and once."""
    both = lambda t: F.array(labels.first_rule(t["name"], labels.TECHNOLOGIES), labels.mapped(t["category"], labels.CATEGORIES))
    return F.array_distinct(F.filter(F.flatten(F.transform(_inner(sets, "technologies"), both)), lambda x: x.isNotNull()))


def sector_names(sets: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(_inner(sets, "sectors"), lambda s: s["name"]), lambda x: x != ""))


def top_category(rows: DataFrame, id_: str, sets: str) -> DataFrame:
    """(id, category): the label most technologies of a record have by their category; of equally many the first in the alphabet. Unknown categories count under the empty label, which gives no category."""
    t = rows.select(F.col(id_).alias("id"), F.explode(_inner(F.col(sets), "technologies")).alias("t")).where("t.category <> ''")
    n = t.groupBy("id", F.coalesce(labels.mapped(F.col("t.category"), labels.CATEGORIES), F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    best = n.groupBy("id").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("category"))
    return best.where("category <> ''")


def program_rows(rows: DataFrame, unnamed: str = "Unknown") -> DataFrame:
    """Canonical rows of programs served with nested parameter sets; ``unnamed`` is the organisation of a row that names none."""
    c = lambda x: F.coalesce(F.col(x), F.lit(""))
    state, sector, name, admin = c("stateobj.name"), c("sectorobj.name"), c("name"), c("administrator")
    fallback = F.coalesce(labels.before_dash(name), F.when(state != "", F.concat(state, F.lit(" State Programs"))), F.lit(unnamed))
    organisation = F.when(admin != "", admin).when(sector == "State", F.concat(state, F.lit(" State Programs"))).when(sector == "Local Government", F.concat(state, F.lit(" Local Government"))).otherwise(fallback)
    whole = (sector == "State") | F.coalesce(F.col("entirestate"), F.lit(False))
    territory = F.when(whole, F.concat(state, F.lit(" Statewide"))).when(admin != "", F.concat(admin, F.lit(" Service Area"))).otherwise(F.concat(fallback, F.lit(" Service Territory")))
    text = filled(contacts.strip_markup(F.col("summary")))
    read = settle_format(read_parameters(F.col("parametersets")), F.col("typeobj.name"))
    d = rows.select("*", read.alias("__r"), text.alias("__t"))
    share = amounts.share_in_text(F.col("__t"))
    told = F.col("__r.percent").isNull() & share.isNotNull()
    return d.select(
        "id",
        F.col("name").alias("program_name"),
        organisation.alias("utility_company"),
        filled(admin).alias("administrator"),
        filled(c("stateobj.abbreviation")).alias("state"),
        territory.alias("service_territory"),
        ((c("stateobj.abbreviation") == "") | (F.coalesce(F.col("entirestate"), F.lit(False)) & (sector == "Federal"))).alias("available_nationwide"),
        filled(dates.iso_date(filled(strip(F.col("startdate"))))).alias("start_date"),
        filled(dates.iso_date(filled(strip(F.col("enddate"))))).alias("end_date"),
        F.col("__t").alias("incentive_description"),
        filled(c("websiteurl")).alias("program_url"),
        F.when(told & (F.col("__r.format") == "narrative"), "percent").otherwise(F.col("__r.format")).alias("incentive_format"),
        F.col("__r.amount").alias("incentive_amount"),
        F.col("__r.maximum").alias("maximum_amount"),
        F.coalesce("__r.percent", share).alias("percent_value"),
        F.col("__r.per_unit").alias("per_unit_amount"),
        F.col("__r.unit").alias("unit_type"),
        F.array_join(F.coalesce(technology_labels(F.col("parametersets")), F.array().cast("array<string>")), "|").alias("categories"),
        filled(F.array_join(F.coalesce(sector_names(F.col("parametersets")), F.array().cast("array<string>")), ", ")).alias("customer_type"),
        filled(F.when(sector == "Local", "Local Government").otherwise(sector)).alias("implementing_sector"),
        F.when(labels.any_word(F.col("__t"), AUDIT_PHRASES), True).alias("energy_audit_required"),
        F.when(labels.any_word(F.col("__t"), CONTRACTOR_PHRASES), True).alias("contractor_required"),
        program_hash(F.col("name"), organisation).alias("program_hash"),
    )


def best_name(v: Column, path: str) -> Column:
    """The first filled name of the named entity under ``path`` of a variant; null if it has none."""
    return F.coalesce(*[filled(F.try_variant_get(v, f"{path}.{n}", "string")) for n in ENTITY_NAMES])


def listing_rows(rows: DataFrame, unnamed: str = "Unknown") -> DataFrame:
    """Canonical rows of listings whose details are JSON text, of the organisation ``unnamed`` where none is named; text that isn't whole JSON leaves the details out, not the row."""
    at = lambda p: filled(F.try_variant_get(F.col("__v"), f"$.{p}", "string"))
    c = lambda x: filled(F.col(x))
    d = rows.select("*", F.try_parse_json(F.col("incentivedata")).alias("__v"))
    utility = F.coalesce(c("utility"), F.lit(unnamed))
    nationwide = F.lower(F.coalesce(F.col("available_nationwide"), F.lit(""))) == "yes"
    product = F.coalesce(at("incentiveproductsubcategory.incentiveproductgeneral.incentiveproductgeneralname"), c("product_general"))
    written = F.coalesce(c("incentiveamount"), at("incentiveamount"))
    items = F.coalesce(F.try_variant_get(F.col("__v"), "$.incentivedeliverymechanics", "array<variant>"), F.array(F.try_variant_get(F.col("__v"), "$.incentivedeliverymechanics", "variant")))
    mechanic = F.lower(F.coalesce(F.try_variant_get(F.get(items, F.lit(0)), "$.incentivedeliverymechanicsname", "string"), F.lit("")))
    instant = mechanic.contains("retailer") | mechanic.contains("instant")
    named = lambda x: F.when(F.lower(x) != "all", x)
    unit = F.coalesce(named(c("product")), named(F.coalesce(at("incentiveproductsubcategory.incentiveproductsubcategoryoverride"), at("incentiveproductsubcategory.incentiveproductsubcategoryname"))))
    kind = F.coalesce(best_name(F.col("__v"), "$.incentivetype"), F.lit("Rebate"))
    about = F.concat(kind, F.lit(": "), F.coalesce(written, F.lit("")), F.lit(" on "), F.coalesce(product, F.lit("")))
    name = F.concat(utility, F.lit(" "), F.coalesce(F.concat(product, F.lit(" Rebate")), F.lit("Rebate Program")))
    day = lambda outer, inner: dates.millis_date(F.coalesce(c(outer), at(inner)))
    restricted = F.coalesce(F.trim(best_name(F.col("__v"), "$.incomequalification")).isin(*RESTRICTED_INCOMES), F.lit(False))
    d = d.withColumn("__a", amounts.read_listed_amount(written))
    return d.select(
        F.col("incentive_id").alias("id"),
        name.alias("program_name"),
        utility.alias("utility_company"),
        F.upper(at("serviceterritory.serviceterritorystatecode")).alias("state"),
        F.coalesce(at("serviceterritory.serviceterritoryname"), at("serviceterritory.serviceterritorydesc")).alias("service_territory"),
        nationwide.alias("available_nationwide"),
        F.col("product_category"),
        F.when(restricted, "Income Qualified").alias("restriction"),
        best_name(F.col("__v"), "$.incentivemarketsector").alias("customer_type"),
        labels.level_of(c("utility"), nationwide).alias("implementing_sector"),
        unit.alias("unit_type"),
        F.col("__a.format").alias("incentive_format"),
        F.col("__a.amount").alias("incentive_amount"),
        F.col("__a.maximum").alias("maximum_amount"),
        F.col("__a.percent").alias("percent_value"),
        F.when(instant, F.concat(F.lit("[Instant Rebate Available] "), about)).otherwise(about).alias("incentive_description"),
        (F.lower(F.coalesce(at("energyauditrequired"), F.lit(""))) == "y").alias("energy_audit_required"),
        F.when(instant, APPLY_RETAILER).when(mechanic.contains("rebate application"), APPLY_FORM).otherwise(APPLY_DEFAULT).alias("application_process"),
        at("programwebaddress").alias("program_url"),
        at("contactemail").alias("contact_email"),
        at("contactphonenumber").alias("contact_phone"),
        day("incentive_start_date", "incentivestartedate").alias("start_date"),
        day("incentive_end_date", "incentiveenddate").alias("end_date"),
        F.when(F.lower(best_name(F.col("__v"), "$.incentivestatus.incentiveactivestatus")) == "active", "active").otherwise("draft").alias("status"),
        program_hash(name, utility).alias("program_hash"),
    )


# Titles of pages that failed.
FAILED_TITLES = ("page not found", "404", "error", "access denied")


def from_plain_text(rows: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, title, description) of texts that have a title: the first line of 5 to 200 bytes, and the first of more than 40, else the title, cut after 500 characters."""
    t = F.col(text)
    lines = F.transform(F.split(t, "\n"), strip)
    size = F.octet_length
    d = rows.where(F.trim(t) != "").select(
        id_,
        F.get(F.filter(lines, lambda x: (size(x) >= 5) & (size(x) <= 200)), F.lit(0)).alias("title"),
        F.get(F.filter(lines, lambda x: size(x) > 40), F.lit(0)).alias("__p"),
    )
    about = F.coalesce("__p", "title")
    cut = F.when(F.length(about) > 500, F.concat(F.substring(about, 1, 497), F.lit("..."))).otherwise(about)
    return d.where(F.col("title").isNotNull() & ~labels.any_word(F.col("title"), FAILED_TITLES)).select(id_, "title", cut.alias("description"))


CALCULATOR = """authorities map<string,struct<name:string,url:string>>, incentives array<struct<payment_methods:array<string>,authority_type:string,authority:string,program:string,program_url:string,more_info_url:string,
items:array<string>,amount:struct<type:string,number:double,maximum:double,representative:double>,owner_status:array<string>,start_date:string,end_date:string,short_description:string>>, zip string""".replace("\n", "")


def calculator_rows(responses: DataFrame, source: str = "calculator", at: Column | None = None) -> DataFrame:
    """Canonical rows of the answers of a calculator by postal code (``CALCULATOR``), one an offer.

    The same offer of several codes has one id: that of its authority, program and first item.
    """
    x = responses.select("authorities", "zip", F.explode("incentives").alias("x")).select("authorities", "zip", "x.*")
    authority = F.coalesce(filled(F.try_element_at("authorities", "authority")["name"]), F.col("authority"), F.lit(""))
    a = F.col("amount")
    n, most, usual = F.coalesce(a["number"], F.lit(0.0)), F.when(a["maximum"] > 0, a["maximum"]), F.when(a["representative"] > 0, a["representative"])
    some = lambda c: F.when(c != 0, c)
    kind = F.coalesce(a["type"], F.lit(""))
    share, money, unit = kind == "percent", kind == "dollar_amount", kind == "dollars_per_unit"
    plain = ~share & ~money & ~unit
    pays = F.coalesce("payment_methods", F.array().cast("array<string>"))
    told = _last(F.filter(pays, lambda m: m.isin("tax_credit", "loan")))
    fmt = F.when(told == "tax_credit", "tax_credit").when(told == "loan", "financing").when(share, "percent").when(money, "dollar_amount").when(unit, "per_unit").when(n > 0, "dollar_amount").otherwise("narrative")
    name = F.concat(authority, F.lit(" — "), F.coalesce("program", F.lit("")))
    item = F.get("items", F.lit(0))
    page, more = filled(F.col("program_url")), filled(F.col("more_info_url"))
    kinds = F.when(F.col("authority_type") == "federal", "Nationwide").when(F.col("authority_type") == "state", F.concat(authority, F.lit(" Statewide"))).otherwise(F.concat(authority, F.lit(" Service Area")))
    sector = F.when(F.col("authority_type").isin("city", "county"), "Local Government").otherwise(F.coalesce(labels.titled(filled(F.col("authority_type"))), F.lit("Utility")))
    start, end = (dates.whole_date(filled(F.trim(c))) for c in ("start_date", "end_date"))
    return x.select(
        source_uuid(source, F.concat_ws("|", F.coalesce("authority", F.lit("")), F.coalesce("program", F.lit("")), F.coalesce(item, F.lit("")))).alias("id"),
        name.alias("program_name"),
        authority.alias("utility_company"),
        filled(F.col("short_description")).alias("incentive_description"),
        fmt.alias("incentive_format"),
        F.when(money, F.coalesce(usual, some(n))).when(unit, some(n)).when(plain, F.when(n > 0, n)).alias("incentive_amount"),
        F.when(share, most).when(money, F.when(usual.isNotNull(), some(n)).otherwise(most)).alias("maximum_amount"),
        F.when(share, some(F.when((n > 0) & (n <= 1), n * 100).otherwise(n))).alias("percent_value"),
        F.when(unit, some(n)).alias("per_unit_amount"),
        F.when(unit, "unit").alias("unit_type"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.when(dates.is_current(start, end, at if at is not None else F.current_timestamp()), "active").otherwise("draft").alias("status"),
        F.coalesce(page, more).alias("program_url"),
        F.coalesce(more, page).alias("application_url"),
        labels.apply_by(pays, APPLY_DEFAULT).alias("application_process"),
        F.array_join(F.transform(pays, labels.payment_name), ", ").alias("payments"),
        (F.coalesce(F.col("authority_type"), F.lit("")) == "federal").alias("available_nationwide"),
        F.col("zip").alias("zip_code"),
        kinds.alias("service_territory"),
        sector.alias("implementing_sector"),
        F.array_distinct(F.transform("items", labels.item_category)).alias("category_tag"),
        labels.item_name(item).alias("item"),
        labels.owners_of(F.col("owner_status")).alias("customer_type"),
        program_hash(name, authority).alias("program_hash"),
    )
