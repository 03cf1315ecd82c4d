"""From staged rows to the catalog: whole rows of programs, links to postal codes and their sources, tags to portfolios, guarded changes of state.

Every operator is an equi-join or an aggregation with map-side combining. Null keys match nothing; repeats
of a link count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions import contacts, labels
from wattlake.operators.merge import merge

# Columns of the catalog that a merge writes, by how they are picked.
TEXTS = (
    "incentive_description", "incentive_format", "unit_type", "state", "service_territory", "customer_type", "administrator", "implementing_sector", "start_date", "end_date", "application_url",
    "application_process", "program_url", "contact_email", "contact_phone", "image_url",
)
VALUES = ("incentive_amount", "maximum_amount", "percent_value", "per_unit_amount", "available_nationwide", "while_funds_last", "contractor_required", "energy_audit_required")
UNIONS = ("category_tag", "segment", "image_urls")
#: Columns that a merge never writes once a row of the catalog exists.
KEPT = ("status", "is_featured", "processed", "created_at")


def whole_rows(rows: DataFrame, key: str, order: Sequence[str], formats: Sequence[str], units: Sequence[str]) -> DataFrame:
    """One row a program with every column of the catalog: names of the first row, the picks of ``merge``, the sources in order, and formats and units only if they are listed."""
    by = F.struct(*order)
    m = merge(rows, key, order, texts=TEXTS, values=VALUES, unions=UNIONS, first_list=("rate_tiers",))
    first = rows.groupBy(key).agg(F.min_by(F.struct("program_name", "utility_company", "source"), by).alias("__f"))
    sources = rows.where("source is not null").groupBy(key, "source").agg(F.min(by).alias("o")).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "source"))), lambda x: x["source"]).alias("sources"))
    out = m.join(first, key).join(sources, key, "left")
    return out.select(
        key, "rows", F.col("__f.program_name").alias("program_name"), F.col("__f.utility_company").alias("utility_company"), F.col("__f.source").alias("source"), "sources",
        *[contacts.keep_listed(F.col(c), formats if c == "incentive_format" else units).alias(c) if c in ("incentive_format", "unit_type") else F.col(c) for c in (*TEXTS, *VALUES, *UNIONS, "rate_tiers")],
    )


def codes_of(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(*keep, zip): every postal code of a row, from its own field and its list, once a row."""
    z = F.array_distinct(F.concat(F.coalesce("zip_codes", F.array().cast("array<string>")), F.when(F.col("zip_code") != "", F.array("zip_code")).otherwise(F.array().cast("array<string>"))))
    return rows.select(*keep, F.explode(z).alias("zip"))


def links(rows: DataFrame, key: str, order: Sequence[str], source_id: str) -> DataFrame:
    """(key, zip, source_id): each code of a program once, with the row of the best order that has it."""
    return codes_of(rows, [key, *order, source_id]).groupBy(key, "zip").agg(F.min_by(source_id, F.struct(*order)).alias(source_id))


def links_by_source(rows: DataFrame, key: str, order: Sequence[str], source: str, source_id: str) -> DataFrame:
    """(key, zip, source, source_id): each code of a program once a source."""
    return codes_of(rows, [key, source, *order, source_id]).groupBy(key, "zip", source).agg(F.min_by(source_id, F.struct(*order)).alias(source_id))


def backfill(rows: DataFrame, known: DataFrame, key: str, source: str, source_id: str) -> DataFrame:
    """(key, zip, source, source_id) of the rows' codes that are links already, distinct."""
    z = codes_of(rows.where(F.col(key).isNotNull()), [key, source, source_id]).where("zip <> ''")
    return z.join(known.select(key, "zip"), [key, "zip"], "left_semi").select(key, "zip", source, source_id).distinct()


def portfolios(tags: DataFrame, key: str, tag: str) -> DataFrame:
    """(key, portfolios): the first portfolio of each tag of a program, in the order of the tags and once; tags are a list column."""
    p = tags.select(key, F.posexplode(tag).alias("pos", "name")).withColumn("portfolio", labels.portfolio_of(F.col("name"))).where("portfolio is not null")
    first = p.groupBy(key, "portfolio").agg(F.min("pos").alias("pos"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "portfolio"))), lambda x: x["portfolio"]).alias("portfolios"))


def category_rows(spark_rows: DataFrame, name: str, identify) -> DataFrame:
    """(id, name, slug, portfolio): the members of a dimension, made from the distinct names in use."""
    n = spark_rows.select(name).where(F.col(name) != "").distinct()
    return n.select(identify(F.col(name)).alias("id"), F.col(name).alias("name"), contacts.slug(F.col(name)).alias("slug"), labels.portfolio_of(F.col(name)).alias("portfolio"))


def seeded(spark) -> DataFrame:
    """(name, slug, code) of all portfolios, also those no category has; a fixed table of eight rows."""
    names = sorted({*labels.PORTFOLIO_CODES, *(p for ps in labels.PORTFOLIOS.values() for p in ps)})
    d = spark.createDataFrame([(n, labels.PORTFOLIO_CODES.get(n)) for n in names], "name string, code string")
    return d.select("name", contacts.slug(F.col("name")).alias("slug"), "code")


def change_state(rows: DataFrame, ids: DataFrame, key: str, state: str, to: Column, guard: Column, also: dict[str, Column] | None = None) -> DataFrame:
    """Rows whose key is among ``ids`` and for which ``guard`` holds take the state ``to`` and the columns ``also``; the others stay as they are."""
    hit = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__hit", F.lit(True))
    x = rows.join(hit, key, "left")
    on = F.coalesce(F.col("__hit") & guard, F.lit(False))
    cols = {state: to, **(also or {})}
    return x.select(*[F.when(on, cols[c]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in rows.columns])


def unseen_to(rows: DataFrame, seen: DataFrame, key: str, state: str, was: str, to: str, scope: Column) -> DataFrame:
    """Rows in ``scope`` in the state ``was`` whose key wasn't seen take the state ``to``."""
    x = rows.join(seen.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__seen", F.lit(True)), key, "left")
    on = F.coalesce(scope & (F.col(state) == was) & F.col("__seen").isNull(), F.lit(False))
    return x.select(*[F.when(on, F.lit(to)).otherwise(F.col(c)).alias(c) if c == state else F.col(c) for c in rows.columns])


def subscriptions(rows: DataFrame, id_: str, lists: str) -> DataFrame:
    """(id, subscriber): each subscriber a row is tagged with, once."""
    return rows.select(id_, F.explode(F.array_distinct(lists)).alias("subscriber")).where("subscriber is not null")
