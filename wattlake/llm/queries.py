"""Queries of the text problems, over whole tables with production parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.llm import abuse, linkage, names, packing, pages, residue, survivor, tokens
from wattlake.functions.text import norm, program_hash
from wattlake.operators import units
from wattlake.session import cut_lineage, let_go, table


def _body(spark: SparkSession, sf_dir: str) -> DataFrame:
    inc = table(spark, sf_dir, "incentive")
    return pages.main_lines(inc, "id", "raw_response", pages.host_of(F.col("source_url"), F.col("program_url")), "utility_company")


JSON_START = r"^[\s\x{FEFF}]*(?:\{(?!\{)|\[(?!\[)(?![A-Za-z]))"


def _texts(spark: SparkSession, sf_dir: str, body: DataFrame) -> DataFrame:
    """(table_name, record_key, text): whatever may hold residue."""
    inc, stg = table(spark, sf_dir, "incentive"), table(spark, sf_dir, "rebates_staging")
    json_rows = inc.where(F.col("raw_response").rlike(JSON_START)).select("id", "raw_response")
    parts = [
        stg.select(F.lit("rebates_staging").alias("table_name"), F.col("id").cast("string").alias("record_key"), F.col("program_name").alias("text")),
        inc.select(F.lit("incentive").alias("table_name"), F.col("id").alias("record_key"), F.col("program_name").alias("text")),
        cut_lineage(residue.json_leaves(json_rows, "id", "raw_response")).select(F.lit("incentive").alias("table_name"), F.col("id").alias("record_key"), "text"),
        body.select(F.lit("incentive").alias("table_name"), F.col("id").alias("record_key"), "text"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("record_key is not null and trim(text) <> ''")


def _residue(texts: DataFrame, wanted: str = "true") -> DataFrame:
    model = residue.fit_all(texts, F.col("text"))
    return residue.score(texts.where(wanted), ("table_name", "record_key"), "text", model)


def staged_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id) of the staged records whose name is residue, for the problems that leave them out."""
    names = table(spark, sf_dir, "rebates_staging").select("id", "program_name").where("trim(program_name) <> ''")
    found = residue.score(names, ("id",), "program_name", residue.fit_all(names, F.col("program_name")))
    found = cut_lineage(found.where("found").select("id"))
    let_go(spark)
    return found


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each page that show its main body, without pages that hold residue."""
    body = _body(spark, sf_dir)
    bad = _residue(_texts(spark, sf_dir, body), "table_name = 'incentive'").where("found").select(F.col("record_key").alias("id")).distinct()
    return body.select("id", "line_no").distinct().join(bad, "id", "left_anti").select(F.col("id").alias("incentive_id"), "line_no")


def p1_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the main body of each page, line by line."""
    return _body(spark, sf_dir).withColumnRenamed("id", "incentive_id").dropDuplicates(["incentive_id", "line_no"])


def p2_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each record the surest residue in it: ratio, kind and coverage."""
    s = _residue(_texts(spark, sf_dir, _body(spark, sf_dir)))
    return s.groupBy("table_name", "record_key").agg(F.max("residue").alias("residue"), F.max_by("kind", "residue").alias("kind"), F.max_by("coverage", "residue").alias("coverage"), F.bool_or("found").alias("found"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that hold residue, filler or a failure message."""
    return p2_scores(spark, sf_dir).where("found").select("table_name", "record_key")


def _linkable(sides: dict[str, DataFrame], org: DataFrame) -> DataFrame:
    """(side, id, name, org, segment, state, label, start, end, rate) of the records of all sides with a name and an organisation.

    The sides are read as one table: the driver plans the reading of rates, the largest plan of all, once.
    """
    day = lambda c: F.when(F.col(c).rlike(r"^\s*\d{4}-\d\d-\d\d"), F.substring(F.trim(c), 1, 10))
    seg = F.lower(F.trim(F.get(F.filter("segment", lambda x: F.trim(x) != ""), F.lit(0))))
    text = lambda t, c: (F.col(c) if c in t.columns else F.lit(None)).cast("string").alias(c)
    rows, told = [], []
    for side, t in sides.items():
        id_ = F.col("id").cast("string")
        key = F.concat(F.lit(side), id_).alias("key")
        rows.append(t.select(F.lit(side).alias("side"), id_.alias("id"), key, norm("program_name").alias("name"), norm("utility_company").alias("u"), F.coalesce(seg, F.lit("")).alias("segment"), linkage.state_of(F.col("state")).alias("state"), text(t, "product_category").alias("label"), day("start_date").alias("start"), day("end_date").alias("end")))
        told.append(t.select(key, *[F.col(c).cast("double").alias(c) for c in ("percent_value", "per_unit_amount")], *[text(t, c) for c in ("program_name", "utility_company", "unit_type", "incentive_description", "source")]))
    both, quantities = (reduce(DataFrame.unionByName, x) for x in (rows, told))
    rates = units.harmonise(quantities, "key", learn=False).groupBy(F.col("id").alias("key")).agg(F.min(F.concat_ws(" ", "common_unit", F.round(F.col("value") * 1000).cast("bigint"))).alias("rate"))
    r = both.join(org, "u").join(rates, "key", "left").where("name <> '' and org is not null")
    return r.select("side", "id", "name", "org", "segment", "state", "label", "start", "end", "rate")


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each staged record that has one with its row of the catalog and a confidence."""
    stg, cat = table(spark, sf_dir, "rebates_staging"), table(spark, sf_dir, "rebates")
    stg = stg.join(staged_residue(spark, sf_dir), "id", "left_anti")
    org = names.organisations(names.distinct_names([t.select("utility_company") for t in (stg, cat)]))
    org = cut_lineage(org.select(F.col("name").alias("u"), F.concat_ws("|", "proper", "kind").alias("org")))
    let_go(spark)
    rows = cut_lineage(_linkable({"s": stg, "c": cat}, org))
    let_go(spark)
    known = rows.where("label is not null").select("name", "label").distinct().orderBy(F.xxhash64("name", "label")).limit(20_000)
    rows = cut_lineage(linkage.read(rows, linkage.ProductModel([(linkage.plain(r[0]), r[1]) for r in known.collect()])))
    rows = cut_lineage(linkage.marks(rows, linkage.vocabulary(rows)))
    let_go(spark)
    rows = linkage.settle_places(rows)
    rows = cut_lineage(rows.withColumn("cluster", F.xxhash64("org", "name", "group")))
    let_go(spark)
    e = linkage.link(rows.where("side = 's'"), rows.where("side = 'c'"))
    return e.select(F.col("left").cast("bigint").alias("staging_id"), F.col("right").alias("rebate_id"), "confidence")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged records and the rows of the catalog that are the same program."""
    return p3_links(spark, sf_dir).select("staging_id", "rebate_id")


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each program identity held by two rows or more."""
    stg = table(spark, sf_dir, "rebates_staging").where("deleted_at is null")
    stg = stg.select("id", "source", "updated_at", "incentive_description", "maximum_amount", program_hash("program_name", "utility_company").alias("program_hash"))
    stg = stg.join(staged_residue(spark, sf_dir), "id", "left_anti")
    ranks = table(spark, sf_dir, "source_rank").groupBy("source").agg(F.min("trust_rank").alias("trust_rank"))
    stg = survivor.mark_beginnings(cut_lineage(stg), "program_hash", "incentive_description", "is_cut").join(ranks, "source", "left")
    return survivor.survive(
        stg,
        "program_hash",
        "id",
        F.coalesce("trust_rank", F.lit(2**31 - 1)),
        "updated_at",
        {"incentive_description": survivor.is_text(F.col("incentive_description")) & ~F.col("is_cut"), "maximum_amount": survivor.is_sum(F.col("maximum_amount"))},
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that give the description and the maximum amount of each program identity."""
    return p4_records(spark, sf_dir).select("program_hash", F.col("incentive_description_id").alias("description_id"), F.col("maximum_amount_id").alias("maximum_id"))


def _organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.organisations(names.distinct_names([table(spark, sf_dir, "rebates_staging").select("utility_company"), table(spark, sf_dir, "energy_star_raw").select("utility")]))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of one organisation."""
    return names.pairs(_organisations(spark, sf_dir))


def p6_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each spelling with the organisation it means."""
    return _organisations(spark, sf_dir)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document with their character ranges."""
    return tokens.encode_with_offsets(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every document comes back whole from its ids (null as the empty text)."""
    d = table(spark, sf_dir, "documents")
    back = tokens.decode(tokens.encode(d, "doc_id", "text"), "doc_id")
    same = back.join(d.select("doc_id", F.coalesce("text", F.lit("")).alias("was")), "doc_id")
    return same.groupBy((F.col("text") == F.col("was")).alias("whole")).agg(F.count("*").alias("n"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = tokens.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text")
    return packing.pack(sized, "doc_id", "tokens", table(spark, sf_dir, "containers"), "container", "capacity_tokens")


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of a text with the container it is put into, for every kind of container."""
    return _pieces(spark, sf_dir).select("container", F.col("id").alias("doc_id"), "piece_no", F.col("size").alias("tokens"), "bin")


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each kind are."""
    return packing.fill_report(_pieces(spark, sf_dir), table(spark, sf_dir, "containers"), "container", "capacity_tokens")


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document for abusive, hateful or sexual language."""
    d = table(spark, sf_dir, "documents")
    return abuse.score(d, "doc_id", "text", abuse.train(d, "doc_id", "text", table(spark, sf_dir, "review_labels")), ("source",))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with abusive, hateful or sexual language."""
    return p10_scores(spark, sf_dir).where("flagged").select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of such documents in each source."""
    r = p10_scores(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.count_if("flagged").alias("flagged"), F.avg("score").alias("mean_score"))
    return r.withColumn("rate", F.col("flagged") / F.col("documents"))


QUERIES = {"p1_found": p1_found, "p1_body": p1_body, "p2_found": p2_found, "p2_scores": p2_scores, "p3_found": p3_found, "p3_links": p3_links, "p4_found": p4_found, "p4_records": p4_records, "p6_found": p6_found, "p6_organisations": p6_organisations, "p8_ids": p8_ids, "p8_offsets": p8_offsets, "p8_roundtrip": p8_roundtrip, "p9_pieces": p9_pieces, "p9_fill": p9_fill, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates}
ORACLE: dict[str, str] = {}
