"""Queries of the general data problems: units and nested records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.functions.text import program_hash
from wattlake.operators import nested, units
from wattlake.session import shared_folder, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rate of a staged record in its common unit, in thousandths."""
    r = units.harmonise(table(spark, sf_dir, "rebates_staging"))
    return r.select("id", "common_unit", F.round(F.col("value") * 1000).cast("bigint").alias("value_milli"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.labelled(
        table(spark, sf_dir, "rebates_staging"), "id", program_hash("program_name", "utility_company"), "percent_value", "per_unit_amount", "unit_type", "incentive_description"
    )


def p5_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each unit label means, and in which round of the source graph it was resolved."""
    return units.label_graph(_labelled(spark, sf_dir))


def p5_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of the source graph: what turns values of one source's label into those of another's."""
    return units.source_edges(_labelled(spark, sf_dir))


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    from_json = nested.json_children(
        table(spark, sf_dir, "energy_star_raw"),
        "incentive_id",
        "incentivedata",
        (nested.JsonChild("mechanic", "incentivedeliverymechanics"), nested.JsonChild("comment", "incentivecomments", (("reply", "replies"),))),
    )
    typed = nested.struct_children(
        table(spark, sf_dir, "dsire_program"), "id", "parametersets", {"parameters": "parameter", "technologies": "technology", "sectors": "sector"}
    )
    return nested.merge_repeats(from_json.unionByName(typed))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every child item of the nested records."""
    return _children(spark, sf_dir).select("child", "parent_key", "set_no", "item_no")


def p7_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child item with its payload as JSON text."""
    return _children(spark, sf_dir)


# the fields of each kind of child
CHILD_FIELDS = {
    "parameter": "source string, qualifier string, amount string, units string", "technology": "name string, category string", "sector": "name string",
    "mechanic": "incentivedeliverymechanicsname string", "comment": "comment string, author string", "reply": "text string",
}


def _table_of(child: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = f"{shared_folder(spark)}/children-{uuid.uuid4().hex}"
        nested.write_tagged(_children(spark, sf_dir), folder)
        return nested.read_tag(spark, folder, child, CHILD_FIELDS[child])

    query.__name__ = f"p7_{child}"
    query.__doc__ = f"The flat table of the children {child}: all tables are written once by tag, this one read under its schema."
    return query


def _table_sql(field: str, columns: tuple[str, ...]) -> str:
    return (
        "WITH s AS (SELECT DISTINCT id, unnest(parametersets) AS s, generate_subscripts(parametersets, 1) AS set_no FROM dsire_program), "
        f"p AS (SELECT id, set_no, unnest(s.{field}) AS p, generate_subscripts(s.{field}, 1) AS item_no FROM s) "
        f"SELECT DISTINCT id::VARCHAR AS parent_key, set_no::INTEGER AS set_no, item_no::INTEGER AS item_no, {', '.join(f'p.{c} AS {c}' for c in columns)} FROM p WHERE p IS NOT NULL AND ({' OR '.join(f'p.{c} IS NOT NULL' for c in columns)})"
    )


QUERIES = {"p5_found": p5_found, "p5_labels": p5_labels, "p5_edges": p5_edges, "p7_found": p7_found, "p7_children": p7_children}
QUERIES |= {f"p7_{c}": _table_of(c) for c in CHILD_FIELDS}
ORACLE: dict[str, str] = {
    "p7_parameter": _table_sql("parameters", ("source", "qualifier", "amount", "units")),
    "p7_technology": _table_sql("technologies", ("name", "category")),
    "p7_sector": _table_sql("sectors", ("name",)),
}
