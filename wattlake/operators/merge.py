"""Survivorship merge of staged rows into one row a program.

Rows of a group are ordered by the priority of their source, then by id. A text takes the first
value that isn't blank, other scalars the first that isn't null, lists the ordered union. The picks are
a min_by with map-side combining; list elements are reduced to the first of each spelling before they are
gathered, so a hot program gathers what differs, not what its rows repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions.text import WS, program_hash


def source_rank(source: Column, priority: Sequence[str]) -> Column:
    """Place in the list of priorities; unlisted and null sources come after it."""
    out = F.lit(len(priority))
    for i, s in reversed(list(enumerate(priority))):
        out = F.when(source == s, i).otherwise(out)
    return out


def group_key(stored: Column, name: Column, organisation: Column) -> Column:
    """The stored key, or, where it is null or empty, the computed one."""
    return F.coalesce(F.when(stored != "", stored), program_hash(name, organisation))


def merge(
    rows: DataFrame, key: str, order: Sequence[str], texts: Sequence[str] = (), values: Sequence[str] = (), unions: Sequence[str] = (), first_list: Sequence[str] = (), sets: Sequence[str] = ()
) -> DataFrame:
    """(key, rows, *columns): ``texts`` first non-blank, ``values`` first non-null, ``unions`` ordered case-blind unions, ``first_list`` first non-empty list, ``sets`` sorted distinct scalars or list elements."""
    by = F.struct(*order)
    aggs = [F.count("*").alias("rows")]
    for c in texts:
        filled = F.trim(F.regexp_replace(F.col(c), WS, " ")) != ""
        aggs.append(F.min_by(F.when(filled, F.col(c)), F.when(filled, by)).alias(c))
    for c in values:
        aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), by)).alias(c))
    for c in first_list:
        filled = F.size(F.coalesce(F.col(c), F.array())) > 0
        aggs.append(F.min_by(F.when(filled, F.col(c)), F.when(filled, by)).alias(c))
    out = rows.groupBy(key).agg(*aggs)
    if not unions and not sets:
        return out
    # every element of every list once a program and spelling, at its first place
    def elements(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(c).alias("c"), i.alias("i"), x.alias("v")))

    parts = [elements(c) for c in (*unions, *sets)]
    e = rows.select(F.col(key).alias("__k"), by.alias("o"), F.explode(F.concat(*parts)).alias("e")).where("e.v is not null")
    spelt = F.when(F.col("e.c").isin(*unions), F.lower(F.col("e.v"))).otherwise(F.col("e.v")) if unions else F.col("e.v")
    first = e.groupBy("__k", F.col("e.c").alias("c"), spelt.alias("s")).agg(F.min(F.struct("o", F.col("e.i").alias("i"), F.col("e.v").alias("v"))).alias("f"))
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.col("f")))), lambda x: x["v"]).alias(c) for c in unions]
    lists += [F.array_sort(F.collect_list(F.when((F.col("c") == c) & (F.col("f.v") != ""), F.col("f.v")))).alias(c) for c in sets]
    got = first.groupBy("__k").agg(*lists)
    out = out.join(got, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")
    return out.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in (*unions, *sets)})
