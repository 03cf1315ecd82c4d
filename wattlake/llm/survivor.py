"""One surviving record for each group of duplicates, field by field.

Each field of a group takes the value of one row: the row with a usable value, of the most trusted
source, then the latest, then with the smallest id. That is the maximum of one composite struct
(usable, trust, time, id, value) a field, so a single aggregation with map-side combining serves all
fields, and a hot group never lies in one task.

A text is usable unless it is blank, a stand-in, or the cut-off beginning of another text of its
group. The latter is told without pairs: distinct texts are sorted by group and text over range
partitions, and a text is a beginning if the next one continues it. A sum is usable if it is
positive, finite and no stand-in.

Nulls: a null time is the earliest; a null or unlisted source is the least trusted; a null part of
the identity counts as empty. Groups of fewer than ``least`` rows are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlake.functions.text import WS
from wattlake.session import cut_lineage

# Texts that stand for a missing one, in lower case without marks around them.
STAND_INS = """|-|--|n/a|na|none|null|nan|nil|tbd|tba|description|no description|no description available|not available|unavailable|see website|see site|see program site for details|see program website|see program website for details
coming soon|test|placeholder|summary|lorem ipsum|more information coming soon|to be determined|various|unknown|undefined|details|pending|details to follow""".replace("\n", "|").split("|")


def is_text(c: Column) -> Column:
    """Whether a text is one: not blank, not a stand-in, not an unfilled template field, not dummy Latin."""
    t = F.trim(F.regexp_replace(F.lower(c), WS, " "))
    bare = F.trim(F.regexp_replace(t, r"^[\s\[\]{}()<>$#%«»_.*-]+|[\s\[\]{}()<>$#%«»_.*!-]+$", ""))
    field = t.rlike(r"^(?:\{\{[^{}]*\}\}|\$?\{[^{}]*\}|<%.*%>|<\?.*\?>|\[\[?[^\[\]]*\]\]?|%%?[\w .]+%%?|@@[\w .]+@@|#[\w .]+#|__\w+__|«[^«»]*»)$")
    return c.isNotNull() & (bare != "") & ~bare.isin(*STAND_INS) & ~t.startswith("lorem ipsum") & ~field


def is_sum(c: Column) -> Column:
    """Whether an amount is a real sum above zero: finite, and not a row of nines that stands for none."""
    return c.isNotNull() & ~F.isnan(c) & (c > 0) & (c < 1e12) & ~F.format_string("%.2f", c).rlike(r"^9{5,}\.(?:00|99)$")


def beginnings(texts: DataFrame, group: str, text: str) -> DataFrame:
    """(group, text) of the texts that another text of their group continues, compared without outer white space and closing dots."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.col(text), WS, " ")), r"(?:\s*(?:\.{3,}|…))+$", "")
    d = texts.where(F.col(text).isNotNull()).select(F.col(group).alias("g"), t.alias("t")).where("t <> ''").distinct()
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(d.repartitionByRange(n, "g", "t").withColumn("p", F.spark_partition_id()))
    nxt = Window.partitionBy("p").orderBy("g", "t")
    d = d.withColumn("n", F.lead(F.struct("g", "t")).over(nxt))
    # the last text of a partition is continued by the first of the next one: as many rows as partitions
    firsts = d.groupBy("p").agg(F.min(F.struct("g", "t")).alias("first"))
    ahead = firsts.withColumn("after", F.lead("first").over(Window.orderBy("p"))).select("p", "after")
    d = d.join(F.broadcast(ahead), "p").withColumn("n", F.coalesce("n", "after"))
    return d.where((F.col("n.g") == F.col("g")) & F.col("n.t").startswith(F.col("t"))).select(F.col("g").alias(group), F.col("t").alias("__cut"))


def mark_beginnings(rows: DataFrame, group: str, text: str, flag: str) -> DataFrame:
    """Adds ``flag``: whether the row's text is the cut-off beginning of another text of its group."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.col(text), WS, " ")), r"(?:\s*(?:\.{3,}|…))+$", "")
    cut = beginnings(rows, group, text).withColumn(flag, F.lit(True))
    return rows.withColumn("__cut", t).join(cut, [group, "__cut"], "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop("__cut")


def survive(rows: DataFrame, group: str, id_: str, rank: Column, time: str, fields: dict[str, Column], least: int = 2) -> DataFrame:
    """(group, rows, <field>_id, <field>): the row and the value that survive for each field, 0 and null if none is usable.

    ``fields`` gives for each field whether the row's value is usable; ``rank`` is smaller for the more trusted.
    """
    kept = rows.withColumn("__rank", rank)
    aggs = [F.count("*").alias("rows")]
    for f, usable in fields.items():
        by = F.struct(usable.alias("u"), (-F.col("__rank")).alias("r"), F.col(time).alias("t"), (-F.col(id_)).alias("i"), F.col(f).alias("v"))
        aggs.append(F.max(by).alias(f"__{f}"))
    out = kept.groupBy(group).agg(*aggs).where(F.col("rows") >= least)
    cols = []
    for f in fields:
        m = F.col(f"__{f}")
        cols += [F.when(m["u"], -m["i"]).otherwise(F.lit(0)).cast("bigint").alias(f"{f}_id"), F.when(m["u"], m["v"]).alias(f)]
    return out.select(group, "rows", *cols)
