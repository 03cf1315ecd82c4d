"""Analytic report frames over a staging table, each one aggregation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def by_status(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def by_source(rows: DataFrame, source: str, status: str, states: tuple[str, ...]) -> DataFrame:
    """(source, total, one count a status, rate): counts by filter and the first status's share in percent."""
    c = [F.count_if(F.col(status) == s).alias(s) for s in states]
    out = rows.groupBy(source).agg(F.count("*").alias("total"), *c)
    return out.withColumn("rate", F.round(100.0 * F.col(states[0]) / F.when(F.col("total") > 0, F.col("total")), 1).cast("double"))


def by_value(rows: DataFrame, column: str, unknown: str = "unknown") -> DataFrame:
    """(value, n) with nulls shown as ``unknown``; a literal value of that name stays a row of its own."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).select(F.coalesce(column, F.lit(unknown)).alias("value"), "n")


def over_dimension(dimension: DataFrame, key: str, rows: DataFrame, value: Column) -> DataFrame:
    """Every member of the dimension with the count of its rows, 0 if it has none; values are compared in upper case and trimmed."""
    n = rows.select(F.upper(F.trim(value)).alias(key)).where(f"{key} is not null").groupBy(key).agg(F.count("*").alias("n"))
    return dimension.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def quality(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: how many rows each check holds for."""
    return rows.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])


def activity(rows: DataFrame, created: str, updated: str, at: datetime, windows: dict[str, str]) -> DataFrame:
    """One row: added and changed rows within each window before ``at``; a changed row is one that existed before the window."""
    now = F.lit(at)
    out = []
    for name, w in windows.items():
        since = now - F.expr(f"interval {w}")
        out += [F.count_if(F.col(created) >= since).alias(f"added_{name}"), F.count_if((F.col(updated) >= since) & (F.col(created) < since)).alias(f"changed_{name}")]
    return rows.agg(*out)
