"""Field-by-field comparison of two versions of records, scores and gaps, in melted form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions.arrays import jaccard
from wattlake.functions.text import strip


def compare_texts(a: Column, b: Column, long: int = 490, head: int = 100) -> Column:
    """match, partial (one holds the other, or the second the first ``head`` characters of a first of ``long`` bytes or more), mismatch; empty, missing (only the second) or extra (only the first). Case and outer spaces ignored."""
    x, y = (strip(F.coalesce(c, F.lit(""))) for c in (a, b))
    cut = F.octet_length(x) >= long
    x, y = F.lower(x), F.lower(y)
    partial = (cut & y.contains(F.substring(x, 1, head))) | x.contains(y) | y.contains(x)
    return F.when((x == "") & (y == ""), "empty").when(x == "", "missing").when(y == "", "extra").when(x == y, "match").when(partial, "partial").otherwise("mismatch")


def compare_numbers(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Zero counts as none; equal within a relative tolerance of the second."""
    x, y = (F.coalesce(F.when(~F.isnan(c), c), F.lit(0.0)) for c in (a, b))
    near = F.abs(x - y) / F.greatest(F.abs(y), F.lit(0.01)) < tolerance
    return F.when((x == 0) & (y == 0), "empty").when(x == 0, "missing").when(y == 0, "extra").when(near, "match").otherwise("mismatch")


def compare_flags(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), "empty").when(a.isNull(), "missing").when(b.isNull(), "extra").when(a == b, "match").otherwise("mismatch")


def compare_lists(a: Column, b: Column) -> Column:
    """By the shared part of both sets: 0.8 and more a match, 0.3 and more partial, less is missing."""
    n = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    j = jaccard(a, b)
    return F.when((n(a) == 0) & (n(b) == 0), "empty").when(n(a) == 0, "missing").when(n(b) == 0, "extra").when(j >= 0.8, "match").when(j >= 0.3, "partial").otherwise("missing")


def melt(pairs: DataFrame, id_: str, statuses: dict[str, tuple[Column, float]]) -> DataFrame:
    """(id, field, status, weight), one row a field."""
    parts = F.array(*[F.struct(F.lit(f).alias("field"), s.alias("status"), F.lit(w).alias("weight")) for f, (s, w) in statuses.items()])
    return pairs.select(id_, F.explode(parts).alias("x")).select(id_, "x.*")


def overall(melted: DataFrame, id_: str) -> DataFrame:
    """(id, score): matches and half the partials over all fields that aren't empty, by weight; 0 if all are."""
    won = F.sum(F.when(F.col("status") == "match", F.col("weight")).when(F.col("status") == "partial", F.col("weight") / 2).otherwise(0.0))
    of = F.sum(F.when(F.col("status") != "empty", F.col("weight")).otherwise(0.0))
    return melted.groupBy(id_).agg(F.when(of > 0, won / of).otherwise(F.lit(0.0)).alias("score"))


def gaps(melted: DataFrame) -> DataFrame:
    """(field, n): how often a field is missing or differs."""
    return melted.where(F.col("status").isin("missing", "mismatch")).groupBy("field").agg(F.count("*").alias("n"))


def means(scores: DataFrame, group: str, score: str, failed: str) -> DataFrame:
    """(group, n, mean, mean_of_read): the mean score, failed records counted with their score and left out."""
    return scores.groupBy(group).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.avg(F.when(~F.col(failed), F.col(score))).alias("mean_of_read"))


def grade(score: Column) -> Column:
    return F.when(score >= 0.85, "good").when(score >= 0.65, "fair").when(score >= 0.4, "weak").otherwise("poor")


def bar(score: Column, width: int = 10) -> Column:
    """A bar of ``width`` signs, as many of them filled as the score has whole parts."""
    n = F.floor(score * width).cast("int")
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("."), F.lit(width) - n))
