"""Routing of records to subscribers by location rules.

The reference form of this join is a nested loop over all rules. Here the rules that are equalities
(state, postal code) are equi-joins; only the substring rules, in either direction, compare a row
with every rule, inside one projection over a literal list: rules are a configuration, whose size is
checked (``most``), so no join of all pairs is planned.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """A subscriber: any of its states, organisations (substring either way), areas (likewise) or postal codes; without any it takes all."""

    id: str
    states: tuple[str, ...] = ()
    organisations: tuple[str, ...] = ()
    areas: tuple[str, ...] = ()
    codes: tuple[str, ...] = field(default=())


def _either_way(value: Column, words: tuple[str, ...]) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    out = F.lit(False)
    for w in (x.strip().lower() for x in words):
        if w:
            out = out | v.contains(w) | ((v != "") & F.lit(w).contains(v))
    return out


def matches(rule: Rule, state: Column, organisation: Column, area: Column, nationwide: Column, codes: Column) -> Column:
    if not (rule.states or rule.organisations or rule.areas or rule.codes):
        return F.lit(True)
    st = F.upper(F.trim(F.coalesce(state, F.lit(""))))
    out = F.coalesce(nationwide, F.lit(False))
    if rule.states:
        out = out | st.isin(*[s.strip().upper() for s in rule.states])
    out = out | _either_way(organisation, rule.organisations) | _either_way(area, rule.areas)
    if rule.codes:
        out = out | F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in rule.codes])), F.lit(False))
    return out


def route(rows: DataFrame, rules: list[Rule], state: str, organisation: str, area: str, nationwide: str, codes: Column, most: int = 2000) -> DataFrame:
    """Rows with the id of each rule they match, in one projection and an explode; nothing is shuffled."""
    if len(rules) > most:
        raise ValueError(f"more than {most} rules: split them into states and codes (equi-joins) first")
    hit = F.array(*[F.when(matches(r, F.col(state), F.col(organisation), F.col(area), F.col(nationwide), codes), F.lit(r.id)) for r in rules])
    return rows.withColumn("rule", F.explode(F.filter(hit, lambda x: x.isNotNull())))


def write_routed(rows: DataFrame, folder: str, column: str = "rule") -> None:
    """Routed rows, one folder a subscriber, in one write."""
    rows.write.mode("overwrite").partitionBy(column).parquet(folder)
