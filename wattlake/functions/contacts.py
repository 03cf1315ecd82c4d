"""Contacts, flags, labels and markup in text, as native columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Patterns of contacts and of statements in program texts.
PHONE = r"(?:^|[^\d])((?:\+1[\s.\-]?)?(?:\(\d{3}\)|\d{3})[\s.\-]\d{3}[\s.\-]\d{4})(?:[^\d]|$)"
EMAIL = r"([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"
CONTRACTOR = r"(?i)(?:must be (?:installed|completed) by|licensed contractor|approved contractor|trade ally|contractor required|participating contractor)"
AUDIT = r"(?i)(?:energy audit required|home assessment required|home energy assessment|home energy checkup required|pre-inspection required)"
ENDED = r"(?i)(?:expired|program ended|no longer available|program closed|funding exhausted|wait ?list)"

LOW_INCOME = r"(?i)(?:low.income|income.qualified|income.eligible|CARE|FERA|LIHEAP|Good Neighbor|affordable|<\s*\d+%\s*AMI|\d+%\s*(?:of\s+)?(?:area\s+median|AMI))"


def found(text: Column, pattern: str) -> Column:
    x = F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1)
    return F.when(x != "", x)


def phone(text: Column) -> Column:
    return found(text, PHONE)


def email(text: Column) -> Column:
    return F.lower(found(text, EMAIL))


def says(text: Column, pattern: str) -> Column:
    """True where the pattern occurs, else null: absence says nothing."""
    return F.when(F.coalesce(text, F.lit("")).rlike(pattern), True)


def slug(name: Column) -> Column:
    s = F.lower(name)
    for a in (" & ", " ", "/"):
        s = F.replace(s, F.lit(a), F.lit("-"))
    return s


def strip_markup(text: Column) -> Column:
    """Text without tags and with each run of white space as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]*>", " "), r"\s+", " "))


def keep_listed(c: Column, allowed: Sequence[str]) -> Column:
    """The value if it is listed, letter case counted, else null."""
    return F.when(c.isin(*allowed), c)


def infer_labels(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Labels whose keywords occur in a text (as substrings, case ignored), in the order of their first rule.

    One disjunction a label, so the plan grows with the labels, not with the rules.
    """
    by: dict[str, list[str]] = {}
    for word, label in rules:
        by.setdefault(label, []).append(word.lower())
    t = F.lower(F.coalesce(text, F.lit("")))

    def any_of(words: list[str]) -> Column:
        out = t.contains(words[0])
        for w in words[1:]:
            out = out | t.contains(w)
        return out

    return F.filter(F.array(*[F.when(any_of(ws), F.lit(label)) for label, ws in by.items()]), lambda x: x.isNotNull())
