"""Text normalisation as native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: All Unicode white space; Java's ``\s`` alone is ASCII.
WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def norm(c: Column | str) -> Column:
    """Lower case, each run of white space as one space, trimmed. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.lower(c), WS, " "))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at its ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{WS}|{WS}$", "")


def blank_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(F.regexp_replace(c, WS, " ")) != "", c)


def program_hash(name: Column | str, organisation: Column | str) -> Column:
    """Identity of a program: SHA-256 over normalised name and organisation; a null part counts as empty."""
    e = F.lit("")
    return F.sha2(F.concat(F.coalesce(norm(name), e), F.lit("|"), F.coalesce(norm(organisation), e)), 256)
