"""Addresses as native columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def path_depth(url: Column) -> Column:
    """How many parts the path of an address has; 0 without one. The query is not cut off."""
    rest = F.regexp_replace(url, r"^.*?://", "")
    return F.when(~rest.contains("/"), 0).otherwise(F.size(F.filter(F.split(F.regexp_replace(rest, r"^[^/]*/", ""), "/"), lambda x: x != "")))


def is_pdf(url: Column) -> Column:
    return F.endswith(F.substring_index(F.lower(url), "?", 1), F.lit(".pdf"))


def keep_url(url: Column, exclude: Sequence[str], include: Sequence[str], least_depth: int = 0) -> Column:
    """Exclusions first, then the least depth, then at least one inclusion; without inclusions all pass. Substrings, case ignored."""
    u = F.lower(url)
    any_of = lambda words: u.rlike("|".join(re.escape(w.lower()) for w in words))
    ok = path_depth(url) >= least_depth
    if exclude:
        ok = ok & ~any_of(exclude)
    return ok & any_of(include) if include else ok


def last_id(url: Column) -> Column:
    """The last part of the path as a whole number; 0 if it is none."""
    return F.coalesce(F.regexp_extract(F.regexp_replace(url, "/+$", ""), r"([^/]*)$", 1).try_cast("int"), F.lit(0))


def parameter(url: Column, name: str) -> Column:
    """The value of a parameter in the query, up to the next one; empty if there is none."""
    return F.regexp_extract(url, rf"{re.escape(name)}=([^&]*)", 1)


def absolute(src: Column, base: str) -> Column:
    """An image address as an absolute one; relative ones that aren't rooted become empty."""
    return (
        F.when(src.startswith("http://") | src.startswith("https://"), src).when(src.startswith("//"), F.concat(F.lit("https:"), src)).when(src.startswith("/"), F.concat(F.lit(base.rstrip("/")), src)).otherwise("")
    )
