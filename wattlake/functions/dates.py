"""Dates kept as text, as native columns; what can't be read stays as it is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_date(text: Column) -> Column:
    """ISO form of MM/YYYY (first of the month) and M/D/YYYY; other texts, ISO ones too, unchanged. Nothing is validated."""
    t = F.trim(text)
    p = F.split(t, "/")
    two = lambda i: F.lpad(F.get(p, F.lit(i)), 2, "0")
    return (
        F.when(F.size(p) == 2, F.concat(F.get(p, F.lit(1)), F.lit("-"), two(0), F.lit("-01")))
        .when(F.size(p) == 3, F.concat(F.get(p, F.lit(2)), F.lit("-"), two(0), F.lit("-"), two(1)))
        .otherwise(t)
    )


def whole_date(text: Column) -> Column:
    """A bare year or month as its first day."""
    return F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01"))).when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)


def millis_date(text: Column) -> Column:
    """The UTC day of a text of milliseconds; null for blank, bad, zero and negative ones."""
    n = F.trim(text).try_cast("bigint")
    return F.when(n > 0, F.date_format(F.timestamp_millis(n), "yyyy-MM-dd"))


def is_current(start: Column, end: Column, at: Column) -> Column:
    """Whether a period of two ISO texts holds at a time: an end of that very day is past, unreadable bounds don't count."""
    s, e = F.try_to_timestamp(start, F.lit("yyyy-MM-dd")), F.try_to_timestamp(end, F.lit("yyyy-MM-dd"))
    return ~(F.coalesce(e < at, F.lit(False)) | F.coalesce(s > at, F.lit(False)))


# Words before the date on which something starts or ends.
START = r"(?i)(?:effective|start(?:s|ing)?|begin(?:s|ning)?|as of|from)\s+(\d{4}-\d{2}-\d{2}|\w+ \d{1,2},?\s*\d{4})"
END = r"(?i)(?:end(?:s|ing)?|expires?|through|until|deadline|valid\s+through|offer\s+ends?)\s+(\d{4}-\d{2}-\d{2}|\w+ \d{1,2},?\s*\d{4}|\w+ \d{4})"


def date_in_text(text: Column, pattern: str) -> Column:
    """The date behind the words of ``pattern``, as written; null if there is none."""
    d = F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1)
    return F.when(d != "", d)
