"""Amounts in free text as native columns. Null text reads as the empty text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattlake.functions.text import strip

# Words near which an amount is that of the offer itself.
CONTEXT = ("rebate", "incentive", "up to $", "receive up to", "save up to", "earn up to", "tax credit", "grant", "award", "discount", "reimburs", "you could receive", "you may receive", "qualifying purchase")

# Patterns of amounts.
DOLLARS, SHARE = r"\$([0-9,]+(?:\.[0-9]+)?)", r"([0-9]+(?:\.[0-9]+)?)\s*%"
PER_KWH, UP_TO = r"\$([0-9]+(?:\.[0-9]+)?)\s*/\s*(?:k[Ww][Hh])", r"(?i)up\s+to\s+\$([0-9,]+(?:\.[0-9]+)?)"


def number(c: Column) -> Column:
    """The number in a matched text without its commas; 0 if there is none."""
    return F.coalesce(F.replace(c, F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0))


def _first(text: Column, pattern: str) -> Column:
    return number(F.regexp_extract(text, pattern, 1))


def parse_amount(text: Column) -> Column:
    """Struct (format, amount): the first of rate per kWh, "up to" sum, plain sum and share whose first match isn't zero, else narrative."""
    t = F.coalesce(text, F.lit(""))
    steps = [(PER_KWH, "per_unit"), (UP_TO, "dollar_amount"), (DOLLARS, "dollar_amount"), (SHARE, "percent")]
    out = F.struct(F.lit("narrative").alias("format"), F.lit(None).cast("double").alias("amount"))
    for pattern, name in reversed(steps):
        v = _first(t, pattern)
        out = F.when(v != 0, F.struct(F.lit(name).alias("format"), v.alias("amount"))).otherwise(out)
    return out


def in_context(text: Column, words: tuple[str, ...] = CONTEXT) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | t.contains(w)
    return out


def parse_amount_in_context(text: Column) -> Column:
    """As parse_amount where a word of context occurs, else narrative."""
    return F.when(in_context(text), parse_amount(text)).otherwise(parse_amount(F.lit("")))


def distinct_amounts(text: Column) -> Column:
    """How many different sums and shares a text names, compared as written."""
    t = F.coalesce(text, F.lit(""))
    sums = F.transform(F.regexp_extract_all(t, F.lit(DOLLARS), 1), lambda x: F.concat(F.lit("$"), x))
    shares = F.transform(F.regexp_extract_all(t, F.lit(SHARE), 1), lambda x: F.concat(x, F.lit("%")))
    return F.size(F.array_distinct(F.concat(sums, shares)))


def share_in_text(text: Column) -> Column:
    """The first whole share from 1 to 100 in a text, null if there is none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"\b([1-9][0-9]?|100)\s*%", 1).try_cast("double")


# Patterns of the amounts in an amount field.
LISTED_RANGE = r"\$\s*([0-9,]+(?:\.[0-9]+)?)\s*-\s*\$\s*([0-9,]+(?:\.[0-9]+)?)"
LISTED_UP_TO = r"(?i)up\s+to\s+\$\s*([0-9,]+(?:\.[0-9]+)?)"
LISTED_SUM = r"\$\s*([0-9,]+(?:\.[0-9]+)?)"
LISTED_PLAIN = r"^([0-9,]+(?:\.[0-9]+)?)$"


def read_listed_amount(text: Column) -> Column:
    """Struct (format, amount, maximum, percent) of an amount field: range, ceiling, share, sum or plain number.

    The first pattern that occurs decides; a ceiling, share or sum of zero has no format, a bound of zero is null.
    """
    t = strip(F.coalesce(text, F.lit("")))
    none = F.lit(None).cast("double")

    def out(fmt: str | None, amount: Column = none, maximum: Column = none, percent: Column = none) -> Column:
        return F.struct(F.lit(fmt).cast("string").alias("format"), amount.alias("amount"), maximum.alias("maximum"), percent.alias("percent"))

    def some(v: Column) -> Column:
        return F.when(v != 0, v)

    def single(pattern: str, made) -> Column:
        v = some(_first(t, pattern))
        return F.when(v.isNotNull(), made(v)).otherwise(out(None))

    lo, hi = (some(number(F.regexp_extract(t, LISTED_RANGE, i))) for i in (1, 2))
    return (
        F.when((t == "") | F.lower(t).isin("varies", "n/a"), out("narrative"))
        .when(t.rlike(LISTED_RANGE), out("tiered", lo, hi))
        .when(t.rlike(LISTED_UP_TO), single(LISTED_UP_TO, lambda v: out("dollar_amount", maximum=v)))
        .when(t.rlike(SHARE), single(SHARE, lambda v: out("percent", percent=v)))
        .when(t.rlike(LISTED_SUM), single(LISTED_SUM, lambda v: out("dollar_amount", v)))
        .when(t.rlike(LISTED_PLAIN), single(LISTED_PLAIN, lambda v: out("dollar_amount", v)))
        .otherwise(out("narrative"))
    )


def settle_hub(amount: Column, text: Column, most: int = 3) -> Column:
    """``amount`` (format, amount) unless the text names ``most`` different amounts or more: then it lists offers and has none of its own."""
    return F.when(distinct_amounts(text) >= most, F.struct(F.lit("narrative").alias("format"), F.lit(None).cast("double").alias("amount"))).otherwise(amount)
