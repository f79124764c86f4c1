"""Text functions: trimming, prefixes, substrings, casts and percentage text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from opsgauge.functions.ratio import round_even

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (Spark's trim knows blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def starts_with(c: Column, *prefixes: str) -> Column:
    """True when the text begins with any of the prefixes; null stays null."""
    return reduce(or_, [c.startswith(p) for p in prefixes])


def contains_ci(c: Column, part: str) -> Column:
    """Case-insensitive substring test; a null text counts as no match."""
    return F.coalesce(F.contains(F.lower(c), F.lit(part.lower())), F.lit(False))


def replace_literal(c: Column, old: str, new: str = "") -> Column:
    """Replace every occurrence of a plain text."""
    return F.replace(c, F.lit(old), F.lit(new))


def to_text(c: Column) -> Column:
    """Number or any scalar as text; null stays null."""
    return c.cast("string")


def to_int(c: Column, default: int | None = 0) -> Column:
    """Whole number from clean or dirty numeric text ("230020.0"); null becomes `default`."""
    text = strip(c.cast("string"))
    number = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    if default is None:
        return number
    return F.when(c.isNull(), F.lit(default).cast("bigint")).otherwise(number)


def line_code(c: Column) -> Column:
    """A numeric code as text without the ".0" tail that a float round trip leaves."""
    return to_text(to_int(c, 0))


def as_percent_text(c: Column, places: int | None = 2) -> Column:
    """12.5 -> "12.5%". With places=None the number is not rounded."""
    number = c if places is None else round_even(c, places)
    return F.concat(number.cast("string"), F.lit("%"))
