"""Date and time functions: parsing, truncation, differences and shifts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from opsgauge.functions.ratio import round_even

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US

# The text layouts that timestamps arrive in.
ISO = "yyyy-MM-dd HH:mm:ss"
MONTH_NAME_12H = "yyyy-MMM-dd hh:mm:ss"
DAY_FIRST_12H = "dd/MM/yyyy hh:mm:ss"
DAY_FIRST = "dd/MM/yyyy HH:mm:ss"
DAY_FIRST_MINUTES = "dd/MM/yyyy HH:mm"
DAY_FIRST_DAY = "dd/MM/yyyy"


def parse_ts(c: Column, layout: str = ISO, strict: bool = False) -> Column:
    """Text to timestamp. Text that does not fit is null, or an error when strict."""
    return F.to_timestamp(c, layout) if strict else F.try_to_timestamp(c, F.lit(layout))


def parse_any(c: Column, layouts: Sequence[str], strict: bool = False) -> Column:
    """Text to timestamp by the first layout that fits, or as a plain timestamp text. Text that fits
    none is null, or an error when strict. A time of day alone is no timestamp: its day would be that
    of the run."""
    tried = [parse_ts(c, layout) for layout in layouts]
    dated = F.when(c.rlike(r"^[\x00-\x20]*\+?\d{4}"), c.try_cast("timestamp"))
    found = F.coalesce(*tried, dated)
    if not strict:
        return found
    complaint = F.raise_error(F.concat(F.lit("not a time: "), c))
    return F.coalesce(found, F.when(c.isNotNull(), complaint.cast("timestamp")))


def fmt_date(c: Column) -> Column:
    """The day as yyyy-MM-dd text."""
    return F.date_format(c, "yyyy-MM-dd")


def as_date(c: Column) -> Column:
    """The day of a timestamp."""
    return F.to_date(c)


def week_u(c: Column) -> Column:
    """Week of the year, weeks beginning on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def micros(c: Column) -> Column:
    """Microseconds since the epoch; the form that range frames need."""
    return F.unix_micros(c.cast("timestamp"))


def floor_div(number: Column, width: int) -> Column:
    """Whole-number division that rounds down, exact for negative numbers too."""
    return ((number - F.pmod(number, F.lit(width))) / F.lit(width)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours to two places, rounded half to even."""
    return round_even((micros(end) - micros(start)) / F.lit(float(HOUR_US)))


def days_floor(start: Column, end: Column) -> Column:
    """Elapsed whole days, rounded down (minus half a day is -1)."""
    return floor_div(micros(end) - micros(start), DAY_US)


def shift_time(c: Column, amount: int, unit: str) -> Column:
    """Move a date by days, or a timestamp by days, hours or minutes."""
    if unit == "date":
        return F.date_add(c, amount)
    parts = {"days": 0, "hours": 0, "mins": 0}
    parts[unit] = amount
    return c + F.make_dt_interval(*[F.lit(parts[u]) for u in ("days", "hours", "mins")])


def monday_of(c: Column) -> Column:
    """The Monday of the week that holds the day."""
    return F.to_date(F.date_trunc("week", c))
