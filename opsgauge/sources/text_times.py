"""Tests on times kept as text that a file scan can make before anything is parsed.

Whether a text can be a time within a span of days shows in how it begins. The beginnings follow from
the layouts, and tests of beginnings are pushed down to Parquet, where they skip row groups by the
least and greatest text; files written day by day are then read for the span only. The tests let
through more than the span (whole months, neighbouring ones where a zone may shift a day), never
less: the parsed times are tested after them.
"""

from __future__ import annotations

from calendar import month_abbr
from collections.abc import Iterator, Sequence
from datetime import date, timedelta
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, functions as F

#: Longer spans are not tested: there would be too many beginnings.
MOST_DAYS = 400
TOKENS = ("yyyy", "MMM", "MM", "dd")


def _days(lo: date, hi: date) -> Iterator[date]:
    for n in range((hi - lo).days + 1):
        yield lo + timedelta(days=n)


def _cases(name: str) -> Iterator[str]:
    """All ways to write a name in capitals and small letters: layouts read month names in any."""
    return map("".join, product(*({c.lower(), c.upper()} for c in name)))


def _beginnings(layout: str, lo: date, hi: date) -> set[str] | None:
    """How texts of a layout begin for the days of the span; None where the layout does not tell."""
    parts, rest = [], layout
    while rest:
        token = next((t for t in TOKENS if rest.startswith(t)), None)
        if token is None and (rest[0].isalpha() or rest[0] in "'[{#"):
            break
        if token in parts:
            return None
        parts.append(token or rest[0])
        rest = rest[len(parts[-1]) :]
    if not {"yyyy", "dd"} <= {*parts} or len({"MMM", "MM"} & {*parts}) != 1 or rest[:1] in ("d", "M", "y"):
        return None
    if parts[-1] != "dd" and parts.index("dd") > max(parts.index(t) for t in parts if t[0] in "yM"):
        parts = parts[: parts.index("dd") + 1]
    if parts[-1] == "dd":  # the day last: whole months will do
        parts = parts[:-1]
    out = set()
    for day in _days(lo, hi):
        written = {
            "yyyy": [f"{day.year:04d}"],
            "MMM": _cases(month_abbr[day.month]),
            "MM": [f"{day.month:02d}"],
            "dd": [f"{day.day:02d}"],
        }
        out.update(map("".join, product(*(list(written.get(p, [p])) for p in parts))))
    return out


def _plain(lo: date, hi: date) -> tuple[set[str], set[str]]:
    """Beginnings and whole texts of plain timestamps, which may carry a zone, a sign or more digits."""
    starts, wholes = set(), set()
    for day in _days(lo - timedelta(days=1), hi + timedelta(days=1)):
        for sign, more in product(("", "+"), ("", "0", "00")):
            year = f"{sign}{more}{day.year:04d}"
            starts |= {f"{year}-{day.month:02d}", f"{year}-{day.month}-"}
            wholes.add(f"{year}-{day.month}")
            if day.month == 1:
                wholes.add(year)
    return starts, wholes


def may_be_within(c: Column, layouts: Sequence[str], lo: str, hi: str) -> Column | None:
    """A test on a text that holds for every text that `parse_any` reads, by these layouts, as a time
    from the day `lo` to the day `hi`; None where no such test can be made."""
    first, last = date.fromisoformat(lo), date.fromisoformat(hi)
    if (last - first).days >= MOST_DAYS:
        return None
    starts, wholes = _plain(first, last)
    for layout in layouts:
        found = _beginnings(layout, first, last)
        if found is None:
            return None
        starts |= found
    # a beginning that another one begins with needs no test of its own
    starts = {s for s in starts if not any(s[:n] in starts for n in range(1, len(s)))}
    # plain timestamps may stand behind blanks
    tests = [c < "!", c.isin(*sorted(wholes)), *(c.startswith(s) for s in sorted(starts))]
    return reduce(or_, tests)
