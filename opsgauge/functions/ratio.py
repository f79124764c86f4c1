"""Ratios, percentages and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(c: Column, places: int = 2) -> Column:
    """Half-even rounding of the scaled value, the rule of array libraries.

    Spark's bround rounds the printed decimal instead: it takes 0.545 for an exact tie and gives
    0.54, where the stored number is just above the tie and rounds to 0.55.
    """
    scale = float(10**places)
    return F.rint(c * scale) / scale


SPLIT = float(2**27 + 1)


def round_exact(c: Column, places: int = 2) -> Column:
    """Half-even rounding of the number itself, the rule of plain Python numbers.

    It differs from `round_even` only where the scaled value looks like a tie: there the part that
    scaling lost decides. That part is computed without error, from the number's two halves.
    """
    scale = float(10**places)
    scaled = c * scale
    high = c * SPLIT - (c * SPLIT - c)
    lost = (high * scale - scaled) + (c - high) * scale
    below = F.floor(scaled).cast("double")
    tie = scaled - below == 0.5
    near = F.when(tie & (lost > 0), below + 1).when(tie & (lost < 0), below).otherwise(F.rint(scaled))
    return near / scale


def pct(
    part: Column, whole: Column, zero: float | None = None, places: int | None = 2, exact: bool = False
) -> Column:
    """100 * part / whole. A zero or missing whole gives `zero`, null unless stated. `exact` is for
    ratios of plain counts, which are rounded as Python numbers; sums are rounded as array values."""
    value = F.try_divide(part, whole) * 100
    if places is not None:
        value = round_exact(value, places) if exact else round_even(value, places)
    return value if zero is None else F.coalesce(value, F.lit(float(zero)))
