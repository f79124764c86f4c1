"""Several measures of one input in one aggregate.

Each measure asks for figures of its own slices of the rows. All figures that count distinct values of
one key are bits of one number a key, for every measure, period and condition; rows are counted and
values summed beside it. So the input is read once, a key sends one narrow row whatever the number of
periods, no row is copied for a period, and the last step adds up bits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from opsgauge.operators.periods import Slices

BITS = 62


@dataclass(frozen=True)
class Ask:
    """What one measure asks of the rows of its slices.

    ``only`` limits the rows further. ``distinct`` counts the keys with a row that meets the test (None:
    any row), ``counts`` the rows that do, ``totals`` sums the known values, and ``peaks`` takes each
    key's largest value and the mean of those. An unknown test is not met. Names must be unique among
    the asks that are fused.
    """

    slices: Slices
    only: Column | None = None
    distinct: Mapping[str, Column | None] = field(default_factory=dict)
    counts: Mapping[str, Column | None] = field(default_factory=dict)
    totals: Mapping[str, Column] = field(default_factory=dict)
    peaks: Mapping[str, Column] = field(default_factory=dict)


def _within(ask: Ask, test: str) -> Column:
    inside = F.expr(test)
    return inside if ask.only is None else inside & ask.only


def fused(df: DataFrame, key: str | Column | None, asks: Sequence[Ask]) -> DataFrame:
    """(period, every name asked for), one row for each period, periods without rows included.

    Counts of nothing are 0, sums of nothing null. ``key`` may be None where nothing distinct is asked
    for; a null key is no value, but its rows are counted and summed.
    """
    labels = [label for label, _ in asks[0].slices.tests]
    bits: list[Column] = []
    place: dict[tuple[str, str], int] = {}
    values: dict[str, Column] = {}
    kinds: dict[str, str] = {}
    for ask in asks:
        if [label for label, _ in ask.slices.tests] != labels:
            raise ValueError("fused measures must have the same periods")
        for kind in ("distinct", "counts", "totals", "peaks"):
            for name in getattr(ask, kind):
                if name in kinds:
                    raise ValueError(f"two measures ask for {name}")
                kinds[name] = kind
        for n, (label, test) in enumerate(ask.slices.tests):
            inside = _within(ask, test)
            meets = lambda c: inside if c is None else inside & c  # noqa: B023,E731
            for name, c in ask.distinct.items():
                place[name, label] = len(bits)
                bits.append(F.when(meets(c), F.lit(1 << len(bits) % BITS).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
            for name, c in ask.counts.items():
                values[f"_{n}_{name}"] = F.when(meets(c), F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for name, c in {**ask.totals, **ask.peaks}.items():
                values[f"_{n}_{name}"] = F.when(inside, c)
    by_key = bool(bits) or "peaks" in kinds.values()
    if by_key and key is None:
        raise ValueError("distinct values and peaks need a key")

    near = reduce(or_, [_within(a, a.slices.bounds) for a in asks])
    masks = {f"_bits{k}": reduce(add, bits[a : a + BITS]) for k, a in enumerate(range(0, len(bits), BITS))}
    rows = df.filter(near)
    if by_key:
        keyed = F.col(key) if isinstance(key, str) else key
        rows = rows.select(keyed.alias("_key"), *[c.alias(n) for n, c in (masks | values).items()])
        peak = lambda n: kinds[n.split("_", 2)[2]] == "peaks"
        rows = rows.groupBy("_key").agg(
            *[F.bit_or(n).alias(n) for n in masks],
            *[(F.max(n) if peak(n) else F.sum(n)).alias(n) for n in values],
        )
    else:
        rows = rows.select(*[c.alias(n) for n, c in values.items()])

    def figure(name: str, n: int, label: str) -> Column:
        if kinds[name] == "peaks":
            return F.avg(F.when(F.col("_key").isNotNull(), F.col(f"_{n}_{name}")))
        if kinds[name] == "distinct":
            at = place[name, label]
            bit = F.lit(1 << at % BITS).cast("bigint")
            return F.count_if(F.col("_key").isNotNull() & (F.col(f"_bits{at // BITS}").bitwiseAND(bit) != 0))
        whole = F.sum(f"_{n}_{name}")
        return F.coalesce(whole, F.lit(0).cast("bigint")) if kinds[name] == "counts" else whole

    figures = {f"f{n}_{name}": figure(name, n, label) for n, label in enumerate(labels) for name in kinds}
    whole = rows.agg(*[c.alias(n) for n, c in figures.items()])
    periods = [
        F.struct(F.lit(label).alias("period"), *[F.col(f"f{n}_{name}").alias(name) for name in kinds])
        for n, label in enumerate(labels)
    ]
    return whole.select(F.inline(F.array(*periods)))
