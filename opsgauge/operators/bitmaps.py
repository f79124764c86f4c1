"""Exact distinct counts that can be merged: a bit for each value, kept day by day.

A distinct count of a week does not follow from those of its days. A set of bits does: the days' sets are
or-ed, and the bits counted. Values get dense numbers once; a bucket is the 64 of them that one long
holds, and a set has a row for each bucket that is not empty. So a full set of n values takes n / 64 rows,
one of a few values spread over many never more rows than values, and all aggregates keep longs only.
Partials of a day never change, so a new day adds its rows, and any week, month or year is an or over
rows that are there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsgauge.operators.periods import Period, assign_periods, complete

#: Slots that values are numbered in side by side; each holds its share of all distinct values.
SLOTS = 1024


def numbered(df: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """(key, id): every distinct known value with a number of its own, 1, 2, 3 … without gaps.

    Values are spread over slots by hash and numbered there; a slot begins where the one before ends.
    Keep the result as a table: numbers hold for the values that it has, and new values are added with
    ``extended``.
    """
    values = df.select(F.col(key)).dropna().distinct().withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(slots)))
    sizes = values.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    # one row a slot
    ahead = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slot", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_slot").orderBy(key))
    return (
        values.withColumn("_place", place)
        .join(F.broadcast(starts), "_slot")
        .select(key, (F.col("_start") + F.col("_place")).alias("id"))
    )


def extended(known: DataFrame, df: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """A numbering with the values of ``df`` that it lacks; known values keep their numbers."""
    new = numbered(df.join(known, key, "left_anti"), key, slots)
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    # the last number is one row
    added = new.crossJoin(F.broadcast(last)).select(key, (F.col("id") + F.col("_last")).alias("id"))
    return known.select(key, "id").unionByName(added)


def day_partials(df: DataFrame, day: str, id: str, by: Sequence[str] = (), **marks: Column | None) -> DataFrame:
    """(day, by …, mark, bucket, bits): for each mark the ids of the rows that meet it (None: all rows).

    The sets of all marks are or-ed side by side, on the map side first. Rows without day or id are left
    out.
    """
    id_ = F.col(id).cast("long")
    bit = F.expr("shiftleft(1L, CAST(_id & 63L AS INT))")
    held = {f"_m{k}": F.lit(True) if c is None else c for k, c in enumerate(marks.values())}
    rows = df.dropna(subset=[day, id]).select(
        F.to_date(day).alias("day"), *by, id_.alias("_id"), *[c.alias(n) for n, c in held.items()]
    )
    sets = rows.groupBy("day", *by, F.shiftright("_id", 6).alias("bucket")).agg(
        *[F.bit_or(F.when(F.col(n), bit)).alias(n) for n in held]
    )
    each = [F.struct(F.lit(name).alias("mark"), F.col(n).alias("bits")) for name, n in zip(marks, held)]
    spread = sets.select("day", *by, "bucket", F.inline(F.array(*each)))
    return spread.filter(F.col("bits").isNotNull()).select("day", *by, "mark", "bucket", "bits")


def merged(partials: DataFrame, to: Sequence[str]) -> DataFrame:
    """Partials of coarser groups, which can be merged again: sets or-ed by mark and bucket."""
    return partials.groupBy(*to, "mark", "bucket").agg(F.bit_or("bits").alias("bits"))


def counted(partials: DataFrame, by: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """(by …, mark …): the exact distinct counts, 0 where a group has no row of a mark."""
    sets = merged(partials, by).select(*by, "mark", F.bit_count("bits").cast("long").alias("_n"))
    sums = [F.coalesce(F.sum(F.when(F.col("mark") == m, F.col("_n"))), F.lit(0)).alias(m) for m in marks]
    return sets.groupBy(*by).agg(*sums)


def period_counts(partials: DataFrame, periods: Sequence[Period], marks: Sequence[str]) -> DataFrame:
    """(period, mark …): distinct counts of report periods from the partials of their days."""
    dated = assign_periods(partials, "day", periods)
    return complete(counted(dated, ["period"], marks), periods, marks)
