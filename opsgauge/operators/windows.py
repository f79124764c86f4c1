"""Windows over time within a key, built so that one key may hold most of the rows.

A plain window puts all rows of a key into one task, and a frame that slides costs the size
of the frame for every row. Here time is cut into slots and the rows are spread by
(key, slot). What a row needs from outside its slot arrives in one of two ways:

* from the one slot at the far edge of its frame, as carried copies that hold nothing but the
  key, the time and the value, placed on the row's own clock;
* from all slots in between, as one total per (key, slot), added up on the map side first.

Inside a slot every frame starts at an end of the slot, so its value is kept running and each
row costs the same however dense the key is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsgauge.functions.clock import DAY_US, HOUR_US, MINUTE_US, floor_div, micros

LONG_AGO = -(2**62)  # slot of rows without a time


def _slot_of(ts: str, slot_us: int) -> Column:
    return F.coalesce(floor_div(micros(F.col(ts)), slot_us), F.lit(LONG_AGO))


def _all_known(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def _carry(df: DataFrame, shift: int, reach: int, needed: Sequence[str], wanted: Column) -> DataFrame:
    """Every row in its home slot, and a copy of the `wanted` ones `shift` slots away on that slot's clock.

    The copy keeps only the `needed` columns; the others are null, so it adds few bytes.
    """
    home = F.col("_home")
    both = df.withColumn("_slot", F.explode(F.when(wanted, F.array(home, home + shift)).otherwise(F.array(home))))
    own = F.col("_slot") == F.col("_home")
    moved = F.when(own, F.col("_us")).otherwise(F.col("_us") + F.lit(reach))
    return both.select(*_narrow(df, needed, own), "_slot", own.alias("_own"), moved.alias("_pos"))


def _narrow(df: DataFrame, needed: Sequence[str], own: Column) -> list[Column]:
    """The columns of own rows, and the needed ones of copies."""
    plain = [F.col(c) for c in df.columns if c in needed]
    return plain + [F.when(own, F.col(c)).alias(c) for c in df.columns if c not in needed]


def _inside(within: str | None, n: int) -> Column:
    """Whether a row is in slice n of those that the bits of a column name; without it, there is one slice of all rows."""
    return F.lit(True) if within is None else F.col(within).bitwiseAND(F.lit(1 << n)) != 0


# Rows and an aggregate over them come from one exchange, made once, if both read the same columns of
# it. A consumer that needs few columns would make the rows read less, so both read all of them.


def _reading(df: DataFrame, own: Column | None = None) -> Column:
    """Not null for a group that holds rows (of its own); reads every column."""
    seen = F.hash(*df.columns)
    return F.max(seen if own is None else F.when(own, seen))


def _read(df: DataFrame) -> Column:
    """True for every row; reads every column."""
    return F.hash(*df.columns) >= F.lit(-(2**31))


def burst_dedupe(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    number: str,
    gap_us: int = 10 * MINUTE_US,
    out: str = "is_latest",
    within: str | None = None,
    slices: int = 1,
    stretch: int = 6,
) -> DataFrame:
    """Mark 1 the rows whose number is the largest of their key in (ts - gap, ts].

    The slot is as wide as the gap, so the frame is the part of the own slot up to the row and
    the part of the slot before it after ts - gap. Rows with a null key have no peers: mark 0.
    Rows are dealt by stretches of slots, so only those of a stretch's last slot are sent twice; the copies
    for the slots inside are made where the rows have been dealt.

    With `within`, a bit of that column says for each of so many slices whether the row is in it, rows are
    peers in the slices that both are in, and the mark has a bit for each.
    """
    base = df.withColumn("_us", micros(F.col(ts))).withColumn("_home", _slot_of(ts, gap_us))
    home, place = F.col("_home"), floor_div(F.col("_home"), stretch)
    last = F.pmod(home, F.lit(stretch)) == stretch - 1
    dealt = base.withColumn("_slots", F.explode(F.when(last, F.array(place, place + 1)).otherwise(F.array(place))))
    needed = [*keys, number, "_us", "_home", *([within] if within else [])]
    dealt = dealt.select(*_narrow(base, needed, F.col("_slots") == place), "_slots").repartition(*keys, "_slots")
    at_home = F.col("_slots") == place
    spread = dealt.withColumn(
        "_slot",
        F.explode(F.when(~at_home, F.array(home + 1)).when(last, F.array(home)).otherwise(F.array(home, home + 1))),
    )
    own = at_home & (F.col("_slot") == home)
    spread = spread.withColumn("_own", own).withColumn("_pos", F.col("_us") + F.when(own, 0).otherwise(gap_us))
    group = Window.partitionBy(*keys, "_slots", "_slot")
    upto = group.orderBy("_pos").rangeBetween(Window.unboundedPreceding, 0)
    after = group.orderBy(F.desc("_pos")).rangeBetween(Window.unboundedPreceding, -1)
    known = _all_known([*keys, "_us"])

    def latest(n: int) -> Column:
        best = F.greatest(
            F.max(F.when(F.col("_own") & _inside(within, n), F.col(number))).over(upto),
            F.max(F.when(~F.col("_own") & _inside(within, n), F.col(number))).over(after),
        )
        return known & _inside(within, n) & (F.col(number) == best)

    marks = [F.when(latest(n), F.lit(1 << n)).otherwise(F.lit(0)) for n in range(slices)]
    marked = spread.withColumn(out, marks[0] if within is None else reduce(add, marks).cast("bigint"))
    return marked.filter("_own").select(*df.columns, out)


def forward_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    mark: str,
    counts: Mapping[str, Sequence[str]],
    horizon_us: int = 30 * DAY_US,
    slot_us: int = HOUR_US,
    slices: int | None = None,
) -> DataFrame:
    """Marked rows of the same key in [ts, ts + horizon], both ends included.

    `counts` names each result and the further columns that its rows must share beside
    `keys`; null equals null in those. All results use one spread of the rows. The horizon
    must be a multiple of the slot. A row with a null in `keys` has no peers: count 0. All columns of
    `df` go through the exchange of the windows: give it no more than are wanted. With `slices`, the mark has a
    bit for each of so many slices, and a result is an array of their counts.
    """
    reach, rest = divmod(horizon_us, slot_us)
    if rest or reach < 1:
        raise ValueError("the horizon must be a multiple of the slot")
    extra = sorted({c for cols in counts.values() for c in cols})
    base = df.withColumn("_us", micros(F.col(ts))).withColumn("_home", _slot_of(ts, slot_us))
    zero = F.lit(0)
    marks = F.coalesce(F.col(mark), zero)
    # one exchange for the rows and for the totals of their slots; rows without a mark count nowhere else
    far = _carry(base, -reach, -horizon_us, [*keys, *extra, mark], marks != 0)
    spread = dealt = far.repartition(*keys, "_slot")
    each = range(slices or 1)
    values = [marks if slices is None else F.shiftright(marks, n).bitwiseAND(F.lit(1)) for n in each]
    value_own = [F.when(F.col("_own"), v).otherwise(zero) for v in values]
    value_far = [F.when(F.col("_own"), zero).otherwise(v) for v in values]
    known = _all_known([*keys, ts])
    part = lambda name, n: f"_ahead_{n}_{name}"

    # narrow keys first: the wider keys then reuse the same partitioning
    for name, cols in sorted(counts.items(), key=lambda item: len(item[1])):
        clock = Window.partitionBy(*keys, "_slot", *cols).orderBy("_pos")
        whole = clock.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = clock.rangeBetween(Window.unboundedPreceding, -1)
        upto = clock.rangeBetween(Window.unboundedPreceding, 0)
        edges = {
            part(name, n): F.sum(value_own[n]).over(whole)
            - F.coalesce(F.sum(value_own[n]).over(before), zero)
            + F.coalesce(F.sum(value_far[n]).over(upto), zero)
            for n in each
        }
        spread = spread.withColumns(edges)
    rows = spread.filter(F.col("_own") & _read(dealt))

    if reach > 1:
        # the finest totals are taken from the rows where these have been dealt, coarser ones from them
        finest = dealt.groupBy(*keys, *extra, "_slot").agg(
            *[F.sum(v).alias(f"_n{n}") for n, v in enumerate(value_own)], _reading(dealt, F.col("_own")).alias("_seen")
        )
        finest = finest.filter("_seen IS NOT NULL")
        for name, cols in counts.items():
            total = finest
            if sorted(cols) != extra:
                total = finest.groupBy(*keys, *cols, "_slot").agg(*[F.sum(f"_n{n}").alias(f"_n{n}") for n in each])
            # the slots in between as a difference of two running totals: a frame with both ends on the
            # move would cost its size for every slot, and a dense key has as many slots as time has
            slots = Window.partitionBy(*keys, *cols).orderBy("_slot")
            ahead = slots.rangeBetween(Window.unboundedPreceding, reach - 1)
            so_far = slots.rangeBetween(Window.unboundedPreceding, 0)
            inner = total.select(
                *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, *cols])],
                F.col("_slot").alias("_kslot"),
                *[(F.sum(f"_n{n}").over(ahead) - F.sum(f"_n{n}").over(so_far)).alias(f"_between{n}") for n in each],
            ).filter(reduce(or_, [F.col(f"_between{n}") > 0 for n in each]))
            test = rows["_slot"] == inner["_kslot"]
            for i, c in enumerate(keys):
                test = test & (rows[c] == inner[f"_k{i}"])
            for i, c in enumerate(cols, start=len(keys)):
                test = test & rows[c].eqNullSafe(inner[f"_k{i}"])
            joined = rows.join(inner, test, "left")
            more = {part(name, n): F.col(part(name, n)) + F.coalesce(F.col(f"_between{n}"), zero) for n in each}
            rows = joined.select(*[c for c in rows.columns if c not in more], *[c.alias(n) for n, c in more.items()])

    def result(name: str) -> Column:
        figures = [F.when(known, F.col(part(name, n))).otherwise(zero).cast("bigint") for n in each]
        return figures[0] if slices is None else F.array(*figures)

    return rows.select(*df.columns, *[result(n).alias(n) for n in counts])


def _attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Add a summary with one row per (key, slot) to the rows of that key and slot."""
    side = summary.toDF(*[f"_s_{c}" if c in (*keys, "_slot") else c for c in summary.columns])
    test = rows["_slot"] == side["_s__slot"]
    for k in keys:
        other = side[f"_s_{k}"]
        test = test & (rows[k].eqNullSafe(other) if null_safe else rows[k] == other)
    return rows.join(side, test, "left").drop("_s__slot", *[f"_s_{k}" for k in keys])


def attach_any(
    df: DataFrame, keys: Sequence[str], spread_on: Sequence[str], slots: int = 1024, bits: bool = False, **labels: Column
) -> DataFrame:
    """Give every row, for each label, whether any row of its key carries it (0/1).

    With `bits`, a label is a whole number instead, a mark in each bit, and a row gets the bits that any
    row of its key carries. The rows of a key are spread over slots by a hash of `spread_on`; each slot
    is reduced to one row before the slots of a key meet. A null key counts as a key of its own.
    """
    zero = F.lit(0)
    marks = {f"_own_{n}": F.coalesce(c, zero) if bits else F.when(c, 1).otherwise(0) for n, c in labels.items()}
    # a null key gets a mark beside a value, so that rows are dealt once, by the very columns of the join
    known = {f"_k{i}": F.coalesce(F.col(k), _blank(df, k)) for i, k in enumerate(keys)}
    missing = {f"_n{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    dealt = [*known, *missing, "_slot"]
    slot = F.coalesce(F.pmod(F.xxhash64(*spread_on), F.lit(slots)), F.lit(0).cast("bigint"))
    rows = df.withColumns({"_slot": slot, **marks, **known, **missing}).drop(*keys).repartition(*dealt)
    per_slot = rows.groupBy(*dealt).agg(
        *[F.bit_or(f"_own_{n}").alias(f"_any_{n}") for n in labels], _reading(rows).alias("_seen")
    )
    per_slot = per_slot.filter("_seen IS NOT NULL").drop("_seen")
    group = Window.partitionBy(*known, *missing)
    whole = per_slot.withColumns({f"_any_{n}": F.bit_or(f"_any_{n}").over(group) for n in labels})
    joined = _attach(rows, whole, [*known, *missing])
    # a test of the rows alone would be made before they are dealt, and one side of the join only
    joined = joined.filter(F.hash(*rows.columns, *[f"_any_{n}" for n in labels]) >= F.lit(-(2**31)))
    back = {k: F.when(~F.col(f"_n{i}"), F.col(f"_k{i}")) for i, k in enumerate(keys)}
    plain = [back[c].alias(c) if c in back else F.col(c) for c in df.columns]
    return joined.select(*plain, *[F.col(f"_any_{n}").alias(n) for n in labels])


def _blank(df: DataFrame, col: str) -> Column:
    """Some value of the column's type."""
    plain = "1970-01-01" if df.schema[col].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else "0"
    return F.lit(plain).cast(df.schema[col].dataType)


def first_in_group(
    df: DataFrame, keys: Sequence[str], ts: str, out: str = "first_flag", slot_us: int = HOUR_US
) -> DataFrame:
    """Mark 1 the rows that hold their key's earliest time; ties are all marked, null keys never."""
    rows = df.withColumn("_slot", _slot_of(ts, slot_us))
    per_slot = rows.groupBy(*keys, "_slot").agg(F.min(ts).alias("_first"))
    earliest = per_slot.withColumn("_first", F.min("_first").over(Window.partitionBy(*keys)))
    joined = _attach(rows, earliest, keys)
    return joined.withColumn(out, F.when(F.col(ts) == F.col("_first"), 1).otherwise(0)).drop("_slot", "_first")


def place_in_group(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    then_by: Sequence[str],
    out: str = "place",
    slot_us: int = DAY_US,
) -> DataFrame:
    """Row number within the key, ordered by time and the further columns.

    The number within the slot plus the size of all earlier slots of the key. Rows are dealt once, by
    key and slot; the sizes are taken from them there.
    """
    rows = df.withColumn("_slot", _slot_of(ts, slot_us)).repartition(*keys, "_slot")
    sizes = rows.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"), _reading(rows).alias("_seen"))
    sizes = sizes.filter("_seen IS NOT NULL")
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select(*keys, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"))
    local = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(ts, *then_by))
    # null equals null here: a test that drops nulls would be made on one side of the exchange only
    joined = _attach(rows.withColumn("_local", local).filter(_read(rows)), ahead, keys, null_safe=True)
    place = F.when(_all_known(keys), F.col("_local") + F.col("_ahead"))
    return joined.withColumn(out, place).drop("_slot", "_local", "_ahead")


def has_previous(
    df: DataFrame, keys: Sequence[str], ts: str, then_by: Sequence[str], out: str = "has_previous"
) -> DataFrame:
    """Mark 1 the rows that have an earlier row of their key; null keys have none."""
    placed = place_in_group(df, keys, ts, then_by, out="_place")
    return placed.withColumn(out, F.when(F.col("_place") > 1, 1).otherwise(0)).drop("_place")
