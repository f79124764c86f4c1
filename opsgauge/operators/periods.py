"""Report periods: membership, look-back slices, and completing a result over all periods."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Period:
    """A labelled span of days, both ends included."""

    label: str
    start: str
    end: str

    def __post_init__(self):
        if date.fromisoformat(self.start) > date.fromisoformat(self.end):
            raise ValueError(f"period {self.label} ends before it starts")


def _day(text: str, shift: int = 0) -> str:
    return (date.fromisoformat(text) + timedelta(days=shift)).isoformat()


def _text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bound(dtype: T.DataType, day: str) -> str:
    """A day as a literal of the column's own type, so that the comparison reaches the file scan."""
    return f"CAST('{_day(day)}' AS {dtype.simpleString()})"


def _within(dtype: T.DataType, col: str, start: str, end: str, mode: str) -> str:
    if mode not in ("date", "instant"):
        raise ValueError(f"unknown mode {mode!r}")
    lower = f"`{col}` >= {_bound(dtype, start)}"
    if mode == "instant" or isinstance(dtype, T.DateType):
        return f"{lower} AND `{col}` <= {_bound(dtype, end)}"
    return f"{lower} AND `{col}` < {_bound(dtype, _day(end, 1))}"


def _within_days_before(dtype: T.DataType, col: str, end: str, days: int, closed: bool, mode: str) -> str:
    first = _day(end, -days)
    if closed:
        return _within(dtype, col, first, end, mode)
    # open bound: a day value must be later than the first day; an instant, than its midnight
    if mode == "date" or isinstance(dtype, T.DateType):
        return _within(dtype, col, _day(first, 1), end, mode)
    return f"`{col}` > {_bound(dtype, first)} AND `{col}` <= {_bound(dtype, end)}"


def in_period(df: DataFrame, col: str, start: str, end: str, mode: str = "date") -> Column:
    """Test that the value lies in [start, end].

    mode="date" takes the whole last day. mode="instant" reads the end as its midnight, so
    for a timestamp only the first instant of the last day belongs to the period.
    """
    return F.expr(_within(df.schema[col].dataType, col, start, end, mode))


def in_lookback(df: DataFrame, col: str, end: str, days: int, closed: bool, mode: str = "date") -> Column:
    """Test for the `days` before the period end; `closed` includes the first day."""
    return F.expr(_within_days_before(df.schema[col].dataType, col, end, days, closed, mode))


@dataclass(frozen=True)
class Slices:
    """The rows that each period takes of an input, as SQL tests by label, and a wider test that all of
    them imply, with plain literals, so that it prunes files and row groups in the scan."""

    tests: tuple[tuple[str, str], ...]
    bounds: str


def period_slices(df: DataFrame, col: str, periods: Sequence[Period], mode: str = "date") -> Slices:
    """The rows dated in each period."""
    lo, hi = min(p.start for p in periods), max(p.end for p in periods)
    dtype = df.schema[col].dataType
    tests = tuple((p.label, _within(dtype, col, p.start, p.end, mode)) for p in periods)
    return Slices(tests, _within(dtype, col, lo, hi, mode))


def lookback_slices(
    df: DataFrame, col: str, periods: Sequence[Period], days: int, closed: bool, mode: str = "date"
) -> Slices:
    """The rows dated in the `days` before the end of each period."""
    lo, hi = min(_day(p.end, -days) for p in periods), max(p.end for p in periods)
    dtype = df.schema[col].dataType
    tests = tuple((p.label, _within_days_before(dtype, col, p.end, days, closed, mode)) for p in periods)
    return Slices(tests, _within(dtype, col, lo, hi, mode))


def undated_slices(periods: Sequence[Period]) -> Slices:
    """All rows for every period."""
    return Slices(tuple((p.label, "TRUE") for p in periods), "TRUE")


def _labelled(df: DataFrame, slices: Slices) -> DataFrame:
    names = ", ".join(f"CASE WHEN {test} THEN {_text(label)} END" for label, test in slices.tests)
    return df.filter(slices.bounds).withColumn("period", F.expr(f"explode(array({names}))")).filter("period IS NOT NULL")


def assign_periods(df: DataFrame, col: str, periods: Sequence[Period], mode: str = "date") -> DataFrame:
    """One row per period that holds the row's date, in a single pass over the input.

    The outer bounds of all periods are tested first, so they reach the scan. A row in two
    overlapping periods appears twice.
    """
    return _labelled(df, period_slices(df, col, periods, mode))


def assign_lookbacks(
    df: DataFrame, col: str, periods: Sequence[Period], days: int, closed: bool, mode: str = "date"
) -> DataFrame:
    """As assign_periods, with each period replaced by the `days` before its end."""
    return _labelled(df, lookback_slices(df, col, periods, days, closed, mode))


def since_and_until(df: DataFrame, col: str, periods: Sequence[Period], days: int | None = None) -> DataFrame:
    """Rows up to the last period's end and, with `days`, from that many days before the first one's
    start; missing times are left out."""
    dtype = df.schema[col].dataType
    df = df.filter(f"`{col}` < {_bound(dtype, _day(max(p.end for p in periods), 1))}")
    if days is not None:
        df = df.filter(f"`{col}` >= {_bound(dtype, _day(min(p.start for p in periods), -days))}")
    return df


def span_of(periods: Sequence[Period], days: int = 0) -> tuple[str, str]:
    """The first and the last day of all periods and of the `days` before their starts and ends."""
    return _day(min(p.start for p in periods), -days), max(p.end for p in periods)


def assign_period_table(df: DataFrame, col: str, periods: DataFrame) -> DataFrame:
    """Membership when the periods are a table (period, start_date, end_date) of any length.

    Each period is spread into its days, which turns the range test into an equi-join on the
    day; Spark picks broadcast or shuffle from the measured size of the calendar. The first and
    the last day are scalar subqueries in the column's own type, so they reach the file scan.
    """
    dtype = df.schema[col].dataType
    ends = periods.agg(F.min("start_date").alias("lo"), F.date_add(F.max("end_date"), 1).alias("hi"))
    lo, hi = (ends.select(F.col(c).cast(dtype)).scalar() for c in ("lo", "hi"))
    df = df.filter((F.col(col) >= lo) & (F.col(col) < hi))
    days = periods.select("period", F.explode(F.sequence("start_date", "end_date")).alias("_day"))
    return df.join(days, F.to_date(df[col]) == days["_day"]).drop("_day")


def period_frame(spark: SparkSession, periods: Sequence[Period]) -> DataFrame:
    """The periods as a table."""
    rows = ", ".join(f"({_text(p.label)}, DATE '{p.start}', DATE '{p.end}')" for p in periods)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(period, start_date, end_date)")


def beside(left: DataFrame, *summaries: DataFrame) -> DataFrame:
    """Summaries put next to each other by period.

    Each is grouped by period, so what is broadcast has at most one row per period.
    """
    for summary in summaries:
        left = left.join(F.broadcast(summary), "period", "left")
    return left


def complete(summary: DataFrame, periods: Sequence[Period], counts: Sequence[str]) -> DataFrame:
    """One row for every period; counts of a period without input are 0, other values null."""
    frame = period_frame(summary.sparkSession, periods).select("period")
    return beside(frame, summary).fillna(0, subset=list(counts))
