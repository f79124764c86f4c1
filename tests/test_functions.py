from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from opsgauge.fixed_values import HOLIDAYS_WITH_NEXT_YEAR
from opsgauge.functions import bizdays, clock, ratio, text


def values(spark, pairs, schema, *columns):
    out = spark.createDataFrame(pairs, schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    return [tuple(r) for r in out.collect()]


def test_strip_removes_all_white_space_at_both_ends(spark):
    raw = [" a b\t", "\n\r\x0bx\x0c", " wide　", "\xa0hard\x85", "", "  ", None, "\x1cfile\x1f"]
    got = values(spark, [(r,) for r in raw], "s string", text.strip(F.col("s")))
    assert [g[0] for g in got] == [None if r is None else r.strip() for r in raw]


def test_prefix_and_substring(spark):
    rows = [("080x",), ("08",), ("7",), (None,), ("Customer SERVICE",)]
    got = values(
        spark, rows, "s string", text.starts_with(F.col("s"), "08", "7"), text.contains_ci(F.col("s"), "Service")
    )
    assert got == [(True, False), (True, False), (True, False), (None, False), (False, True)]


def test_codes_that_went_through_floats(spark):
    rows = [("230020.0",), (" 270009",), (None,), ("n/a",), ("9007199254740993",)]
    got = values(spark, rows, "s string", text.to_int(F.col("s")), text.line_code(F.col("s")))
    assert got == [
        (230020, "230020"),
        (270009, "270009"),
        (0, "0"),
        (None, None),
        (9007199254740993, "9007199254740993"),
    ]


def test_replace_literal_takes_every_occurrence(spark):
    assert values(spark, [("1.0.05",)], "s string", text.replace_literal(F.col("s"), ".0")) == [("15",)]


def test_percent_text(spark):
    got = values(spark, [(12.345,), (100.0,), (0.0,), (None,)], "x double", text.as_percent_text(F.col("x")))
    assert [g[0] for g in got] == ["12.34%", "100.0%", "0.0%", None]


def test_parse_timestamp_layouts(spark):
    got = values(
        spark,
        [("2025-Dec-08 03:04:05", "08/12/2025 03:04:05", "bad")],
        "a string, b string, c string",
        clock.parse_ts(F.col("a"), clock.MONTH_NAME_12H, strict=True),
        clock.parse_ts(F.col("b"), clock.DAY_FIRST_12H),
        clock.parse_ts(F.col("c")),
    )
    assert got == [(datetime(2025, 12, 8, 3, 4, 5), datetime(2025, 12, 8, 3, 4, 5), None)]


def test_strict_parse_raises(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|PARSE"):
        values(spark, [("bad",)], "s string", clock.parse_ts(F.col("s"), strict=True))


def test_days_round_down_and_hours_to_two_places(spark):
    start = datetime(2025, 1, 10, 12)
    rows = [(start, start + timedelta(hours=h)) for h in (-12, 0, 12, 24, 36.005)] + [(start, None)]
    got = values(
        spark,
        rows,
        "a timestamp, b timestamp",
        clock.days_floor(F.col("a"), F.col("b")),
        clock.hours_between(F.col("a"), F.col("b")),
    )
    assert got[:5] == [(-1, -12.0), (0, 0.0), (0, 12.0), (1, 24.0), (1, float(np.round(129618 / 3600, 2)))]
    assert got[5] == (None, None)


def test_week_of_year_and_monday(spark):
    days = [date(2025, 12, 14), date(2025, 1, 1), date(2024, 12, 31), date(2023, 1, 1)]
    got = values(spark, [(d,) for d in days], "d date", clock.week_u(F.col("d")), clock.monday_of(F.col("d")))
    assert got == [(int(d.strftime("%U")), d - timedelta(days=d.weekday())) for d in days]


def test_shifts(spark):
    got = values(
        spark,
        [(datetime(2025, 3, 1, 0, 5), date(2025, 3, 1))],
        "t timestamp, d date",
        clock.shift_time(F.col("t"), -10, "mins"),
        clock.shift_time(F.col("t"), 30, "days"),
        clock.shift_time(F.col("d"), -30, "date"),
    )
    assert got == [(datetime(2025, 2, 28, 23, 55), datetime(2025, 3, 31, 0, 5), date(2025, 1, 30))]


def test_business_days_equal_the_calendar(spark):
    first = date(2024, 1, 1)
    days = [first + timedelta(days=n) for n in range(0, 760, 3)]
    pairs = [(a, days[(i * 7) % len(days)]) for i, a in enumerate(days)]
    pairs += [(a, a + timedelta(days=n)) for a in days[::5] for n in range(-9, 10)]
    expression = bizdays.business_days(F.col("a"), F.col("b"), HOLIDAYS_WITH_NEXT_YEAR)
    got = [g[0] for g in values(spark, pairs, "a date, b date", expression)]
    want = np.busday_count([p[0] for p in pairs], [p[1] for p in pairs], holidays=list(HOLIDAYS_WITH_NEXT_YEAR))
    assert got == want.tolist()


def test_business_days_of_unknown_dates(spark):
    rows = [(None, date(2025, 1, 1)), (date(2025, 1, 1), None)]
    got = values(spark, rows, "a date, b date", bizdays.business_days(F.col("a"), F.col("b")))
    assert got == [(None,), (None,)]


def test_toward_zero_and_clip(spark):
    got = values(
        spark,
        [(5,), (0,), (-3,), (None,)],
        "x bigint",
        bizdays.toward_zero(F.col("x")),
        bizdays.clip_low(F.col("x")),
    )
    assert got == [(4, 5), (0, 0), (-2, 0), (None, None)]


def test_percentages_and_their_zero_rules(spark):
    got = values(
        spark,
        [(1, 3), (1, 0), (0, 0), (None, 4), (1, 800), (3, 800)],
        "a bigint, b bigint",
        ratio.pct(F.col("a"), F.col("b")),
        ratio.pct(F.col("a"), F.col("b"), zero=0),
        ratio.pct(F.col("a"), F.col("b"), places=None),
    )
    assert got[0] == (33.33, 33.33, 1 / 3 * 100)
    assert got[1] == got[2] == (None, 0.0, None)
    assert got[3][:2] == (None, 0.0)
    assert [g[0] for g in got[4:]] == [0.12, 0.38]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 5000)), min_size=200, max_size=400))
def test_rounding_is_that_of_arrays(spark, pairs):
    got = [g[0] for g in values(spark, pairs, "a bigint, b bigint", ratio.pct(F.col("a"), F.col("b")))]
    want = np.round(np.array([a / b * 100 for a, b in pairs]), 2)
    assert got == want.tolist()


def test_exact_rounding_equals_python(spark):
    from opsgauge.functions.ratio import round_exact

    pairs = [(a, b) for b in (160, 800, 4000) for a in range(1, b + 1)] + [(a, 20000) for a in range(1, 20000, 7)]
    df = spark.createDataFrame([(a / b * 100,) for a, b in pairs], "x double")
    got = [r["y"] for r in df.select(round_exact(F.col("x")).alias("y")).collect()]
    assert got == [round(a / b * 100, 2) for a, b in pairs]
    assert got != [float(np.round(a / b * 100, 2)) for a, b in pairs]
