"""The split windows against direct loops, on rows with hot keys, ties, nulls and slot edges."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgauge.functions.clock import HOUR_US, MINUTE_US
from opsgauge.operators import windows

START = datetime(2025, 3, 1)
SCHEMA = "id int, k string, c string, t timestamp, num bigint"


def make(seed, n=160, span_minutes=600, hot=0.5):
    """Half of the rows share one key; some keys, codes and times are null; many times tie."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        minute = rng.choice([rng.randrange(span_minutes), rng.randrange(0, span_minutes, 10)])
        t = None if rng.random() < 0.03 else START + timedelta(minutes=minute)
        out.append((i, key, rng.choice(["x", "y", None]), t, rng.randrange(60)))
    return out


def want_latest(rows, gap):
    marks = {}
    for i, k, _, t, num in rows:
        peers = [r[4] for r in rows if k and t and r[1] == k and r[3] and t - gap < r[3] <= t]
        marks[i] = int(bool(peers) and num == max(peers))
    return marks


def want_ahead(rows, marks, horizon, by_code):
    return {
        i: sum(
            marks[r[0]]
            for r in rows
            if k and t and r[1] == k and r[3] and t <= r[3] <= t + horizon and (not by_code or r[2] == c)
        )
        for i, k, c, t, _ in rows
    }


@pytest.mark.parametrize("seed", range(4))
def test_burst_dedupe(spark, seed):
    data = make(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = windows.burst_dedupe(df, ["k"], "t", "num", 10 * MINUTE_US, "mark")
    assert got.columns == [*df.columns, "mark"]
    assert {r.id: r.mark for r in got.collect()} == want_latest(data, timedelta(minutes=10))


def test_burst_dedupe_keeps_rows_whole(spark, rows):
    df = spark.createDataFrame(make(9), SCHEMA)
    got = windows.burst_dedupe(df, ["k"], "t", "num", 10 * MINUTE_US).drop("is_latest")
    assert rows(got) == rows(df)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("horizon", "slot"), [(60, 60), (120, 30), (200, 10), (900, 60)])
def test_forward_counts(spark, seed, horizon, slot):
    data = make(seed + 20)
    df = spark.createDataFrame(data, SCHEMA)
    marked = windows.burst_dedupe(df, ["k"], "t", "num", 10 * MINUTE_US, "mark")
    got = windows.forward_counts(
        marked, ["k"], "t", "mark", {"any": [], "same": ["c"]}, horizon * MINUTE_US, slot * MINUTE_US
    ).collect()
    marks = want_latest(data, timedelta(minutes=10))
    reach = timedelta(minutes=horizon)
    assert {r.id: r.any for r in got} == want_ahead(data, marks, reach, False)
    assert {r.id: r.same for r in got} == want_ahead(data, marks, reach, True)


def test_result_does_not_depend_on_the_slot(spark, rows):
    marked = spark.createDataFrame(make(5), SCHEMA).withColumn("mark", F.lit(1))

    def counted(slot):
        return rows(
            windows.forward_counts(marked, ["k"], "t", "mark", {"n": []}, 4 * HOUR_US, slot).select("id", "n")
        )

    assert counted(4 * HOUR_US) == counted(HOUR_US) == counted(5 * MINUTE_US)


def test_horizon_must_fit_the_slot(spark):
    df = spark.createDataFrame(make(1, n=2), SCHEMA).withColumn("mark", F.lit(1))
    with pytest.raises(ValueError):
        windows.forward_counts(df, ["k"], "t", "mark", {"n": []}, 90 * MINUTE_US, 60 * MINUTE_US)


def test_first_in_group(spark):
    data = make(31)
    df = spark.createDataFrame(data, SCHEMA)
    firsts = {}
    for _, k, _, t, _ in data:
        if k and t:
            firsts[k] = min(firsts.get(k, t), t)
    want = {i: int(bool(k and t) and t == firsts[k]) for i, k, _, t, _ in data}
    got = windows.first_in_group(df, ["k"], "t", slot_us=30 * MINUTE_US).collect()
    assert {r.id: r.first_flag for r in got} == want


def test_place_in_group_equals_row_number(spark, rows):
    data = make(32)
    df = spark.createDataFrame(data, SCHEMA).filter("k is not null")
    got = windows.place_in_group(df, ["k"], "t", ["id"], slot_us=30 * MINUTE_US).select("id", "place")
    want = df.selectExpr("id", "row_number() over (partition by k order by t, id) as place")
    assert rows(got) == rows(want)
    flags = windows.has_previous(spark.createDataFrame(data, SCHEMA), ["k"], "t", ["id"])
    assert flags.count() == len(data)
    assert flags.filter("k is null and has_previous = 1").count() == 0


def test_attach_any_takes_null_as_a_key(spark, rows):
    data = [("a", 1, "R"), ("a", 2, None), ("b", 3, None), (None, 4, "R"), (None, 5, "P")]
    df = spark.createDataFrame(data, "k string, n int, o string")
    got = windows.attach_any(df, ["k"], ["n"], hit=F.col("o") == "R").select("n", "hit")
    assert rows(got) == [(1, 1), (2, 1), (3, 0), (4, 1), (5, 1)]


def test_forward_counts_has_no_frame_that_costs_its_size(spark):
    df = spark.createDataFrame(make(5), SCHEMA).withColumn("mark", F.lit(1))
    got = windows.forward_counts(df, ["k"], "t", "mark", {"any": [], "same": ["c"]}, 720 * HOUR_US, HOUR_US)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    starts = re.findall(r"specifiedwindowframe\(\w+, ([^,]+),", text)
    assert starts and set(starts) == {"unboundedpreceding$()"}


def test_attach_any_deals_its_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS n", "id % 5 = 0 AS o")
    got = windows.attach_any(df, ["k"], ["n"], hit=F.col("o"))
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["string", "bigint", "date", "boolean"])
def test_attach_any_or_s_bits_and_keeps_null_apart(spark, rows, kind):
    plain = {"string": ("0", "1"), "bigint": ("0", "1"), "date": ("1970-01-01", "2024-01-01")}.get(kind, ("false", "true"))
    data = [(plain[0], 1, 1), (plain[0], 2, 6), (plain[1], 3, None), (None, 4, 8), (None, 5, 16)]
    df = spark.createDataFrame(data, "k string, n int, b bigint").withColumn("k", F.col("k").cast(kind))
    got = windows.attach_any(df, ["k"], ["n"], bits=True, b_any=F.col("b"))
    assert got.columns == ["k", "n", "b", "b_any"]
    assert [r[:2] for r in rows(got.select("n", "b_any"))] == [(1, 7), (2, 7), (3, 0), (4, 24), (5, 24)]
    assert rows(got.drop("b_any")) == rows(df)


@pytest.mark.parametrize("seed", range(2))
def test_slices_as_bits_equal_each_slice_alone(spark, seed):
    """Bursts and counts of three slices in one pass, slices of a row named by the bits of a number."""
    rng = random.Random(seed)
    data = [(*row, rng.randrange(8)) for row in make(seed + 60)]
    df = spark.createDataFrame(data, SCHEMA + ", inside bigint")
    marked = windows.burst_dedupe(df, ["k"], "t", "num", 10 * MINUTE_US, "mark", "inside", 3)
    asked = {"any": [], "same": ["c"]}
    got = windows.forward_counts(marked, ["k"], "t", "mark", asked, 60 * MINUTE_US, 10 * MINUTE_US, 3).collect()
    for n in range(3):
        rows = [row[:5] for row in data if row[5] >> n & 1]
        marks = want_latest(rows, timedelta(minutes=10))
        mine = [r for r in got if r.inside >> n & 1]
        assert {r.id: r.mark >> n & 1 for r in mine} == marks
        for name, by_code in (("any", False), ("same", True)):
            assert {r.id: r[name][n] for r in mine} == want_ahead(rows, marks, timedelta(minutes=60), by_code)
    assert all(r.mark >> n & 1 == 0 for r in got for n in range(3) if not r.inside >> n & 1)


def test_contacts_are_not_copied_for_periods(spark):
    """More periods than one row stands for: each gives what it gives alone, and rows are dealt without it."""
    from opsgauge.operators.periods import Period
    from opsgauge.plans import contacts

    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", None]), i, START + timedelta(minutes=rng.randrange(0, 60 * 24 * 60, 7)), rng.choice(["x", None]))
        for i in range(300)
    ]
    logs = spark.createDataFrame(rows, "installation_number string, comm_log_number bigint, creation_date timestamp, code_key_two string")
    logs = logs.withColumns({
        "creation_date_hour": F.col("creation_date"), "creation_id": F.lit("7"), "code_key_one": F.lit("o"), "code_key_three": F.lit("t"),
        "creation_source": F.lit(contacts.V.CONTACT_SOURCES[0]), "creation_media": F.lit(contacts.V.CONTACT_MEDIA[0]),
        "creation_direction": F.lit(contacts.V.CONTACT_DIRECTION), "country": F.lit(contacts.V.UK),
    })
    days = [START + timedelta(days=5 * n) for n in range(contacts.GROUP + 2)]
    periods = [Period(f"P{n}", d.strftime("%Y-%m-%d"), d.strftime("%Y-%m-%d")) for n, d in enumerate(days)]
    flags = lambda p: contacts.contact_flags(contacts.counted_contacts(logs, p), HOUR_US, 48 * HOUR_US)
    got = flags(periods)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(got) == sorted((r for p in periods for r in key(flags([p]))), key=repr) != []
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", got._jdf.queryExecution().executedPlan().toString())
    assert keys and not any("period" in k for k in keys)
