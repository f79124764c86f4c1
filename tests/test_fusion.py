"""Fused measures against one aggregate for each, and what their plans read."""

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.measures import DEPLOYMENT
from opsgauge.operators.aggregates import distinct_counts, mean_of_max
from opsgauge.operators.fusion import Ask, fused
from opsgauge.operators.periods import (
    Period,
    assign_lookbacks,
    assign_periods,
    complete,
    lookback_slices,
    period_slices,
    undated_slices,
)
from opsgauge.plans import report
from opsgauge.sources.schemas import SCHEMAS, schema_of
from opsgauge.sources.tables import parquet_source

FIRST = date(2025, 1, 1)
PERIODS = [
    Period("Week", "2025-01-06", "2025-01-12"), Period("Month", "2025-01-01", "2025-01-31"),
    Period("It's", "2025-01-10", "2025-02-20"), Period("Empty", "2030-01-01", "2030-01-02"),
]


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(3)
    some = lambda values: rng.choice([None, *values])
    rows = [
        (some("abcdefghij"), some([FIRST + timedelta(days=rng.randrange(70))] * 9), some([True, False]), some(range(50)))
        for _ in range(800)
    ]
    return spark.createDataFrame(rows, "k string, d date, open boolean, v long").repartition(5)


def by_period(df):
    return {r["period"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("copies", [1, 20])
def test_equals_single_aggregates(visits, copies):
    """Also where the marks need more than one number."""
    dated, back = period_slices(visits, "d", PERIODS), lookback_slices(visits, "d", PERIODS, 9, closed=False)
    asks = [
        Ask(dated, distinct={"keys": None, "open_keys": F.col("open")}, counts={"rows": None, "big": F.col("v") > 20}),
        Ask(back, F.col("open"), distinct={"recent": F.col("v") < 40}, totals={"sum": F.col("v")}),
        Ask(undated_slices(PERIODS), peaks={"peak": F.col("v")}, counts={"all": F.col("d").isNotNull()}),
        *[Ask(dated, distinct={f"more{n}": F.col("v") == n}) for n in range(copies)],
    ]
    got = by_period(fused(visits, "k", asks))
    in_period, recent = assign_periods(visits, "d", PERIODS), assign_lookbacks(visits, "d", PERIODS, 9, closed=False)
    marks = {f"more{n}": F.col("v") == n for n in range(copies)}
    one = distinct_counts(in_period, "k", ["period"], keys=None, open_keys=F.col("open"), **marks)
    one = by_period(complete(one, PERIODS, ["keys", "open_keys", *marks]))
    two = in_period.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v") > 20).alias("big"))
    two = by_period(complete(two, PERIODS, ["rows", "big"]))
    three = recent.filter("open")
    sums = by_period(complete(three.groupBy("period").agg(F.sum("v").alias("sum")), PERIODS, []))
    keys = by_period(complete(distinct_counts(three, "k", ["period"], recent=F.col("v") < 40), PERIODS, ["recent"]))
    peak = mean_of_max(visits, "k", "v").first()["mean"]
    whole = visits.filter("d IS NOT NULL").count()
    for label in (p.label for p in PERIODS):
        want = {**one[label], **two[label], **sums[label], **keys[label], "peak": peak, "all": whole}
        assert got[label] == want


def test_without_key_and_without_rows(visits):
    dated = period_slices(visits, "d", PERIODS)
    got = by_period(fused(visits, None, [Ask(dated, counts={"n": None}, totals={"s": F.col("v")})]))
    assert got["Empty"] == {"period": "Empty", "n": 0, "s": None} and got["Week"]["n"] > 0
    none = by_period(fused(visits.limit(0), "k", [Ask(dated, distinct={"n": None}, peaks={"p": F.col("v")})]))
    assert all(none[p.label] == {"period": p.label, "n": 0, "p": None} for p in PERIODS)


def test_what_cannot_be_fused(visits):
    dated = period_slices(visits, "d", PERIODS)
    with pytest.raises(ValueError, match="same periods"):
        fused(visits, "k", [Ask(dated, distinct={"n": None}), Ask(period_slices(visits, "d", PERIODS[:1]), distinct={"m": None})])
    with pytest.raises(ValueError, match="two measures ask for n"):
        fused(visits, "k", [Ask(dated, distinct={"n": None}), Ask(dated, counts={"n": None})])
    with pytest.raises(ValueError, match="need a key"):
        fused(visits, None, [Ask(dated, distinct={"n": None})])


def test_a_key_sends_one_row(visits):
    text = fused(visits, "k", [Ask(period_slices(visits, "d", PERIODS), distinct={"n": None})])._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in text and "Expand" not in text
    assert len(re.findall(r"hashpartitioning", text)) == 1


def test_report_reads_each_shared_input_once(spark, tmp_path):
    """As many scans of an input as its measures have grains."""
    for name in SCHEMAS:
        spark.createDataFrame([], schema_of(name)).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    week = [Period("Week", "2025-12-08", "2025-12-14"), Period("Month", "2025-12-01", "2025-12-14")]
    kpis = report.report(report.report_parts(parquet_source(spark, str(tmp_path)), week, DEPLOYMENT, "2025-12-15"))
    text = kpis._jdf.queryExecution().executedPlan().toString()
    scans = Counter(re.findall(r"Location: InMemoryFileIndex\(1 paths\)\[[^\]]*?(\w+)\.parquet\]", text))
    shared = {"tickets_open": 1, "services_closed": 2, "selfservice_finalised": 1, "alarm_incidences": 1, "accessory_services": 1}
    assert {n: scans[n] for n in shared} == shared
    assert len(kpis.collect()) == 2 * len(report.CATALOGUE)
