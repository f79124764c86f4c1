"""Distinct counts by bits against COUNT(DISTINCT), and the numbering below them."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from opsgauge.operators import bitmaps
from opsgauge.operators.periods import Period


def visits(spark, seed, days, values=3000):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *[f"v{rng.randrange(values)}"] * 30]), rng.choice([None, *[date(2025, 1, 1) + timedelta(days=rng.choice(days))] * 30]), rng.random() < 0.3, rng.choice("xy"))
        for _ in range(4000)
    ]
    return spark.createDataFrame(rows, "v string, d date, late boolean, area string")


def test_numbers_are_dense_and_stay(spark, tmp_path):
    first = visits(spark, 1, range(5))
    ids = bitmaps.numbered(first, "v", slots=7)
    ids.write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    n = first.select("v").dropna().distinct().count()
    assert sorted(r.id for r in ids.collect()) == list(range(1, n + 1)) and ids.select("v").distinct().count() == n
    more = bitmaps.extended(ids, visits(spark, 2, range(5), 6000), "v", slots=7)
    assert more.join(ids, ["v", "id"]).count() == n
    assert sorted(r.id for r in more.collect()) == list(range(1, more.count() + 1)) and more.select("v").distinct().count() == more.count() > n
    assert bitmaps.numbered(first.limit(0), "v").count() == 0
    assert bitmaps.extended(ids.limit(0), first, "v").count() == n


def test_days_merge_to_any_period(spark):
    rows = visits(spark, 3, range(40), 40_000)
    rows = rows.withColumn("id", F.substring("v", 2, 9).cast("long") * 7 + 1)
    marks = {"all": None, "late": F.col("late"), "none": F.lit(False)}
    days = bitmaps.day_partials(rows, "d", "id", ["area"], **marks)
    spans = [Period("Week", "2025-01-06", "2025-01-12"), Period("Month", "2025-01-01", "2025-01-31"), Period("Later", "2026-01-01", "2026-01-02")]
    got = {r["period"]: (r["all"], r["late"], r["none"]) for r in bitmaps.period_counts(days, spans, list(marks)).collect()}
    for p in spans:
        inside = rows.filter(F.col("d").between(date.fromisoformat(p.start), date.fromisoformat(p.end)))
        want = inside.agg(F.count_distinct("id"), F.count_distinct(F.when(F.col("late"), F.col("id")))).first()
        assert got[p.label] == (want[0], want[1], 0)
    # weeks first, then the whole, gives the same as days
    weeks = bitmaps.merged(days.withColumn("week", F.date_trunc("week", "day")), ["week", "area"])
    whole = bitmaps.counted(weeks, ["area"], ["all"]).collect()
    want = rows.dropna(subset=["d", "id"]).groupBy("area").agg(F.count_distinct("id").alias("n")).collect()
    assert {r["area"]: r["all"] for r in whole} == {r["area"]: r["n"] for r in want}


def test_sets_of_few_values_stay_small(spark):
    # ids far apart, so that hardly two of a day share a bucket of any size
    rows = spark.range(3000).select((F.col("id") * 1_000_003 - 7).alias("id"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d"))
    days = bitmaps.day_partials(rows, "d", "id", all=None, odd=F.col("id") % 2 != 0)
    stored = days.collect()
    size = sum(len(r["bits"]) if isinstance(r["bits"], (bytes, bytearray)) else 8 for r in stored)
    assert size <= 2 * 8 * 3000
    # longs are added up by hash; nothing is sorted for it
    assert "SortAggregate" not in days._jdf.queryExecution().executedPlan().toString()
    whole = bitmaps.counted(days.withColumn("one", F.lit(1)), ["one"], ["all", "odd"]).first()
    assert (whole["all"], whole["odd"]) == (3000, 1500)


def test_ids_at_the_edges_of_buckets(spark):
    ids = [-(2**63), -65, -64, -1, 0, 1, 63, 64, 65, 2**63 - 1, 64]
    rows = spark.createDataFrame([(i, date(2025, 1, 1)) for i in ids], "id long, d date")
    days = bitmaps.day_partials(rows, "d", "id", n=None)
    assert bitmaps.counted(days, ["day"], ["n"]).first()["n"] == len(set(ids))
