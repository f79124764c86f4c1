"""Cleaning, filters, joins and aggregates on hand-made rows with nulls, ties and padding."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from opsgauge.operators import aggregates, clean, joins, periods, predicates, sets
from opsgauge.operators.periods import Period
from opsgauge.sources import report_table, tables
from opsgauge.sources.schemas import SCHEMAS, conform, schema_of


@pytest.fixture
def abc(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("V", 4)], "c string, n int")


def kept(df):
    return sorted(r.n for r in df.collect())


def test_unknown_is_not_the_excluded_value(abc):
    assert kept(predicates.where_ne(abc, "c", "V")) == [1, 2, 3]
    assert kept(predicates.where_not_in(abc, "c", ["V", "a"])) == [2, 3]
    assert kept(predicates.where_prefix(abc, "c", ["V"], negate=True)) == [1, 2, 3]
    assert kept(predicates.where_contains_ci(abc, "c", "v", negate=True)) == [1, 2, 3]


def test_unknown_meets_no_test(abc):
    assert kept(predicates.where_eq(abc, "c", "V")) == [4]
    assert kept(predicates.where_in(abc, "c", ["V", "a"])) == [1, 4]
    assert kept(predicates.where_prefix(abc, "c", ["V", "b"])) == [2, 4]
    assert kept(predicates.where_null(abc, "c")) == [3]
    assert kept(predicates.where_not_null(abc, "c")) == [1, 2, 4]


def test_compound_exclusion(spark):
    rows = [("A", "B", "C", 1), ("A", "B", None, 2), (None, None, None, 3), ("A", "X", "C", 4)]
    df = spark.createDataFrame(rows, "x string, y string, z string, n int")
    out = predicates.exclude_when(df, F.col("x") == "A", F.col("y") == "B", F.col("z") == "C")
    assert kept(out) == [2, 3, 4]
    assert kept(predicates.drop_all_null(df, "x", "y", "z")) == [1, 2, 4]


def test_buckets_exclude_their_upper_bound(spark):
    hours = [23.99, 24.0, 47.99, 48.0, 71.0, 72.0, 167.99, 168.0, None]
    df = spark.createDataFrame([(h,) for h in hours], "h double")
    cuts = ((24, "24h"), (48, "48h"), (72, "72h"), (168, "7d"))
    got = [r[0] for r in df.select(predicates.bucketize(F.col("h"), cuts, "more")).collect()]
    assert got == ["24h", "48h", "48h", "72h", "72h", "7d", "7d", "more", "more"]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    got = [r[0] for r in df.select(predicates.map_default(F.col("c"), {"x": 0, "y": 30}, 90)).collect()]
    assert got == [0, 30, 90, 90]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` closing/finishing_date ` int, `total_(net)` int")
    assert clean.clean_headers(df).columns == ["closing/finishing_date", "total_(net)"]
    assert clean.clean_headers(df, plain=True).columns == ["closing_finishing_date", "total_net"]


def test_trim_all_leaves_other_types(spark):
    df = spark.createDataFrame([(" a\t", 1, date(2024, 1, 1))], "s string, n int, d date")
    out = clean.trim_all(df)
    assert out.first() == ("a", 1, date(2024, 1, 1))
    assert out.schema == df.schema


LAST = Period("P", "2025-12-01", "2025-12-14")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_last_day_of_a_period(spark, kind):
    times = [datetime(2025, 11, 30, 23), datetime(2025, 12, 1), datetime(2025, 12, 14), datetime(2025, 12, 14, 9),
             datetime(2025, 12, 15)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp").select(F.col("t").cast(kind).alias("t"))

    def days(mode):
        return df.filter(periods.in_period(df, "t", LAST.start, LAST.end, mode)).count()

    assert days("date") == 3
    assert days("instant") == 2


def test_lookback_bounds(spark):
    days = [date(2025, 11, d) for d in (13, 14, 15)] + [date(2025, 12, 14), date(2025, 12, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert df.filter(periods.in_lookback(df, "d", "2025-12-14", 30, closed=True)).count() == 3
    assert df.filter(periods.in_lookback(df, "d", "2025-12-14", 30, closed=False)).count() == 2


def test_all_periods_in_one_pass_equal_each_alone(spark, sf_dir, rows):
    spans = [Period("a", "1996-01-01", "1997-06-30"), Period("b", "1997-01-01", "1997-12-31"),
             Period("c", "1999-05-05", "1999-05-05")]
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    together = periods.assign_periods(orders, "o_orderdate", spans)
    apart = sets.union_by_name(*[periods.assign_periods(orders, "o_orderdate", [s]) for s in spans])
    table = periods.assign_period_table(orders, "o_orderdate", periods.period_frame(spark, spans))
    assert rows(together) == rows(apart) == rows(table)


def test_complete_adds_empty_periods(spark):
    out = periods.complete(
        spark.createDataFrame([("a", 3, 1.5)], "period string, n bigint, x double"),
        [Period("a", "2025-01-01", "2025-01-02"), Period("b", "2025-01-03", "2025-01-04")],
        ["n"],
    )
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 1.5), ("b", 0, None)]


def test_period_must_not_be_reversed():
    with pytest.raises(ValueError):
        Period("x", "2025-01-02", "2025-01-01")


def test_groups_with_null_keys_are_left_out(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 4), ("a", "x", 8)], "k string, l string, n int")
    assert rows(aggregates.sum_by(df, ["k", "l"], ["n"])) == [("a", "x", 9)]
    assert rows(aggregates.repeat_groups(df, ["k", "l"], 2)) == [("a", "x", 2, 1)]


def test_distinct_counts_equal_conditional_count_distinct(spark, sf_dir, rows):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn(
        "k", F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey"))
    )
    late = F.col("l_shipdate") > F.lit("1998-01-01").cast("date")
    got = aggregates.distinct_counts(items, "k", ["l_returnflag"], keys=None, late=late, none=F.lit(None).cast("boolean"))
    want = items.groupBy("l_returnflag").agg(
        F.count_distinct("k").alias("keys"), F.count_distinct(F.when(late, F.col("k"))).alias("late"), F.lit(0)
    )
    assert rows(got) == rows(want)


def test_distinct_counts_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "k string, n int")
    assert tuple(aggregates.distinct_counts(df, "k", (), keys=None, some=F.col("n") == 1).first()) == (0, 0)


def test_dedupe_keeps_one_row_of_a_null_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4)], "k string, n int")
    assert rows(aggregates.dedupe_first(df, "k", [F.col("n")])) == [("a", 1), (None, 4)]


def test_mean_of_max(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", None), ("c", 2.0), (None, 9.0)], "k string, v double")
    assert aggregates.mean_of_max(df, "k", "v").first()[0] == 3.5


def test_duplicate_dimension_keys_repeat_or_not(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(joins.matched_only(fact, dim, "k", "id")) == [("a", 1), ("a", 1)]
    assert rows(joins.matched_only(fact, dim, "k", "id", keep_duplicates=False)) == [("a", 1)]
    assert rows(joins.match_flag(fact, dim, "k", "id")) == [("a", 1, 1), ("b", 2, 0), (None, 3, 0)]
    assert joins.enrich(fact, dim, "k", "id").count() == 4
    assert joins.enrich(fact, dim, "k", "id", null_safe=True).filter("n = 3 and k <=> id").count() == 1


def test_suffix_for_taken_names(spark):
    a = spark.createDataFrame([("x", 1)], "id string, n int")
    b = spark.createDataFrame([("x", 2, 3)], "id string, n int, m int")
    out = joins.left_join_suffix(a, b, "id", "id", "_r")
    assert out.columns == ["id", "n", "id_r", "n_r", "m"]
    assert tuple(out.first()) == ("x", 1, "x", 2, 3)


def test_latest_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), (None, 9, 5)], "k string, o int, n int")
    assert rows(joins.latest_per_key(df, "k", "o")) == [("a", 2, 2), ("a", 2, 3)]


def test_union_by_position_takes_the_first_headers(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2, "y")], "other int, header string")
    assert sets.union_by_position(a, b).columns == ["n", "s"]
    assert rows(sets.union_by_position(a, b)) == [(1, "x"), (2, "y")]


def test_lookback_scan_bounds(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 2),)], "d date")
    source = {"t": df}.__getitem__
    assert tables.read_since(source, "t", "d", "2025-02-10", 40).count() == 2
    assert tables.read_since(source, "t", "d", "2025-02-10", 40, strict=True).count() == 1


def test_latest_snapshot(spark, rows):
    df = spark.createDataFrame([(1, datetime(2025, 1, 1)), (2, datetime(2025, 1, 2)), (3, None)], "n int, t timestamp")
    assert kept(tables.latest_snapshot(df, "t")) == [2]


def test_inputs_are_brought_to_their_schema(spark):
    raw = spark.createDataFrame(
        [("i", datetime(2025, 1, 1), "q", "Completed", None, "0871", 5, "extra")],
        "interaction_id string, start_timestamp timestamp, ` last_vqueue` string, technical_result string, "
        "technical_result_reason string, `from` string, routing_point_time int, more string",
    )
    out = conform(raw, "care_calls")
    assert out.columns == schema_of("care_calls").fieldNames()
    assert dict(out.dtypes)["routing_point_time"] == "bigint"
    with pytest.raises(ValueError, match="lacks"):
        conform(raw.drop("from"), "care_calls")


def test_every_schema_parses():
    assert all(len(schema_of(name)) > 0 for name in SCHEMAS)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_keeps_other_periods(spark, tmp_path, fmt, rows):
    path = str(tmp_path / "report")
    schema = "row int, kpi_id string, area string, region string, value double, unit string, period string"
    week = spark.createDataFrame([(1, "k", "a", "UK", 1.0, "count", "Week")], schema)
    month = spark.createDataFrame([(1, "k", "a", "UK", 2.0, "count", "Month"), (2, "l", "a", "UK", None, "pct", "Month")], schema)
    report_table.write_report(week.unionByName(month), path, fmt)
    report_table.write_report(week.withColumn("value", F.lit(5.0)), path, fmt)
    got = report_table.read_report(spark, path, fmt).select(*week.columns)
    assert rows(got) == rows(week.withColumn("value", F.lit(5.0)).unionByName(month))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_as_of_each_run(spark, tmp_path, fmt):
    """A repeated run can be undone, and a failed one leaves nothing."""
    path = str(tmp_path / "report")
    schema = "row int, kpi_id string, area string, region string, value double, unit string, period string"
    kpis = lambda value, *periods: spark.createDataFrame([(1, "k", "a", "UK", value, "count", p) for p in periods], schema)
    assert report_table.last_run(spark, path, fmt) == 0
    assert report_table.write_report(kpis(1.0, "Week", "Month"), path, fmt) == 1
    assert report_table.write_report(kpis(2.0, "Week"), path, fmt) == 2
    with pytest.raises(Exception, match="boom"):
        report_table.write_report(kpis(9.0, "Month").withColumn("value", F.raise_error(F.lit("boom")).cast("double")), path, fmt)
    assert report_table.write_report(kpis(3.0, "Week"), path, fmt) == 3
    values = lambda until: {r.period: r.value for r in report_table.read_report(spark, path, fmt, until).collect()}
    assert [values(n) for n in (1, 2, 3, None)] == [{"Week": 1.0, "Month": 1.0}, {"Week": 2.0, "Month": 1.0}] + [{"Week": 3.0, "Month": 1.0}] * 2
    with pytest.raises(ValueError, match="3 is the newest"):
        report_table.write_report(kpis(4.0, "Week"), path, fmt, run=2)


def test_ratio_of_the_first_year(spark):
    from opsgauge.plans import calls

    columns = "report_date date, report_year int, report_month int, calls_queue string, " + ", ".join(
        f"{m} bigint" for m in calls.MEASURES
    )
    data = [
        (date(2024, 12, 30), 2024, 12, "q", 10, 8, 4, 1, 2),
        (date(2025, 1, 2), 2025, 1, "q", 10, 2, 2, 1, 0),
        (date(2025, 1, 2), 2025, 1, "hidden", 99, 99, 99, 99, 99),
        (date(2025, 1, 2), None, 1, "q", 99, 99, 99, 99, 99),
        (date(2025, 1, 3), 2025, 1, "twice", 4, 4, 1, 0, 0),
    ]
    facts = spark.createDataFrame(data, columns)
    queues = spark.createDataFrame(
        [("q", "s", "d", "v", "m"), ("hidden", "s", "d", "v", None), ("twice", "s", "d", "v", "m"),
         ("twice", "s", "d2", "v", "m")],
        "queues string, skills string, departments string, media_type string, manager string",
    )
    span = [Period("P", "2024-12-29", "2025-01-04")]
    whole = calls.queue_sla(facts, queues, span, ["q", "hidden"]).first()
    first = calls.queue_sla(facts, queues, span, ["q", "hidden"], year_rule="first").first()
    assert tuple(whole) == ("P", 10, 60.0, 20.0, 10.0)
    assert tuple(first) == ("P", 10, 50.0, 25.0, 10.0)
    assert tuple(calls.queue_sla(facts, queues, span, ["twice"], "first").first()) == ("P", 8, 25.0, 0.0, 0.0)
    assert tuple(calls.department_sla(facts, queues, span, "d", "q").first()) == ("P", 4, 25.0, 0.0, 0.0)
