"""Texts in place of times, calendars that end, and database options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsgauge.functions.bizdays import business_days
from opsgauge.operators.periods import Period, assign_period_table, since_and_until
from opsgauge.operators.sets import hconcat
from opsgauge.plans import alarm, care, contacts, digital, onboarding
from opsgauge.sources.schemas import conform, lost_values, schema_of
from opsgauge.sources.tables import jdbc_options

WEEK = [Period("Week", "2025-12-08", "2025-12-14")]


def callouts(spark, *stamps):
    rows = [(str(k), s, True, 100.0) for k, s in enumerate(stamps)]
    return spark.createDataFrame(rows, "callout_id string, callout_created_at string, responder_dispatch_completed boolean, avg_true_resp_time double")


def test_day_first_texts_of_several_layouts(spark):
    raw = callouts(spark, "10/12/2025 11:30:00", "10/12/2025 11:30", "12/10/2025 11:30", "10/12/2025", "soon", None, "2025-12-11 01:02:03")
    out = alarm.guard_callouts(conform(raw, "guard_callouts"), WEEK).first()
    assert (out["guard_callouts"], out["under_40_min_pct"]) == (4, 100.0)
    assert [tuple(r) for r in lost_values(raw, "guard_callouts").collect()] == [("guard_callouts", "callout_created_at", 1)]


def test_layouts_of_the_caller_come_first(spark):
    raw = callouts(spark, "12.10.2025")
    layouts = {"guard_callouts.callout_created_at": ("MM.dd.yyyy",)}
    assert conform(raw, "guard_callouts", layouts).first()["callout_created_at"] == dt.datetime(2025, 12, 10)


def messages(spark, stamp):
    row = ("1", stamp, 5, "q", 1)
    return spark.createDataFrame([row], "ixn_id string, ini_resource_time string, mediation_time long, `queue/workbin` string, `queue/workbin_duration` long")


def test_messages_are_stamped_with_month_names(spark):
    got = conform(messages(spark, "2025-Dec-08 03:04:05"), "messages").first()
    assert got["ini_resource_time"] == dt.datetime(2025, 12, 8, 3, 4, 5)


def test_unreadable_times_are_an_error_unless_declared(spark):
    with pytest.raises(Exception, match="not a time: someday"):
        conform(messages(spark, "someday"), "messages").collect()
    assert lost_values(messages(spark, "someday"), "messages").count() == 0


def test_one_bad_date_does_not_stop_field_retention(spark):
    raw = spark.createDataFrame(
        [("a", "1", "2025-12-09 10:00:00"), ("b", "2", "2025-13-40")], "code_maintenance_ibs string, installation_number string, closing_finishing_date string"
    ).withColumns({c: F.lit("x") for c in ("status_maintenance", "technician_identifier", "customer_retained", "reti")})
    got = conform(raw, "field_retention").orderBy("code_maintenance_ibs").collect()
    assert [r["closing_finishing_date"] for r in got] == [dt.datetime(2025, 12, 9, 10), None]


def test_spans_beyond_the_calendar_are_an_error(spark):
    days = spark.createDataFrame([(dt.date(2025, 12, 22), dt.date(2026, 1, 5))], "a date, b date")
    count = lambda holidays: days.select(business_days(F.col("a"), F.col("b"), holidays, strict=True).alias("n")).first()["n"]
    assert count(["2025-12-25", "2025-12-26", "2026-01-01"]) == 7
    with pytest.raises(Exception, match="cover 2025 to 2025 only"):
        count(["2025-12-25", "2025-12-26"])
    with pytest.raises(ValueError, match="covers no year"):
        count([])


def test_calendars_have_no_default(spark):
    for plan in (care.cancellation_response, care.backlog_age, onboarding.onboarding_speed):
        with pytest.raises(TypeError):
            plan(spark.range(1), spark.range(1), WEEK) if plan is care.cancellation_response else plan(spark.range(1), WEEK)


def test_only_the_years_of_counted_spans_need_holidays(spark):
    schema = "installation_number string, installation_date timestamp, min_comp_attempt_date timestamp"
    rows = [("1", dt.datetime(2025, 12, 8), dt.datetime(2025, 12, 10)), ("2", dt.datetime(2019, 1, 1), dt.datetime(2019, 1, 9))]
    out = onboarding.onboarding_speed(spark.createDataFrame(rows, schema), WEEK, ["2025-12-25"]).first()
    assert out["installations"] == 1 and out["beyond_calendar"] == 0


def test_spans_beyond_the_calendar_make_their_measure_null(spark):
    """One odd date hides the figure that it would falsify, and is counted."""
    schema = "installation_number string, installation_date timestamp, min_comp_attempt_date timestamp"
    rows = [("1", dt.datetime(2025, 12, 8), dt.datetime(2025, 12, 10)), ("2", dt.datetime(1990, 1, 1), dt.datetime(2025, 12, 10))]
    out = onboarding.onboarding_speed(spark.createDataFrame(rows, schema), WEEK, ["2025-12-25"]).first().asDict()
    assert out == {"period": WEEK[0].label, "installations": None, "under_5_days_pct": None, "beyond_calendar": 1}
    tickets = [("a", dt.date(1990, 1, 1), None, "CANC", "UK"), ("b", dt.date(2025, 12, 9), None, "CANC", "UK")]
    opened = spark.createDataFrame(tickets, schema_of("tickets_open"))
    aged = care.backlog_age(opened, WEEK, "2025-12-15", ["2025-12-25"]).first()
    assert (aged["mean_age"], aged["beyond_calendar"]) == (None, 1)
    assert care.backlog_age(opened.filter("ticker_number = 'b'"), WEEK, "2025-12-15", ["2025-12-25"]).first()["mean_age"] == 4.0
    closed = spark.createDataFrame(
        [("a", dt.datetime(2025, 12, 9), None, dt.datetime(2031, 1, 1), "e", "CLOSED", "v", "r", "CANC", "UK")], schema_of("tickets_closed")
    )
    answer = care.cancellation_response(opened, closed, WEEK, ["2025-12-25"]).first()
    assert (answer["opened"], answer["closed"], answer["response_pct"], answer["beyond_calendar"]) == (1, None, None, 1)


def test_database_tables_need_their_partitioning():
    parts = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError, match="table calls would be read by one task"):
        jdbc_options("calls", {"url": "u"}, {}, ())
    with pytest.raises(ValueError, match="give numPartitions"):
        jdbc_options("calls", {"url": "u"}, {"calls": {k: v for k, v in parts.items() if k != "numPartitions"}}, ())
    assert jdbc_options("calls", {"url": "u"}, {"calls": parts}, ()) == {"url": "u", "dbtable": "calls", **parts}
    assert jdbc_options("queues", {"url": "u"}, {}, ("queues",)) == {"url": "u", "dbtable": "queues"}


def test_side_by_side_needs_single_rows(spark):
    one = spark.range(1).select(F.lit(1).alias("a"))
    assert hconcat(one, spark.range(1).select(F.lit(2).alias("b"))).collect() == [(1, 2)]
    with pytest.raises(Exception, match="(?i)more than one row"):
        hconcat(one, spark.range(2).select(F.col("id").alias("b"))).collect()


def stored(spark, tmp_path, df, name):
    df.write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().toString()


def test_period_table_bounds_reach_the_scan(spark, tmp_path):
    facts = stored(spark, tmp_path, spark.range(100).selectExpr("id", "timestamp'2025-12-01' + make_dt_interval(cast(id as int)) as at"), "facts")
    periods = spark.sql("SELECT 'Week' AS period, DATE '2025-12-08' AS start_date, DATE '2025-12-14' AS end_date")
    out = assign_period_table(facts, "at", periods)
    assert out.count() == 7
    # the bounds are scalar subqueries on the column itself
    text = plan_of(out)
    assert "(at#" in text and text.count("scalar-subquery") >= 2


def test_messages_are_bounded_and_matched_before_first_sessions(spark, tmp_path):
    rows = [("1", "2025-12-01 00:00:00"), ("1", "2025-12-09 00:00:00"), ("2", "2025-12-09 00:00:00"), ("3", "2025-12-30 00:00:00")]
    df = spark.createDataFrame(rows, "ixn_id string, t string").selectExpr(
        "ixn_id", "timestamp(t) AS ini_resource_time", "5L AS mediation_time", "'q' AS queue_workbin", "1L AS queue_workbin_duration"
    )
    table = stored(spark, tmp_path, df, "messages")
    whole = digital.message_sla(table, WEEK, ["q"], ["q"])
    assert whole.first()["within_180_pct"] == 50.0
    assert digital.message_sla(table, WEEK, ["q"], ["q"], lookback_days=2).first()["within_180_pct"] == 100.0
    text = plan_of(whole)
    scans = [line for line in text.split("== Physical")[-1].split("\n") if "PushedFilters" in line]
    assert scans and all("LessThan(ini_resource_time,2025-12-15" in line for line in scans)
    assert "LeftSemi" in text
    assert since_and_until(table, "ini_resource_time", WEEK, 7).count() == 3


def test_the_roster_meets_sums_of_contacts(spark):
    flags = spark.createDataFrame(
        [("Week", "1", "a", 1, 1), ("Week", "1", "a", 2, 1), ("Week", "1", "b", 1, 4), ("Week", "2", None, 1, 1)],
        "period string, installation_number string, creation_id string, same_reason_ahead long, contacts_ahead long",
    )
    roster = spark.createDataFrame([("a",), ("a",), (None,)], "employee_id string")
    out = contacts.contact_quality(flags, WEEK, roster).first()
    assert (out["fcr_pct"], out["repeat_pct"]) == (66.67, 50.0)
    plan = contacts.contact_quality(flags, WEEK, roster)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("LeftOuter, (creation_id")
    assert "Aggregate [period" in plan[join:]
