"""Tests on times kept as text: nothing of the span is lost, and they reach the scan."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgauge.functions import clock
from opsgauge.operators.periods import Period, assign_periods
from opsgauge.plans import alarm, digital
from opsgauge.sources.schemas import LAYOUTS, conform
from opsgauge.sources.text_times import may_be_within

LAYOUT_LISTS = [(), (clock.MONTH_NAME_12H,), (clock.DAY_FIRST_12H,), (clock.DAY_FIRST, clock.DAY_FIRST_MINUTES, clock.DAY_FIRST_DAY), (clock.ISO,), ("MM/dd/yyyy HH:mm",)]
SPANS = [("2025-12-08", "2025-12-14"), ("2024-12-31", "2025-01-02"), ("2025-02-27", "2025-04-02"), ("2025-12-10", "2025-12-10")]


def texts():
    """Times in all layouts, and odd ways to write them."""
    rng = random.Random(8)
    out = ["", " ", "2025", "+2025", "2025-12", "2025-1", "2025-12-9", "02025-12-09", "+002025-12-09 01:02:03", "\t2025-12-10 05:00:00",
           "2025-01-01T00:30:00+09:00", "2024-12-31 23:30:00-05:00", "2025-12-09T10:00", "10:00:00", "T10:00", "someday", "2025-DEC-09 01:02:03",
           "2025-dEc-14 11:59:59", "2025-Dec-9 01:02:03", "9/12/2025 01:02:03", "09/12/2025 1:02:03", "2025-12-15 00:00:00", "09/12/25 01:02:03",
           "31/12/2024 12:00:00", "2025-12-10 24:00:00", "12/10/2025 10:00", "-2025-12-10"]
    for _ in range(400):
        t = datetime(2024, 12, 25) + timedelta(seconds=rng.randrange(86400 * 370))
        pattern = rng.choice(["%Y-%b-%d %I:%M:%S", "%d/%m/%Y %I:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M"])
        text = t.strftime(pattern)
        out.append(rng.choice([text, text, text, text.upper(), text.lower(), " " + text, text + " "]))
    return out


@pytest.mark.parametrize("layouts", LAYOUT_LISTS)
@pytest.mark.parametrize("span", SPANS)
def test_no_time_of_the_span_is_lost(spark, layouts, span):
    df = spark.createDataFrame([(t,) for t in texts()], "t string").withColumn("at", clock.parse_any(F.col("t"), layouts))
    inside = F.to_date("at").between(date.fromisoformat(span[0]), date.fromisoformat(span[1]))
    test = may_be_within(F.col("t"), layouts, *span)
    lost = df.filter(inside & ~test).collect()
    assert test is not None and lost == [] and df.filter(inside).count() > 0
    # and most others are left out
    assert df.filter(test).count() < df.count() / 2


@pytest.mark.parametrize("layouts", [("HH:mm dd/MM/yyyy",), ("yy-MM-dd",), ("EEE dd MMM yyyy",), ("dd MMMM yyyy",)])
def test_layouts_that_do_not_tell(layouts):
    assert may_be_within(F.lit("x"), layouts, *SPANS[0]) is None


def test_long_spans_are_not_tested():
    assert may_be_within(F.lit("x"), (), "2020-01-01", "2025-01-01") is None


WEEK = [Period("Week", "2025-12-08", "2025-12-14")]


def pushed(df):
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", df._jdf.queryExecution().executedPlan().toString())


def stored(spark, tmp_path, name, column, rows, schema):
    path = f"{tmp_path}/{name}.parquet"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_callouts(spark, tmp_path):
    rows = [("a", "09/12/2025 10:00:00", True, 5.0), ("b", "09/11/2025 10:00:00", True, 5.0), ("c", "2025-12-14 23:00:00", True, 5.0),
            ("d", "not known", True, 5.0), ("e", "14/12/2025", True, 9999.0)]
    raw = stored(spark, tmp_path, "guard_callouts", "callout_created_at", rows, "callout_id string, callout_created_at string, responder_dispatch_completed boolean, avg_true_resp_time double")
    out = alarm.guard_callouts(conform(raw, "guard_callouts", within=("callout_created_at", "2025-12-08", "2025-12-14")), WEEK)
    filters = pushed(out)[0]
    assert "StringStartsWith(callout_created_at,09/12/2025" in filters and "StringStartsWith(callout_created_at,2025-12" in filters
    assert "09/11/2025" not in filters
    got = out.first()
    assert (got["guard_callouts"], round(got["under_40_min_pct"], 6)) == (3, 66.666667)
    assert out.collect() == alarm.guard_callouts(conform(raw, "guard_callouts"), WEEK).collect()


def test_messages(spark, tmp_path):
    rows = [("a", "2025-Dec-09 10:00:00", 10, "q", 1), ("b", "2025-dec-10 10:00:00", 500, "q", 1), ("c", "2025-Aug-09 10:00:00", 10, "q", 1)]
    raw = stored(spark, tmp_path, "messages", "ini_resource_time", rows, "ixn_id string, ini_resource_time string, mediation_time long, queue_workbin string, queue_workbin_duration long")
    cut = conform(raw, "messages", within=("ini_resource_time", "2025-12-01", "2025-12-14"))
    out = digital.message_sla(cut, WEEK, ["q"], ["q"], lookback_days=7)
    assert all("StringStartsWith(ini_resource_time,2025-Dec-" in f and "2025-Aug" not in f for f in pushed(out))
    assert tuple(out.first()) == ("Week", 2, 50.0)


def test_contact_logs(spark, tmp_path):
    """The day that contacts are cut by, where it is a text too."""
    raw = stored(spark, tmp_path, "contact_logs", "creation_date", [("09/12/2025", "09/12/2025 10:00:00"), ("09/10/2025", "09/10/2025 10:00:00")], "creation_date string, creation_date_hour string")
    names = "installation_number creation_source creation_id creation_media creation_direction country code_key_one code_key_two code_key_three".split()
    raw = raw.withColumns({n: F.lit("x") for n in names}).withColumn("comm_log_number", F.lit(1).cast("long"))
    days = {"contact_logs.creation_date": (clock.DAY_FIRST_DAY,)}
    out = assign_periods(conform(raw, "contact_logs", days, ("creation_date", "2025-11-08", "2025-12-14")), "creation_date", WEEK)
    filters = pushed(out)[0]
    assert "StringStartsWith(creation_date,09/12/2025" in filters and "StringStartsWith(creation_date,09/10/2025" not in filters
    assert out.count() == 1 and "contact_logs.creation_date_hour" in LAYOUTS
