"""Measures on hand-made rows, the edge rules of each, and the report as a whole."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.measures import AS_OF, DEPLOYMENT, PERIODS
from catalog.standins import Inputs
from opsgauge.fixed_values import HOLIDAYS, HOLIDAYS_WITH_NEXT_YEAR
from opsgauge.functions.clock import DAY_US, HOUR_US
from opsgauge.operators.periods import Period
from opsgauge.plans import alarm, backoffice, care, contacts, digital, field, onboarding, report, selfservice, service
from opsgauge.run import run_report
from opsgauge.sources.schemas import SCHEMAS, lost_values, schema_of

WEEK = Period("Week", "2025-12-08", "2025-12-14")
DAY = date(2025, 12, 10)
NOON = datetime(2025, 12, 10, 12)


def table(spark, name, *rows, **defaults):
    """Rows of a logical input; columns not given are null."""
    schema = schema_of(name)
    return spark.createDataFrame([tuple({**defaults, **r}.get(f.name) for f in schema) for r in rows], schema)


def only(df):
    return df.first().asDict()


def test_escalations_count_a_missing_number_once(spark):
    base = {"ticket_problem": "CVIP", "closing_date": DAY, "creation_datetime": NOON}
    rows = [
        {"ticket_number_closed": "1", "closing_date_time": NOON + timedelta(hours=23, minutes=59)},
        {"ticket_number_closed": "1", "closing_date_time": NOON + timedelta(hours=30)},
        {"ticket_number_closed": "2", "closing_date_time": NOON + timedelta(hours=24)},
        {"ticket_number_closed": None, "closing_date_time": NOON},
        {"ticket_number_closed": "3", "installation_number_closed": "71", "closing_date_time": NOON},
    ]
    got = only(service.escalations(table(spark, "escalations", *rows, **base), [WEEK]))
    assert got == {"period": "Week", "escalations": 3, "under_24h_pct": 33.33, "under_48h_pct": 66.67}


def test_alarm_times_treat_null_by_country(spark):
    rows = [
        {"incidence_number": "1", "country": "UK ", "tm_attended": None},
        {"incidence_number": "2", "country": "UK", "tm_attended": 60},
        {"incidence_number": "3", "country": "IRELAND", "tm_attended": None},
        {"incidence_number": "4", "country": "IRELAND", "tm_attended": 181, "cancellation_type": "CONFORT"},
        {"incidence_number": "5", "country": "UK", "cancellation_subtype": "RETREP"},
        {"incidence_number": "6", "country": "UK", "incidence_type": "TA", "cancellation_type": "CONFIA",
         "cancellation_subtype": " INTIME\t"},
    ]
    got = only(alarm.incidence_volume(table(spark, "alarm_incidences", *rows, incidence_creation_date=DAY), [WEEK]))
    assert got["incidences_uk"] == 2 and got["incidences_ie"] == 2 and got["agent_ie"] == 1
    assert (got["under_60_pct_uk"], got["over_180_pct_uk"]) == (50.0, 0.0)
    assert (got["under_60_pct_ie"], got["over_180_pct_ie"]) == (0.0, 50.0)


def test_repeat_alarm_needs_three_on_one_day(spark):
    rows = [{"installation_number": "a", "incidence_creation_date": DAY}] * 3
    rows += [{"installation_number": "b", "incidence_creation_date": DAY}] * 2
    rows += [{"installation_number": "b", "incidence_creation_date": DAY + timedelta(days=1)}] * 2
    rows += [{"installation_number": None, "incidence_creation_date": DAY}] * 5
    df = table(spark, "alarm_incidences", *rows, incidence_number="n", country="UK", panel="SDVECU")
    assert only(alarm.repeat_alarms(df, [WEEK]))["repeat_alarm_pct"] == 50.0


def contact(minutes, number, installation="i", **more):
    at = NOON + timedelta(minutes=minutes)
    return {"installation_number": installation, "comm_log_number": number, "creation_date": at.date(),
            "creation_date_hour": at, **more}


CONTACT = {"creation_source": "CS", "creation_media": "PHO", "creation_direction": "Incoming", "country": "UK",
           "code_key_one": "1", "code_key_two": "x"}


def quality(spark, rows, **windows):
    logs = table(spark, "contact_logs", *rows, **CONTACT)
    flags = contacts.contact_flags(contacts.counted_contacts(logs, [WEEK]), **windows)
    return only(contacts.contact_quality(flags, [WEEK]))


def test_resolved_and_repeated_contacts(spark):
    rows = [
        contact(0, 1),  # another of the same reason follows
        contact(60, 2),
        contact(90, 3, code_key_two="y"),
        contact(0, 4, "j"),
        contact(0, 5, None),  # no installation: judged by nobody
        contact(5, 6, "k", code_key_three="GDPR"),
        contact(5, 7, "k", code_key_one=None, code_key_two=None),
        contact(5, 8, "k", creation_id="IBS"),
    ]
    assert quality(spark, rows) == {"period": "Week", "fcr_pct": 75.0, "repeat_pct": 50.0}


def test_number_out_of_order_in_a_burst_is_not_counted(spark):
    rows = [contact(0, 9), contact(5, 3), contact(30, 4)]
    # the second is the smaller number within ten minutes, so only two count: not repeated
    assert quality(spark, rows)["repeat_pct"] == 0.0
    assert quality(spark, [contact(0, 3), contact(5, 9), contact(30, 10)])["repeat_pct"] == 100.0


def test_contact_windows_respect_the_horizon(spark):
    rows = [contact(0, 1), contact(24 * 60, 2), contact(24 * 60 + 1, 3)]
    assert quality(spark, rows, horizon_us=DAY_US, slot_us=HOUR_US)["repeat_pct"] == 0.0
    assert quality(spark, rows, horizon_us=DAY_US + HOUR_US, slot_us=HOUR_US)["repeat_pct"] == 100.0


def test_messages_take_the_first_session_of_the_whole_table(spark):
    rows = [
        {"ixn_id": "a", "ini_resource_time": NOON - timedelta(days=20), "mediation_time": 1},
        {"ixn_id": "a", "ini_resource_time": NOON, "mediation_time": 1},  # not its first session
        {"ixn_id": "b", "ini_resource_time": NOON, "mediation_time": 180},
        {"ixn_id": "b", "ini_resource_time": NOON, "mediation_time": 10},  # a tie counts too
        {"ixn_id": "c", "ini_resource_time": NOON, "mediation_time": 181},
    ]
    df = table(spark, "messages", *rows, queue_workbin="route", queue_workbin_duration=0)
    got = only(digital.message_sla(df, [WEEK], ["route"], ["route"]))
    assert got == {"period": "Week", "messages": 3, "within_180_pct": 66.67}


def test_cancellation_response_days(spark):
    monday = datetime(2025, 12, 8, 9)
    rows = [
        {"ticker_number": "1", "fecha_desde_asignacion": monday + timedelta(days=2)},
        {"ticker_number": "2", "fecha_desde_asignacion": monday + timedelta(days=3)},
        {"ticker_number": "3", "fecha_desde_asignacion": monday - timedelta(days=9)},
        {"ticker_number": "4", "close_employee_id": "e"},
        {"ticker_number": "5"},
        {"ticker_number": "6", "fecha_desde_asignacion": datetime(2030, 1, 1), "close_employee_id": "e"},
        {"ticker_number": "7", "fecha_desde_asignacion": monday, "pais": "IRELAND", "vstatus": "ERROR"},
        {"ticker_number": "8", "fecha_desde_asignacion": monday, "pais": "IRELAND", "vstatus": "CLOSED"},
    ]
    closed = table(spark, "tickets_closed", *rows, opening_date=monday, type="CANC", pais="UK")
    opened = table(
        spark, "tickets_open", *[{"ticker_number": str(n), "pais": "IRELAND" if n > 6 else "UK"} for n in range(1, 9)],
        opening_date=DAY,
    )
    got = only(care.cancellation_response(opened, closed, [WEEK], HOLIDAYS_WITH_NEXT_YEAR))
    assert (got["opened"], got["closed"], got["opened_ie"]) == (8, 4, 2)
    assert (got["response_pct"], got["response_pct_ie"]) == (50.0, 50.0)


def test_desk_retention_without_a_whole_is_zero(spark):
    closed = table(
        spark, "tickets_closed", {"type": "CCN", "vresolution": "Retained"}, closing_date=NOON, vstatus="CLOSED",
        close_employee_id="e",
    )
    staff = table(spark, "care_staff", {"employee_id": "e"})
    assert only(care.desk_retention(closed, staff, [WEEK]))["retention_pct"] == 0.0


def test_onboarding_counts_each_waiting_time(spark):
    friday = datetime(2025, 12, 5)
    rows = [
        {"installation_number": "a", "installation_date": friday},
        {"installation_number": "a", "installation_date": friday - timedelta(days=30)},
        {"installation_number": "b", "installation_date": NOON + timedelta(days=3)},
    ]
    got = only(onboarding.onboarding_speed(table(spark, "onboarding", *rows, min_comp_attempt_date=NOON), [WEEK], HOLIDAYS))
    assert got == {"period": "Week", "installations": 3, "under_5_days_pct": 66.67, "beyond_calendar": 0}


def test_retention_drops_codes_that_only_wait(spark):
    def visit(code, installation, outcome, reti=None):
        return {"code_maintenance_ibs": code, "installation_number": installation, "customer_retained": outcome,
                "reti": reti}

    rows = [
        visit("1", "a", "PENDING"), visit("1", "b", "RETAINED"),
        visit("2", "c", "PENDING"),
        visit("3", "d", "NOT RETAINED", "RETI TAKEOVER"),
        visit("4", "e", "NOT RETAINED"), visit("4", "f", "PENDING"),
    ]
    df = table(spark, "field_retention", *rows, status_maintenance="FINL", technician_identifier="t",
               closing_finishing_date=NOON)
    # codes 1 and 3 over installations a, b, d, e, f
    assert only(field.field_retention(df, [WEEK], ["t"]))["retention_pct"] == 40.0


def test_retention_judges_each_period_by_its_own_visits(spark):
    first = datetime(2025, 3, 3, 12)
    rows = [
        {"code_maintenance_ibs": "1", "installation_number": "a", "customer_retained": "RETAINED",
         "closing_finishing_date": first},
        {"code_maintenance_ibs": "1", "installation_number": "a", "customer_retained": "PENDING",
         "closing_finishing_date": first + timedelta(days=1)},
        {"code_maintenance_ibs": None, "installation_number": "b", "customer_retained": None,
         "closing_finishing_date": first + timedelta(days=69)},
    ]
    df = table(spark, "field_retention", *rows, status_maintenance="FINL", technician_identifier="t")
    # more days than a whole number has bits
    days = [(first + timedelta(days=n)).date().isoformat() for n in range(70)]
    periods = [Period(day, day, day) for day in days] + [Period("All", days[0], days[-1])]
    got = {r.period: r.retention_pct for r in field.field_retention(df, periods, ["t"]).collect()}
    assert len(got) == 71
    known = {day: value for day, value in got.items() if value is not None}
    assert known == {days[0]: 100.0, days[69]: 0.0, "All": 50.0}


def test_first_time_fix(spark):
    def visit(code, hours, installation="i", kind="TECH"):
        return {"code_maintenance_ibs": code, "installation_number": installation, "call_type_code": kind,
                "closing_finishing_date": NOON + timedelta(hours=hours)}

    rows = [visit("1", 0), visit("2", 1), visit("3", 2, kind="ROBB"), visit("4", 3, kind=None), visit("4", 9),
            visit("5", 0, None), visit("6", 0, None), visit("7", 0, "7x")]
    df = table(spark, "services_closed", *rows, technician_line_code="230020.0", status_maintenance="FINL")
    # misses: 2 and 4, of six codes
    assert only(field.first_time_fix(df, [WEEK], ["MOVE"]))["first_time_fix_pct"] == 66.67


@pytest.mark.parametrize(("mode", "finalised"), [("date", 2), ("instant", 1)])
def test_last_day_by_bound_mode(spark, mode, finalised):
    rows = [
        {"maintenance_id": "1", "maintenance_closing_date": datetime(2025, 12, 14)},
        {"maintenance_id": "2", "maintenance_closing_date": datetime(2025, 12, 14, 9)},
    ]
    done = table(spark, "selfservice_finalised", *rows)
    empty = [table(spark, n) for n in ("selfservice_opened", "selfservice_chasing", "promoted_to_field")]
    got = only(selfservice.volume(empty[0], done, empty[1], empty[2], [WEEK], mode))
    assert got["finalised"] == finalised and got["opened"] == 0


def test_sentinel_closings_are_left_out_and_unknown_ones_kept(spark):
    rows = [
        {"cancellation_datetime": datetime(1980, 1, 1)},
        {"cancellation_datetime": None, "cancellation_subtype": "OPSE "},
        {"cancellation_datetime": NOON, "incidence_creation_datetime": NOON - timedelta(hours=48)},
    ]
    closed = table(spark, "mt_closed", *rows, cancellation_date=DAY)
    got = only(backoffice.closing_times(closed, [WEEK]))
    assert (got["in_72h"], got["over_7d"], got["captured_pct"]) == (1, 1, 50.0)
    none = [table(spark, n) for n in ("mt_generated", "zv_generated", "zv_closed")]
    volume = only(backoffice.volume(none[0], none[1], closed, none[2], [WEEK]))
    assert (volume["closed"], volume["sent_to_field_pct"], volume["received_uk"]) == (2, 50.0, 0)


def test_report_of_empty_tables_has_every_row(spark):
    def source(name):
        return spark.createDataFrame([], schema_of(name))

    got = report.report(report.report_parts(source, [WEEK], DEPLOYMENT, "2025-12-15")).collect()
    assert len(got) == 83
    assert all(r.value == 0 for r in got if r.unit == "count")
    assert all(r.value in (None, 0.0) for r in got)


def test_report_is_stored_and_read_back(spark, sf_dir, tmp_path):
    inputs = Inputs(spark, sf_dir)
    got = run_report(spark, inputs.raw, PERIODS, DEPLOYMENT, AS_OF, str(tmp_path / "kpis"))
    assert got.count() == 83 * 3
    assert got.filter(F.col("period") == "Span").agg(F.count("value")).first()[0] > 80


def test_losses_are_counted_in_the_same_scans(spark, sf_dir, tmp_path):
    """Unreadable times of two inputs, one of them read by several measures; the report stays the same."""
    inputs = Inputs(spark, sf_dir)

    def source(name):
        raw = inputs.raw(name)
        columns = {"field_retention": "closing_finishing_date", "field_backlog": "audit_insert_timestamp"}
        if name not in columns:
            return raw
        at = F.col(columns[name])
        text = F.when(F.dayofmonth(at) % 10 == 7, "not known").otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        return raw.withColumn(columns[name], text)

    path = str(tmp_path / "kpis")
    got = run_report(spark, source, PERIODS, DEPLOYMENT, AS_OF, path, count_losses=True)
    names = ("guard_callouts", "field_retention", "field_backlog")
    want = {tuple(r) for n in names for r in lost_values(source(n), n).collect()}
    stored = spark.read.parquet(f"{path}_losses")
    assert {(r.input, r.column, r.lost) for r in stored.collect()} == want and {r.run for r in stored.collect()} == {1}
    assert any(lost > 0 for _, _, lost in want) and got.count() == 83 * 3
    losses = {}
    parts = report.report_parts(source, PERIODS, DEPLOYMENT, AS_OF, losses)
    plan = parts["field_retention"]._jdf.queryExecution().optimizedPlan().toString()
    plain = report.report_parts(source, PERIODS, DEPLOYMENT, AS_OF)["field_retention"]._jdf.queryExecution().optimizedPlan().toString()
    assert set(losses) == set(names) and plan.count("Relation [") == plain.count("Relation [")


def test_missing_installations_are_one(spark):
    rows = [{"installation_number": n, "monitoring_status": "OP", "contract_status": "CUEM"} for n in ("1", "1", None, None, "2")]
    portfolio = table(spark, "portfolio", *rows)
    held = lambda *numbers: table(spark, "devices", *[{"ins_no": n} for n in numbers], device="FG")
    assert tuple(backoffice.portfolio_base(portfolio, held("1", "9")).first()) == (3, 1)
    assert tuple(backoffice.portfolio_base(portfolio, held("1", None, None)).first()) == (3, 2)


def test_every_input_of_the_report_has_a_schema():
    assert len(SCHEMAS) == 41
