"""The logical inputs and the columns each must have.

Column names are the plain form of the source headers: symbols become single underscores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from opsgauge.functions.clock import DAY_FIRST, DAY_FIRST_12H, DAY_FIRST_DAY, DAY_FIRST_MINUTES, MONTH_NAME_12H, parse_any
from opsgauge.operators.clean import clean_headers
from opsgauge.sources.text_times import may_be_within

# Column names and types of the logical inputs.
SCHEMAS = {
    "queue_calls": (
        "report_date date, report_year int, report_month int, interval_30min string, "
        "service_received long, accepted_agent long, accepted_under40sec long, "
        "abandoned_waiting_higher10sec long, accepted_over120sec long, calls_queue string"
    ),
    "queues": "queues string, skills string, departments string, media_type string, manager string",
    "agents": (
        "employee_id string, formula1 string, supervisory_organization string, worker_s_manager string"
    ),
    "contact_logs": (
        "installation_number string, comm_log_number long, creation_date date, "
        "creation_date_hour timestamp, creation_source string, creation_id string, "
        "creation_media string, creation_direction string, country string, code_key_one string, "
        "code_key_two string, code_key_three string"
    ),
    "chats": (
        "report_date date, agent_id string, chat_hour int, chat_queue string, interaction_id string, "
        "flag_rerouted int, response_time long, queue_time long"
    ),
    "emails": (
        "report_day date, employee_id string, interaction_id string, interaction_duration long, "
        "email_response_time long, stop_action int, report_queue string"
    ),
    "messages": (
        "ixn_id string, ini_resource_time timestamp, mediation_time long, queue_workbin string, "
        "queue_workbin_duration long"
    ),
    "faq": "date date, created string, fse_installer string, faqable string, not_faqable string",
    "alarm_incidences": (
        "incidence_number string, installation_number string, incidence_creation_date date, "
        "incidence_type string, cancellation_type string, cancellation_subtype string, "
        "country string, panel string, tm_attended int"
    ),
    "guard_callouts": (
        "callout_id string, callout_created_at timestamp, responder_dispatch_completed boolean, "
        "avg_true_resp_time double"
    ),
    "police": "incidence_creation_date date, country string, total_incidences_with_police_net double",
    "services_opened": (
        "code_maintenance_ibs string, installation_number string, creating_date date, "
        "installation_cost_center_code string, days_install_to_creation int, call_type_code string"
    ),
    "services_closed": (
        "code_maintenance_ibs string, installation_number string, creating_date timestamp, "
        "closing_finishing_date timestamp, status_maintenance string, technician_line_code string, "
        "req_by string, activity_type string, call_type_code string"
    ),
    "field_retention": (
        "code_maintenance_ibs string, installation_number string, closing_finishing_date timestamp, "
        "status_maintenance string, technician_identifier string, customer_retained string, reti string"
    ),
    "mt_generated": "incidence_number string, incidence_creation_date date, country string",
    "zv_generated": "incidence_number string, incidence_creation_date date, country string",
    "mt_closed": (
        "incidence_number string, cancellation_date date, cancellation_datetime timestamp, "
        "incidence_creation_datetime timestamp, cancellation_subtype string"
    ),
    "zv_closed": "incidence_number string, incidence_cancellation_date date, cancellation_subtype string",
    "mt_backlog": "incidence_number string, incidence_creation_date date",
    "zv_backlog": "incidence_number string, incidence_creation_date date",
    "portfolio": (
        "installation_number string, monitoring_status string, contract_status string, panel_group string"
    ),
    "devices": "ins_no string, device string",
    "escalations": (
        "ticket_number_closed string, installation_number_closed string, ticket_problem string, "
        "closing_date date, closing_date_time timestamp, creation_datetime timestamp"
    ),
    "tickets_open": "ticker_number string, opening_date date, closing_date date, type string, pais string",
    "tickets_closed": (
        "ticker_number string, opening_date timestamp, closing_date timestamp, "
        "fecha_desde_asignacion timestamp, close_employee_id string, vstatus string, "
        "vclosing_id string, vresolution string, type string, pais string"
    ),
    "care_calls": (
        "interaction_id string, start_timestamp timestamp, last_vqueue string, "
        "technical_result string, technical_result_reason string, caller string, routing_point_time long"
    ),
    "care_staff": "employee_id string",
    "onboarding": "installation_number string, installation_date timestamp, min_comp_attempt_date timestamp",
    "selfservice_opened": "maintenance_id string, creation_date date",
    "selfservice_finalised": (
        "maintenance_id string, creation_date timestamp, maintenance_closing_date timestamp, "
        "closing_finishing_identifier string"
    ),
    "selfservice_chasing": "maintenance_id string, order_creation_date date",
    "promoted_to_field": "maintenance_id string, field_promotion_date date",
    "accessory_services": "code_maintenance_ibs string, closing_finishing_date timestamp",
    "field_backlog": (
        "code_maintenance_ibs string, installation_number string, creating_date date, req_by string, "
        "age double, country string, audit_insert_timestamp timestamp"
    ),
    "installation_snapshot": "installation_number string, audit_insert_timestamp timestamp",
    "schedule_changed": (
        "date date, wzprefix string, d1_service_status string, service_number string, compare string"
    ),
    "schedule_unchanged": "date date, wzprefix string, d1_service_status string, service_number string",
    "notices_sent": "contract string, notice long, notice_close_date date",
    "notices_promoted": "contract string, notice long, notice_close_date date",
    "maintained": "service_code string, created timestamp, closed timestamp",
    "maintained_finalised": "service_code string, created timestamp, closed timestamp",
}

# Source headers whose plain form is a reserved word.
OTHER_NAMES = {"from": "caller"}

# The layouts of times that sources keep as text.
LAYOUTS = {
    "messages.ini_resource_time": (MONTH_NAME_12H,),
    "contact_logs.creation_date_hour": (DAY_FIRST_12H,),
    "guard_callouts.callout_created_at": (DAY_FIRST, DAY_FIRST_MINUTES, DAY_FIRST_DAY),
}

# Times whose unreadable values count as missing; elsewhere they are an error.
COERCED = (
    "guard_callouts.callout_created_at",
    "field_retention.closing_finishing_date",
    "mt_closed.cancellation_datetime",
    "mt_closed.incidence_creation_datetime",
    "field_backlog.audit_insert_timestamp",
    "installation_snapshot.audit_insert_timestamp",
)

Layouts = Mapping[str, Sequence[str]]

MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def text_moment(name: str, field: T.StructField, layouts: Layouts | None = None) -> Column:
    """A time kept as text: by the caller's layouts or the source's own, else as plain text; not
    readable is null or an error, as the source is declared."""
    key = f"{name}.{field.name}"
    parsed = parse_any(F.col(field.name), {**LAYOUTS, **(layouts or {})}.get(key, ()), strict=key not in COERCED)
    return parsed.cast(field.dataType)


def lost_values(df: DataFrame, name: str, layouts: Layouts | None = None) -> DataFrame:
    """(input, column, lost): how many texts of each time that may be coerced cannot be read."""
    plain = clean_headers(df, plain=True).withColumnsRenamed(OTHER_NAMES)
    counts = [
        F.struct(
            F.lit(name).alias("input"),
            F.lit(f.name).alias("column"),
            F.count_if(F.col(f.name).isNotNull() & text_moment(name, f, layouts).isNull()).alias("lost"),
        )
        for f in coerced_texts(plain, name)
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "input string, column string, lost long")
    return plain.agg(F.array(*counts).alias("all")).selectExpr("inline(all)")


def coerced_texts(plain: DataFrame, name: str) -> list[T.StructField]:
    """The times of an input that are kept as text and may be unreadable."""
    return [
        f for f in schema_of(name)
        if f"{name}.{f.name}" in COERCED and isinstance(plain.schema[f.name].dataType, T.StringType)
    ]


def conform(
    df: DataFrame,
    name: str,
    layouts: Layouts | None = None,
    within: tuple[str, str, str] | None = None,
    losses: dict[str, Observation] | None = None,
) -> DataFrame:
    """Bring a table to its declared columns and types; a missing column is an error.

    `within` (column, first day, last day) says that only rows of that span are wanted. It is used
    where the column is kept as text: rows whose text cannot be a time of the span are left out by a
    test that reaches the file scan, before any text is parsed (or found to be unreadable).

    `losses` receives, under the input's name, an observation that counts the unreadable values of
    times that may be coerced, while the rows are read for whatever they are wanted for. Then all
    rows of such an input have to be read, so `within` is not used for it.

    Dates and timestamps stay as they are stored, whatever mix of them is declared: period
    tests accept each of them, and a cast would keep the test from reaching the file scan.
    Texts in their place are parsed; `layouts` gives, by "input.column", the layouts to try.
    """
    plain = clean_headers(df, plain=True).withColumnsRenamed(OTHER_NAMES)
    schema = schema_of(name)
    missing = [f.name for f in schema if f.name not in plain.columns]
    if missing:
        raise ValueError(f"table {name} lacks {', '.join(missing)}")

    counted = coerced_texts(plain, name) if losses is not None else []
    if within is not None and not counted and isinstance(plain.schema[within[0]].dataType, T.StringType):
        tried = {**LAYOUTS, **(layouts or {})}.get(f"{name}.{within[0]}", ())
        test = may_be_within(F.col(within[0]), tried, *within[1:])
        plain = plain if test is None else plain.filter(test)

    def column(field: T.StructField):
        have = plain.schema[field.name].dataType
        same = have == field.dataType or (isinstance(have, MOMENTS) and isinstance(field.dataType, MOMENTS))
        c = F.col(field.name)
        if isinstance(have, T.StringType) and isinstance(field.dataType, MOMENTS):
            return text_moment(name, field, layouts).alias(field.name)
        return c if same else c.cast(field.dataType).alias(field.name)

    if not counted:
        return plain.select(*[column(f) for f in schema])
    raw = {f.name: f"_raw_{f.name}" for f in counted}
    parsed = plain.select(*[column(f) for f in schema], *[F.col(n).alias(r) for n, r in raw.items()])
    lost = [F.count_if(F.col(r).isNotNull() & F.col(n).isNull()).alias(n) for n, r in raw.items()]
    losses[name] = Observation(f"unreadable times of {name}")
    return parsed.observe(losses[name], *lost).drop(*raw.values())
