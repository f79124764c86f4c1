"""The measures as registered queries, each with independent SQL over the same inputs.

The SQL takes the direct way: range joins, conditional distinct counts and self-joins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import ORACLES, query
from catalog.standins import AS_OF, EVENT_PERIODS, HOLIDAYS, ORDER_PERIODS, with_inputs
from opsgauge.fixed_values import LINES, LINES_FIRST_TIME_FIX, LINES_WITH_ACCESSORIES
from opsgauge.functions.clock import DAY_US, HOUR_US
from opsgauge.functions.ratio import round_even
from opsgauge.plans import (
    alarm,
    backoffice,
    calls,
    care,
    contacts,
    digital,
    field,
    onboarding,
    report,
    selfservice,
    service,
)
from opsgauge.sources.schemas import conform

OP, EP = ORDER_PERIODS, EVENT_PERIODS
UK_QUEUES = tuple(f"NATION_{n}" for n in range(18))
IE_QUEUES = tuple(f"NATION_{n}" for n in range(18, 21))
ALARM_QUEUES = tuple(f"NATION_{n}" for n in range(21, 25))
TECHNICIANS = ("T1", "T2", "T4", "T5", "T6", "T7")
WORK_CALL_TYPES = ("MOVE", "WORK")
CHAT_QUEUES = ("click", "view", "error")
MESSAGE_QUEUES = ("click", "view", "error", "signup")
ROUTING_QUEUES = ("click", "view")
WINDOWS = {"gap_us": 6 * HOUR_US, "horizon_us": 7 * DAY_US, "slot_us": 4 * HOUR_US}


def listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def pct(part: str, whole: str, zero: bool = False) -> str:
    value = f"round_even(({part}) / NULLIF({whole}, 0) * 100, 2)"
    return f"COALESCE({value}, 0)" if zero else value


def pct_exact(part: str, whole: str, zero: bool = False) -> str:
    """Rounded as plain Python numbers are: the exact product decides what looks like a tie."""
    high = "(v * CAST(134217729 AS DOUBLE) - (v * CAST(134217729 AS DOUBLE) - v))"
    lost = f"(({high} * 100 - v * 100) + (v - {high}) * 100)"
    near = (
        f"CASE WHEN v * 100 - floor(v * 100) = 0.5 AND {lost} > 0 THEN floor(v * 100) + 1 "
        f"WHEN v * 100 - floor(v * 100) = 0.5 AND {lost} < 0 THEN floor(v * 100) ELSE round_even(v * 100, 0) END"
    )
    value = f"list_transform([({part}) / NULLIF({whole}, 0) * 100], lambda v: {near} / 100)[1]"
    return f"COALESCE({value}, 0)" if zero else value


def distinct(key: str, condition: str) -> str:
    return f"COUNT(DISTINCT CASE WHEN {condition} THEN {key} END)"


def in_period(day: str) -> str:
    return f"CAST({day} AS DATE) BETWEEN s AND e"


# ---------------------------------------------------------------- calls

LEVELS = f"""
SELECT periods.period, CAST(COALESCE(SUM(accepted_agent), 0) AS BIGINT) AS accepted,
       {pct("SUM(accepted_under40sec)", "SUM(accepted_agent)")} AS under_40_pct,
       {pct("SUM(accepted_over120sec)", "SUM(accepted_agent)")} AS over_120_pct,
       {pct("SUM(abandoned_waiting_higher10sec)", "SUM(service_received)")} AS abandoned_pct
FROM periods LEFT JOIN (
    SELECT c.* FROM queue_calls c JOIN queues q ON c.calls_queue = q.queues
    WHERE skills IS NOT NULL AND departments IS NOT NULL AND media_type IS NOT NULL
      AND manager IS NOT NULL AND <RULE>
) t ON {in_period("report_date")}
GROUP BY periods.period
"""


def levels(rule: str) -> str:
    return with_inputs("queue_calls queues", LEVELS.replace("<RULE>", rule), OP)


@query("K01_queue_sla", levels(f"calls_queue IN {listed(UK_QUEUES)}"))
def queue_sla(t):
    return calls.queue_sla(t("queue_calls"), t("queues"), OP, UK_QUEUES)


@query("K01_queue_sla_ie", levels(f"calls_queue IN {listed(IE_QUEUES)}"))
def queue_sla_ie(t):
    return calls.queue_sla(t("queue_calls"), t("queues"), OP, IE_QUEUES)


@query("K02_department_sla", levels("departments = 'Technical' AND calls_queue <> 'NATION_2'"))
def department_sla(t):
    return calls.department_sla(t("queue_calls"), t("queues"), OP, "Technical", "NATION_2")


@query("K03_alarm_call_sla", levels(f"calls_queue IN {listed(ALARM_QUEUES)}"))
def alarm_call_sla(t):
    return calls.queue_sla(t("queue_calls"), t("queues"), OP, ALARM_QUEUES)


@query(
    "K07_faq_adherence",
    with_inputs(
        "faq",
        f"""
SELECT period, {pct("COUNT(not_faqable)", "COUNT(faqable) + COUNT(not_faqable)")} AS adherence_pct
FROM periods LEFT JOIN faq ON {in_period("date")} AND created IS NOT NULL
     AND fse_installer IN ('FSE', 'Installer')
GROUP BY period
""",
        EP,
    ),
)
def faq_adherence(t):
    return calls.faq_adherence(t("faq"), EP)


# ---------------------------------------------------------------- contacts

# brute force: every contact against every contact of its installation
FLAGS = """
, kept AS (
    SELECT period, installation_number, comm_log_number, creation_date_hour, creation_id,
           COALESCE(code_key_two, '') AS k2, COALESCE(code_key_three, '') AS k3
    FROM contact_logs JOIN periods ON CAST(creation_date AS DATE) BETWEEN e - 30 AND e
    WHERE creation_source IN ('CS', 'CUDE', 'CUSV', 'ATT')
      AND (creation_id IS NULL OR creation_id NOT IN ('Automatic', 'BUSSOA', 'COMMLOG', 'IBS'))
      AND creation_media IN ('   ', 'CHA', 'EMA', 'PHO', 'TEL', 'WAP')
      AND code_key_three IS DISTINCT FROM 'GDPR' AND creation_direction = 'Incoming' AND country = 'UK'
      AND NOT (code_key_one IS NULL AND code_key_two IS NULL AND code_key_three IS NULL)
), marked AS (
    SELECT a.*, CASE WHEN comm_log_number = (
        SELECT MAX(b.comm_log_number) FROM kept b
        WHERE b.period = a.period AND b.installation_number = a.installation_number
          AND b.creation_date_hour <= a.creation_date_hour
          AND b.creation_date_hour > a.creation_date_hour - INTERVAL 6 HOUR) THEN 1 ELSE 0 END AS is_latest
    FROM kept a
), pairs AS (
    SELECT a.period, a.installation_number, a.comm_log_number, a.creation_date_hour, a.creation_id,
           a.is_latest, COUNT(b.period) AS contacts_ahead,
           COUNT(CASE WHEN a.k2 = b.k2 AND a.k3 = b.k3 THEN 1 END) AS same_reason_ahead
    FROM marked a LEFT JOIN marked b
      ON a.period = b.period AND a.installation_number = b.installation_number AND b.is_latest = 1
     AND b.creation_date_hour >= a.creation_date_hour
     AND b.creation_date_hour <= a.creation_date_hour + INTERVAL 7 DAY
    GROUP BY ALL
)
"""
# WITH ... AS (VALUES) ends the head, so the chain goes on with a comma
def contact_sql(body: str, more: str = "") -> str:
    return with_inputs("contact_logs" + more, FLAGS + body, EP)


def flags_of(t):
    return contacts.contact_flags(contacts.counted_contacts(t("contact_logs"), EP), **WINDOWS)


@query(
    "K04_first_contact_resolution",
    contact_sql(
        f"""
SELECT periods.period, {pct("COUNT(CASE WHEN same_reason_ahead = 1 THEN 1 END)",
                            "COUNT(CASE WHEN same_reason_ahead >= 1 THEN 1 END)")} AS fcr_pct
FROM periods LEFT JOIN pairs ON pairs.period = periods.period GROUP BY periods.period
"""
    ),
)
def first_contact_resolution(t):
    return contacts.contact_quality(flags_of(t), EP).select("period", "fcr_pct")


@query(
    "K05_repeat_contact",
    contact_sql(
        f"""
SELECT periods.period, {pct_exact("COUNT(DISTINCT CASE WHEN contacts_ahead >= 3 THEN installation_number END)",
                            "COUNT(DISTINCT installation_number)", zero=True)} AS repeat_pct
FROM periods LEFT JOIN pairs ON pairs.period = periods.period GROUP BY periods.period
"""
    ),
)
def repeat_contact(t):
    return contacts.contact_quality(flags_of(t), EP).select("period", "repeat_pct")


ROSTER = """
SELECT employee_id, supervisory_organization, worker_s_manager FROM agents
WHERE formula1 = 'Active' AND supervisory_organization ILIKE '%customer service team%'
  AND supervisory_organization NOT ILIKE '%south%' AND worker_s_manager IS DISTINCT FROM 'Manager 7'
"""


def roster_of(t):
    return contacts.filtered_roster(t("agents"), ["Customer Service Team"], ["South"], ["Manager 7"])


@query(
    "K06_agent_enriched_contacts",
    with_inputs(
        "contact_logs agents",
        f"""
SELECT comm_log_number, creation_id, employee_id, supervisory_organization, worker_s_manager
FROM contact_logs LEFT JOIN ({ROSTER}) r ON creation_id = employee_id
""",
    ),
)
def agent_enriched_contacts(t):
    out = contacts.enriched_contacts(t("contact_logs"), roster_of(t))
    return out.select(
        "comm_log_number", "creation_id", "employee_id", "supervisory_organization", "worker_s_manager"
    )


@query(
    "K06_contact_quality_by_roster",
    contact_sql(
        f"""
SELECT periods.period,
       {pct("COUNT(CASE WHEN same_reason_ahead = 1 THEN 1 END)",
            "COUNT(CASE WHEN same_reason_ahead >= 1 THEN 1 END)")} AS fcr_pct,
       {pct_exact("COUNT(DISTINCT CASE WHEN contacts_ahead >= 3 THEN installation_number END)",
            "COUNT(DISTINCT installation_number)", zero=True)} AS repeat_pct
FROM periods LEFT JOIN (
    SELECT pairs.* FROM pairs LEFT JOIN (SELECT * FROM ({ROSTER}) UNION ALL SELECT * FROM ({ROSTER})) r
      ON creation_id = employee_id
) p ON p.period = periods.period GROUP BY periods.period
""",
        " agents",
    ),
)
def contact_quality_by_roster(t):
    roster = roster_of(t)
    return contacts.contact_quality(flags_of(t), EP, roster.unionByName(roster))


# ---------------------------------------------------------------- chats, emails, messages


@query(
    "K08_chat_sla",
    with_inputs(
        "chats",
        f"""
SELECT period, {distinct("interaction_id", "flag_rerouted = 0")} AS chats,
       {pct_exact(distinct("interaction_id", "flag_rerouted = 0 AND response_time - queue_time < 60"),
            distinct("interaction_id", "flag_rerouted = 0"))} AS under_60_pct,
       {pct_exact(distinct("interaction_id", "flag_rerouted = 0 AND response_time - queue_time > 120"),
            distinct("interaction_id", "flag_rerouted = 0"))} AS over_120_pct
FROM periods LEFT JOIN chats ON {in_period("report_date")} AND chat_queue IN {listed(CHAT_QUEUES)}
GROUP BY period
""",
        EP,
    ),
)
def chat_sla(t):
    return digital.chat_sla(t("chats"), EP, CHAT_QUEUES)


@query(
    "K09_email_sla",
    with_inputs(
        "emails",
        f"""
SELECT period, {", ".join(
    f"COUNT(CASE WHEN stop_action = 1 AND interaction_duration < {h * 3600} THEN 1 END) AS under_{h}h"
    for h in (12, 24, 48))}
FROM periods LEFT JOIN emails ON {in_period("report_day")} GROUP BY period
""",
        EP,
    ),
)
def email_sla(t):
    return digital.email_sla(t("emails"), EP)


@query(
    "K10_message_sla",
    with_inputs(
        "messages",
        f"""
SELECT period, COUNT(DISTINCT ixn_id) AS messages,
       {pct(f"COUNT(CASE WHEN queue_workbin IN {listed(ROUTING_QUEUES)} AND is_first = 1 "
            "AND mediation_time - queue_workbin_duration <= 180 THEN 1 END)",
            distinct("ixn_id", f"queue_workbin IN {listed(ROUTING_QUEUES)}"), zero=True)} AS within_180_pct
FROM periods LEFT JOIN (
    SELECT m.*, CASE WHEN ini_resource_time = (
        SELECT MIN(ini_resource_time) FROM messages o WHERE o.ixn_id = m.ixn_id) THEN 1 ELSE 0 END AS is_first
    FROM messages m
) m ON {in_period("ini_resource_time")} AND queue_workbin IN {listed(MESSAGE_QUEUES)}
GROUP BY period
""",
        EP,
    ),
)
def message_sla(t):
    return digital.message_sla(t("messages"), EP, MESSAGE_QUEUES, ROUTING_QUEUES)


# the same over messages stamped as text, on a twelve-hour clock without halves of the day
@query(
    "K10_message_sla_text",
    with_inputs(
        "messages",
        f"""
, stamped AS (
    SELECT * REPLACE (date_trunc('day', ini_resource_time)
                      + to_seconds(CAST((CASE WHEN hour(ini_resource_time) % 12 = 0 THEN 12 ELSE hour(ini_resource_time) % 12 END % 12) * 3600
                                   + minute(ini_resource_time) * 60 + second(ini_resource_time) AS BIGINT)) AS ini_resource_time)
    FROM messages
)
SELECT period, COUNT(DISTINCT ixn_id) AS messages,
       {pct(f"COUNT(CASE WHEN queue_workbin IN {listed(ROUTING_QUEUES)} AND is_first = 1 "
            "AND mediation_time - queue_workbin_duration <= 180 THEN 1 END)",
            distinct("ixn_id", f"queue_workbin IN {listed(ROUTING_QUEUES)}"), zero=True)} AS within_180_pct
FROM periods LEFT JOIN (
    SELECT m.*, CASE WHEN ini_resource_time = (
        SELECT MIN(ini_resource_time) FROM stamped o WHERE o.ixn_id = m.ixn_id) THEN 1 ELSE 0 END AS is_first
    FROM stamped m
) m ON {in_period("ini_resource_time")} AND queue_workbin IN {listed(MESSAGE_QUEUES)}
GROUP BY period
""",
        EP,
    ),
)
def message_sla_text(t):
    stamp = F.date_format("ini_resource_time", "yyyy-MMM-dd hh:mm:ss")
    texts = conform(t.raw("messages").withColumn("ini_resource_time", stamp), "messages")
    return digital.message_sla(texts, EP, MESSAGE_QUEUES, ROUTING_QUEUES)


# ---------------------------------------------------------------- alarm

CLEAN = """
, clean AS (
    SELECT incidence_number, installation_number, incidence_creation_date, tm_attended,
           regexp_replace(incidence_type, '^\\s+|\\s+$', '', 'g') AS incidence_type,
           regexp_replace(cancellation_type, '^\\s+|\\s+$', '', 'g') AS cancellation_type,
           regexp_replace(cancellation_subtype, '^\\s+|\\s+$', '', 'g') AS cancellation_subtype,
           regexp_replace(country, '^\\s+|\\s+$', '', 'g') AS country,
           regexp_replace(panel, '^\\s+|\\s+$', '', 'g') AS panel
    FROM alarm_incidences
), counted AS (
    SELECT * FROM clean JOIN periods ON CAST(incidence_creation_date AS DATE) BETWEEN s AND e
    WHERE NOT (COALESCE(incidence_type, '') = 'TA' AND COALESCE(cancellation_type, '') = 'CONFIA'
               AND COALESCE(cancellation_subtype, '') IN ('INTIME', 'TAMRES'))
      AND COALESCE(cancellation_subtype, '') <> 'RETREP'
)
"""
UK_N = "COUNT(CASE WHEN country = 'UK' THEN incidence_number END)"
IE_N = "COUNT(CASE WHEN country = 'IRELAND' THEN incidence_number END)"
AUTO_UK = "COUNT(CASE WHEN country = 'UK' AND cancellation_type IN ('CONFIA', 'CONFORT') THEN incidence_number END)"
AUTO_IE = "COUNT(CASE WHEN country = 'IRELAND' AND cancellation_type IN ('CONFIA', 'CONFORT') THEN incidence_number END)"
VOLUME_SQL = f"""{UK_N} AS incidences_uk, {UK_N} - {AUTO_UK} AS agent_uk, {pct(AUTO_UK, UK_N)} AS automated_pct_uk,
       {IE_N} AS incidences_ie, {IE_N} - {AUTO_IE} AS agent_ie"""
TIMES_SQL = f"""
       {pct("COUNT(CASE WHEN country = 'UK' AND COALESCE(tm_attended, 0) < 60 THEN 1 END)", UK_N)} AS under_60_pct_uk,
       {pct("COUNT(CASE WHEN country = 'UK' AND COALESCE(tm_attended, 0) > 180 THEN 1 END)", UK_N)} AS over_180_pct_uk,
       {pct("COUNT(CASE WHEN country = 'IRELAND' AND tm_attended < 60 THEN 1 END)", IE_N)} AS under_60_pct_ie,
       {pct("COUNT(CASE WHEN country = 'IRELAND' AND tm_attended > 180 THEN 1 END)", IE_N)} AS over_180_pct_ie"""


def alarm_sql(columns: str) -> str:
    return with_inputs("alarm_incidences", CLEAN + f"SELECT period, {columns} FROM counted GROUP BY period", EP)


@query("K11_alarm_volume", alarm_sql(VOLUME_SQL))
def alarm_volume(t):
    out = alarm.incidence_volume(t("alarm_incidences"), EP)
    return out.select("period", "incidences_uk", "agent_uk", "automated_pct_uk", "incidences_ie", "agent_ie")


@query("K12_alarm_response", alarm_sql(TIMES_SQL))
def alarm_response(t):
    out = alarm.incidence_volume(t("alarm_incidences"), EP)
    return out.select("period", "under_60_pct_uk", "over_180_pct_uk", "under_60_pct_ie", "over_180_pct_ie")


@query(
    "K13_repeat_alarm",
    with_inputs(
        "alarm_incidences",
        CLEAN
        + """
SELECT period, round_even(COUNT(DISTINCT CASE WHEN n >= 3 THEN installation_number END)
                          / COUNT(DISTINCT installation_number) * 100, 9) AS repeat_alarm_pct
FROM (SELECT period, installation_number, CAST(incidence_creation_date AS DATE) AS d, COUNT(*) AS n FROM counted
      WHERE country = 'UK' AND panel IN ('SDVECU', 'SDVFAST') GROUP BY ALL)
GROUP BY period
""",
        EP,
    ),
)
def repeat_alarm(t):
    out = alarm.repeat_alarms(t("alarm_incidences"), EP)
    return out.select("period", round_even(F.col("repeat_alarm_pct"), 9).alias("repeat_alarm_pct"))


@query(
    "K14_guard_callouts",
    with_inputs(
        "guard_callouts",
        """
SELECT period, COUNT(callout_id) AS guard_callouts,
       round_even(COALESCE(COUNT(CASE WHEN avg_true_resp_time > 0 AND avg_true_resp_time < 2400 THEN 1 END)
             / NULLIF(COUNT(CASE WHEN avg_true_resp_time IS NOT NULL THEN callout_id END), 0), 0) * 100, 9)
           AS under_40_min_pct
FROM periods LEFT JOIN guard_callouts
  ON CAST(try_strptime(callout_created_at, '%d/%m/%Y %H:%M:%S') AS DATE) BETWEEN s AND e
 AND responder_dispatch_completed
GROUP BY period
""",
        EP,
    ),
)
def guard_callouts(t):
    out = alarm.guard_callouts(t("guard_callouts"), EP)
    return out.withColumn("under_40_min_pct", round_even(F.col("under_40_min_pct"), 9))


# days first, without seconds, and some that cannot be read
@query("K14_guard_callouts_other_layout", ORACLES["K14_guard_callouts"])
def guard_callouts_other_layout(t):
    shorter = F.regexp_replace("callout_created_at", ":00$", "")
    out = alarm.guard_callouts(conform(t.raw("guard_callouts").withColumn("callout_created_at", shorter), "guard_callouts"), EP)
    return out.withColumn("under_40_min_pct", round_even(F.col("under_40_min_pct"), 9))


@query(
    "K15_police_callouts",
    with_inputs(
        "police",
        f"""
SELECT period, CAST(COALESCE(SUM(CAST(trunc(COALESCE(total_incidences_with_police_net, 0)) AS BIGINT)), 0) AS BIGINT)
           AS police_callouts
FROM periods LEFT JOIN police ON {in_period("incidence_creation_date")} AND country = 'UK' GROUP BY period
""",
        EP,
    ),
)
def police_callouts(t):
    return alarm.police_callouts(t("police"), EP)


# ---------------------------------------------------------------- field services


@query(
    "K16_opened_services",
    with_inputs(
        "services_opened",
        f"""
SELECT period, {distinct("code_maintenance_ibs", "NOT ie")} AS opened_uk,
       {distinct("code_maintenance_ibs", "ie")} AS opened_ie
FROM periods LEFT JOIN (
    SELECT *, starts_with(installation_number, '7') AS ie FROM services_opened
    WHERE call_type_code IS DISTINCT FROM '100'
      AND NOT COALESCE(CASE trim(COALESCE(installation_cost_center_code, '')) WHEN 'UK270' THEN 0
                  WHEN 'UK191' THEN 30 WHEN 'UK330' THEN 30 ELSE 90 END >= days_install_to_creation, FALSE)
) t ON {in_period("creating_date")} GROUP BY period
""",
        OP,
    ),
)
def opened_services(t):
    return field.opened_services(t("services_opened"), OP)


CODE = "code_maintenance_ibs"


def closed_body(lines) -> str:
    return f"""
, done AS (
    SELECT *, COALESCE(starts_with(installation_number, '7'), FALSE) AS ie,
           req_by IS DISTINCT FROM 'GTI' AS aware,
           COALESCE(activity_type, '') NOT IN ('Retention oppertunity', 'Installations', 'Moonshot Upgrade',
                                               'System Dismantle') AS judged,
           floor(date_diff('second', creating_date, closing_finishing_date) / 86400.0) AS days
    FROM services_closed
    WHERE status_maintenance = 'FINL' AND installation_number IS DISTINCT FROM '0'
      AND CAST(CAST(COALESCE(TRY_CAST(trim(technician_line_code) AS DOUBLE), 0) AS BIGINT) AS STRING)
          IN {listed(lines)}
)
"""


@query(
    "K17_closed_services",
    with_inputs(
        "services_closed",
        closed_body(LINES)
        + f"""
SELECT period, {distinct(CODE, "NOT ie AND aware")} + {distinct(CODE, "NOT ie AND NOT aware")} AS finalised,
       {distinct(CODE, "NOT ie AND aware")} AS aware, {distinct(CODE, "NOT ie AND NOT aware")} AS not_aware
FROM periods LEFT JOIN done ON {in_period("closing_finishing_date")} GROUP BY period
""",
        OP,
    ),
)
def closed_services(t):
    out = field.closed_services(t("services_closed"), OP)
    return out.select("period", "finalised", "aware", "not_aware")


@query(
    "K18_closing_sla",
    with_inputs(
        "services_closed",
        closed_body(LINES)
        + f"""
SELECT period,
       {pct_exact(distinct(CODE, "NOT ie AND aware AND judged AND days <= 7"),
            distinct(CODE, "NOT ie AND aware AND judged"))} AS aware_in_time_pct,
       {pct_exact(distinct(CODE, "NOT ie AND NOT aware AND judged AND days <= 30"),
            distinct(CODE, "NOT ie AND NOT aware AND judged"))} AS not_aware_in_time_pct,
       {pct_exact(distinct(CODE, "ie AND aware AND judged AND days <= 7"),
            distinct(CODE, "ie AND aware AND judged"))} AS aware_in_time_pct_ie
FROM periods LEFT JOIN done ON {in_period("closing_finishing_date")} GROUP BY period
""",
        OP,
    ),
)
def closing_sla(t):
    out = field.closed_services(t("services_closed"), OP)
    return out.select("period", "aware_in_time_pct", "not_aware_in_time_pct", "aware_in_time_pct_ie")


# the three label joins, written as joins
@query(
    "K19_field_retention",
    with_inputs(
        "field_retention",
        f"""
, kept AS (
    SELECT * FROM field_retention JOIN periods ON {in_period("closing_finishing_date")}
    WHERE status_maintenance = 'FINL' AND technician_identifier IN {listed(TECHNICIANS)}
), labelled AS (
    SELECT a.period, a.code_maintenance_ibs, a.installation_number,
           CASE WHEN r.customer_retained = 'RETAINED' THEN 'Retained'
                WHEN w.customer_retained = 'NOT RETAINED' AND w.reti = 'RETI TAKEOVER' THEN 'Retained'
                WHEN p.customer_retained = 'PENDING' THEN 'Pending' ELSE 'Not Retained' END AS label
    FROM kept a
    LEFT JOIN kept r ON a.period = r.period AND a.code_maintenance_ibs = r.code_maintenance_ibs
    LEFT JOIN kept w ON a.period = w.period AND a.code_maintenance_ibs = w.code_maintenance_ibs
    LEFT JOIN kept p ON a.period = p.period AND a.code_maintenance_ibs = p.code_maintenance_ibs
)
SELECT periods.period, {pct_exact(distinct("code_maintenance_ibs", "label = 'Retained'"),
                            "COUNT(DISTINCT installation_number)")} AS retention_pct
FROM periods LEFT JOIN labelled ON labelled.period = periods.period AND label <> 'Pending'
GROUP BY periods.period
""",
        OP,
    ),
)
def field_retention(t):
    return field.field_retention(t("field_retention"), OP, TECHNICIANS)


# closing times as text
@query("K19_field_retention_text", ORACLES["K19_field_retention"])
def field_retention_text(t):
    text = F.date_format("closing_finishing_date", "yyyy-MM-dd HH:mm:ss")
    texts = conform(t.raw("field_retention").withColumn("closing_finishing_date", text), "field_retention")
    return field.field_retention(texts, OP, TECHNICIANS)


@query(
    "K39_first_time_fix",
    with_inputs(
        "services_closed",
        f"""
, kept AS (
    SELECT period, code_maintenance_ibs, installation_number, closing_finishing_date,
           CASE WHEN COALESCE(call_type_code, '') IN {listed((*WORK_CALL_TYPES, "ROBB"))} THEN 0 ELSE 1 END AS technical
    FROM services_closed JOIN periods ON CAST(closing_finishing_date AS DATE) BETWEEN e - 41 AND e
    WHERE call_type_code IS DISTINCT FROM '100' AND status_maintenance IS DISTINCT FROM 'CERR'
      AND NOT COALESCE(starts_with(installation_number, '7'), FALSE)
      AND trim(replace(trim(technician_line_code), '.0', '')) IN {listed(LINES_FIRST_TIME_FIX)}
), once AS (
    SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY period, code_maintenance_ibs
        ORDER BY closing_finishing_date, installation_number, technical) = 1
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY period, installation_number
        ORDER BY closing_finishing_date, code_maintenance_ibs) AS place FROM once
)
SELECT periods.period, {pct("COUNT(CASE WHEN NOT (place > 1 AND technical = 1) THEN 1 END)",
                            "COUNT(code_maintenance_ibs)")} AS first_time_fix_pct
FROM periods LEFT JOIN placed ON placed.period = periods.period GROUP BY periods.period
""",
        OP,
    ),
)
def first_time_fix(t):
    return field.first_time_fix(t("services_closed"), OP, WORK_CALL_TYPES)


@query(
    "K40_field_backlog",
    with_inputs(
        "field_backlog installation_snapshot",
        f"""
, newest AS (
    SELECT *, req_by IS DISTINCT FROM 'GTI' AS aware FROM field_backlog
    WHERE country = 'UK' AND audit_insert_timestamp = (SELECT MAX(audit_insert_timestamp) FROM field_backlog)
), oldest AS (SELECT aware, code_maintenance_ibs, MAX(age) AS age FROM newest
              WHERE code_maintenance_ibs IS NOT NULL GROUP BY ALL
), base AS (
    SELECT COUNT(DISTINCT installation_number) AS n FROM installation_snapshot
    WHERE audit_insert_timestamp = (SELECT MAX(audit_insert_timestamp) FROM installation_snapshot)
      AND CAST(audit_insert_timestamp AS DATE) = DATE '2001-08-13'
)
SELECT period, COUNT(CASE WHEN aware THEN code_maintenance_ibs END) AS aware,
       COUNT(CASE WHEN NOT aware THEN code_maintenance_ibs END) AS not_aware,
       (SELECT round_even(AVG(age), 2) FROM oldest WHERE aware) AS aware_age,
       (SELECT round_even(AVG(age), 2) FROM oldest WHERE NOT aware) AS not_aware_age,
       (SELECT {pct("COUNT(DISTINCT code_maintenance_ibs)", "ANY_VALUE(n)")} FROM newest, base WHERE NOT aware)
           AS backlog_pct
FROM periods LEFT JOIN newest ON {in_period("creating_date")} AND installation_number IS DISTINCT FROM '0'
GROUP BY period
""",
        OP,
    ),
)
def field_backlog(t):
    return field.field_backlog(t("field_backlog"), t("installation_snapshot"), OP, AS_OF)


@query(
    "K41_schedule_adherence",
    with_inputs(
        "schedule_changed schedule_unchanged",
        f"""
, c AS (SELECT * FROM schedule_changed WHERE NOT regexp_matches(COALESCE(wzprefix, ''), '^(IE|IN)'))
, u AS (SELECT * FROM schedule_unchanged WHERE NOT regexp_matches(COALESCE(wzprefix, ''), '^(IE|IN)'))
SELECT period, {pct(
    f"(SELECT COUNT(service_number) FROM c WHERE {in_period('date')} AND d1_service_status = 'completed')"
    f" + (SELECT COUNT(service_number) FROM u WHERE {in_period('date')} AND d1_service_status = 'completed')",
    f"(SELECT COUNT(service_number) FROM c WHERE {in_period('date')} AND d1_service_status IN ('completed', 'started'))"
    f" + (SELECT COUNT(service_number) FROM u WHERE {in_period('date')} AND d1_service_status IN "
    f"('completed', 'suspended', 'notdone', 'pending'))"
    f" + (SELECT COUNT(service_number) FROM c WHERE {in_period('date')} AND compare = 'Removed')")} AS adherence_pct
FROM periods
""",
        OP,
    ),
)
def schedule_adherence(t):
    return field.schedule_adherence(t("schedule_changed"), t("schedule_unchanged"), OP)


# ---------------------------------------------------------------- back office

STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
BACK_OFFICE = f"""
, got AS (SELECT {STRIP.format(c="country")} AS country, incidence_creation_date AS d FROM mt_generated
          UNION ALL SELECT {STRIP.format(c="country")}, incidence_creation_date FROM zv_generated)
, done AS (SELECT {STRIP.format(c="cancellation_subtype")} AS detail, cancellation_date AS d FROM mt_closed
           WHERE cancellation_datetime IS DISTINCT FROM TIMESTAMP '1980-01-01 00:00:00'
           UNION ALL SELECT {STRIP.format(c="cancellation_subtype")}, incidence_cancellation_date FROM zv_closed)
"""


@query(
    "K20_backoffice_volume",
    with_inputs(
        "mt_generated zv_generated mt_closed zv_closed",
        BACK_OFFICE
        + f"""
SELECT period, (SELECT COUNT(*) FROM got WHERE {in_period("d")} AND country = 'UK') AS received_uk,
       (SELECT COUNT(*) FROM got WHERE {in_period("d")} AND country = 'IRELAND') AS received_ie,
       (SELECT COUNT(*) FROM done WHERE {in_period("d")}) AS closed
FROM periods
""",
        OP,
    ),
)
def backoffice_volume(t):
    out = backoffice.volume(t("mt_generated"), t("zv_generated"), t("mt_closed"), t("zv_closed"), OP)
    return out.select("period", "received_uk", "received_ie", "closed")


@query(
    "K21_sent_to_field",
    with_inputs(
        "mt_generated zv_generated mt_closed zv_closed",
        BACK_OFFICE
        + f"""
SELECT period, {pct_exact("COUNT(CASE WHEN detail = 'OPSE' THEN 1 END)", "COUNT(d)")} AS sent_to_field_pct
FROM periods LEFT JOIN done ON {in_period("d")} GROUP BY period
""",
        OP,
    ),
)
def sent_to_field(t):
    out = backoffice.volume(t("mt_generated"), t("zv_generated"), t("mt_closed"), t("zv_closed"), OP)
    return out.select("period", "sent_to_field_pct")


@query(
    "K22_closing_brackets",
    with_inputs(
        "mt_closed",
        f"""
, timed AS (
    SELECT period, round_even(date_diff('second', incidence_creation_datetime, cancellation_datetime) / 3600.0, 2) AS h
    FROM mt_closed JOIN periods ON {in_period("cancellation_date")}
    WHERE cancellation_datetime IS DISTINCT FROM TIMESTAMP '1980-01-01 00:00:00'
)
SELECT period, COUNT(CASE WHEN h < 24 THEN 1 END) AS in_24h, COUNT(CASE WHEN h >= 24 AND h < 48 THEN 1 END) AS in_48h,
       COUNT(CASE WHEN h >= 48 AND h < 72 THEN 1 END) AS in_72h, COUNT(CASE WHEN h >= 72 AND h < 168 THEN 1 END) AS in_7d,
       COUNT(CASE WHEN h >= 168 OR h IS NULL THEN 1 END) AS over_7d,
       {pct("COUNT(CASE WHEN h <= 48 THEN 1 END)", "COUNT(*)")} AS captured_pct
FROM timed GROUP BY period
""",
        OP,
    ),
)
def closing_brackets(t):
    return backoffice.closing_times(t("mt_closed"), OP)


BASE = """
, active AS (
    SELECT COALESCE(installation_number, '') AS installation_number FROM portfolio
    WHERE panel_group IS DISTINCT FROM 'ERROR' AND (
        (trim(monitoring_status) = 'OP' AND trim(contract_status) IN ('CUEM', 'CUOP', 'GRAT'))
     OR (trim(monitoring_status) = 'STBY' AND trim(contract_status) IN ('CUEM', 'CUOP', 'STBY'))
     OR (trim(monitoring_status) = 'XCAN' AND trim(contract_status) IN ('CUEM', 'CUOP'))
     OR (trim(monitoring_status) IN ('EDOC', 'INST', 'N/A') AND trim(contract_status) = 'CUOP'))
), base AS (
    SELECT COUNT(DISTINCT installation_number) AS panel_base,
           COUNT(DISTINCT CASE WHEN installation_number IN (SELECT COALESCE(ins_no, '') FROM devices WHERE device = 'FG')
                               THEN installation_number END) AS device_base
    FROM active
)
"""


@query("K23_active_portfolio", with_inputs("portfolio devices", BASE + "SELECT * FROM base").replace("\n, active", ", active"))
def active_portfolio(t):
    return backoffice.portfolio_base(t("portfolio"), t("devices"))


@query(
    "K24_backlog_size",
    with_inputs(
        "portfolio devices mt_backlog zv_backlog",
        BASE
        + f"""
SELECT period, p AS panel_backlog, {pct_exact("p", "panel_base")} AS panel_pct,
       d AS device_backlog, {pct_exact("d", "device_base")} AS device_pct
FROM base, (SELECT period,
    (SELECT COUNT(DISTINCT trim(incidence_number)) FROM mt_backlog WHERE {in_period("incidence_creation_date")}) AS p,
    (SELECT COUNT(DISTINCT trim(incidence_number)) FROM zv_backlog WHERE {in_period("incidence_creation_date")}) AS d
    FROM periods) n
""",
        OP,
    ),
)
def backlog_size(t):
    base = backoffice.portfolio_base(t("portfolio"), t("devices"))
    return backoffice.backlog(t("mt_backlog"), t("zv_backlog"), base, OP)


# ---------------------------------------------------------------- service and care

ESCALATED = "COUNT(DISTINCT ticket) + MAX(CASE WHEN n = 1 AND ticket IS NULL THEN 1 ELSE 0 END)"


@query(
    "K25_escalation_sla",
    with_inputs(
        "escalations",
        f"""
SELECT period, {ESCALATED} AS escalations, {pct(distinct("ticket", "h < 24"), ESCALATED)} AS under_24h_pct,
       {pct(distinct("ticket", "h < 48"), ESCALATED)} AS under_48h_pct
FROM periods LEFT JOIN (
    SELECT ticket_number_closed AS ticket, closing_date, 1 AS n,
           round_even(date_diff('second', creation_datetime, closing_date_time) / 3600.0, 2) AS h
    FROM escalations WHERE ticket_problem = 'CVIP' AND NOT COALESCE(starts_with(installation_number_closed, '7'), FALSE)
) t ON {in_period("closing_date")} GROUP BY period
""",
        OP,
    ),
)
def escalation_sla(t):
    return service.escalations(t("escalations"), OP)


# business days by counting calendar days
CALENDAR = f"""
, workdays AS (
    SELECT CAST(d AS DATE) AS d FROM range(TIMESTAMP '1990-01-01', TIMESTAMP '2010-01-01', INTERVAL 1 DAY) t(d)
    WHERE isodow(d) < 6 AND strftime(d, '%Y-%m-%d') NOT IN {listed(HOLIDAYS)}
), pairs AS (<PAIRS>
), spans AS (
    SELECT a, b, CASE WHEN b >= a THEN (SELECT COUNT(*) FROM workdays WHERE d >= a AND d < b)
                      WHEN b < a THEN -(SELECT COUNT(*) FROM workdays WHERE d > b AND d <= a) END AS n
    FROM pairs
)
"""


def calendar(pairs: str) -> str:
    return CALENDAR.replace("<PAIRS>", pairs)


ANSWERED = """
, rated AS (
    SELECT t.*, CASE WHEN fecha_desde_asignacion IS NULL THEN NULL WHEN n < 0 THEN 0 ELSE n END AS wd
    FROM tickets_closed t LEFT JOIN spans ON a = CAST(opening_date AS DATE) AND b = CAST(fecha_desde_asignacion AS DATE)
    WHERE type = 'CANC'
)
"""
UK_T = "pais = 'UK'"
IE_T = "pais = 'IRELAND' AND vstatus = 'CLOSED'"
INTERNAL = "fecha_desde_asignacion IS NULL AND close_employee_id IS NOT NULL"


def answered(country: str) -> str:
    where = f"FROM rated WHERE {in_period('opening_date')} AND {country}"
    return (
        f"(SELECT COUNT(DISTINCT ticker_number) {where} AND wd IN (0, 1, 2))"
        f" + (SELECT COUNT(DISTINCT ticker_number) {where} AND {INTERNAL})"
    )


OPENED = f"(SELECT COUNT(DISTINCT ticker_number) FROM tickets_open WHERE {in_period('opening_date')}"


@query(
    "K26_cancellation_response",
    with_inputs(
        "tickets_open tickets_closed",
        calendar(
            "SELECT DISTINCT CAST(opening_date AS DATE) AS a, CAST(fecha_desde_asignacion AS DATE) AS b FROM tickets_closed"
        )
        + ANSWERED
        + f"""
SELECT period, {OPENED}) AS opened, {answered(UK_T)} AS closed, {OPENED} AND pais = 'IRELAND') AS opened_ie,
       {pct(answered(UK_T), OPENED + ")")} AS response_pct,
       {pct(answered(IE_T), OPENED + " AND pais = 'IRELAND')")} AS response_pct_ie
FROM periods
""",
        OP,
    ),
)
def cancellation_response(t):
    return care.cancellation_response(t("tickets_open"), t("tickets_closed"), OP, HOLIDAYS).drop("beyond_calendar")


@query(
    "K27_ticket_backlog",
    with_inputs(
        "tickets_open",
        f"""
, c AS (SELECT *, CAST(opening_date AS DATE) AS d FROM tickets_open WHERE type = 'CANC')
SELECT period, (SELECT COUNT(DISTINCT ticker_number) FROM c WHERE d BETWEEN s AND e AND closing_date IS NULL) AS backlog,
       (SELECT {pct(distinct("ticker_number", "closing_date IS NULL"), "COUNT(DISTINCT ticker_number)")}
        FROM c WHERE d > e - 30 AND d <= e) AS backlog_pct,
       (SELECT {pct(distinct("ticker_number", "closing_date IS NULL"), "COUNT(DISTINCT ticker_number)")}
        FROM c WHERE d > e - 30 AND d <= e AND pais = 'IRELAND') AS backlog_pct_ie
FROM periods
""",
        OP,
    ),
)
def ticket_backlog(t):
    return care.ticket_backlog(t("tickets_open"), OP)


@query(
    "K28_backlog_age",
    with_inputs(
        "tickets_open",
        calendar("SELECT DISTINCT CAST(opening_date AS DATE) AS a, DATE '2001-08-14' AS b FROM tickets_open")
        + """
SELECT period, (SELECT round_even(AVG(CASE WHEN n < 0 THEN 0 ELSE n END), 2) FROM tickets_open
                JOIN spans ON a = CAST(opening_date AS DATE)
                WHERE type = 'CANC' AND closing_date IS NULL) AS mean_age
FROM periods
""",
        OP,
    ),
)
def backlog_age(t):
    return care.backlog_age(t("tickets_open"), OP, AS_OF, HOLIDAYS).drop("beyond_calendar")


IS_ANSWERED = """(COALESCE(technical_result, '') IN ('Completed', 'Transferred', 'Conferenced')
             OR COALESCE(technical_result_reason, '') = 'AbandonedFromHold')"""
IS_ABANDONED = """(COALESCE(technical_result, '') = 'Abandoned'
             OR COALESCE(technical_result_reason, '') IN ('AbandonedWhileQueued', 'AbandonedWhileRinging'))"""
IS_IRISH = "caller LIKE '08%' AND caller NOT LIKE '080%'"
IXN = "interaction_id"
CARE = f"""
SELECT period, <COLUMNS> FROM periods LEFT JOIN care_calls ON {in_period("start_timestamp")} AND last_vqueue = 'CARE'
GROUP BY period
"""


@query(
    "K29_care_line",
    with_inputs(
        "care_calls",
        CARE.replace(
            "<COLUMNS>",
            f"""COUNT(DISTINCT {IXN}) AS calls,
       {distinct(IXN, IS_ANSWERED + " AND routing_point_time < 40")} AS answered_under_40,
       {pct_exact(distinct(IXN, IS_ANSWERED + " AND routing_point_time < 40"), "COUNT(DISTINCT interaction_id)")} AS under_40_pct,
       {pct_exact(distinct(IXN, IS_ANSWERED + " AND routing_point_time > 120"), "COUNT(DISTINCT interaction_id)")} AS over_120_pct,
       {distinct(IXN, IS_ABANDONED)} AS abandoned,
       {pct_exact(distinct(IXN, IS_ABANDONED + " AND routing_point_time > 10"), "COUNT(DISTINCT interaction_id)")}
           AS abandoned_over_10_pct""",
        ),
        EP,
    ),
)
def care_line(t):
    return care.care_line(t("care_calls"), EP, "CARE").drop("calls_ie", "under_40_pct_ie")


@query(
    "K30_care_line_ie",
    with_inputs(
        "care_calls",
        CARE.replace(
            "<COLUMNS>",
            f"""{distinct(IXN, IS_IRISH)} AS calls_ie,
       {pct_exact(distinct(IXN, IS_IRISH + " AND routing_point_time < 40"), distinct(IXN, IS_IRISH), zero=True)} AS under_40_pct_ie""",
        ),
        EP,
    ),
)
def care_line_ie(t):
    return care.care_line(t("care_calls"), EP, "CARE").select("period", "calls_ie", "under_40_pct_ie")


def ended(kind: str, end: str) -> str:
    return f"COUNT(CASE WHEN type = '{kind}' AND vresolution = '{end}' THEN 1 END)"


@query(
    "K31_desk_retention",
    with_inputs(
        "tickets_closed care_staff",
        f"""
SELECT period, {pct_exact(
    f"{ended('CANC', 'Retained')} + {ended('RECO', 'Retained')} + {ended('CCN', 'Retained')}",
    f"{ended('CANC', 'Retained')} + {ended('RECO', 'Retained')} + {ended('CANC', 'Cancelled')}", zero=True)} AS retention_pct
FROM periods LEFT JOIN (
    SELECT t.* FROM tickets_closed t JOIN care_staff ON close_employee_id = employee_id
    WHERE vstatus IN ('CLOSED', 'ERROR') AND vclosing_id IS DISTINCT FROM 'ERROR'
) t ON {in_period("closing_date")} GROUP BY period
""",
        OP,
    ),
)
def desk_retention(t):
    return care.desk_retention(t("tickets_closed"), t("care_staff"), OP)


@query(
    "K32_onboarding_speed",
    with_inputs(
        "onboarding",
        calendar(
            "SELECT DISTINCT CAST(installation_date AS DATE) AS a, CAST(min_comp_attempt_date AS DATE) AS b FROM onboarding"
        )
        + f"""
, grouped AS (
    SELECT period, n - sign(n) AS days, COUNT(DISTINCT installation_number) AS inst
    FROM onboarding JOIN spans ON a = CAST(installation_date AS DATE) AND b = CAST(min_comp_attempt_date AS DATE)
    JOIN periods ON {in_period("min_comp_attempt_date")}
    GROUP BY ALL
)
SELECT period, CAST(SUM(inst) AS BIGINT) AS installations,
       {pct("SUM(CASE WHEN days < 5 THEN inst ELSE 0 END)", "SUM(inst)")} AS under_5_days_pct
FROM grouped GROUP BY period
""",
        OP,
    ),
)
def onboarding_speed(t):
    return onboarding.onboarding_speed(t("onboarding"), OP, HOLIDAYS).drop("beyond_calendar")


# ---------------------------------------------------------------- self-service

FINALISED = f"(SELECT COUNT(DISTINCT maintenance_id) FROM selfservice_finalised WHERE {in_period('maintenance_closing_date')})"
PROMOTED = f"(SELECT COUNT(maintenance_id) FROM promoted_to_field WHERE {in_period('field_promotion_date')})"
SELF_INPUTS = "selfservice_opened selfservice_finalised selfservice_chasing promoted_to_field"


def self_volume(t):
    return selfservice.volume(*[t(n) for n in SELF_INPUTS.split()], OP)


@query(
    "K33_selfservice_volume",
    with_inputs(
        SELF_INPUTS,
        f"""
SELECT period, (SELECT COUNT(DISTINCT maintenance_id) FROM selfservice_opened WHERE {in_period("creation_date")}) AS opened,
       {FINALISED} AS finalised,
       (SELECT COUNT(maintenance_id) FROM selfservice_chasing WHERE {in_period("order_creation_date")}) AS backlog,
       {PROMOTED} AS promoted
FROM periods
""",
        OP,
    ),
)
def selfservice_volume(t):
    return self_volume(t).drop("to_field_pct")


@query(
    "K34_selfservice_ten_days",
    with_inputs(
        "selfservice_finalised",
        f"""
, timed AS (
    SELECT period, floor(date_diff('second', creation_date, maintenance_closing_date) / 86400.0) AS days
    FROM selfservice_finalised JOIN periods ON {in_period("maintenance_closing_date")}
)
SELECT period, {pct("COUNT(CASE WHEN days <> 0 AND days <= 10 THEN 1 END)", "COUNT(CASE WHEN days <> 0 THEN 1 END)")} AS in_10_days_pct
FROM timed GROUP BY period
""",
        OP,
    ),
)
def selfservice_ten_days(t):
    return selfservice.closed_in_ten_days(t("selfservice_finalised"), OP)


@query(
    "K35_selfservice_to_field",
    with_inputs(
        "selfservice_finalised promoted_to_field",
        f"SELECT period, {pct(PROMOTED, f'({PROMOTED} + {FINALISED})')} AS to_field_pct FROM periods",
        OP,
    ),
)
def selfservice_to_field(t):
    return self_volume(t).select("period", "to_field_pct")


FIELD_TOTAL = (
    f"(SELECT {distinct(CODE, 'NOT ie AND aware')} + {distinct(CODE, 'NOT ie AND NOT aware')} "
    f"FROM done WHERE {in_period('closing_finishing_date')})"
)
EXTRA = f"(SELECT COUNT(DISTINCT {CODE}) FROM accessory_services WHERE {in_period('closing_finishing_date')})"


@query(
    "K36_selfservice_share",
    with_inputs(
        "selfservice_finalised accessory_services services_closed",
        closed_body(LINES_WITH_ACCESSORIES)
        + f"SELECT period, {pct_exact(f'{FINALISED} + {EXTRA}', f'({FINALISED} + {FIELD_TOTAL})')} AS share_pct FROM periods",
        OP,
    ),
)
def selfservice_share(t):
    return selfservice.share_of_field_work(
        t("selfservice_finalised"), t("accessory_services"), t("services_closed"), OP
    )


@query(
    "K37_closed_without_agent",
    with_inputs(
        "selfservice_finalised",
        f"""
SELECT period, {pct_exact("COUNT(*) - COUNT(closing_finishing_identifier)", "COUNT(*)")} AS no_agent_pct
FROM selfservice_finalised JOIN periods ON {in_period("maintenance_closing_date")} GROUP BY period
""",
        OP,
    ),
)
def closed_without_agent(t):
    return selfservice.without_agent(t("selfservice_finalised"), OP)


@query(
    "K38_promoted_share",
    with_inputs(
        "notices_sent notices_promoted maintained maintained_finalised",
        f"""
, sent AS (SELECT * FROM notices_sent UNION ALL SELECT * FROM notices_promoted)
, newest AS (SELECT sent.* FROM sent JOIN (SELECT contract, MAX(notice) AS notice FROM sent GROUP BY contract) m
             ON sent.contract = m.contract AND sent.notice = m.notice)
, services AS (SELECT * FROM maintained UNION ALL SELECT * FROM maintained_finalised)
, n AS (SELECT period, (SELECT COUNT(DISTINCT notice) FROM newest WHERE {in_period("notice_close_date")}) AS notices,
               (SELECT COUNT(DISTINCT service_code) FROM services WHERE {in_period("closed")}) AS services FROM periods)
SELECT period, notices, services, notices + services AS total, {pct("notices", "notices + services")} AS promoted_pct
FROM n
""",
        OP,
    ),
)
def promoted_share(t):
    return selfservice.promoted_share(
        t("notices_sent"), t("notices_promoted"), t("maintained"), t("maintained_finalised"), OP
    )


# ---------------------------------------------------------------- report

DEPLOYMENT = report.Deployment(
    service_queues=UK_QUEUES,
    service_queues_ie=IE_QUEUES,
    alarm_queues=ALARM_QUEUES,
    support_department="Technical",
    support_queue_left_out="NATION_2",
    chat_queues=CHAT_QUEUES,
    message_queues=MESSAGE_QUEUES,
    message_routing_queues=ROUTING_QUEUES,
    care_queue="CARE",
    retention_technicians=TECHNICIANS,
    work_call_types=WORK_CALL_TYPES,
    organisation_parts=("Customer Service Team",),
    organisation_parts_left_out=("South",),
    managers_left_out=("Manager 7",),
    holidays=HOLIDAYS,
    care_holidays=HOLIDAYS,
    contact_windows=WINDOWS,
)
# The report's rows, by their zero-based number, with the query whose SQL gives the figure.
REPORT_ROWS = (
    (6, "alarm_incidences", "alarm", "UK", "K11_alarm_volume", "incidences_uk", "count"),
    (7, "alarm_agent_incidences", "alarm", "UK", "K11_alarm_volume", "agent_uk", "count"),
    (8, "alarm_automated_pct", "alarm", "UK", "K11_alarm_volume", "automated_pct_uk", "pct"),
    (9, "alarm_incidences_ie", "alarm", "IE", "K11_alarm_volume", "incidences_ie", "count"),
    (10, "alarm_agent_incidences_ie", "alarm", "IE", "K11_alarm_volume", "agent_ie", "count"),
    (12, "alarm_under_60_pct", "alarm", "UK", "K12_alarm_response", "under_60_pct_uk", "pct"),
    (13, "alarm_over_180_pct", "alarm", "UK", "K12_alarm_response", "over_180_pct_uk", "pct"),
    (14, "alarm_under_60_pct_ie", "alarm", "IE", "K12_alarm_response", "under_60_pct_ie", "pct"),
    (15, "alarm_over_180_pct_ie", "alarm", "IE", "K12_alarm_response", "over_180_pct_ie", "pct"),
    (17, "alarm_calls", "alarm", "UK", "K03_alarm_call_sla", "accepted", "count"),
    (18, "alarm_calls_under_40_pct", "alarm", "UK", "K03_alarm_call_sla", "under_40_pct", "pct"),
    (20, "guard_callouts", "alarm", "UK", "K14_guard_callouts", "guard_callouts", "count"),
    (21, "guard_under_40_min_pct", "alarm", "UK", "K14_guard_callouts", "under_40_min_pct", "pct"),
    (22, "police_callouts", "alarm", "UK", "K15_police_callouts", "police_callouts", "count"),
    (24, "repeat_alarm_pct", "alarm", "UK", "K13_repeat_alarm", "repeat_alarm_pct", "pct"),
    (26, "service_calls", "service", "UK", "K01_queue_sla", "accepted", "count"),
    (27, "service_calls_under_40_pct", "service", "UK", "K01_queue_sla", "under_40_pct", "pct"),
    (28, "service_calls_over_120_pct", "service", "UK", "K01_queue_sla", "over_120_pct", "pct"),
    (29, "service_calls_abandoned_pct", "service", "UK", "K01_queue_sla", "abandoned_pct", "pct"),
    (30, "service_calls_ie", "service", "IE", "K01_queue_sla_ie", "accepted", "count"),
    (31, "service_calls_under_40_pct_ie", "service", "IE", "K01_queue_sla_ie", "under_40_pct", "pct"),
    (33, "chats", "service", "UK", "K08_chat_sla", "chats", "count"),
    (34, "chats_under_60_pct", "service", "UK", "K08_chat_sla", "under_60_pct", "pct"),
    (35, "chats_over_120_pct", "service", "UK", "K08_chat_sla", "over_120_pct", "pct"),
    (37, "messages", "service", "UK", "K10_message_sla", "messages", "count"),
    (38, "messages_within_180_pct", "service", "UK", "K10_message_sla", "within_180_pct", "pct"),
    (40, "escalations", "service", "UK", "K25_escalation_sla", "escalations", "count"),
    (41, "escalations_under_24h_pct", "service", "UK", "K25_escalation_sla", "under_24h_pct", "pct"),
    (42, "escalations_under_48h_pct", "service", "UK", "K25_escalation_sla", "under_48h_pct", "pct"),
    (44, "first_contact_resolution_pct", "service", "UK", "K04_first_contact_resolution", "fcr_pct", "pct"),
    (45, "repeat_contact_pct", "service", "UK", "K05_repeat_contact", "repeat_pct", "pct"),
    (47, "field_opened", "field", "UK", "K16_opened_services", "opened_uk", "count"),
    (48, "field_finalised", "field", "UK", "K17_closed_services", "finalised", "count"),
    (49, "field_aware", "field", "UK", "K17_closed_services", "aware", "count"),
    (50, "field_not_aware", "field", "UK", "K17_closed_services", "not_aware", "count"),
    (51, "field_opened_ie", "field", "IE", "K16_opened_services", "opened_ie", "count"),
    (53, "field_aware_7_days_pct", "field", "UK", "K18_closing_sla", "aware_in_time_pct", "pct"),
    (54, "field_not_aware_30_days_pct", "field", "UK", "K18_closing_sla", "not_aware_in_time_pct", "pct"),
    (55, "field_aware_7_days_pct_ie", "field", "IE", "K18_closing_sla", "aware_in_time_pct_ie", "pct"),
    (57, "schedule_adherence_pct", "field", "UK", "K41_schedule_adherence", "adherence_pct", "pct"),
    (59, "first_time_fix_pct", "field", "UK", "K39_first_time_fix", "first_time_fix_pct", "pct"),
    (61, "field_backlog_pct", "field", "UK", "K40_field_backlog", "backlog_pct", "pct"),
    (62, "field_backlog_aware", "field", "UK", "K40_field_backlog", "aware", "count"),
    (63, "field_backlog_aware_age", "field", "UK", "K40_field_backlog", "aware_age", "days"),
    (64, "field_backlog_not_aware", "field", "UK", "K40_field_backlog", "not_aware", "count"),
    (65, "field_backlog_not_aware_age", "field", "UK", "K40_field_backlog", "not_aware_age", "days"),
    (67, "tickets_opened", "care", "UK", "K26_cancellation_response", "opened", "count"),
    (68, "tickets_closed", "care", "UK", "K26_cancellation_response", "closed", "count"),
    (69, "tickets_opened_ie", "care", "IE", "K26_cancellation_response", "opened_ie", "count"),
    (71, "ticket_response_pct", "care", "UK", "K26_cancellation_response", "response_pct", "pct"),
    (72, "ticket_response_pct_ie", "care", "IE", "K26_cancellation_response", "response_pct_ie", "pct"),
    (74, "care_answered_under_40", "care", "UK", "K29_care_line", "answered_under_40", "count"),
    (75, "care_under_40_pct", "care", "UK", "K29_care_line", "under_40_pct", "pct"),
    (76, "care_over_120_pct", "care", "UK", "K29_care_line", "over_120_pct", "pct"),
    (77, "care_abandoned", "care", "UK", "K29_care_line", "abandoned", "count"),
    (78, "care_abandoned_over_10_pct", "care", "UK", "K29_care_line", "abandoned_over_10_pct", "pct"),
    (79, "care_calls_ie", "care", "IE", "K30_care_line_ie", "calls_ie", "count"),
    (80, "care_under_40_pct_ie", "care", "IE", "K30_care_line_ie", "under_40_pct_ie", "pct"),
    (82, "ticket_backlog", "care", "UK", "K27_ticket_backlog", "backlog", "count"),
    (83, "ticket_backlog_pct", "care", "UK", "K27_ticket_backlog", "backlog_pct", "pct"),
    (84, "ticket_backlog_age", "care", "UK", "K28_backlog_age", "mean_age", "days"),
    (85, "ticket_backlog_pct_ie", "care", "IE", "K27_ticket_backlog", "backlog_pct_ie", "pct"),
    (87, "desk_retention_pct", "care", "UK", "K31_desk_retention", "retention_pct", "pct"),
    (88, "field_retention_pct", "care", "UK", "K19_field_retention", "retention_pct", "pct"),
    (91, "onboarding_installations", "onboarding", "UK", "K32_onboarding_speed", "installations", "count"),
    (93, "onboarding_under_5_days_pct", "onboarding", "UK", "K32_onboarding_speed", "under_5_days_pct", "pct"),
    (95, "selfservice_opened", "selfservice", "UK", "K33_selfservice_volume", "opened", "count"),
    (96, "selfservice_finalised", "selfservice", "UK", "K33_selfservice_volume", "finalised", "count"),
    (98, "selfservice_share_of_field_pct", "selfservice", "UK", "K36_selfservice_share", "share_pct", "pct"),
    (99, "selfservice_no_agent_pct", "selfservice", "UK", "K37_closed_without_agent", "no_agent_pct", "pct"),
    (101, "selfservice_backlog", "selfservice", "UK", "K33_selfservice_volume", "backlog", "count"),
    (103, "selfservice_to_field_pct", "selfservice", "UK", "K35_selfservice_to_field", "to_field_pct", "pct"),
    (105, "backoffice_received", "backoffice", "UK", "K20_backoffice_volume", "received_uk", "count"),
    (106, "backoffice_sent_to_field_pct", "backoffice", "UK", "K21_sent_to_field", "sent_to_field_pct", "pct"),
    (107, "backoffice_received_ie", "backoffice", "IE", "K20_backoffice_volume", "received_ie", "count"),
    (111, "backoffice_panel_backlog", "backoffice", "UK", "K24_backlog_size", "panel_backlog", "count"),
    (112, "backoffice_panel_backlog_pct", "backoffice", "UK", "K24_backlog_size", "panel_pct", "pct"),
    (113, "backoffice_device_backlog", "backoffice", "UK", "K24_backlog_size", "device_backlog", "count"),
    (114, "backoffice_device_backlog_pct", "backoffice", "UK", "K24_backlog_size", "device_pct", "pct"),
    (116, "support_calls", "support", "UK", "K02_department_sla", "accepted", "count"),
    (118, "support_calls_under_40_pct", "support", "UK", "K02_department_sla", "under_40_pct", "pct"),
    (119, "support_calls_abandoned_pct", "support", "UK", "K02_department_sla", "abandoned_pct", "pct"),
    (121, "faq_adherence_pct", "support", "UK", "K07_faq_adherence", "adherence_pct", "pct"),
)
EVENT_PARTS = {"alarms", "guards", "police", "chats", "messages", "contacts", "care_line", "faq"}
ORDER_PARTS = {
    "calls", "escalations", "opened_services", "adherence", "first_time_fix", "field_backlog", "tickets",
    "desk_retention", "field_retention", "onboarding", "work", "backoffice", "backoffice_backlog",
}
PERIODS = {**dict.fromkeys(EVENT_PARTS, EP), **dict.fromkeys(ORDER_PARTS, OP)}


def parts_of(t):
    return report.report_parts(t.raw, PERIODS, DEPLOYMENT, AS_OF)


def long_sql(printed: bool = False) -> str:
    """The measures' own SQL, one row per measure and period; as printed, without roundings that only
    the comparison of numbers needs."""
    from catalog.registry import ORACLES

    def value(key: str, column: str) -> tuple[str, str]:
        if not printed:
            return f"round_even(CAST({column} AS DOUBLE), 6)", ORACLES[key]
        body = ORACLES[key]
        if "* 100, 9)" in body:
            body = body.replace("* 100, 9)", "* 100)").replace("round_even(CO", "(CO")
        return f"CAST({column} AS DOUBLE)", body

    rows = []
    for row, kpi, area, region, key, column, unit in REPORT_ROWS:
        shown, body = value(key, column)
        rows.append(
            f"SELECT {row} AS row, '{kpi}' AS kpi_id, '{area}' AS area, '{region}' AS region, "
            f"{shown} AS value, '{unit}' AS unit, period FROM ({body})"
        )
    return "\nUNION ALL\n".join(rows)


@query("K42_report", long_sql())
def report_long(t):
    return report.report(parts_of(t)).withColumn("value", round_even(F.col("value"), 6)).drop("note")


@query(
    "K42_report_pivot",
    f"""
SELECT row, kpi_id, area, region, {", ".join(f'''MAX(CASE WHEN period = '{p.label}' THEN
       CASE unit WHEN 'pct' THEN CAST(value AS VARCHAR) || '%'
                 WHEN 'count' THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END END) AS "{p.label}"'''
    for p in OP)}
FROM ({long_sql(printed=True)}) GROUP BY ALL
""",
)
def report_pivot(t):
    return report.pivot(report.report(parts_of(t)), [p.label for p in OP])
