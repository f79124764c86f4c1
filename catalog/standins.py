"""The logical inputs, derived from the test tables.

Each text is plain SQL that both Spark and DuckDB read, so the two sides of a comparison
start from the same input. Every input keeps all rows of its table; only the staff list names
some of the suppliers. Nulls, padding and dirty codes are put into values, by the same
expression on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsgauge.operators.periods import Period
from opsgauge.session import apply_settings
from opsgauge.sources.schemas import conform

EVENT_PERIODS = (
    Period("Week", "2024-01-08", "2024-01-14"),
    Period("Month", "2024-01-01", "2024-01-28"),
    Period("Span", "2024-01-01", "2024-01-30"),
)
ORDER_PERIODS = (
    Period("Week", "1998-03-02", "1998-03-08"),
    Period("Month", "1998-03-01", "1998-03-31"),
    Period("Span", "1995-01-01", "2001-11-10"),
)
AS_OF = "2001-08-15"
HOLIDAYS = (
    "1994-12-26", "1995-05-29", "1996-01-01", "1996-12-25", "1996-12-26", "1998-01-01", "1998-03-06", "1998-03-07",
    "1998-12-25", "2000-05-29", "2001-12-25", "2002-01-01",
)

# lineitem with its order: services, tickets and visits
SERVICES = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate, o_custkey, o_orderstatus, o_orderdate,
       o_orderpriority
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

STANDINS = {
    "queue_calls": """
SELECT l_shipdate AS report_date, CAST(year(l_shipdate) AS INT) AS report_year,
       CAST(month(l_shipdate) AS INT) AS report_month,
       CAST(l_linenumber AS STRING) AS interval_30min,
       CAST(l_quantity AS BIGINT) + l_linenumber AS service_received,
       CAST(l_quantity AS BIGINT) AS accepted_agent,
       CAST(floor(l_quantity * (1 - l_discount)) AS BIGINT) AS accepted_under40sec,
       CAST(l_linenumber AS BIGINT) AS abandoned_waiting_higher10sec,
       CAST(floor(l_quantity * l_tax) AS BIGINT) AS accepted_over120sec,
       n_name AS calls_queue
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
""",
    "queues": """
SELECT n_name AS queues, r_name AS skills,
       CASE WHEN n_regionkey < 3 THEN 'Technical' ELSE 'Service' END AS departments,
       'voice' AS media_type, CASE WHEN n_nationkey IN (3, 14) THEN NULL ELSE r_name END AS manager
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
""",
    "agents": """
SELECT CAST(s_suppkey AS STRING) AS employee_id,
       CASE WHEN s_acctbal > 0 THEN 'Active' ELSE 'Left' END AS formula1,
       CASE WHEN s_nationkey < 15 THEN 'Customer SERVICE Team (North desk)'
            WHEN s_nationkey < 20 THEN 'customer service team (south desk)'
            WHEN s_nationkey < 23 THEN NULL ELSE 'Field team' END AS supervisory_organization,
       CASE WHEN s_nationkey = 7 THEN 'Manager 7' WHEN s_nationkey = 8 THEN NULL ELSE 'Manager' END
           AS worker_s_manager
FROM {supplier}
""",
    "contact_logs": """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE CAST(user_id AS STRING) || '-' || CAST(event_id % 12 AS STRING) END AS installation_number,
       (event_id * 7919) % 1000003 AS comm_log_number, ts AS creation_date,
       ts AS creation_date_hour,
       CASE event_type WHEN 'click' THEN 'CS' WHEN 'view' THEN 'CUDE' WHEN 'signup' THEN 'CUSV'
                       WHEN 'purchase' THEN 'ATT' ELSE 'OTHER' END AS creation_source,
       CASE WHEN event_id % 31 = 0 THEN 'Automatic' WHEN event_id % 37 = 0 THEN NULL
            ELSE CAST(event_id % 61 AS STRING) END AS creation_id,
       CASE event_id % 4 WHEN 0 THEN '   ' WHEN 1 THEN 'CHA' WHEN 2 THEN 'PHO' ELSE 'EMA' END
           AS creation_media,
       CASE WHEN event_id % 19 = 0 THEN 'Outgoing' ELSE 'Incoming' END AS creation_direction,
       CASE WHEN user_id % 11 = 4 THEN 'IRELAND' ELSE 'UK' END AS country,
       CASE WHEN value < 10 THEN NULL ELSE 'ONE' END AS code_key_one,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS code_key_two,
       CASE WHEN event_id % 23 = 0 THEN 'GDPR' WHEN event_id % 5 = 0 THEN NULL
            ELSE CAST(event_id % 3 AS STRING) END AS code_key_three
FROM {events}
""",
    "chats": """
SELECT ts AS report_date, CAST(user_id AS STRING) AS agent_id, CAST(hour(ts) AS INT) AS chat_hour,
       event_type AS chat_queue,
       CAST(user_id AS STRING) || '/' || CAST(CAST(ts AS DATE) AS STRING) AS interaction_id,
       CAST(event_id % 4 AS INT) AS flag_rerouted,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) + 20 END AS response_time,
       event_id % 20 AS queue_time
FROM {events}
""",
    "emails": """
SELECT ts AS report_day, CAST(user_id AS STRING) AS employee_id, CAST(event_id AS STRING) AS interaction_id,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(floor(value * 1500) AS BIGINT) END
           AS interaction_duration,
       event_id % 900 AS email_response_time, CAST(event_id % 2 AS INT) AS stop_action,
       event_type AS report_queue
FROM {events}
""",
    "messages": """
SELECT CASE WHEN event_id % 101 = 0 THEN NULL
            ELSE CAST(user_id AS STRING) || '/' || CAST(CAST(ts AS DATE) AS STRING) END AS ixn_id,
       ts AS ini_resource_time, CAST(floor(value * 5) AS BIGINT) AS mediation_time,
       event_type AS queue_workbin, event_id % 30 AS queue_workbin_duration
FROM {events}
""",
    "faq": """
SELECT ts AS date, CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'form' END AS created,
       CASE event_type WHEN 'click' THEN 'FSE' WHEN 'view' THEN 'Installer' ELSE event_type END
           AS fse_installer,
       CASE WHEN value < 30 THEN 'x' END AS faqable, CASE WHEN value >= 25 THEN 'x' END AS not_faqable
FROM {events}
""",
    "alarm_incidences": """
SELECT CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS incidence_number,
       CAST(user_id AS STRING) AS installation_number, ts AS incidence_creation_date,
       CASE WHEN event_id % 3 = 0 THEN 'TA' || chr(9) ELSE ' AL ' END AS incidence_type,
       CASE event_id % 5 WHEN 0 THEN 'CONFIA  ' WHEN 1 THEN 'CONFORT' WHEN 2 THEN NULL ELSE 'OTHER' END
           AS cancellation_type,
       CASE event_id % 7 WHEN 0 THEN 'INTIME' WHEN 1 THEN ' TAMRES' WHEN 2 THEN 'RETREP' || chr(10)
                         WHEN 3 THEN NULL ELSE 'REST' END AS cancellation_subtype,
       CASE WHEN user_id % 10 < 7 THEN ' UK' ELSE 'IRELAND ' END AS country,
       CASE event_id % 3 WHEN 0 THEN 'SDVECU' WHEN 1 THEN 'SDVFAST ' ELSE 'OLD' END AS panel,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(floor(value * 3) AS INT) END AS tm_attended
FROM {events}
""",
    "guard_callouts": """
SELECT CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS callout_id,
       CASE WHEN event_id % 41 = 0 THEN 'not known'
            ELSE substr(CAST(CAST(ts AS DATE) AS STRING), 9, 2) || '/'
                 || substr(CAST(CAST(ts AS DATE) AS STRING), 6, 2) || '/'
                 || substr(CAST(CAST(ts AS DATE) AS STRING), 1, 4) || ' 11:30:00' END
           AS callout_created_at,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id % 3 <> 0 END AS responder_dispatch_completed,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 14 = 0 THEN 0 ELSE value * 60 END
           AS avg_true_resp_time
FROM {events}
""",
    "police": """
SELECT ts AS incidence_creation_date, CASE WHEN user_id % 5 = 0 THEN 'IRELAND' ELSE 'UK' END AS country,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END AS total_incidences_with_police_net
FROM {events}
""",
    "services_opened": """
SELECT CAST(l_orderkey AS STRING) AS code_maintenance_ibs, CAST(l_partkey AS STRING) AS installation_number,
       l_shipdate AS creating_date,
       CASE l_linenumber WHEN 1 THEN ' UK270' WHEN 2 THEN 'UK191 ' WHEN 3 THEN 'UK330' WHEN 4 THEN NULL
                         ELSE 'UK999' END AS installation_cost_center_code,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_quantity * 3 AS INT) END AS days_install_to_creation,
       CASE l_returnflag WHEN 'A' THEN '100' WHEN 'N' THEN 'MOVE' ELSE NULL END AS call_type_code
FROM {lineitem}
""",
    "services_closed": """
SELECT CAST(l_orderkey AS STRING) AS code_maintenance_ibs,
       CASE WHEN l_partkey % 50 = 0 THEN '0' ELSE CAST(l_partkey AS STRING) END AS installation_number,
       o_orderdate AS creating_date, l_shipdate AS closing_finishing_date,
       CASE l_returnflag WHEN 'A' THEN 'FINL' WHEN 'N' THEN 'CERR' ELSE 'FINL' END AS status_maintenance,
       CASE l_linenumber WHEN 1 THEN '230020.0' WHEN 2 THEN ' 270009' WHEN 3 THEN '265009'
                         WHEN 4 THEN NULL WHEN 5 THEN '270026' ELSE '270025' END AS technician_line_code,
       CASE WHEN l_linestatus = 'O' THEN 'GTI' WHEN l_linenumber = 2 THEN NULL ELSE 'CUST' END AS req_by,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Installations' WHEN '2-HIGH' THEN NULL
                            ELSE 'Repair' END AS activity_type,
       CASE o_orderstatus WHEN 'O' THEN 'MOVE' WHEN 'P' THEN 'ROBB'
            ELSE CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '100' ELSE 'TECH' END
            END AS call_type_code
FROM ({services}) s
""",
    "field_retention": """
SELECT CAST(l_orderkey AS STRING) AS code_maintenance_ibs, CAST(l_partkey AS STRING) AS installation_number,
       l_shipdate AS closing_finishing_date,
       CASE WHEN l_linestatus = 'O' OR l_linenumber < 5 THEN 'FINL' ELSE 'OPEN' END AS status_maintenance,
       'T' || CAST(l_linenumber AS STRING) AS technician_identifier,
       CASE l_returnflag WHEN 'A' THEN 'NOT RETAINED'
            WHEN 'N' THEN CASE WHEN l_discount > 0.07 THEN 'RETAINED' ELSE NULL END
            ELSE 'PENDING' END AS customer_retained,
       CASE WHEN l_tax > 0.06 THEN 'RETI TAKEOVER' WHEN l_tax > 0.03 THEN 'OTHER' END AS reti
FROM {lineitem}
""",
    "mt_generated": """
SELECT CAST(o_orderkey AS STRING) AS incidence_number, o_orderdate AS incidence_creation_date,
       CASE o_orderstatus WHEN 'F' THEN ' UK ' WHEN 'O' THEN 'IRELAND' || chr(10) ELSE NULL END AS country
FROM {orders}
""",
    "zv_generated": """
SELECT CAST(l_orderkey AS STRING) AS incidence_number, l_shipdate AS incidence_creation_date,
       CASE l_returnflag WHEN 'A' THEN 'UK' WHEN 'N' THEN chr(9) || 'IRELAND' ELSE 'OTHER' END AS country
FROM {lineitem}
""",
    "mt_closed": """
SELECT CAST(l_orderkey AS STRING) AS incidence_number, l_shipdate AS cancellation_date,
       CASE WHEN l_suppkey % 13 = 0 THEN TIMESTAMP '1980-01-01 00:00:00' WHEN l_suppkey % 17 = 0 THEN NULL
            ELSE l_shipdate END AS cancellation_datetime,
       o_orderdate AS incidence_creation_datetime,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'OPSE  ' WHEN '2-HIGH' THEN NULL ELSE 'CUST' END
           AS cancellation_subtype
FROM ({services}) s
""",
    "zv_closed": """
SELECT CAST(o_orderkey AS STRING) AS incidence_number, o_orderdate AS incidence_cancellation_date,
       CASE o_orderstatus WHEN 'F' THEN ' OPSE' WHEN 'O' THEN NULL ELSE 'CUST' END AS cancellation_subtype
FROM {orders}
""",
    "mt_backlog": """
SELECT CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE ' ' || CAST(o_custkey AS STRING) END AS incidence_number,
       o_orderdate AS incidence_creation_date
FROM {orders}
""",
    "zv_backlog": """
SELECT CAST(l_orderkey AS STRING) || ' ' AS incidence_number, l_shipdate AS incidence_creation_date
FROM {lineitem}
""",
    "portfolio": """
SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS installation_number,
       CASE c_mktsegment WHEN 'BUILDING' THEN ' OP' WHEN 'FURNITURE' THEN 'STBY '
            WHEN 'MACHINERY' THEN 'XCAN' WHEN 'HOUSEHOLD' THEN 'EDOC' ELSE 'GONE' END AS monitoring_status,
       CASE WHEN c_nationkey < 6 THEN 'CUEM' WHEN c_nationkey < 12 THEN ' CUOP'
            WHEN c_nationkey < 16 THEN 'GRAT' WHEN c_nationkey < 20 THEN 'STBY' ELSE NULL END
           AS contract_status,
       CASE WHEN c_nationkey % 4 = 0 THEN 'ERROR' WHEN c_nationkey % 4 = 1 THEN NULL ELSE 'PANEL' END
           AS panel_group
FROM {customer}
""",
    "devices": """
SELECT CASE WHEN o_custkey % 89 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS ins_no,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'FG' ELSE 'DT' END AS device
FROM {orders}
""",
    "escalations": """
SELECT CASE WHEN l_partkey % 301 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS ticket_number_closed,
       CAST(l_partkey AS STRING) AS installation_number_closed,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'CVIP' ELSE 'REST' END AS ticket_problem,
       l_shipdate AS closing_date, l_shipdate + l_linenumber * INTERVAL '3' HOUR AS closing_date_time,
       o_orderdate AS creation_datetime
FROM ({services}) s
""",
    "tickets_open": """
SELECT CAST(l_orderkey AS STRING) AS ticker_number, l_shipdate AS opening_date,
       CASE WHEN l_linenumber < 4 THEN NULL ELSE l_shipdate END AS closing_date,
       CASE l_returnflag WHEN 'A' THEN 'CANC' WHEN 'N' THEN 'RECO' ELSE 'CANC' END AS type,
       CASE WHEN l_linestatus = 'O' THEN 'UK' ELSE 'IRELAND' END AS pais
FROM {lineitem}
""",
    "tickets_closed": """
SELECT CAST(l_orderkey AS STRING) AS ticker_number, o_orderdate AS opening_date, l_shipdate AS closing_date,
       CASE WHEN l_linenumber = 1 THEN NULL
            ELSE o_orderdate + (l_linenumber - 3) * INTERVAL '1' DAY END AS fecha_desde_asignacion,
       CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS close_employee_id,
       CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'ERROR' ELSE 'CLOSED' END AS vstatus,
       CASE WHEN l_linenumber = 7 THEN 'ERROR' WHEN l_linenumber = 6 THEN NULL ELSE 'OK' END AS vclosing_id,
       CASE WHEN l_discount < 0.04 THEN 'Retained' WHEN l_discount < 0.08 THEN 'Cancelled' END AS vresolution,
       CASE l_returnflag WHEN 'A' THEN 'CANC' WHEN 'N' THEN 'RECO' ELSE
            CASE WHEN l_tax < 0.03 THEN 'CCN' ELSE 'CANC' END END AS type,
       CASE WHEN l_linestatus = 'O' THEN 'UK' ELSE 'IRELAND' END AS pais
FROM ({services}) s
""",
    "care_calls": """
SELECT CAST(user_id AS STRING) || '/' || CAST(CAST(ts AS DATE) AS STRING) AS interaction_id,
       ts AS start_timestamp, CASE WHEN event_type = 'signup' THEN 'OTHER' ELSE 'CARE' END AS last_vqueue,
       CASE event_id % 6 WHEN 0 THEN 'Completed' WHEN 1 THEN 'Transferred' WHEN 2 THEN 'Abandoned'
                         WHEN 3 THEN NULL WHEN 4 THEN 'Conferenced' ELSE 'Other' END AS technical_result,
       CASE event_id % 7 WHEN 0 THEN 'AbandonedFromHold' WHEN 1 THEN 'AbandonedWhileQueued'
                         WHEN 2 THEN 'AbandonedWhileRinging' WHEN 3 THEN NULL ELSE 'Other' END
           AS technical_result_reason,
       CASE WHEN user_id % 4 = 0 THEN '08' || CAST(user_id AS STRING) WHEN user_id % 4 = 1 THEN '0800'
            WHEN user_id % 4 = 2 THEN NULL ELSE '07' END AS caller,
       CAST(floor(value) AS BIGINT) AS routing_point_time
FROM {events}
""",
    "care_staff": """
SELECT CAST(s_suppkey AS STRING) AS employee_id FROM {supplier} WHERE s_acctbal > 2000
UNION ALL
SELECT CAST(s_suppkey AS STRING) AS employee_id FROM {supplier} WHERE s_acctbal > 7000
""",
    "onboarding": """
SELECT CAST(l_partkey AS STRING) AS installation_number, o_orderdate AS installation_date,
       CASE WHEN l_suppkey % 19 = 0 THEN NULL
            ELSE o_orderdate + (l_linenumber * 3 - 6) * INTERVAL '1' DAY END AS min_comp_attempt_date
FROM ({services}) s
""",
    "selfservice_opened": """
SELECT CAST(o_custkey AS STRING) AS maintenance_id, o_orderdate AS creation_date FROM {orders}
""",
    "selfservice_finalised": """
SELECT CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS maintenance_id,
       o_orderdate AS creation_date,
       CASE WHEN l_linenumber = 1 THEN o_orderdate + INTERVAL '5' HOUR
            WHEN l_linenumber < 4 THEN o_orderdate + l_suppkey % 20 * INTERVAL '15' HOUR
            ELSE l_shipdate END AS maintenance_closing_date,
       CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS closing_finishing_identifier
FROM ({services}) s
""",
    "selfservice_chasing": """
SELECT CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS maintenance_id,
       o_orderdate AS order_creation_date
FROM {orders}
""",
    "promoted_to_field": """
SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey AS STRING) END AS maintenance_id,
       o_orderdate AS field_promotion_date
FROM {orders}
""",
    "accessory_services": """
SELECT CAST(l_orderkey AS STRING) AS code_maintenance_ibs, l_shipdate AS closing_finishing_date
FROM {lineitem}
""",
    "field_backlog": """
SELECT CASE WHEN l_partkey % 173 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS code_maintenance_ibs,
       CASE WHEN l_partkey % 50 = 0 THEN '0' ELSE CAST(l_partkey AS STRING) END AS installation_number,
       l_shipdate AS creating_date,
       CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linestatus = 'O' THEN 'GTI' ELSE 'CUST' END AS req_by,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS age,
       CASE WHEN l_returnflag = 'A' THEN 'IRELAND' ELSE 'UK' END AS country,
       CASE WHEN l_linenumber = 1 THEN TIMESTAMP '2001-08-12 06:00:00'
            ELSE TIMESTAMP '2001-08-13 06:00:00' END AS audit_insert_timestamp
FROM {lineitem}
""",
    "installation_snapshot": """
SELECT CAST(c_custkey AS STRING) AS installation_number,
       CASE WHEN c_nationkey = 0 THEN TIMESTAMP '2001-08-06 06:00:00'
            ELSE TIMESTAMP '2001-08-13 06:00:00' END AS audit_insert_timestamp
FROM {customer}
""",
    "schedule_changed": """
SELECT l_shipdate AS date, CASE l_linenumber WHEN 1 THEN 'IE1' WHEN 2 THEN 'IN2' WHEN 3 THEN NULL
                                             ELSE 'SE' END AS wzprefix,
       CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'N' THEN 'started' ELSE NULL END AS d1_service_status,
       CASE WHEN l_partkey % 91 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS service_number,
       CASE WHEN l_linestatus = 'O' THEN 'Removed' ELSE 'Added' END AS compare
FROM {lineitem}
""",
    "schedule_unchanged": """
SELECT o_orderdate AS date, CASE o_orderstatus WHEN 'F' THEN 'IE' WHEN 'O' THEN 'SE' END AS wzprefix,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'completed' WHEN '2-HIGH' THEN 'suspended'
            WHEN '3-MEDIUM' THEN 'notdone' WHEN '5-LOW' THEN 'pending' END AS d1_service_status,
       CAST(o_orderkey AS STRING) AS service_number
FROM {orders}
""",
    "notices_sent": """
SELECT CAST(o_custkey AS STRING) AS contract, o_orderkey AS notice, o_orderdate AS notice_close_date FROM {orders}
""",
    "notices_promoted": """
SELECT CAST(l_suppkey AS STRING) AS contract_number, l_orderkey AS notice_number, l_shipdate AS closed_on
FROM {lineitem}
""",
    "maintained": """
SELECT CAST(l_orderkey AS STRING) AS service_code, o_orderdate AS created, l_shipdate AS closed
FROM ({services}) s
""",
    "maintained_finalised": """
SELECT 'F' || CAST(o_orderkey AS STRING) AS code, o_orderdate AS opened_on, o_orderdate AS closed_on FROM {orders}
""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# These two stand for lists with other headers, which a positional union overwrites.
OTHER_HEADERS = ("notices_promoted", "maintained_finalised")


class Inputs:
    """The test tables and the logical inputs over them, as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._read = spark, sf_dir, {}
        apply_settings(spark)

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def sql(self, text: str) -> DataFrame:
        text = text.replace("{services}", SERVICES)
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def raw(self, name: str) -> DataFrame:
        return self.sql(STANDINS[name])

    def __call__(self, name: str) -> DataFrame:
        raw = self.raw(name)
        return raw if name in OTHER_HEADERS else conform(raw, name)


def plain_sql(text: str) -> str:
    """The text with table names in place of the placeholders."""
    text = text.replace("{services}", SERVICES)
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def with_inputs(names: str, body: str, periods: tuple[Period, ...] | None = None) -> str:
    """SQL with the named inputs, and the periods as a table, in front of a query."""
    parts = [f"{n} AS ({plain_sql(STANDINS[n]).strip()})" for n in names.split()]
    if periods:
        rows = ", ".join(f"('{p.label}', DATE '{p.start}', DATE '{p.end}')" for p in periods)
        parts.append(f"periods(period, s, e) AS (VALUES {rows})")
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return plain_sql(head + body.strip())
