"""The operators as registered queries, each with SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.measures import AS_OF, HOLIDAYS, OP, calendar, in_period, listed
from catalog.registry import query
from catalog.standins import with_inputs
from opsgauge import fixed_values as V
from opsgauge.functions import bizdays, clock, ratio, text
from opsgauge.functions.clock import DAY_US, HOUR_US
from opsgauge.operators import aggregates, bitmaps, clean, joins, periods, predicates, sets, windows
from opsgauge.plans import digital, field, report
from opsgauge.sources import report_table, tables

STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def strip_sql(c: str) -> str:
    return STRIP.format(c=c)


# ---------------------------------------------------------------- sources and sinks


@query("S01_full_scan", "SELECT * FROM customer")
def full_scan(t):
    return tables.read_table(tables.parquet_source(t.spark, t.sf_dir), "customer")


@query(
    "S02_lookback_scan",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= DATE '2001-08-15' - 2000",
)
def lookback_scan(t):
    source = tables.parquet_source(t.spark, t.sf_dir)
    return tables.read_since(source, "orders", "o_orderdate", AS_OF, 2000).select("o_orderkey", "o_custkey")


@query(
    "S02_lookback_scan_strict",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > DATE '2001-08-15' - 2000",
)
def lookback_scan_strict(t):
    source = tables.parquet_source(t.spark, t.sf_dir)
    return tables.read_since(source, "orders", "o_orderdate", AS_OF, 2000, strict=True).select(
        "o_orderkey", "o_custkey"
    )


@query("S03_projected_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def projected_scan(t):
    source = tables.parquet_source(t.spark, t.sf_dir)
    return tables.read_cols(source, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])


@query("S04_filtered_scan", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def filtered_scan(t):
    source = tables.parquet_source(t.spark, t.sf_dir)
    return tables.read_where(source, "orders", F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "S05_latest_snapshot",
    with_inputs(
        "field_backlog",
        """
SELECT code_maintenance_ibs, installation_number, req_by, age, country FROM field_backlog
WHERE audit_insert_timestamp = (SELECT MAX(audit_insert_timestamp) FROM field_backlog)
""",
    ),
)
def latest_snapshot(t):
    newest = tables.latest_snapshot(t("field_backlog"), "audit_insert_timestamp")
    return newest.select("code_maintenance_ibs", "installation_number", "req_by", "age", "country")


@query(
    "S06_report_rows",
    with_inputs(
        "services_opened",
        f"""
, n AS (
    SELECT period, COUNT(DISTINCT CASE WHEN NOT ie THEN code_maintenance_ibs END) AS uk,
           COUNT(DISTINCT CASE WHEN ie THEN code_maintenance_ibs END) AS ie
    FROM periods LEFT JOIN (
        SELECT *, starts_with(installation_number, '7') AS ie FROM services_opened
        WHERE call_type_code IS DISTINCT FROM '100'
          AND NOT COALESCE(CASE trim(COALESCE(installation_cost_center_code, '')) WHEN 'UK270' THEN 0
                  WHEN 'UK191' THEN 30 WHEN 'UK330' THEN 30 ELSE 90 END >= days_install_to_creation, FALSE)
    ) o ON {in_period("creating_date")} GROUP BY period
)
SELECT 47 AS row, 'field_opened' AS kpi_id, 'field' AS area, 'UK' AS region, CAST(uk AS DOUBLE) AS value,
       'count' AS unit, period FROM n
UNION ALL SELECT 51, 'field_opened_ie', 'field', 'IE', CAST(ie AS DOUBLE), 'count', period FROM n
""",
        OP,
    ),
)
def report_rows(t):
    """The rows that write_report stores; the sink itself is exercised by the tests."""
    return report.report({"opened_services": field.opened_services(t("services_opened"), OP)}).drop("note")


@query(
    "S06_report_history",
    """
WITH n AS (
    SELECT CAST(o_custkey % 7 AS INT) AS run, o_orderpriority AS period, COUNT(*) AS value
    FROM orders WHERE NOT (starts_with(o_orderpriority, '1') AND o_custkey % 7 > 3) GROUP BY ALL
)
SELECT run, period, value FROM n WHERE run <= 5 QUALIFY run = MAX(run) OVER (PARTITION BY period)
""",
)
def report_history(t):
    """Rows of the newest run of each period, as after run 5."""
    run = (F.col("o_custkey") % 7).cast("int")
    kept = t.table("orders").filter(~(F.col("o_orderpriority").startswith("1") & (run > 3)))
    counts = kept.groupBy(run.alias("run"), F.col("o_orderpriority").alias("period")).agg(F.count(F.lit(1)).alias("value"))
    return report_table.newest(counts, until_run=5)


# ---------------------------------------------------------------- projections, cleaning, filters


@query("P01_clean_headers", "SELECT * FROM customer")
def clean_headers(t):
    customer = t.table("customer")
    return clean.clean_headers(customer.toDF(*[f" {c}\t" for c in customer.columns]))


@query(
    "P02_trim_all",
    with_inputs(
        "alarm_incidences",
        "SELECT incidence_number, installation_number, tm_attended, "
        + ", ".join(
            f"{strip_sql(c)} AS {c}"
            for c in ("incidence_type", "cancellation_type", "cancellation_subtype", "country", "panel")
        )
        + " FROM alarm_incidences",
    ),
)
def trim_all(t):
    return clean.trim_all(t("alarm_incidences")).drop("incidence_creation_date")


@query(
    "P03_trim_column",
    with_inputs(
        "portfolio",
        "SELECT installation_number, trim(monitoring_status) AS monitoring_status, contract_status FROM portfolio",
    ),
)
def trim_column(t):
    return clean.trim_col(t("portfolio"), "monitoring_status").drop("panel_group")


@query("P04_subset_rename", with_inputs("devices", "SELECT ins_no AS installation_number, device AS kind FROM devices"))
def subset_rename(t):
    return clean.rename(t("devices"), installation_number="ins_no", kind="device")


@query(
    "P05_derived_columns",
    with_inputs(
        "messages",
        """SELECT ixn_id, mediation_time - queue_workbin_duration AS queue_time, 1 AS counted FROM messages""",
    ),
)
def derived_columns(t):
    wait = F.col("mediation_time") - F.col("queue_workbin_duration")
    return t("messages").withColumns({"queue_time": wait, "counted": F.lit(1)}).select(
        "ixn_id", "queue_time", "counted"
    )


@query(
    "P06_flags",
    with_inputs(
        "chats",
        "SELECT interaction_id, response_time, queue_time, flag_rerouted, "
        + ", ".join(
            f"CASE WHEN response_time - queue_time {op} {n} AND flag_rerouted = 0 THEN 1 ELSE 0 END AS {name}"
            for op, n, name in (
                ("<", 40, "under_40_sec"),
                ("<", 60, "under_60_sec"),
                (">", 120, "over_120_sec"),
                (">", 40, "over_40_sec"),
                ("<", 180, "under_180_sec"),
            )
        )
        + " FROM chats",
    ),
)
def flags(t):
    return digital.chat_flags(t("chats")).drop("report_date", "agent_id", "chat_hour", "chat_queue")


@query(
    "P07_case_rules",
    with_inputs(
        "portfolio",
        """
SELECT installation_number, CASE
    WHEN trim(monitoring_status) = 'OP' AND trim(contract_status) IN ('CUEM', 'CUOP', 'GRAT') THEN 1
    WHEN trim(monitoring_status) = 'STBY' AND trim(contract_status) IN ('CUEM', 'CUOP', 'STBY') THEN 1
    WHEN trim(monitoring_status) = 'XCAN' AND trim(contract_status) IN ('CUEM', 'CUOP') THEN 1
    WHEN trim(monitoring_status) IN ('EDOC', 'INST', 'N/A') AND trim(contract_status) = 'CUOP' THEN 1
    ELSE 0 END AS active
FROM portfolio
""",
    ),
)
def case_rules(t):
    status, contract = text.strip(F.col("monitoring_status")), text.strip(F.col("contract_status"))
    return t("portfolio").select(
        "installation_number", predicates.case_flag(status, contract, V.ACTIVE_RULES).alias("active")
    )


@query(
    "P08_duration_buckets",
    """
SELECT event_id, CASE WHEN value < 24 THEN '24h' WHEN value < 48 THEN '48h' WHEN value < 72 THEN '72h'
                      WHEN value < 168 THEN '3 to 7 days' ELSE 'Over 7 days' END AS bucket
FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events)
""",
)
def duration_buckets(t):
    value = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    bucket = predicates.bucketize(value, V.CLOSING_CUTS, V.CLOSING_ABOVE)
    return t.table("events").select("event_id", bucket.alias("bucket"))


@query(
    "P09_mapped_constant",
    with_inputs(
        "services_opened",
        """
SELECT code_maintenance_ibs, installation_number, warranty,
       CASE WHEN warranty >= days_install_to_creation THEN 'BRANCH' ELSE 'FIELD' END AS desk
FROM (SELECT *, CASE trim(installation_cost_center_code) WHEN 'UK270' THEN 0
                WHEN 'UK191' THEN 30 WHEN 'UK330' THEN 30 ELSE 90 END AS warranty FROM services_opened)
""",
    ),
)
def mapped_constant(t):
    code = text.strip(F.col("installation_cost_center_code"))
    warranty = predicates.map_default(code, V.WARRANTY_DAYS, V.WARRANTY_DAYS_DEFAULT)
    desk = predicates.flag(F.col("warranty") >= F.col("days_install_to_creation"), "BRANCH", "FIELD")
    return t("services_opened").withColumn("warranty", warranty).select(
        "code_maintenance_ibs", "installation_number", "warranty", desk.alias("desk")
    )


CLOSED_COLUMNS = "code_maintenance_ibs, installation_number, status_maintenance, req_by, activity_type, call_type_code"


def closed(t):
    return t("services_closed").select(*CLOSED_COLUMNS.split(", "))


def closed_sql(rule: str) -> str:
    return with_inputs("services_closed", f"SELECT {CLOSED_COLUMNS} FROM services_closed WHERE {rule}")


@query("P10_equal", closed_sql("status_maintenance = 'FINL'"))
def equal(t):
    return predicates.where_eq(closed(t), "status_maintenance", "FINL")


@query("P10_not_equal_keeps_null", closed_sql("req_by IS DISTINCT FROM 'GTI'"))
def not_equal(t):
    return predicates.where_ne(closed(t), "req_by", "GTI")


@query("P11_in_list", closed_sql("call_type_code IN ('MOVE', 'TECH')"))
def in_list(t):
    return predicates.where_in(closed(t), "call_type_code", ["MOVE", "TECH"])


@query(
    "P11_not_in_list_keeps_null",
    closed_sql(f"activity_type IS NULL OR activity_type NOT IN {listed(V.SLA_ACTIVITIES_LEFT_OUT)}"),
)
def not_in_list(t):
    return predicates.where_not_in(closed(t), "activity_type", V.SLA_ACTIVITIES_LEFT_OUT)


@query("P12_prefix", closed_sql("installation_number LIKE '7%'"))
def prefix(t):
    return predicates.where_prefix(closed(t), "installation_number", ["7"])


@query(
    "P12_no_prefix_keeps_null",
    with_inputs(
        "schedule_changed",
        "SELECT service_number, wzprefix FROM schedule_changed "
        "WHERE wzprefix IS NULL OR NOT (wzprefix LIKE 'IE%' OR wzprefix LIKE 'IN%')",
    ),
)
def no_prefix(t):
    kept = predicates.where_prefix(t("schedule_changed"), "wzprefix", ["IE", "IN"], negate=True)
    return kept.select("service_number", "wzprefix")


@query(
    "P12_prefix_but_not_longer",
    with_inputs(
        "care_calls",
        "SELECT interaction_id, caller FROM care_calls WHERE caller LIKE '08%' AND caller NOT LIKE '080%'",
    ),
)
def prefix_but_not_longer(t):
    kept = predicates.where_prefix(t("care_calls"), "caller", ["08"])
    return predicates.where_prefix(kept, "caller", ["080"], negate=True).select("interaction_id", "caller")


@query(
    "P13_contains",
    with_inputs("agents", "SELECT * FROM agents WHERE lower(supervisory_organization) LIKE '%customer service team%'"),
)
def contains(t):
    return predicates.where_contains_ci(t("agents"), "supervisory_organization", "Customer Service Team")


@query(
    "P13_contains_not",
    with_inputs(
        "agents",
        "SELECT * FROM agents WHERE lower(COALESCE(supervisory_organization, '')) NOT LIKE '%south%'",
    ),
)
def contains_not(t):
    return predicates.where_contains_ci(t("agents"), "supervisory_organization", "South", negate=True)


@query("P14_null", closed_sql("req_by IS NULL"))
def null_rows(t):
    return predicates.where_null(closed(t), "req_by")


@query("P14_not_null", closed_sql("req_by IS NOT NULL AND call_type_code IS NOT NULL"))
def not_null_rows(t):
    return predicates.where_not_null(closed(t), "req_by", "call_type_code")


@query(
    "P15_period_whole_days",
    "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'",
)
def period_whole_days(t):
    events = t.table("events")
    return events.filter(periods.in_period(events, "ts", "2024-01-03", "2024-01-27")).select("event_id", "user_id")


@query(
    "P15_period_to_midnight",
    "SELECT event_id, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-27'",
)
def period_to_midnight(t):
    events = t.table("events")
    test = periods.in_period(events, "ts", "2024-01-03", "2024-01-27", mode="instant")
    return events.filter(test).select("event_id", "user_id")


@query(
    "P16_lookback_open",
    "SELECT event_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-29' - 25 AND CAST(ts AS DATE) <= DATE '2024-01-29'",
)
def lookback_open(t):
    events = t.table("events")
    return events.filter(periods.in_lookback(events, "ts", "2024-01-29", 25, closed=False)).select("event_id")


@query(
    "P16_lookback_closed",
    "SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-29' - 25 AND CAST(ts AS DATE) <= DATE '2024-01-29'",
)
def lookback_closed(t):
    events = t.table("events")
    return events.filter(periods.in_lookback(events, "ts", "2024-01-29", 25, closed=True)).select("event_id")


@query(
    "P17_compound_exclusion",
    with_inputs(
        "alarm_incidences",
        """
SELECT incidence_number, incidence_type, cancellation_type, cancellation_subtype FROM alarm_incidences
WHERE (CASE WHEN incidence_type LIKE 'TA%' AND cancellation_type LIKE 'CONFIA%'
             AND cancellation_subtype IN ('INTIME', ' TAMRES') THEN 0 ELSE 1 END) = 1
  AND cancellation_subtype IS DISTINCT FROM 'REST'
""",
    ),
)
def compound_exclusion(t):
    rows = t("alarm_incidences").select(
        "incidence_number", "incidence_type", "cancellation_type", "cancellation_subtype"
    )
    kept = predicates.exclude_when(
        rows,
        F.col("incidence_type").startswith("TA"),
        F.col("cancellation_type").startswith("CONFIA"),
        F.col("cancellation_subtype").isin("INTIME", " TAMRES"),
    )
    return predicates.where_ne(kept, "cancellation_subtype", "REST")


@query(
    "P18_drop_all_null",
    with_inputs(
        "contact_logs",
        """
SELECT comm_log_number, code_key_one, code_key_two, code_key_three FROM contact_logs
WHERE COALESCE(code_key_one, code_key_two, code_key_three) IS NOT NULL
""",
    ),
)
def drop_all_null(t):
    codes = ("code_key_one", "code_key_two", "code_key_three")
    return predicates.drop_all_null(t("contact_logs"), *codes).select("comm_log_number", *codes)


@query(
    "P19_null_replacement",
    with_inputs(
        "tickets_closed",
        """
SELECT ticker_number, COALESCE(close_employee_id, 'none') AS close_employee_id,
       date_diff('day', DATE '2030-01-01', COALESCE(CAST(fecha_desde_asignacion AS DATE), DATE '2030-01-01')) AS days_left
FROM tickets_closed
""",
    ),
)
def null_replacement(t):
    filled = clean.fill(t("tickets_closed"), "close_employee_id", "none")
    filled = clean.fill(filled, "fecha_desde_asignacion", V.NO_ASSIGNMENT_DAY)
    days = F.date_diff(F.to_date("fecha_desde_asignacion"), F.lit(V.NO_ASSIGNMENT_DAY).cast("date"))
    return filled.select("ticker_number", "close_employee_id", days.cast("bigint").alias("days_left"))


# ---------------------------------------------------------------- joins


@query(
    "J01_left_join_dimension",
    "SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey FROM lineitem "
    "LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey",
)
def left_join_dimension(t):
    dim = t.table("supplier").filter(F.col("s_acctbal") > 0)
    return joins.enrich(t.table("lineitem"), dim, "l_suppkey", "s_suppkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "s_nationkey"
    )


@query(
    "J01_left_join_null_matches_null",
    """
WITH f AS (SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS k FROM events),
     d AS (SELECT CASE WHEN n_nationkey = 0 THEN NULL ELSE CAST(n_nationkey AS BIGINT) END AS dk, n_name FROM nation)
SELECT event_id, k, n_name FROM f LEFT JOIN d ON k IS NOT DISTINCT FROM dk
""",
)
def left_join_null_matches_null(t):
    fact = t.table("events").select("event_id", F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("k"))
    dim = t.table("nation").select(
        F.when(F.col("n_nationkey") != 0, F.col("n_nationkey")).cast("bigint").alias("dk"), "n_name"
    )
    return joins.enrich(fact, dim, "k", "dk", null_safe=True).select("event_id", "k", "n_name")


@query(
    "J02_left_join_shared_key",
    with_inputs(
        "portfolio devices",
        """
SELECT p.installation_number, COALESCE(held, 0) AS held FROM portfolio p LEFT JOIN
    (SELECT DISTINCT ins_no, 1 AS held FROM devices WHERE device = 'FG') d ON p.installation_number = d.ins_no
""",
    ),
)
def left_join_shared_key(t):
    held = t("devices").filter(F.col("device") == "FG").select(
        F.col("ins_no").alias("installation_number"), F.lit(1).alias("held")
    )
    out = joins.left_join(t("portfolio"), held.distinct(), "installation_number")
    return out.select("installation_number", F.coalesce("held", F.lit(0)).alias("held"))


@query(
    "J03_matched_only",
    with_inputs(
        "tickets_closed care_staff",
        "SELECT ticker_number, close_employee_id, vresolution FROM tickets_closed "
        "JOIN care_staff ON close_employee_id = employee_id",
    ),
)
def matched_only(t):
    tickets = t("tickets_closed").select("ticker_number", "close_employee_id", "vresolution")
    return joins.matched_only(tickets, t("care_staff"), "close_employee_id", "employee_id")


@query(
    "J03_matched_once",
    with_inputs(
        "tickets_closed care_staff",
        "SELECT ticker_number, close_employee_id, vresolution FROM tickets_closed "
        "WHERE close_employee_id IN (SELECT employee_id FROM care_staff)",
    ),
)
def matched_once(t):
    tickets = t("tickets_closed").select("ticker_number", "close_employee_id", "vresolution")
    return joins.matched_only(
        tickets, t("care_staff"), "close_employee_id", "employee_id", keep_duplicates=False
    )


@query(
    "J03_match_indicator",
    with_inputs(
        "tickets_closed care_staff",
        "SELECT ticker_number, close_employee_id, CASE WHEN close_employee_id IN (SELECT employee_id FROM care_staff) "
        "THEN 1 ELSE 0 END AS matched FROM tickets_closed",
    ),
)
def match_indicator(t):
    tickets = t("tickets_closed").select("ticker_number", "close_employee_id")
    return joins.match_flag(tickets, t("care_staff"), "close_employee_id", "employee_id")


@query(
    "J04_left_join_suffix",
    """
SELECT a.o_orderkey, a.o_custkey, b.o_orderkey AS o_orderkey_workday, b.o_orderstatus
FROM (SELECT o_orderkey, o_custkey FROM orders) a
LEFT JOIN (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH') b
  ON a.o_orderkey = b.o_orderkey
""",
)
def left_join_suffix(t):
    orders = t.table("orders")
    right = orders.filter(F.col("o_orderpriority") == "2-HIGH").select("o_orderkey", "o_orderstatus")
    return joins.left_join_suffix(
        orders.select("o_orderkey", "o_custkey"), right, "o_orderkey", "o_orderkey", "_workday"
    )


@query(
    "J05_any_label",
    with_inputs(
        "field_retention",
        """
SELECT a.code_maintenance_ibs,
       MAX(CASE WHEN r.customer_retained = 'RETAINED' THEN 1 ELSE 0 END) AS retained,
       MAX(CASE WHEN r.customer_retained = 'NOT RETAINED' AND r.reti = 'RETI TAKEOVER' THEN 1 ELSE 0 END) AS takeover,
       MAX(CASE WHEN r.customer_retained = 'PENDING' THEN 1 ELSE 0 END) AS pending
FROM field_retention a LEFT JOIN field_retention r ON a.code_maintenance_ibs = r.code_maintenance_ibs
GROUP BY a.code_maintenance_ibs
""",
    ),
)
def any_label(t):
    outcome = F.col("customer_retained")
    return joins.any_label(
        t("field_retention"),
        "code_maintenance_ibs",
        retained=outcome == V.RETAINED,
        takeover=(outcome == V.NOT_RETAINED) & (F.col("reti") == V.TAKEOVER),
        pending=outcome == V.PENDING,
    )


@query(
    "J05_label_every_row",
    with_inputs(
        "field_retention",
        """
SELECT code_maintenance_ibs, installation_number, technician_identifier,
       MAX(CASE WHEN customer_retained = 'RETAINED' THEN 1 ELSE 0 END) OVER (PARTITION BY code_maintenance_ibs) AS retained
FROM field_retention
""",
    ),
)
def label_every_row(t):
    rows = t("field_retention").select(
        "code_maintenance_ibs", "installation_number", "technician_identifier", "customer_retained"
    )
    return windows.attach_any(
        rows,
        ["code_maintenance_ibs"],
        ["installation_number", "technician_identifier"],
        retained=F.col("customer_retained") == V.RETAINED,
    ).drop("customer_retained")


NOTICES = """
, sent AS (SELECT * FROM notices_sent UNION ALL SELECT * FROM notices_promoted)
"""


@query(
    "J06_latest_per_key",
    "WITH m AS (SELECT l_suppkey AS k, MAX(l_shipdate) AS d FROM lineitem GROUP BY l_suppkey) "
    "SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber FROM lineitem JOIN m ON l_suppkey = k AND l_shipdate = d",
)
def latest_per_key(t):
    rows = t.table("lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    return joins.latest_per_key(rows, "l_suppkey", "l_shipdate").drop("l_shipdate")


MARKED = """
WITH rows_ AS (SELECT event_id, CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS k, ts,
                      CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS code,
                      (event_id * 7919) % 1000003 AS num FROM events),
marked AS (
    SELECT a.*, CASE WHEN num = (SELECT MAX(b.num) FROM rows_ b WHERE b.k = a.k AND b.ts <= a.ts
                                  AND b.ts > a.ts - INTERVAL 6 HOUR) THEN 1 ELSE 0 END AS is_latest FROM rows_ a)
"""
DEDUPE_SQL = MARKED + "SELECT event_id, is_latest FROM marked"
AHEAD_SQL = (
    MARKED
    + """
SELECT a.event_id, COUNT(CASE WHEN <RULE> THEN b.event_id END) AS ahead
FROM marked a LEFT JOIN marked b ON a.k = b.k AND b.is_latest = 1 AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 7 DAY
GROUP BY a.event_id
"""
)
AHEAD_CODE, AHEAD_ANY = AHEAD_SQL.replace("<RULE>", "a.code = b.code"), AHEAD_SQL.replace("<RULE>", "TRUE")


def marked(t):
    rows = t.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 101 != 0, F.col("user_id")).alias("k"),
        "ts",
        F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("event_type")).alias("code"),
        ((F.col("event_id") * 7919) % 1000003).alias("num"),
    )
    return windows.burst_dedupe(rows, ["k"], "ts", "num", 6 * HOUR_US, "is_latest")


@query("J07_trailing_range_join", DEDUPE_SQL)
@query("W02_burst_dedupe", DEDUPE_SQL)
def burst_dedupe(t):
    return marked(t).select("event_id", "is_latest")


def ahead(t, cols):
    counted = windows.forward_counts(
        marked(t), ["k"], "ts", "is_latest", {"ahead": cols}, 7 * DAY_US, 4 * HOUR_US
    )
    return counted.select("event_id", "ahead")


@query("J08_forward_range_join", AHEAD_CODE)
@query("W03_repeat_count_same_code", AHEAD_CODE)
def repeat_count_same_code(t):
    return ahead(t, ["code"])


@query("W04_repeat_count", AHEAD_ANY)
def repeat_count(t):
    return ahead(t, [])


MEMBERS = with_inputs(
    "tickets_open",
    f"SELECT period, ticker_number, type, pais FROM tickets_open JOIN periods ON {in_period('opening_date')}",
    OP,
)


@query("J09_period_membership", MEMBERS)
def period_membership(t):
    return periods.assign_periods(t("tickets_open"), "opening_date", OP).select(
        "period", "ticker_number", "type", "pais"
    )


@query("J09_period_table_membership", MEMBERS)
def period_table_membership(t):
    tickets = t("tickets_open")
    return periods.assign_period_table(tickets, "opening_date", periods.period_frame(t.spark, OP)).select(
        "period", "ticker_number", "type", "pais"
    )


# ---------------------------------------------------------------- aggregates

CALL_KEYS = ("report_date", "report_year", "report_month", "calls_queue", *(
    "skills", "departments", "media_type", "manager"))
CALL_SUMS = ("abandoned_waiting_higher10sec", "accepted_under40sec", "accepted_over120sec", "accepted_agent",
             "service_received")


@query(
    "A01_grouped_sums",
    with_inputs(
        "queue_calls queues",
        f"""
SELECT strftime(report_date, '%Y-%m-%d') AS report_date, {", ".join(CALL_KEYS[1:])},
       {", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in CALL_SUMS)}
FROM queue_calls LEFT JOIN queues ON calls_queue = queues
WHERE {" AND ".join(f"{k} IS NOT NULL" for k in CALL_KEYS)}
GROUP BY ALL
""",
    ),
)
def grouped_sums(t):
    joined = joins.enrich(t("queue_calls"), t("queues"), "calls_queue", "queues")
    sums = aggregates.sum_by(joined, CALL_KEYS, CALL_SUMS)
    return sums.withColumn("report_date", clock.fmt_date(F.col("report_date")))


@query(
    "A02_roll_up_to_year",
    with_inputs(
        "queue_calls",
        f"""
SELECT period, report_year, {", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in CALL_SUMS)}
FROM queue_calls JOIN periods ON {in_period("report_date")} GROUP BY ALL
""",
        OP,
    ),
)
def roll_up_to_year(t):
    dated = periods.assign_periods(t("queue_calls"), "report_date", OP)
    return aggregates.sum_by(dated, ["period", "report_year"], CALL_SUMS)


@query("A03_distinct_count", "SELECT COUNT(DISTINCT l_partkey) AS parts FROM lineitem")
def distinct_count(t):
    return aggregates.nunique(t.table("lineitem"), "l_partkey", alias="parts")


# a text key, numbered first
@query(
    "A03_mergeable_distinct_count",
    with_inputs(
        "services_closed",
        f"""
SELECT period, COUNT(DISTINCT code_maintenance_ibs) AS codes,
       COUNT(DISTINCT CASE WHEN status_maintenance = 'FINL' THEN code_maintenance_ibs END) AS finished,
       COUNT(DISTINCT CASE WHEN req_by = 'GTI' THEN code_maintenance_ibs END) AS internal
FROM periods LEFT JOIN services_closed ON {in_period("closing_finishing_date")} GROUP BY period
""",
        OP,
    ),
)
def mergeable_distinct_count(t):
    rows = t("services_closed")
    rows = rows.join(bitmaps.numbered(rows, "code_maintenance_ibs"), "code_maintenance_ibs")
    marks = {"codes": None, "finished": F.col("status_maintenance") == "FINL", "internal": F.col("req_by") == "GTI"}
    days = bitmaps.day_partials(rows, "closing_finishing_date", "id", **marks)
    return bitmaps.period_counts(days, OP, list(marks))


# weeks, months and years from the same days; whole numbers need no numbering
@query(
    "A02_distinct_roll_up",
    """
SELECT unit, strftime(date_trunc(unit, o_orderdate), '%Y-%m-%d') AS start, COUNT(DISTINCT o_custkey) AS customers,
       COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS finished
FROM orders, (VALUES ('week'), ('month'), ('year')) AS u(unit) GROUP BY ALL
""",
)
def distinct_roll_up(t):
    marks = {"customers": None, "finished": F.col("o_orderstatus") == "F"}
    orders = t.table("orders").withColumn("id", F.col("o_custkey") + 1)
    days = bitmaps.day_partials(orders, "o_orderdate", "id", **marks)
    units = F.array(*[F.struct(F.lit(u).alias("unit"), clock.fmt_date(F.date_trunc(u, "day")).alias("start")) for u in ("week", "month", "year")])
    spread = days.select("*", F.inline(units))
    return bitmaps.counted(spread, ["unit", "start"], list(marks))


@query(
    "A04_grouped_distinct_count",
    "SELECT l_linenumber, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_linenumber",
)
def grouped_distinct_count(t):
    return aggregates.nunique(t.table("lineitem"), "l_partkey", ["l_linenumber"], "parts")


@query(
    "A05_conditional_distinct_counts",
    """
SELECT l_linenumber, COUNT(DISTINCT l_partkey) AS parts,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS returned,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'A' AND l_discount > 0.05 THEN l_partkey END) AS returned_cheap
FROM lineitem GROUP BY l_linenumber
""",
)
def conditional_distinct_counts(t):
    returned = F.col("l_returnflag") == "A"
    return aggregates.distinct_counts(
        t.table("lineitem"),
        "l_partkey",
        ["l_linenumber"],
        parts=None,
        returned=returned,
        returned_cheap=returned & (F.col("l_discount") > 0.05),
    )


@query(
    "A06_open_ratio",
    with_inputs(
        "tickets_open",
        """
SELECT type, COUNT(DISTINCT ticker_number) AS opened,
       COUNT(DISTINCT CASE WHEN closing_date IS NULL THEN ticker_number END) AS still_open,
       round_even(COUNT(DISTINCT CASE WHEN closing_date IS NULL THEN ticker_number END)
                  / COUNT(DISTINCT ticker_number) * 100, 2) AS open_pct
FROM tickets_open GROUP BY type
""",
    ),
)
def open_ratio(t):
    sums = aggregates.distinct_counts(
        t("tickets_open"), "ticker_number", ["type"], opened=None, still_open=F.col("closing_date").isNull()
    )
    return sums.withColumn("open_pct", ratio.pct(F.col("still_open"), F.col("opened")))


@query(
    "A07_counts",
    with_inputs(
        "field_retention",
        """
SELECT technician_identifier, COUNT(*) AS all_rows, COUNT(customer_retained) AS judged,
       COUNT(CASE WHEN customer_retained = 'RETAINED' THEN 1 END) AS retained
FROM field_retention GROUP BY technician_identifier
""",
    ),
)
def counts(t):
    outcome = F.col("customer_retained")
    return aggregates.count_rows(
        t("field_retention"),
        ["technician_identifier"],
        all_rows=F.lit(True),
        judged=outcome.isNotNull(),
        retained=outcome == V.RETAINED,
    )


@query(
    "A08_repeat_groups",
    "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS count, CASE WHEN COUNT(*) >= 3 THEN 1 ELSE 0 END AS repeat "
    "FROM events GROUP BY ALL",
)
def repeat_groups(t):
    dated = t.table("events").withColumn("day", clock.fmt_date(F.col("ts")))
    return aggregates.repeat_groups(dated, ["user_id", "day"], 3)


@query(
    "A09_mean_of_max",
    with_inputs(
        "field_backlog",
        """
SELECT country, round_even(AVG(age), 6) AS mean FROM (
    SELECT country, code_maintenance_ibs, MAX(age) AS age FROM field_backlog
    WHERE code_maintenance_ibs IS NOT NULL GROUP BY ALL) GROUP BY country
""",
    ),
)
def mean_of_max(t):
    out = aggregates.mean_of_max(t("field_backlog"), "code_maintenance_ibs", "age", ["country"])
    return out.withColumn("mean", ratio.round_even(F.col("mean"), 6))


@query(
    "A10_mean_ignoring_null",
    with_inputs("field_backlog", "SELECT req_by, round_even(AVG(age), 6) AS mean FROM field_backlog GROUP BY req_by"),
)
def mean_ignoring_null(t):
    return t("field_backlog").groupBy("req_by").agg(ratio.round_even(F.avg("age"), 6).alias("mean"))


@query(
    "A11_scalar_sum",
    with_inputs(
        "guard_callouts",
        "SELECT CAST(SUM(CAST(responder_dispatch_completed AS INT)) AS BIGINT) AS sent FROM guard_callouts",
    ),
)
def scalar_sum(t):
    return t("guard_callouts").agg(F.sum(F.col("responder_dispatch_completed").cast("int")).alias("sent"))


@query("A12_distinct_rows", with_inputs("devices", "SELECT DISTINCT ins_no, device FROM devices"))
def distinct_rows(t):
    return aggregates.distinct_rows(t("devices"), "ins_no", "device")


ONCE = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) = 1
"""


@query("A13_dedupe_first", ONCE)
def dedupe_first(t):
    rows = t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")]
    return aggregates.dedupe_first(rows, "l_orderkey", order).drop("l_shipdate")


@query(
    "A14_percentages",
    """
SELECT l_suppkey, round_even(a / NULLIF(n, 0) * 100, 2) AS share, a / NULLIF(n, 0) * 100 AS exact,
       COALESCE(round_even(a / NULLIF(b, 0) * 100, 2), 0) AS guarded
FROM (SELECT l_suppkey, COUNT(*) AS n, COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) AS a,
             COUNT(CASE WHEN l_quantity > 49 AND l_linenumber = 7 AND l_tax > 0.07 THEN 1 END) AS b
      FROM lineitem GROUP BY l_suppkey)
""",
)
def percentages(t):
    n = aggregates.count_rows(
        t.table("lineitem"),
        ["l_suppkey"],
        n=F.lit(True),
        a=F.col("l_returnflag") == "A",
        b=(F.col("l_quantity") > 49) & (F.col("l_linenumber") == 7) & (F.col("l_tax") > 0.07),
    )
    return n.select(
        "l_suppkey",
        ratio.pct(F.col("a"), F.col("n")).alias("share"),
        ratio.pct(F.col("a"), F.col("n"), places=None).alias("exact"),
        ratio.pct(F.col("a"), F.col("b"), zero=0).alias("guarded"),
    )


@query("A15_grouped_max", "SELECT l_partkey, MAX(l_quantity) AS l_quantity FROM lineitem GROUP BY l_partkey")
def grouped_max(t):
    return aggregates.max_by_key(t.table("lineitem"), "l_partkey", "l_quantity")


# ---------------------------------------------------------------- windows


@query(
    "W01_first_session",
    """
WITH m AS (SELECT event_id, CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS k, date_trunc('hour', ts) AS ts FROM events)
SELECT event_id, CASE WHEN ts = MIN(ts) OVER (PARTITION BY k) AND k IS NOT NULL THEN 1 ELSE 0 END AS first_flag FROM m
""",
)
def first_session(t):
    rows = t.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 101 != 0, F.col("user_id")).alias("k"),
        F.date_trunc("hour", "ts").alias("ts"),
    )
    return windows.first_in_group(rows, ["k"], "ts").select("event_id", "first_flag")


PLACES = """
WITH once AS (
    SELECT l_orderkey AS code, l_partkey AS installation, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) = 1
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY installation ORDER BY l_shipdate, code) AS place FROM once
)
"""


def once(t):
    return dedupe_first_rows(t).select(
        F.col("l_orderkey").alias("code"), F.col("l_partkey").alias("installation"), "l_shipdate"
    )


def dedupe_first_rows(t):
    rows = t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")]
    return aggregates.dedupe_first(rows, "l_orderkey", order)


@query(
    "W05_has_previous",
    PLACES + "SELECT code, installation, CASE WHEN place > 1 THEN 1 ELSE 0 END AS has_previous FROM placed",
)
def has_previous(t):
    out = windows.has_previous(once(t), ["installation"], "l_shipdate", ["code"])
    return out.select("code", "installation", "has_previous")


@query("W05_place_in_group", PLACES + "SELECT code, installation, place FROM placed")
def place_in_group(t):
    out = windows.place_in_group(once(t), ["installation"], "l_shipdate", ["code"])
    return out.select("code", "installation", "place")


@query(
    "W06_top_row_per_key",
    "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
)
def top_row_per_key(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    rows = t.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return aggregates.dedupe_first(rows, "o_custkey", order).drop("o_totalprice")


# ---------------------------------------------------------------- order and sets


@query("O01_sort", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def sort(t):
    return t.table("orders").select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


@query(
    "O02_first_group",
    with_inputs(
        "queue_calls",
        f"""
SELECT period, round_even(u / NULLIF(a, 0) * 100, 2) AS under_40_pct FROM (
    SELECT period, report_year, SUM(accepted_under40sec) AS u, SUM(accepted_agent) AS a
    FROM queue_calls JOIN periods ON {in_period("report_date")} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY period ORDER BY report_year) = 1
""",
        OP,
    ),
)
def first_group(t):
    dated = periods.assign_periods(t("queue_calls"), "report_date", OP)
    years = aggregates.sum_by(dated, ["period", "report_year"], ["accepted_under40sec", "accepted_agent"])
    value = ratio.pct(F.col("accepted_under40sec"), F.col("accepted_agent"))
    return aggregates.first_group(years, ["period"], "report_year", under_40_pct=value)


@query(
    "U01_union_by_position",
    with_inputs(
        "notices_sent notices_promoted",
        "SELECT contract, notice FROM (SELECT * FROM notices_sent UNION ALL SELECT * FROM notices_promoted)",
    ),
)
def union_by_position(t):
    return sets.union_by_position(t("notices_sent"), t("notices_promoted")).select("contract", "notice")


BRACKETS = """
SELECT CASE WHEN l_quantity < {n} THEN 'under {n}' ELSE 'not under {n}' END AS bracket,
       COUNT(DISTINCT l_orderkey) AS codes FROM lineitem GROUP BY bracket
"""


@query("U02_union_by_name", f"{BRACKETS.format(n=24)} UNION ALL {BRACKETS.format(n=48)}")
def union_by_name(t):
    def bracket(n):
        label = predicates.flag(F.col("l_quantity") < n, f"under {n}", f"not under {n}")
        rows = t.table("lineitem").withColumn("bracket", label)
        return aggregates.nunique(rows, "l_orderkey", ["bracket"], "codes")

    return sets.union_by_name(bracket(24), bracket(48))


@query(
    "U03_side_by_side",
    "SELECT (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS holders, "
    "(SELECT COUNT(DISTINCT l_partkey) FROM lineitem) AS parts",
)
def side_by_side(t):
    return sets.hconcat(
        aggregates.nunique(t.table("orders"), "o_custkey", alias="holders"),
        aggregates.nunique(t.table("lineitem"), "l_partkey", alias="parts"),
    )


# ---------------------------------------------------------------- scalar functions


@query(
    "F01_strip",
    f"SELECT doc_id, length({strip_sql('padded')}) AS n FROM "
    "(SELECT doc_id, ' ' || chr(9) || text || chr(10) || ' ' AS padded FROM documents)",
)
def strip(t):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("\n "))
    return t.table("documents").select("doc_id", F.length(text.strip(padded)).cast("bigint").alias("n"))


@query(
    "F02_starts_with",
    "SELECT p_partkey, CAST(p_name LIKE 'small%' OR p_name LIKE 'red%' AS INT) AS hit FROM part",
)
def starts_with(t):
    return t.table("part").select(
        "p_partkey", text.starts_with(F.col("p_name"), "small", "red").cast("int").alias("hit")
    )


@query("F03_contains", "SELECT doc_id, CAST(text ILIKE '%license%' AS INT) AS hit FROM documents")
def contains_text(t):
    return t.table("documents").select(
        "doc_id", text.contains_ci(F.col("text"), "License").cast("int").alias("hit")
    )


@query("F04_replace", "SELECT o_orderkey, replace(CAST(o_totalprice AS VARCHAR), '.0', '') AS price FROM orders")
def replace(t):
    price = text.replace_literal(F.col("o_totalprice").cast("string"), ".0", "")
    return t.table("orders").select("o_orderkey", price.alias("price"))


@query(
    "F05_casts",
    with_inputs(
        "services_closed",
        """
SELECT code_maintenance_ibs, CAST(COALESCE(TRY_CAST(trim(technician_line_code) AS DOUBLE), 0) AS BIGINT) AS line,
       CAST(CAST(COALESCE(TRY_CAST(trim(technician_line_code) AS DOUBLE), 0) AS BIGINT) AS VARCHAR) AS line_code
FROM services_closed
""",
    ),
)
def casts(t):
    c = F.col("technician_line_code")
    return t("services_closed").select(
        "code_maintenance_ibs", text.to_int(c).alias("line"), text.line_code(c).alias("line_code")
    )


@query(
    "F06_parse_timestamp",
    """
WITH x AS (SELECT event_id, ts, CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS iso,
                  strftime(ts, '%Y-%b-%d %I:%M:%S') AS named, strftime(ts, '%d/%m/%Y %I:%M:%S') AS day_first FROM events)
SELECT event_id, epoch_us(try_strptime(iso, '%Y-%m-%d %H:%M:%S')) AS iso,
       epoch_us(date_trunc('day', ts) + INTERVAL 1 SECOND * ((hour(ts) % 12) * 3600 + minute(ts) * 60 + floor(second(ts)))) AS named,
       epoch_us(date_trunc('day', ts) + INTERVAL 1 SECOND * ((hour(ts) % 12) * 3600 + minute(ts) * 60 + floor(second(ts)))) AS day_first
FROM x
""",
)
def parse_timestamp(t):
    ts = F.col("ts")
    iso = F.when(F.col("event_id") % 11 == 0, "n/a").otherwise(F.date_format(ts, clock.ISO))
    named, day_first = F.date_format(ts, clock.MONTH_NAME_12H), F.date_format(ts, clock.DAY_FIRST_12H)
    return t.table("events").select(
        "event_id",
        clock.micros(clock.parse_ts(iso, clock.ISO)).alias("iso"),
        clock.micros(clock.parse_ts(named, clock.MONTH_NAME_12H, strict=True)).alias("named"),
        clock.micros(clock.parse_ts(day_first, clock.DAY_FIRST_12H)).alias("day_first"),
    )


@query(
    "F07_format_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(strftime(o_orderdate, '%U') AS INT) AS week FROM orders",
)
def format_date(t):
    d = F.col("o_orderdate")
    return t.table("orders").select("o_orderkey", clock.fmt_date(d).alias("day"), clock.week_u(d).alias("week"))


@query(
    "F08_time_differences",
    with_inputs(
        "escalations",
        """
SELECT ticket_number_closed,
       round_even(date_diff('microsecond', creation_datetime, closing_date_time) / 3600000000.0, 2) AS hours,
       CAST(floor(date_diff('second', creation_datetime, closing_date_time) / 86400.0) AS BIGINT) AS days
FROM escalations
""",
    ),
)
def time_differences(t):
    start, end = F.col("creation_datetime"), F.col("closing_date_time")
    return t("escalations").select(
        "ticket_number_closed",
        clock.hours_between(start, end).alias("hours"),
        clock.days_floor(start, end).alias("days"),
    )


@query(
    "F09_business_days",
    "WITH "
    + calendar(
        "SELECT DISTINCT CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    ).strip()[2:]
    + """
SELECT l_orderkey, l_linenumber, n AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN spans ON a = CAST(o_orderdate AS DATE) AND b = CAST(l_shipdate AS DATE)
""",
)
def business_days(t):
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = bizdays.business_days(F.col("o_orderdate"), F.col("l_shipdate"), HOLIDAYS)
    return joined.select("l_orderkey", "l_linenumber", days.alias("days"))


SPANS = "date_diff('day', o_orderdate, l_shipdate)"


@query(
    "F10_toward_zero",
    f"SELECT l_orderkey, {SPANS} - CAST(sign({SPANS}) AS BIGINT) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def toward_zero(t):
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.date_diff("l_shipdate", "o_orderdate").cast("bigint")
    return joined.select("l_orderkey", bizdays.toward_zero(days).alias("days"))


@query(
    "F11_clip_low",
    f"SELECT l_orderkey, CASE WHEN {SPANS} < 0 THEN 0 ELSE {SPANS} END AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def clip_low(t):
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", bizdays.clip_low(F.date_diff("l_shipdate", "o_orderdate")).cast("bigint").alias("days"))


@query(
    "F12_shifts",
    """
SELECT event_id, epoch_us(ts - INTERVAL 10 MINUTE) AS before, epoch_us(ts + INTERVAL 30 DAY) AS after,
       strftime(CAST(ts AS DATE) - 41, '%Y-%m-%d') AS day, strftime(date_trunc('week', ts), '%Y-%m-%d') AS monday
FROM events
""",
)
def shifts(t):
    ts = F.col("ts")
    return t.table("events").select(
        "event_id",
        clock.micros(clock.shift_time(ts, -10, "mins")).alias("before"),
        clock.micros(clock.shift_time(ts, 30, "days")).alias("after"),
        clock.fmt_date(clock.shift_time(clock.as_date(ts), -41, "date")).alias("day"),
        clock.fmt_date(clock.monday_of(ts)).alias("monday"),
    )


@query("F13_round_half_even", "SELECT event_id, round_even(value / 8, 2) AS eighth FROM events")
def round_half_even(t):
    return t.table("events").select("event_id", ratio.round_even(F.col("value") / 8).alias("eighth"))


@query(
    "F14_percent_text",
    "SELECT l_suppkey, CAST(round_even(COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) / COUNT(*) * 100, 2) AS VARCHAR) || '%' AS share "
    "FROM lineitem GROUP BY l_suppkey",
)
def percent_text(t):
    n = aggregates.count_rows(t.table("lineitem"), ["l_suppkey"], n=F.lit(True), a=F.col("l_returnflag") == "A")
    share = ratio.pct(F.col("a"), F.col("n"))
    return n.select("l_suppkey", text.as_percent_text(share).alias("share"))


@query(
    "F15_as_date",
    "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS n, "
    "COUNT(CASE WHEN CAST(ts AS DATE) > DATE '2024-01-15' THEN 1 END) AS late FROM events GROUP BY 1",
)
def as_date(t):
    day = clock.as_date(F.col("ts"))
    return (
        t.table("events")
        .groupBy(day.alias("d"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(day > F.lit("2024-01-15").cast("date")).alias("late"))
        .select(clock.fmt_date(F.col("d")).alias("day"), "n", "late")
    )
