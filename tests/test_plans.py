"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.registry import QUERIES as catalog_queries
from opsgauge.operators import aggregates, joins, periods
from opsgauge.operators.periods import Period

# the optional subpackage has its own tests
QUERIES = {k: q for k, q in entry.queries().items() if k in catalog_queries}
# ungrouped aggregates put side by side, one row each
ONE_ROW_SIDES = {"K24_backlog_size", "K28_backlog_age", "K40_field_backlog", "U03_side_by_side"}
REPORTS = {"K42_report", "K42_report_pivot"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - REPORTS))
def test_no_pairs_and_no_python(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "Python" not in text and "InPandas" not in text
    assert "Expand" not in text
    if key not in ONE_ROW_SIDES:
        assert "NestedLoop" not in text


def scans(text):
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)


def test_period_bounds_reach_the_scan(spark, sf_dir):
    filters, columns = next(
        s for s in scans(plan(QUERIES["K01_queue_sla"](spark, sf_dir))) if "l_shipdate" in s[1]
    )
    assert "GreaterThanOrEqual(l_shipdate,1995-01-01" in filters
    assert "LessThan(l_shipdate,2001-11-11" in filters
    assert "l_extendedprice" not in columns and "l_partkey" not in columns


def test_lookback_reaches_the_scan(spark, sf_dir):
    filters, columns = scans(plan(QUERIES["S02_lookback_scan"](spark, sf_dir)))[0]
    assert "GreaterThanOrEqual(o_orderdate" in filters
    assert "o_totalprice" not in columns


def test_status_filter_reaches_the_scan(spark, sf_dir):
    filters, _ = scans(plan(QUERIES["S04_filtered_scan"](spark, sf_dir)))[0]
    assert "EqualTo(o_orderstatus,F)" in filters


def test_all_periods_share_one_scan(spark, sf_dir):
    spans = [Period(str(n), f"199{n}-01-01", f"199{n}-12-31") for n in range(5, 10)]
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(periods.assign_periods(orders, "o_orderdate", spans).groupBy("period").count())
    assert text.count("FileScan") == 1
    assert "Join" not in text


def test_first_rows_are_picked_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(aggregates.dedupe_first(orders, "o_custkey", [F.col("o_orderkey")]))
    # plans print from the last step to the first, so the early limit comes after the exchange
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_ties_of_a_hot_key_do_not_meet(spark):
    """A third of all rows tie for the newest of one key: the join by shuffle splits them."""
    rows = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("k"),
        F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 7).alias("o"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        latest = joins.latest_per_key(rows, "k", "o")
        assert "Window" not in plan(latest)
        by_task = latest.groupBy("k", F.spark_partition_id().alias("task")).agg(F.count("text").alias("n"), F.max("text"))
        split = [r["n"] for r in by_task.collect() if r["k"] == 0]
        assert len(split) > 4 and sum(split) == 200_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_distinct_counts_combine_before_the_shuffle(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(aggregates.distinct_counts(items, "l_partkey", ["l_linenumber"], n=None, a=F.col("l_tax") > 0))
    assert text.count("Exchange") == 2
    assert text.index("Exchange", text.index("Exchange") + 1) < text.rindex("HashAggregate")


def test_windows_spread_a_key_over_slots(spark, sf_dir):
    """No exchange of the contact rows is on the key alone."""
    text = plan(QUERIES["W02_burst_dedupe"](spark, sf_dir))
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", text)
    assert keys and all("_slot" in k for k in keys)


def test_report_reads_the_call_intervals_once(spark, sf_dir):
    text = plan(QUERIES["K42_report"](spark, sf_dir))
    assert len([s for s in scans(text) if "l_discount" in s[1] and "l_quantity" in s[1] and "l_tax" in s[1]]) == 1


def final_plan(df):
    """The plan that ran, with exchanges made once shown as reused."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", ["K04_first_contact_resolution", "K05_repeat_contact"])
def test_bursts_are_judged_once(spark, sf_dir, key):
    """The rows of the windows and the totals of their slots come from one exchange."""
    text = final_plan(QUERIES[key](spark, sf_dir))
    assert text.count("Scan parquet") == 1
    # a burst window is one over the largest number
    assert len(re.findall(r"Window \[.*max\(", text)) == 2
    assert "ReusedExchange" in text


def test_place_in_group_deals_rows_once(spark, sf_dir):
    from opsgauge.operators.aggregates import dedupe_first
    from opsgauge.operators.windows import place_in_group

    orders = dedupe_first(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey", [F.col("o_orderdate")])
    text = final_plan(place_in_group(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]))
    # one that deduplicates, one within slots, one over slots
    assert len(re.findall(r"\bWindow \[", text)) == 3
    assert text.count("Scan parquet") == 1 and "ReusedExchange" in text


def test_field_retention_deals_visits_once(spark, sf_dir):
    """Visits go to the slots of their code, not to (code, installation) before; a hot pair is spread."""
    text = final_plan(QUERIES["K19_field_retention"](spark, sf_dir))
    dealt = re.findall(r"[-:] Exchange hashpartitioning\((.*?), \d+\)", text)
    assert not [k for k in dealt if "code_maintenance_ibs" in k and "installation_number" in k]
    assert len([k for k in dealt if re.match(r"_k0#\d+, _n0#\d+, _slot#", k)]) == 1
