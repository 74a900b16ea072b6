"""The physical plans are the intended ones."""

import re

import pytest

from starmill import fixed_values as fixed
from starmill.operators.lookups import BroadcastBudget
from starmill.operators.members import remap_orphans
from starmill.operators.quality import key_report
from starmill.plans import gold, silver
from starmill.plans.contracts import RAW, SILVER
from starmill.sources.literals import rate_lookup, region_lookup


@pytest.fixture(scope="module")
def silver_items(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "items")
    spark.createDataFrame([], SILVER["order_items"].schema).write.parquet(path)
    return spark.read.schema(SILVER["order_items"].schema).parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _fact_stays(plan):
    """No exchange or sort between the fact's file scan, the leftmost leaf, and the result."""
    path = plan[: plan.index("FileScan parquet")]
    return "Exchange" not in path and "Sort" not in path


def test_fact_moves_no_rows_while_lookups_fit(spark, silver_items):
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    plan = _plan(gold.fact_order_items(silver_items, rate_lookup(spark, fixed.INR_PER_UNIT), customers))
    assert plan.count("BroadcastHashJoin") == 2
    assert _fact_stays(plan)


def test_fact_reads_no_audit_columns(spark, silver_items):
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    plan = _plan(gold.fact_order_items(silver_items, rate_lookup(spark, fixed.INR_PER_UNIT), customers))
    read = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "_source_file" not in read and "_processed_at" not in read


def test_few_orphans_of_a_large_dimension_leave_the_fact_in_place(spark, silver_items):
    customers = spark.range(1000).selectExpr("'C' || id AS customer_id")
    rates = rate_lookup(spark, fixed.INR_PER_UNIT)
    plan = _plan(gold.fact_order_items(silver_items, rates, customers, BroadcastBudget(rows=500)))
    assert plan.count("BroadcastHashJoin") == 2 and _fact_stays(plan)


def test_many_orphans_of_a_large_dimension_are_shuffled_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).selectExpr("'X' || id AS customer_id")
        customers = spark.range(100).selectExpr("'C' || id AS customer_id")
        resolved = remap_orphans(fact, customers, "customer_id", fixed.UNKNOWN_KEY, BroadcastBudget(rows=50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _plan(resolved).count("SortMergeJoin") == 1
    assert resolved.where("customer_id = '-1'").count() == 100


def test_silver_items_shuffle_once(spark):
    text = ", ".join(f"{c} string" for c in [*RAW["order_items"].names, "_source_file"])
    raw = spark.createDataFrame([], text)
    plan = _plan(silver.order_items(raw))
    assert plan.count("Exchange hashpartitioning") == 1


def test_customer_region_is_a_broadcast_of_a_constant(spark):
    customers = spark.createDataFrame([], SILVER["customers"].schema)
    plan = _plan(gold.with_region(customers, region_lookup(spark, fixed.REGION_BY_COUNTRY_STATE)))
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan and "hashpartitioning" not in plan


def test_lookups_stated_in_code_are_measured_without_a_job(spark):
    customers = spark.createDataFrame([], SILVER["customers"].schema)
    regions = region_lookup(spark, fixed.REGION_BY_COUNTRY_STATE)
    spark.sparkContext.setJobGroup("literals", "literals")
    gold.with_region(customers, regions)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("literals")


def test_orphans_are_reconciled_through_a_join(spark, tmp_path):
    fact = spark.range(10).selectExpr("'C' || id AS customer_id", "CAST(id AS DECIMAL(24,2)) AS amount")
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    moved = remap_orphans(fact, customers, "customer_id", fixed.UNKNOWN_KEY)
    known = moved.groupBy((moved["customer_id"] == fixed.UNKNOWN_KEY).alias("unknown")).sum("amount")
    assert "Join" in known._jdf.queryExecution().optimizedPlan().toString()


def test_missing_keys_are_filtered_at_the_scan(spark, tmp_path):
    schema = SILVER["customers"].schema
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/c")
    plan = _plan(silver.customers(spark.read.schema(schema).parquet(f"{tmp_path}/c")))
    assert "PushedFilters: [IsNotNull(customer_id)]" in plan


def test_grain_check_reads_only_the_keys(spark, silver_items):
    plan = _plan(key_report(silver_items, "t", ["order_id", "item_seq"]))
    assert "ReadSchema: struct<order_id:string,item_seq:int>" in plan
    assert "partial_count" in plan
