"""Merging batches into a stored table: equal to one pass over all, few buckets rewritten, no extra exchange."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from starmill.operators.dedup import latest_per_key
from starmill.operators.quality import key_report
from starmill.plans.contracts import FACT, Contract
from starmill.sinks.buckets import BucketedTable
from starmill.sinks.records import subfolders
from starmill.sinks.tables import publish
from starmill.workload import queries

SCHEMA = T.StructType().add("order_id", "string").add("item_seq", "string").add("at", "integer").add("value", "string")
KEYS = ("order_id", "item_seq")


def latest(df, keys):
    return latest_per_key(df, keys, [F.col("at").desc_nulls_last()])


@pytest.fixture
def table(tmp_path):
    return BucketedTable(f"{tmp_path}/lines", SCHEMA, KEYS, 32, latest)


def content(df):
    return sorted(map(tuple, df.select(*SCHEMA.names).collect()), key=str)


def test_batches_in_turn_equal_all_at_once(spark, table):
    draw = random.Random(4)
    assert table.read(spark).collect() == [] and table.merge(spark.createDataFrame([], SCHEMA)).touched == 0
    batches = []
    for _ in range(5):
        rows = [(draw.choice(["a", "b", None, "c"]), str(draw.randint(0, 9)), draw.choice([1, 2, 3, None]), draw.choice("xyz")) for _ in range(60)]
        batches.append(spark.createDataFrame(rows + [("hot", "1", draw.randint(1, 9), "h")] * 100, SCHEMA))
    for batch in (*batches[:3], batches[2], *batches[3:]):  # one comes twice
        table.merge(batch.withColumn("other", F.lit(1)))
    every = batches[0]
    for batch in batches[1:]:
        every = every.unionByName(batch)
    assert content(table.read(spark)) == content(latest(every, KEYS))


def test_only_touched_buckets_are_rewritten(spark, table):
    table.merge(spark.createDataFrame([(f"o{i}", "1", 1, "old") for i in range(400)], SCHEMA))
    before = table._records(spark).latest()["folders"]
    done = table.merge(spark.createDataFrame([("o1", "1", 2, "new"), ("o2", "1", 0, "late")], SCHEMA))
    after = table._records(spark).latest()["folders"]
    assert done.touched == sum(before[b] != after[b] for b in after) <= 2 and done.buckets == len(after) == 32
    got = {r.order_id: r.value for r in table.read(spark).collect()}
    assert len(got) == 400 and got["o1"] == "new" and got["o2"] == "old"


def test_a_merge_that_dies_changes_nothing(spark, table, monkeypatch):
    table.merge(spark.createDataFrame([("a", "1", 1, "x")], SCHEMA))
    with monkeypatch.context() as patch:
        patch.setattr("starmill.sinks.records.Records.add", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.merge(spark.createDataFrame([("a", "1", 2, "y")], SCHEMA))
    assert content(table.read(spark)) == [("a", "1", 1, "x")]


def test_superseded_folders_go(spark, table):
    for n in range(4):
        table.merge(spark.createDataFrame([(f"o{i}", "1", n, f"v{n}") for i in range(0, 40, n + 1)], SCHEMA))
    reader, rows = table.read(spark), content(table.read(spark))
    assert table.drop_superseded(spark) > 0 and content(reader) == rows
    assert table.drop_superseded(spark) == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_grain_of_a_bucketed_table_is_checked_without_moving_keys(spark, database):
    contract = Contract("lines", SCHEMA, KEYS)
    rows = spark.range(1000).selectExpr("CAST(id DIV 3 AS STRING) AS order_id", "CAST(id % 3 AS STRING) AS item_seq", "1 AS at", "'v' AS value")
    publish(rows, database, contract)
    assert "Exchange hashpartitioning" in plan(key_report(spark.table(f"{database}.lines"), "lines", KEYS))
    publish(rows, database, contract, buckets=(8, KEYS))
    report = key_report(spark.table(f"{database}.lines"), "lines", KEYS)
    assert "Exchange hashpartitioning" not in plan(report)
    assert [(r.row_count, r.violations) for r in report.collect()] == [(1000, 0)] * 2


def test_a_bucketed_refresh_moves_lines_once(spark, tmp_path):
    from starmill import fixed_values as fixed
    from starmill.plans import gold
    from starmill.plans.contracts import SILVER
    from starmill.sources.literals import rate_lookup
    from starmill.workload.queries import clean, customers_dimension

    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/bucketed'")
    items = clean(spark, "/root/testdata/sf0.001", "order_items").withColumns({"_source_file": F.lit("f"), "_ingested_at": F.current_timestamp()})
    publish(items.select(*SILVER["order_items"].columns), "bucketed", SILVER["order_items"], buckets=(8, KEYS))
    stored = spark.table(f"bucketed.{SILVER['order_items'].name}")
    fact = gold.fact_order_items(stored, rate_lookup(spark, fixed.INR_PER_UNIT), customers_dimension(spark, "/root/testdata/sf0.001"))
    fact_side = plan(fact.groupBy(*FACT.grain).count())
    scan = next(line for line in fact_side.splitlines() if "slv_order_items" in line and "FileScan" in line)
    assert "Bucketed: true" in scan
    above = fact_side[: fact_side.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in above


def test_few_buckets_are_divided_among_tasks(spark, tmp_path):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        schema = spark.range(0).selectExpr("id AS key", "id AS at").schema
        table = BucketedTable(str(tmp_path), schema, ["key"], 2, latest)
        table.merge(spark.range(500).selectExpr("id AS key", "1L AS at"))
        table.merge(spark.range(250, 750).selectExpr("id AS key", "2L AS at"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    stored = table.read(spark)
    assert len(stored.inputFiles()) > 2
    assert sorted(map(tuple, stored.collect())) == [(k, 1 if k < 250 else 2) for k in range(750)]


def test_a_merge_leaves_only_rows(spark, table, shuffles_left):
    """Its exchanges and the reduced batch go with it, also when nothing was to be merged."""
    for rows in ([("o1", "1", 1, "old"), ("o2", "1", 1, "old")], [], [("o1", "1", 2, "new")]):
        table.merge(spark.createDataFrame(rows, SCHEMA))
    folders = set(subfolders(spark, f"{table.root}/rows"))
    assert not shuffles_left() and not [f for f in folders if f.endswith("-batch")]
    assert sorted(r.value for r in table.read(spark).collect()) == ["new", "old"]


def test_the_merging_query_keeps_one_state(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(queries, "BucketedTable", lambda *a: tables.append(BucketedTable(*a)) or tables[-1])
    queries.QUERIES["merged_lines"](spark, "/root/testdata/sf0.001")
    root = tables[0].root
    kept = sum(len(subfolders(spark, f"{root}/rows/{run}")) for run in subfolders(spark, f"{root}/rows"))
    assert kept == 16
