"""Broadcast and spread joins agree, and the spread join survives hot keys and NULLs."""

import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from starmill.operators.lookups import BroadcastBudget, frequent_keys, left_lookup

NO_BROADCAST = BroadcastBudget(rows=0)


def _both(fact, lookup, on):
    return [left_lookup(fact, lookup, on, budget) for budget in (BroadcastBudget(), NO_BROADCAST)]


def test_budget_counts_rows_and_bytes(spark):
    df = spark.range(10).select(F.lit("x" * 10).alias("text"))
    assert BroadcastBudget(rows=10, bytes=100).admits(df)
    assert not BroadcastBudget(rows=9, bytes=100).admits(df)
    assert not BroadcastBudget(rows=10, bytes=99).admits(df)
    assert BroadcastBudget().admits(df.where("false"))


def test_hot_keys_are_found(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("key"))
    hottest = max(frequent_keys(df, [F.col("key")]), key=lambda pair: pair[1])
    wanted = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert hottest[0] == wanted and abs(hottest[1] - 1 / 3) < 0.01


def test_no_rows_means_no_hot_keys(spark):
    assert frequent_keys(spark.range(5).where("false"), [F.col("id")]) == []


@pytest.mark.parametrize("copies", [1, 2])
def test_hot_null_and_missing_keys(spark, rows, copies):
    fact = spark.range(6000, numPartitions=4).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
    )
    lookup = spark.createDataFrame(
        [("hot", "H")] * copies + [(f"k{n}", f"v{n}") for n in range(0, 50, 2)] + [(None, "never")],
        "code string, value string",
    )
    sent, spread = _both(fact, lookup, {"code": F.col("key")})
    assert spread.columns == sent.columns == ["row", "key", "value"]
    assert rows(spread) == rows(sent)
    assert spread.count() == 6000 + 2000 * (copies - 1)


def test_a_hot_key_reaches_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # Exact copies of one row, so only their partition and the fan can tell them apart.
        fact = spark.range(16000, numPartitions=8).select(F.lit("hot").alias("key"))
        lookup = spark.createDataFrame([("hot", "H"), ("cold", "C")], "code string, value string")
        joined = left_lookup(fact, lookup, {"code": F.col("key")}, NO_BROADCAST)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 16000 and max(sizes) <= 16000 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_key_types_and_map_columns_do_not_matter(spark, rows):
    fact = spark.range(200).selectExpr("id + CAST(3000000000 AS BIGINT) * (id % 2) AS key", "map('n', id) AS extra", "id")
    lookup = spark.range(50).selectExpr("CAST(id AS INT) AS code", "'v' || id AS value")
    sent, spread = _both(fact, lookup, {"code": F.col("key")})
    assert rows(spread, "id", "value") == rows(sent, "id", "value")
    assert spread.where("value IS NOT NULL").count() == 25


def test_thousands_of_warm_keys(spark, rows):
    fact = spark.range(20000).selectExpr("id % 5000 AS key", "id")
    lookup = spark.range(5000).selectExpr("id AS code", "id * 2 AS value")
    sent, spread = _both(fact, lookup, {"code": F.col("key")})
    assert spread.count() == 20000 and rows(spread.agg(F.sum("value"))) == rows(sent.agg(F.sum("value")))


_key = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_key, _key), min_size=1, max_size=30), st.lists(st.tuples(_key, _key), min_size=1, max_size=8))
def test_composite_keys_match_nested_loops(spark, rows, facts, members):
    expected = []
    for n, (a, b) in enumerate(facts):
        hits = [m for m, (x, y) in enumerate(members) if a is not None and b is not None and (a, b) == (x, y)]
        expected += [(n, hit) for hit in hits or [None]]
    fact = spark.createDataFrame([(n, *f) for n, f in enumerate(facts)], "n int, a int, b int")
    lookup = spark.createDataFrame([(*m, n) for n, m in enumerate(members)], "x int, y int, hit int")
    wanted = sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
    for joined in _both(fact, lookup, {"x": F.col("a"), "y": F.col("b")}):
        assert rows(joined, "n", "hit") == wanted
